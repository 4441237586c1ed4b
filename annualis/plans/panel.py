"""The whole job: raw sources of any number of extract years -> stage tables -> panel.

There is no loop over years or cohorts: each source is one scan over all extracts, and every
step is one DataFrame expression. With a stage folder each step is written to Parquet and read
back, which cuts the lineage and lets a run resume; without one the same steps compose into a
single lazy plan.
"""

from base64 import b64encode
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from annualis import codes
from annualis.operators import (
    annualise, assemble_panel, attach_contributions, cohort_of, consolidate_entity,
    demographics_join, entity_of_state, entity_state, expand_to_years, family_composition, firm_id_correction,
    firm_panel, income_by_firm, join_household, merge_entity_states, monthly_days, panel_summary, prepare_episodes,
    reclassify_contract, rectangularise, restrict_to_cohort, retirement_year,
)
from annualis.operators.contributions import monthly_maximum
from annualis.operators.income import person_income, personal_income, work_income
from annualis.operators.report import LG_K
from annualis.sources import layouts
from annualis.sources.scan import list_files, row_quality, scan_raw
from annualis.sources.stages import Versions, publish, read_manifest, table_key, write_stage, write_summary

# Stage number -> its tables. Nothing reads the RESULTS_ONLY back; WIDE ones are large copies.
STAGES = {
    1: ["person_state", "persons", "individuals_full", "individuals_last", "episodes_typed", "firms"],
    2: ["episodes", "contributions", "merged"],
    3: ["monthly_days"],
    4: ["annual"],
    5: ["annual_demographics"],
    6: ["firm_id_correction", "income", "income_work", "income_person", "income_pension", "pensions"],
    7: ["panel"],
}
WIDE = {"individuals_full", "merged", "monthly_days"}
RESULTS_ONLY = WIDE | {"firms", "income_pension", "person_state"}
# The tables several steps read: enough to keep a single query from doing work twice.
SHARED = {"persons", "individuals_last", "episodes_typed", "episodes", "contributions", "income"}
SOURCES = ["PERSONAL", "CONVIVIR", "AFILIAD", "COTIZA", "FISCAL", "PRESTAC"]

Table = Callable[[int, str, Callable[[], DataFrame]], DataFrame]


def scan_sources(spark: SparkSession, root: str, files: list[Row] | None = None,
                 seen: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """The raw scans of all sources below a folder of year folders, which is listed once.

    ``seen`` receives an observation of row quality for each source that has files; it is filled by the
    pass that reads the source.
    """
    files = list_files(spark, root) if files is None else files
    raw = {s: scan_raw(spark, root, s, files=files, ledger=seen is not None) for s in SOURCES}
    if seen is not None:
        for source in {f.source for f in files} & set(SOURCES):
            seen[source] = Observation(f"quality of {source}")
            raw[source] = raw[source].observe(seen[source], *row_quality(source)).drop("n_fields", "undecodable")
    return raw


def _years(raw: dict[str, DataFrame], source: str, first: int, last: int) -> DataFrame:
    return raw[source].filter(F.col("extract_year").between(first, last))


def _lazy(stage: int, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    return build()


def build_panel(raw: dict[str, DataFrame], first: int = codes.FIRST_EXTRACT,
                last: int = codes.LAST_EXTRACT, last_panel_year: int | None = None,
                table: Table = _lazy, inkind: str = "twice", per_key: str = "sum",
                flags: str = "first", calendar_lags: bool = False,
                names: dict[str, str] | None = None, salts: int = 16,
                without: tuple[str, ...] = (),
                known: tuple[DataFrame, set[int]] | None = None) -> DataFrame:
    """The panel from raw rows by source. ``table`` decides whether a step is materialised.

    ``salts`` is the number of sub-keys a person or an account is split into where raw facts
    meet a lookup; on a big cluster raise it as long as the lookups stay small beside the facts.
    ``without`` names columns that the person-years shall lack, as sources without them would have it.
    ``known`` is a state of persons and the extracts it holds, which are not read again for persons.
    ``last_panel_year`` is the later one of ``last`` and the default extract, if it isn't given.
    """
    last_panel_year = last_panel_year or max(last, codes.LAST_EXTRACT)

    def snapshots():
        people, homes = _years(raw, "PERSONAL", first, last), _years(raw, "CONVIVIR", first, last)
        if known:
            new = ~F.col("extract_year").isin(sorted(known[1]))
            people, homes = people.filter(new), homes.filter(new)
        return join_household(layouts.read_persons(people), layouts.read_households(homes))

    def person_state():
        state = entity_state(snapshots())
        return merge_entity_states(known[0], state) if known else state

    def persons():
        state = table(1, "person_state", person_state)
        return consolidate_entity(snapshots()) if state is None else entity_of_state(state)

    def typed_episodes():
        rows = _years(raw, "AFILIAD", first, last)
        return layouts.read_episodes(layouts.delivered_episode_parts(rows))

    def all_episodes():
        # three steps need different columns of it, so the text is only parsed once
        return table(1, "episodes_typed", typed_episodes)

    def episodes():
        kept = restrict_to_cohort(all_episodes(), cohort, ["firm_cc2", "entry_date", "exit_date"],
                                  salts=salts)
        return prepare_episodes(kept)

    def contributions():
        rows = layouts.read_all_contributions(_years(raw, "COTIZA", first, last))
        return monthly_maximum(
            restrict_to_cohort(rows, cohort, ["firm_cc2", "year"], salts=salts))

    def wide():
        return attach_contributions(
            expand_to_years(table(2, "episodes", episodes), last_year=last_panel_year),
            table(2, "contributions", contributions))

    def annual():
        return annualise(table(2, "episodes", episodes),
                         table(2, "contributions", contributions),
                         per_key, flags, calendar_lags, last_year=last_panel_year)

    def demographics():
        joined = demographics_join(table(4, "annual", annual), people, last_panel_year)
        return reclassify_contract(family_composition(joined))

    def income():
        rows = _years(raw, "FISCAL", max(first, codes.FIRST_TAX_EXTRACT), last)
        return income_by_firm(layouts.read_payments(rows))

    def panel():
        by_firm = table(6, "income", income)
        out = assemble_panel(
            table(5, "annual_demographics", demographics).drop(*without),
            table(6, "income_work", lambda: work_income(by_firm)),
            table(6, "income_person", lambda: personal_income(by_firm)),
            table(6, "pensions", lambda: retirement_year(
                layouts.read_pensions(_years(raw, "PRESTAC", first, last)))),
            table(6, "firm_id_correction", lambda: firm_id_correction(all_episodes())),
            inkind, calendar_lags, names, salts)
        if table is not _lazy:
            # tables that are results of their own
            table(1, "firms", lambda: firm_panel(all_episodes()))
            table(6, "income_pension",
                  lambda: person_income(by_firm, "pension").drop("inkind_pension"))
            table(1, "individuals_full", lambda: rectangularise(people, last_panel_year))
            merged = table(2, "merged", wide)
            table(3, "monthly_days", lambda: monthly_days(merged if merged is not None else wide()))
        return out

    people = table(1, "persons", persons)
    cohort = table(1, "individuals_last", lambda: cohort_of(people, last_panel_year))
    return table(7, "panel", panel)


def stage_tables(spark: SparkSession, out_root: str, keep: set[str] | None = None) -> Table:
    """A ``table`` function that writes each step once, below a folder of its own run.

    ``keep`` limits the written steps; all others stay lazy.
    """
    done: dict[str, DataFrame] = {}

    def table(stage: int, name: str, build: Callable[[], DataFrame]) -> DataFrame | None:
        if name not in done:
            if keep is not None and name not in keep:
                done[name] = None if name in RESULTS_ONLY else build()
            else:
                done[name] = write_stage(build(), out_root, name)
        return done[name]

    return table


# What decides the rows of a table: the sources it is read from, the tables it is built from, and the
# options that shape it. Options in no list (salts) change no row.
DEPENDS: dict[str, tuple[list[str], list[str], list[str]]] = {
    "person_state": (["PERSONAL", "CONVIVIR"], [], []),
    "persons": ([], ["person_state"], []),
    "individuals_full": ([], ["persons"], ["last_panel_year"]),
    "individuals_last": ([], ["persons"], ["last_panel_year"]),
    "episodes_typed": (["AFILIAD"], [], []),
    "firms": ([], ["episodes_typed"], []),
    "episodes": ([], ["episodes_typed", "individuals_last"], []),
    "contributions": (["COTIZA"], ["individuals_last"], []),
    "merged": ([], ["episodes", "contributions"], ["last_panel_year"]),
    "monthly_days": ([], ["merged"], []),
    "annual": ([], ["episodes", "contributions"], ["last_panel_year", "per_key", "flags", "calendar_lags"]),
    "annual_demographics": ([], ["annual", "persons"], ["last_panel_year"]),
    "firm_id_correction": ([], ["episodes_typed"], []),
    "income": (["FISCAL"], [], []),
    "income_work": ([], ["income"], []),
    "income_person": ([], ["income"], []),
    "income_pension": ([], ["income"], []),
    "pensions": (["PRESTAC"], [], []),
    "panel": ([], ["annual_demographics", "income_work", "income_person", "pensions", "firm_id_correction"],
              ["inkind", "calendar_lags", "names", "without"]),
}
RULES = 1  # raise it when the rules of a table change, so that older versions are not taken over


def _told(files: list[Row], sources: list[str]) -> list[list]:
    return sorted([f.source, f.year, f.path, f.size, str(f.modified)] for f in files if f.source in sources)


def _known_state(spark: SparkSession, entry: dict | None, files: list[Row]) -> tuple[DataFrame, set[int]] | None:
    """The last run's state of persons and its extracts, if their files are all there as they were and
    other files are of other extracts."""
    if not entry or entry["rules"] != RULES:
        return None
    now = _told(files, DEPENDS["person_state"][0])
    years = {f[1] for f in entry["files"]}
    if sorted(f for f in now if f[1] in years) != sorted(entry["files"]):
        return None
    return spark.read.parquet(entry["path"]), years


def table_keys(files: list[Row], first: int, last: int, options: dict) -> dict[str, str]:
    """The key of every table: a digest of the files (path, size, time) it is read from, the years, the
    options that shape it, and the keys of the tables below it."""
    keys: dict[str, str] = {}

    def key(name: str) -> str:
        if name not in keys:
            sources, tables, shaped = DEPENDS[name]
            keys[name] = table_key(name, rules=RULES, years=[first, last], files=_told(files, sources),
                                   tables={t: key(t) for t in tables}, options={o: options.get(o) for o in shaped})
        return keys[name]
    for name in DEPENDS:
        key(name)
    return keys


def run(spark: SparkSession, raw_root: str, out_root: str, first: int = codes.FIRST_EXTRACT,
        last: int = codes.LAST_EXTRACT, from_stage: int = 1, wide_tables: bool = False, ledger: bool = False,
        **options) -> DataFrame:
    """Build and write every stage table, the panel (by year) and the summary, and publish them.

    The raw folder is listed once. When only extracts were added, persons are merged from the last run's
    state and the new extracts (``from_stage`` above 1). A table is built unless it belongs to a stage before ``from_stage``
    and a whole version of it is there that was built from the same files, years and options, by any
    earlier run, finished or not (``from_stage=8``: whatever is there and still right). The manifest names
    the versions of the last whole run; it is replaced in one step at the end, so what readers see
    changes from one whole run to the next.

    ``wide_tables`` also writes the rectangular person panel and the episode-year tables with monthly
    bases and days; nothing reads them back, so they are off by default. ``ledger`` also counts rows that
    are short, long or hold bad bytes, in the pass that reads them; the counts of the sources that this
    run has read are in the manifest.
    """
    names = {name for tables in STAGES.values() for name in tables}
    keep = names if wide_tables else names - WIDE
    before = read_manifest(spark, out_root).get("tables", {})
    shaped = {"last_panel_year": max(last, codes.LAST_EXTRACT), "per_key": "sum", "flags": "first",
              "calendar_lags": False, "inkind": "twice", "names": None, **options}
    files = list_files(spark, raw_root, first, last)
    keys, versions = table_keys(files, first, last, shaped), Versions(spark, out_root)
    seen: dict[str, Observation] = {}
    known = _known_state(spark, before.get("person_state"), files) if from_stage > 1 else None
    # files of extracts that the state holds need not be opened
    held = known[1] if known else set()
    opened = [f for f in files if f.source not in DEPENDS["person_state"][0] or f.year not in held]
    raw = scan_sources(spark, raw_root, opened, seen if ledger else None)
    counts: dict[str, Observation] = {}
    done: dict[str, DataFrame | None] = {}

    def table(stage: int, name: str, build: Callable[[], DataFrame]) -> DataFrame | None:
        if name not in done and name not in keep:
            done[name] = None if name in RESULTS_ONLY else build()
        elif name not in done:
            def counted():
                out = build()
                if "person_id" in out.columns:  # rows and persons, in the pass that writes them
                    counts[name] = Observation(name)
                    out = out.observe(counts[name], F.count(F.lit(1)).alias("n_rows"),
                                      F.hll_sketch_agg("person_id", LG_K).alias("sketch"))
                if name != "panel":
                    return out
                # well-sized files per year: AQE splits big years and merges small ones
                return out.hint("rebalance", "year").sortWithinPartitions("year", "person_id")
            told = {"stage": stage}
            if name == "person_state":
                told |= {"files": _told(files, DEPENDS[name][0]), "rules": RULES}
            done[name] = versions.table(name, keys[name], counted, "year" if name == "panel" else None,
                                        reuse=stage < from_stage, **told)
        return done[name]

    panel = build_panel(raw, first, last, table=table, known=known, **options)
    write_summary(panel_summary(panel), out_root)
    for name, told in versions.tables.items():
        if name in counts:
            found = counts[name].get
            told |= {"n_rows": found["n_rows"], "sketch": b64encode(found["sketch"]).decode()}
        elif before.get(name, {}).get("key") == told["key"]:  # as counted when it was written
            told |= {k: v for k, v in before[name].items() if k in ("n_rows", "sketch")}
    read = {s for n, t in versions.tables.items() if t["built"] for s in DEPENDS[n][0]}
    publish(spark, out_root, {
        "tables": versions.tables, "years": [first, last], "options": shaped,
        "files": _told(files, SOURCES),
        "quality": {s: o.get for s, o in seen.items() if s in read}})
    return panel


def run_report(spark: SparkSession, out_root: str) -> DataFrame:
    """name, stage, built (by the last run), n_rows and the estimated persons of every table of the last
    whole run, from what was counted while they were written; null for what was not counted."""
    rows = [(name, t["stage"], t["built"], t.get("n_rows"), t.get("sketch"))
            for name, t in sorted(read_manifest(spark, out_root).get("tables", {}).items())]
    found = spark.createDataFrame(rows, "name string, stage int, built boolean, n_rows long, sketch string")
    return found.select("name", "stage", "built", "n_rows", F.expr("hll_sketch_estimate(unbase64(sketch))").alias("n_persons"))
