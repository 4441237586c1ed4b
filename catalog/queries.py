"""The registered queries: every operator over the whole test tables."""

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis import codes
from annualis import operators as op
from annualis.functions import (
    attach_code,
    birth_month, birth_year, clamp, date_day, date_month, date_year, div, null_if, plain_int,
    safe_int, strip,
    strip_zeros, without_prefix,
)
from annualis.operators.annual import firm_years
from annualis.operators.assemble import with_income_lag
from annualis.operators.attributes import full_year_before
from annualis.operators.income import person_income, work_income
from annualis.session import configure
from annualis.plans import SHARED, build_panel, run, stage_tables as plan_tables
from annualis.sources import layouts
from annualis.sources.naming import source_identity
from annualis.sources.scan import scan_quality, scan_raw, source_report
from annualis.sources.stages import read_summary, write_stage, write_summary
from catalog.delivery import PROJECTION, deliver, lines
from catalog.projections import PROJECTIONS, tables_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
MONTHS = range(1, 13)
CLEAN_KEYS = ["person_id", "entry_date", "exit_date", "firm_cc2"]


def query(f):
    """Register a query; it runs with the session settings the operators are designed for."""
    QUERIES[f.__name__] = lambda spark, sf: f(configure(spark), sf)
    return f


def source_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Stored bytes of a table per partition it is dealt into: a task's share stays the same as tables grow.
STORED_BYTES_A_PARTITION = 1 << 20


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a table's files, from the file system's listing."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(hadoop_path).getLength()


def projection(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The projection over whole tables. Line items are dealt by the key of their join with orders,
    which a large table needs anyway; in a small one it spreads a file that comes in one piece. The
    number of partitions grows with the stored table, so a task's share does not; a small table is
    still spread over the session's cores."""
    tables = {t: source_table(spark, sf, t) for t in tables_of(name)}
    if "lineitem" in tables:
        least = spark.sparkContext.defaultParallelism
        grown = -(-stored_bytes(spark, f"{sf}/lineitem.parquet") // STORED_BYTES_A_PARTITION)
        tables["lineitem"] = tables["lineitem"].repartition(max(least, grown), "l_orderkey")
    return spark.sql(PROJECTIONS[name], **tables)


# A task delivers the rows of so many stored bytes as long as there is one for each core, but not of
# less: it writes a piece of every file, so few tasks make few small files.
STORED_BYTES_A_PIECE = (4 << 20, 64 << 20)


def delivered_lines(spark: SparkSession, sf: str, source: str, odd: bool = False) -> DataFrame:
    """The lines of a source in the tasks that write them. Each takes partitions of the projection one
    after the other, so it holds no more than one of them."""
    name = PROJECTION[source]
    stored = max(stored_bytes(spark, f"{sf}/{t}.parquet") for t in tables_of(name))
    least, most = (-(-stored // size) for size in reversed(STORED_BYTES_A_PIECE))
    tasks = max(least, min(most, spark.sparkContext.defaultParallelism))
    return lines(projection(spark, sf, name), source, odd).coalesce(tasks)


def delivered(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Raw rows as the scan gives them: text fields, empty ones null."""
    fields = projection(spark, sf, name)
    return fields.selectExpr(*[f"nullif({c}, '') AS {c}" if c.startswith("c") else c
                               for c in fields.columns])


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    names = {"PERSONAL": "raw_persons", "CONVIVIR": "raw_households", "AFILIAD": "raw_episodes",
             "COTIZA": "raw_contributions", "FISCAL": "raw_payments", "PRESTAC": "raw_pensions"}
    return {source: delivered(spark, sf, name) for source, name in names.items()}


def shared_folder(spark: SparkSession) -> str:
    """A new folder for written tables below the one that spark.checkpoint.dir names; where that is
    unset (tests), a folder of this process is set for the session. What is written lives as long
    as that folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="annualis-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/annualis-{uuid.uuid4().hex}"


def snapshots(spark, sf):
    """One snapshot per person and extract: the typed rows, without copies."""
    return op.dedup_by_key(projection(spark, sf, "snapshots"), ["extract_year", "person_id"])


def contribution_rows(spark, sf, autonomous: int, step: int = 1) -> DataFrame:
    long = projection(spark, sf, "contributions").filter(F.col("autonomous") == autonomous)
    prefix = "contribution_aut_" if autonomous else "contribution_"
    return long.selectExpr("person_id", "firm_cc2", "year", *[
        f"CASE WHEN month = {m} THEN cents - cents % {step} END AS {prefix}{m}" for m in MONTHS])


def merged_contributions(spark, sf, step: int = 1) -> DataFrame:
    return op.merge_contributions(contribution_rows(spark, sf, 0, step),
                                  contribution_rows(spark, sf, 1, step))


def clean_episodes(spark, sf):
    return op.prepare_episodes(projection(spark, sf, "episodes"))


def classified_years(spark, sf):
    flagged = op.classify_episode(clean_episodes(spark, sf))
    return op.monthly_days(op.expand_to_years(flagged))


# Sources


@query
def read_persons(spark, sf):
    return layouts.read_persons(delivered(spark, sf, "raw_persons"))


@query
def read_households(spark, sf):
    return layouts.read_households(delivered(spark, sf, "raw_households"))


@query
def read_episodes(spark, sf):
    raw = layouts.delivered_episode_parts(delivered(spark, sf, "raw_episodes"))
    return layouts.read_episodes(raw)


@query
def read_contributions(spark, sf):
    return layouts.read_contributions(delivered(spark, sf, "raw_contributions"))


@query
def read_contributions_autonomous(spark, sf):
    return layouts.read_contributions(delivered(spark, sf, "raw_contributions"), autonomous=True)


@query
def read_payments(spark, sf):
    return layouts.read_payments(delivered(spark, sf, "raw_payments"))


@query
def read_pensions(spark, sf):
    return layouts.read_pensions(delivered(spark, sf, "raw_pensions"))


@query
def read_file_numbers(spark, sf):
    return layouts.read_file_numbers(delivered(spark, sf, "raw_file_numbers"))


@query
def source_names(spark, sf):
    paths = projection(spark, sf, "raw_paths")
    identity = source_identity(F.col("path"))
    return (paths.select("o_orderkey", "path", identity.alias("found"))
            .filter(F.col("found").isNotNull()).select("o_orderkey", "path", "found.*"))


@query
def stage_tables(spark, sf):
    """A stage table written, by year, and read back."""
    table = merged_contributions(spark, sf)
    return write_stage(table.hint("rebalance", "year"), shared_folder(spark), "contributions",
                       partition_by="year").select(
        "person_id", "firm_cc2", F.col("year").cast("smallint").alias("year"),
        *[f"{kind}_{m}" for kind in ("contribution", "contribution_aut") for m in MONTHS])


def scanned(spark, sf, source: str) -> DataFrame:
    """A source written as text, all extracts in one job, and scanned again. Some rows are short, long,
    quoted or hold bad bytes, none of which changes what the layouts read."""
    root = f"{shared_folder(spark)}/raw"
    deliver(delivered_lines(spark, sf, source, odd=True), root, source)
    return scan_raw(spark, root, source)


@query
def scan_files(spark, sf):
    """Person records of all extracts from text."""
    return layouts.read_persons(scanned(spark, sf, "PERSONAL"))


@query
def scan_households(spark, sf):
    return layouts.read_households(scanned(spark, sf, "CONVIVIR"))


@query
def scan_episodes(spark, sf):
    return layouts.read_episodes(scanned(spark, sf, "AFILIAD"))


@query
def scan_contributions(spark, sf):
    return layouts.read_contributions(scanned(spark, sf, "COTIZA"))


@query
def scan_payments(spark, sf):
    return layouts.read_payments(scanned(spark, sf, "FISCAL"))


@query
def scan_pensions(spark, sf):
    return layouts.read_pensions(scanned(spark, sf, "PRESTAC"))


@query
def scan_file_numbers(spark, sf):
    return layouts.read_file_numbers(scanned(spark, sf, "DIVISION"))


@query
def scan_ledger(spark, sf):
    """Rows of all sources by extract and part, with those that are short, long or undecodable."""
    root = f"{shared_folder(spark)}/raw"
    for source in PROJECTION:
        deliver(delivered_lines(spark, sf, source, odd=True), root, source)
    return scan_quality(spark, root)


@query
def source_files(spark, sf):
    """What is read of parts, a second spelling and a copy in a folder below."""
    root = f"{shared_folder(spark)}/raw"
    deliver(delivered_lines(spark, sf, "AFILIAD"), root, "AFILIAD")
    for ending in ("_CDF.TXT", "_CDF.txt"):
        deliver(delivered_lines(spark, sf, "FISCAL"), root, "FISCAL", ending=ending)
    for folder in ("", "old/"):
        deliver(delivered_lines(spark, sf, "PERSONAL"), root, "PERSONAL", folder)
    report = source_report(spark, root)
    return report.select("year", "source", "part", "status").distinct()


# Scalars and predicates


@query
def safe_cast(spark, sf):
    texts = projection(spark, sf, "texts")
    return texts.select(
        "l_orderkey", "l_linenumber", strip("code").alias("stripped"),
        safe_int("code", "tinyint").alias("as_tinyint"),
        safe_int("code", "smallint").alias("as_smallint"),
        safe_int("code", "int").alias("as_int"), safe_int("code").alias("as_bigint"),
        null_if(plain_int(without_prefix("code")), 99).alias("country"),
        strip_zeros("code").alias("no_zeros"),
        birth_year("yyyymm").alias("birth_year"), birth_month("yyyymm").alias("birth_month"),
    )


@query
def date_parts(spark, sf):
    days = projection(spark, sf, "episodes")
    length = F.col("exit_date") - F.col("entry_date")
    return days.select(
        "person_id", "firm_cc2", "entry_date", "exit_date",
        date_year("entry_date").alias("entry_year"), date_month("entry_date").alias("entry_month"),
        date_day("entry_date").alias("entry_day"),
        clamp(length, 0).alias("at_least"), clamp(length, None, 100).alias("at_most"),
        clamp(F.when(F.col("ptcoef") % 3 > 0, length), 0, 100).alias("within"),
    )


@query
def range_flags(spark, sf):
    flagged = op.classify_episode(projection(spark, sf, "episodes"))
    return flagged.select("person_id", "firm_cc2", "entry_date", "exit_date",
                          "contribution_regime", "job_relationship", "firm_muni", "rel_contract",
                          "self_emp", "emp_hogar", "unemp_jr", "basque_navarra")


# Keys, sets and joins


@query
def conflict_drop(spark, sf):
    rows = projection(spark, sf, "snapshots").select("person_id", "birth_date")
    return op.drop_conflicting_keys(rows, ["person_id"])


@query
def dedup_key(spark, sf):
    return snapshots(spark, sf)


@query
def top_per_key(spark, sf):
    rows = projection(spark, sf, "payments").select(
        "person_id", "year", "payment_type", "firm_id", "wage_cents")
    return op.keep_top(rows, ["person_id", "year"],
                       [-F.col("wage_cents"), "payment_type", "firm_id"])


@query
def set_difference(spark, sf):
    """Persons with pensions but without payments (anti join), and the other way round."""
    pensions = projection(spark, sf, "pensions").select("person_id", "year").distinct()
    payments = projection(spark, sf, "payments").select("person_id", "year").distinct()
    return (pensions.join(payments, ["person_id", "year"], "left_anti")
            .select("*", F.lit("pension").alias("only_in"))
            .unionByName(payments.join(pensions, ["person_id", "year"], "left_anti")
                         .select("*", F.lit("payment").alias("only_in"))))


@query
def union_relaxed(spark, sf):
    """Extracts with different columns stacked; what one lacks is null."""
    payments = projection(spark, sf, "payments")
    early = payments.filter(F.col("year") < 1998).select("person_id", "year", "wage_cents")
    late = payments.filter(F.col("year") >= 1998).select(
        "person_id", "year", "wage_cents", "inkind_cents")
    return early.unionByName(late, allowMissingColumns=True)


# Persons


@query
def household_join(spark, sf):
    persons = layouts.read_persons(delivered(spark, sf, "raw_persons"))
    homes = layouts.read_households(delivered(spark, sf, "raw_households"))
    return op.join_household(persons, homes)


@query
def entity_latest(spark, sf):
    return op.consolidate_entity(snapshots(spark, sf).drop("snapshot_order"))


@query
def entity_incremental(spark, sf):
    """Persons from the written state of all extracts but the newest, merged with the newest one's."""
    rows = snapshots(spark, sf).drop("snapshot_order")
    newest = rows.agg(F.max("extract_year")).first()[0]
    before = op.entity_state(rows.filter(F.col("extract_year") < newest))
    kept = write_stage(before, shared_folder(spark), "person_state")
    state = op.merge_entity_states(kept, op.entity_state(rows.filter(F.col("extract_year") == newest)))
    return op.entity_of_state(state)


@query
def rectangularise(spark, sf):
    persons = entity_latest(spark, sf)
    return op.rectangularise(persons, last_year=2000).select(
        "person_id", "year", "birth_year", "sex", "first_extract", "last_extract")


@query
def cohort(spark, sf):
    return op.cohort_of(entity_latest(spark, sf), last_year=1998)


@query
def cohort_episodes(spark, sf):
    """Episodes of each person's last extract."""
    facts = projection(spark, sf, "episodes").withColumn("extract_year", date_year("entry_date"))
    lookup = op.cohort_of(entity_latest(spark, sf))
    return op.restrict_to_cohort(facts, lookup, ["firm_cc2", "exit_date"]).select(
        "person_id", "firm_cc2", "entry_date", "exit_date", "firm_id", "ptcoef")


# Episodes and contributions


@query
def episodes_clean(spark, sf):
    return clean_episodes(spark, sf)


@query
def episode_years(spark, sf):
    return op.expand_to_years(clean_episodes(spark, sf), 1996, 1999).select(
        "person_id", "firm_cc2", "entry_date", "exit_date", "year")


@query
def monthly_days(spark, sf):
    return op.monthly_days(op.expand_to_years(clean_episodes(spark, sf))).select(
        "person_id", "firm_cc2", "entry_date", "exit_date", "year",
        *[f"days{m}" for m in MONTHS])


@query
def contrib_merge(spark, sf):
    return merged_contributions(spark, sf)


@query
def contrib_full_outer(spark, sf):
    """The two contribution sources combined by a full outer join."""
    keys = ["person_id", "firm_cc2", "year"]
    regular = projection(spark, sf, "contributions").filter("autonomous = 0").groupBy(*keys).agg(
        F.sum("cents").alias("regular_cents"))
    own = projection(spark, sf, "contributions").filter("autonomous = 1").groupBy(*keys).agg(
        F.sum("cents").alias("autonomous_cents"))
    return regular.join(own, keys, "full_outer")


@query
def episode_contrib(spark, sf):
    years = op.expand_to_years(clean_episodes(spark, sf)).select(*CLEAN_KEYS, "year")
    return op.attach_contributions(years, merged_contributions(spark, sf))


# Annual facts


@query
def annual_days(spark, sf):
    return op.annual_days(classified_years(spark, sf))


@query
def annual_days_calendar(spark, sf):
    return op.annual_days(classified_years(spark, sf), calendar_lags=True)


@query
def firm_year(spark, sf):
    out = firm_years(classified_years(spark, sf), merged_contributions(spark, sf))
    return out.drop("worked", "first_episode")


@query
def person_year(spark, sf):
    return op.annualise(clean_episodes(spark, sf), merged_contributions(spark, sf))


@query
def main_job(spark, sf):
    """Main job where many firms tie on the annual contribution."""
    out = op.annualise(clean_episodes(spark, sf), merged_contributions(spark, sf, 5_000_000))
    return out.select("person_id", "year", "main_firm_cc2", "main_firm_contrib", "firm_muni",
                      "contract_type")


@query
def person_year_any(spark, sf):
    """Every base counted once per firm-year; flags over all episodes; calendar lags."""
    return op.annualise(clean_episodes(spark, sf), merged_contributions(spark, sf),
                        per_key="max", flags="any", calendar_lags=True)


@query
def row_counts(spark, sf):
    """Rows and persons of the cleaned episodes."""
    return op.row_counts(clean_episodes(spark, sf))


@query
def person_report(spark, sf):
    """Rows and persons of three tables by year and in all, exact and estimated from sketches: those of
    all years are merged from the years'."""
    tables = {"contributions": projection(spark, sf, "contributions"), "payments": projection(spark, sf, "payments"),
              "snapshots": projection(spark, sf, "snapshots").withColumnRenamed("extract_year", "year")}
    rows = reduce(DataFrame.union, [t.select(F.lit(n).alias("name"), F.col("year").cast("int").alias("year"), "person_id")
                                    for n, t in tables.items()])
    years = write_stage(op.person_states(rows, ["name", "year"]), shared_folder(spark), "person_states")
    every = op.merge_states(years, ["name"]).select("name", F.lit(None).cast("int").alias("year"), "n_rows", "sketch")
    told = op.estimated(years.unionByName(every))
    exact = op.exact(rows, ["name", "year"]).unionByName(
        op.exact(rows, ["name"]).withColumn("year", F.lit(None).cast("int")))
    same = (told["name"] == exact["name"]) & told["year"].eqNullSafe(exact["year"])
    off = F.abs(F.col("n_estimated") - F.col("n_entities"))
    return told.join(exact, same).select(
        told["name"], told["year"], "n_rows", "n_entities", (off <= F.col("n_entities") * op.ERROR + 1).alias("within_error"))


# Firms


def firm_rows(spark, sf):
    episodes = projection(spark, sf, "episodes")
    return episodes.select(
        "firm_cc2", "firm_cc", "firm_id", "exit_date",
        date_year("entry_date").alias("extract_year"), "firm_muni",
        F.when(F.col("ptcoef") % 3 > 0, F.col("ptcoef")).alias("firm_workers"),
        F.when(F.col("ptcoef") % 5 > 0, F.col("ptcoef")).alias("firm_age"),
        F.when(F.col("contract_type") % 3 > 0, F.col("contract_type") % 100).alias("sector_cnae93"),
        F.when(F.col("contract_type") % 7 > 0, F.col("contract_type") % 90).alias("sector_cnae09"),
        (F.col("contribution_regime") % 2).alias("firm_ett"), div("firm_muni", 1000).alias("firm_main_prov"),
        F.when(F.col("contract_type") % 4 > 0, F.col("contract_type")).alias("firm_jur_type"),
        F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                    (F.col("contract_type") % 26 + 1).cast("int"), F.lit(1))
        .alias("firm_jur_status"),
    )


@query
def firm_panel(spark, sf):
    return op.firm_panel(firm_rows(spark, sf))


@query
def firm_id_fix(spark, sf):
    return op.firm_id_correction(firm_rows(spark, sf), first_exit_year=1998)


@query
def firm_id_applied(spark, sf):
    rows = projection(spark, sf, "episodes").select("person_id", "entry_date", "exit_date",
                                                    "firm_cc", "firm_id")
    return op.apply_firm_id(rows, firm_id_fix(spark, sf), ["person_id", "entry_date"])


# Income and pensions


def by_firm(spark, sf):
    return op.income_by_firm(projection(spark, sf, "payments"))


@query
def income_work(spark, sf):
    return work_income(by_firm(spark, sf))


@query
def income_unemp(spark, sf):
    return person_income(by_firm(spark, sf), "unemp")


@query
def income_prof(spark, sf):
    return person_income(by_firm(spark, sf), "prof")


@query
def income_pension(spark, sf):
    return op.split_payments(projection(spark, sf, "payments"))["pension_fiscal"]


@query
def retirement(spark, sf):
    return op.retirement_year(layouts.full_retirement(projection(spark, sf, "pensions")))


# Attributes


def person_years_moved(spark, sf):
    """Person-years with total contribution, moved into the years of the price series."""
    rows = projection(spark, sf, "contributions").withColumn("year", F.col("year") + 7)
    return rows.groupBy("person_id", F.col("year").cast("smallint").alias("year")).agg(
        F.sum("cents").alias("cents"))


@query
def demographics(spark, sf):
    persons = entity_latest(spark, sf)
    years = person_years_moved(spark, sf).withColumn("year", (F.col("year") - 7).cast("smallint"))
    return op.demographics_join(years, persons, last_year=2000).drop("birth_date2", "birth_date3")


@query
def family(spark, sf):
    rows = projection(spark, sf, "snapshots").withColumn("year", F.col("extract_year"))
    return op.family_composition(rows).select("snapshot_order", "year", "famsize", "famsize_06",
                                              "famsize_715", "famsize_a65")


@query
def contract_class(spark, sf):
    rows = projection(spark, sf, "episodes").select(*CLEAN_KEYS, "contract_type")
    return op.reclassify_contract(rows)


@query
def deflate(spark, sf):
    rows = person_years_moved(spark, sf).withColumn("wage", F.col("cents").cast("double") / 100)
    return op.deflate(rows, ["wage"])


@query
def geography(spark, sf):
    rows = projection(spark, sf, "episodes").select(*CLEAN_KEYS, "firm_muni")
    return op.geography(rows)


@query
def education(spark, sf):
    rows = projection(spark, sf, "snapshots").select("snapshot_order", "edu_code")
    seven = attach_code(rows, codes.EDUCATION_7, "edu_code", "STRING",
                                      "education", "INT")
    return op.collapse_education(seven).drop("edu_code")


@query
def income_lag(spark, sf):
    rows = person_years_moved(spark, sf).withColumn("tot_inc", F.col("cents").cast("double") / 100)
    return with_income_lag(rows)


@query
def full_year(spark, sf):
    return full_year_before(op.annual_days(classified_years(spark, sf)))


# The whole panel


def panel_rows(spark, sf):
    """The panel with the tables that several steps read written once."""
    table = plan_tables(spark, shared_folder(spark), keep=SHARED)
    return build_panel(sources(spark, sf), table=table)


@query
def panel(spark, sf):
    return panel_rows(spark, sf)


def rounded(summary: DataFrame) -> DataFrame:
    return summary.select("year", "n_persons", *[
        F.round(c, 4).alias(c) for c in ("mean_real_wage", "mean_real_tot_inc", "mean_days")])


@query
def panel_summary(spark, sf):
    return rounded(op.panel_summary(panel_rows(spark, sf)))


@query
def panel_lacking(spark, sf):
    """The panel of sources without firm identifiers and ages; payments in kind counted once, and lags of
    calendar years."""
    table = plan_tables(spark, shared_folder(spark), keep=SHARED)
    return build_panel(sources(spark, sf), table=table, inkind="once", calendar_lags=True, without=("firm_id", "age"))


def delivered_run(spark, sf) -> str:
    """The folder of a run from delivered text to the published panel."""
    folder = shared_folder(spark)
    for source in PROJECTION:
        deliver(delivered_lines(spark, sf, source), f"{folder}/raw", source)
    run(spark, f"{folder}/raw", f"{folder}/out")
    return folder


@query
def staged_run(spark, sf):
    """Text to panel in stages, and resumed: only the last stage is built again."""
    folder = delivered_run(spark, sf)
    return run(spark, f"{folder}/raw", f"{folder}/out", from_stage=7)


@query
def staged_summary(spark, sf):
    """The yearly summary as written for other tools, read back."""
    folder = shared_folder(spark)
    write_summary(op.panel_summary(panel_rows(spark, sf)), folder)
    return rounded(read_summary(spark, folder))
