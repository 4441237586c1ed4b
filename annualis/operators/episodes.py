"""Episodes (entry date, exit date) to person-firm-year rows with monthly days and flags."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis import codes
from annualis.functions import (
    clamp, date_day, date_year, div, flag, in_ranges, prefilter, scattered_join,
)
from annualis.functions.lookups import FILTER_SLOTS
from annualis.operators.keys import dedup_by_key

MONTHS = range(1, 13)
DAYS = [f"days{m}" for m in MONTHS]


def restrict_to_cohort(facts: DataFrame, cohort: DataFrame, scatter_by: list[str | Column],
                       person: str = "person_id", salts: int = 16, filter_slots: int = FILTER_SLOTS) -> DataFrame:
    """Keep the facts of each person's last extract only, over all extracts at once.

    A person has facts in up to as many extracts as there are and keeps one of them, so a filter of
    bounded size, made of the cohort, drops the others where they are read (``filter_slots``; 0: no
    filter). A person may hold a large share of what stays, hence the scattered join. The extract year
    is not a key afterwards, so later aggregates shuffle (pre-aggregated) on their own keys.
    """
    keys = [person, "extract_year"]
    lookup = cohort.select(person, F.col("last_extract").alias("extract_year"))
    near = prefilter(facts, lookup, keys, filter_slots) if filter_slots else facts
    kept = scattered_join(near, lookup, keys, "left_semi", scatter_by, salts)
    return kept.drop("extract_year")


def prepare_episodes(episodes: DataFrame, person: str = "person_id", firm: str = "firm_cc2",
                     entry: str = "entry_date", exit_: str = "exit_date") -> DataFrame:
    """Unique, non-negative episodes with entry and exit year.

    The duration test only uses key columns, so it runs before the shuffle. Episodes without
    an exit date do not pass it.
    """
    valid = episodes.filter(F.col(exit_) >= F.col(entry))
    unique = dedup_by_key(valid, [person, entry, exit_, firm])
    return unique.withColumns({"entry_year": date_year(entry), "exit_year": date_year(exit_)})


def _span(first_year: int, last_year: int) -> tuple[Column, Column]:
    return (F.greatest(F.col("entry_year").cast("int"), F.lit(first_year)),
            F.least(F.col("exit_year").cast("int"), F.lit(last_year)))


def touching(episodes: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Episodes with a year within [first_year, last_year]."""
    start, end = _span(first_year, last_year)
    # greatest and least skip nulls
    known = F.col("entry_year").isNotNull() & F.col("exit_year").isNotNull()
    return episodes.filter((start <= end) & known)


def expand_to_years(episodes: DataFrame, first_year: int = codes.FIRST_PANEL_YEAR,
                    last_year: int = codes.LAST_EXTRACT) -> DataFrame:
    """One row per calendar year an episode touches within [first_year, last_year]."""
    start, end = _span(first_year, last_year)
    # without the filter sequence() would count down
    years = F.sequence(start.cast("smallint"), end.cast("smallint"))
    return touching(episodes, first_year, last_year).select("*", F.explode(years).alias("year"))


def monthly_days(episode_years: DataFrame, year: str = "year", entry: str = "entry_date",
                 exit_: str = "exit_date") -> DataFrame:
    """Add days1..days12: the days an episode covers per month of the year, months counting 30.

    A month outside the episode is null, one inside has 30 days. The first month counts from
    the entry day to day 30 (31 in December), the last month up to the exit day, limited to
    1..30; a stretch of February that begins on day 1 and ends on day 28 or 29 is a full month.
    The parts that do not depend on the month are columns of a projection of their own, so the
    twelve month columns stay small enough to be compiled.
    """
    first, last = F.col("_first_month"), F.col("_last_month")
    entry_day, exit_day = F.col("_entry_day"), F.col("_exit_day")
    ends_february = (last == 2) & exit_day.isin(28, 29)
    this_year = F.col(year).cast("int") * 100
    df = episode_years.withColumns({
        # months counted from the row's year: below 1 is earlier, above 12 later
        "_first_month": (div(entry, 100) - this_year).cast("int"),
        "_last_month": (div(exit_, 100) - this_year).cast("int"),
        "_entry_day": date_day(entry), "_exit_day": date_day(exit_),
    }).withColumns({
        "_from_entry": clamp(F.when(first == 12, 31).otherwise(30) - entry_day + 1, 1, 30),
        "_to_exit": F.when(ends_february, F.lit(30)).otherwise(clamp(exit_day, 1, 30)),
        "_between": F.when(ends_february & (entry_day == 1), F.lit(30))
                     .otherwise(clamp(exit_day - entry_day + 1, 1, 30)),
    })

    def days(month: int) -> Column:
        return F.expr(f"""
            CASE WHEN _first_month <= {month} AND _last_month >= {month} THEN
                CASE WHEN _first_month < {month} AND _last_month > {month} THEN 30
                     WHEN _first_month < {month} THEN _to_exit
                     WHEN _last_month > {month} THEN _from_entry
                     ELSE _between END
            END""")

    helpers = [c for c in df.columns if c not in episode_years.columns]
    return df.withColumns({f"days{m}": days(m) for m in MONTHS}).drop(*helpers)


def classify_episode(df: DataFrame) -> DataFrame:
    """Add the 1/0/null flags of an episode; a null code, or a column that a source lacks, gives a
    null flag."""
    lacking = {"contribution_regime", "job_relationship", "firm_muni"} - set(df.columns)
    whole, df = df.columns, df.withColumns({c: F.lit(None).cast("bigint") for c in sorted(lacking)})
    unemployed = F.expr(f"job_relationship IN {tuple(codes.UNEMPLOYED_RELATIONS)}")
    flagged = df.withColumns({
        "rel_contract": flag(in_ranges("contribution_regime", codes.WORK_REGIMES) & ~unemployed),
        "self_emp": flag(in_ranges("contribution_regime", codes.SELF_EMPLOYED_REGIMES)),
        "emp_hogar": flag(in_ranges("contribution_regime", codes.DOMESTIC_REGIMES)),
        "unemp_jr": flag(unemployed),
        "basque_navarra": flag(in_ranges("firm_muni", codes.FORAL_MUNICIPALITIES)),
    })
    return flagged.drop(*(lacking - set(whole)))
