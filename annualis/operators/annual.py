"""Episodes to one row per person and year: totals, days, lags and the main job.

The work is two nested aggregates over episode-years. The first is per person, firm and year,
the second per person and year; both combine before their shuffle, and the finer key of the
first spreads a hot person over many tasks. Both only carry keys, days, flags and amounts.
Contributions join between the two, where both sides have unique keys, so the 24 monthly
columns never travel with the episodes; the many attributes of the main job join at the end
from the one episode they belong to, so they are never repeated per year.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annualis import codes
from annualis.functions import row_total
from annualis.operators.contributions import AUTONOMOUS, REGULAR
from annualis.operators.episodes import (
    DAYS, classify_episode, expand_to_years, monthly_days, touching,
)

# In this order the join on them leaves rows sorted for the aggregate by person and year.
FIRM_KEYS = ["person_id", "year", "firm_cc2"]
EPISODE_KEYS = ["person_id", "firm_cc2", "entry_date", "exit_date"]
# The attributes of the main job that are carried to the panel.
MAIN_JOB = ["contribution_regime", "contribution_group", "contract_type", "ptcoef", "firm_muni",
            "firm_workers", "firm_age", "firm_jur_type", "firm_jur_status", "firm_id", "firm_cc",
            "firm_main_prov", "firm_ett", "sector_cnae09", "sector_cnae93", "rel_contract"]
YEAR_FLAGS = {"self_emp": "self_emp_year", "emp_hogar": "emp_hogar_year",
              "unemp_jr": "unemp_year", "basque_navarra": "basque_navarra_year"}
LAGS = (1, 2, 3)


# Entry and exit date as one number: a fixed-width order, unique within a firm after
# prepare_episodes.
EPISODE_ORDER = "entry_date * 100000000 + exit_date"


def firm_years(episode_years: DataFrame, contributions: DataFrame | None = None,
               per_key: str = "sum", flags: str = "first",
               attributes: list[str] = MAIN_JOB) -> DataFrame:
    """Person-firm-year rows: contributions (cents), days, and the first episode's attributes.

    ``per_key='sum'`` counts the bases of a firm-year once per episode in it, ``'max'`` once.
    ``flags='first'`` takes the flags of the first episode, ``'any'`` the maximum. days1..12
    and ``worked`` (null without any) are over relevant episodes only. With attributes of fixed
    width all buffers are numbers and the aggregate is hash based.
    """
    have = set(episode_years.columns)
    carried = [c for c in attributes if c in have]
    year_flags = [c for c in YEAR_FLAGS if c in have]

    def first(c):
        return F.expr(f"min_by({c}, _order) AS {c}")

    df = episode_years.withColumn("_order", F.expr(EPISODE_ORDER)).groupBy(*FIRM_KEYS).agg(
        F.expr("count(1) AS n_episodes"), F.sum(row_total(DAYS)).alias("firm_days"),
        F.expr("min(_order) AS first_episode"),
        F.expr("max(CASE WHEN rel_contract = 1 THEN 1 END) AS worked"),
        *[F.expr(f"max(CASE WHEN rel_contract = 1 THEN {c} END) AS {c}") for c in DAYS],
        *[first(c) for c in carried],
        *[first(c) if flags == "first" else F.expr(f"max({c}) AS {c}") for c in year_flags],
    )
    if contributions is None:
        amounts = [F.expr("CAST(0 AS BIGINT) AS firm_cents"),
                   F.expr("CAST(0 AS BIGINT) AS firm_aut_cents")]
    else:
        annual = contributions.select(
            *FIRM_KEYS, row_total(REGULAR).alias("_cents"), row_total(AUTONOMOUS).alias("_aut"))
        df = df.join(annual, FIRM_KEYS, "left")
        times = "n_episodes" if per_key == "sum" else "1"
        amounts = [F.expr(f"coalesce(_cents * {times}, 0) AS firm_cents"),
                   F.expr(f"coalesce(_aut * {times}, 0) AS firm_aut_cents")]
    return df.select(*FIRM_KEYS, "n_episodes", "first_episode", *amounts, "firm_days", *DAYS,
                     "worked", *carried, *year_flags)


def with_days_lags(df: DataFrame, calendar: bool = False, person: str = "person_id",
                   year: str = "year", days: str = "days") -> DataFrame:
    """Days of the previous one, two and three rows that have days (or calendar years).

    Rows are unique per person and year, so a window holds at most as many rows as there are
    panel years, whoever the person is.
    """
    by_year = W.partitionBy(person).orderBy(year)
    if calendar:
        lags = {n: F.sum(days).over(by_year.rangeBetween(-n, -n)) for n in LAGS}
    else:
        # lag() in the DataFrame API cannot skip nulls
        lags = {n: F.when(F.col(days).isNotNull(), F.expr(
            f"lag({days}, {n}) IGNORE NULLS OVER (PARTITION BY {person} ORDER BY {year})"))
            for n in LAGS}
    return df.withColumns({f"{days}_lag{n}": lag.cast("int") for n, lag in lags.items()})


def annual_days(episode_years: DataFrame, calendar_lags: bool = False) -> DataFrame:
    """Person-year days over relevant episodes with their lags (years without any are absent)."""
    relevant = episode_years.filter(F.col("rel_contract") == 1)
    months = relevant.groupBy("person_id", "year").agg(*[F.max(c).alias(c) for c in DAYS])
    days = months.select("person_id", "year", row_total(DAYS).cast("int").alias("days"))
    return with_days_lags(days, calendar_lags)


def annualise(episodes: DataFrame, contributions: DataFrame | None = None,
              per_key: str = "sum", flags: str = "first", calendar_lags: bool = False,
              first_year: int = codes.FIRST_PANEL_YEAR,
              last_year: int = codes.LAST_EXTRACT) -> DataFrame:
    """Prepared episodes -> one row per person and year: total contribution, flags, main job,
    days and lags.

    The main job is the firm with the highest annual contribution, ties going to the smallest
    firm code; its attributes are those of its first episode. An episode without a person belongs
    to no person-year, as in the cohort join, and is left out. Amounts are summed in cents and
    become euros once, at the end.
    """
    used = touching(episodes, first_year, last_year).filter(F.col("person_id").isNotNull())
    flagged = classify_episode(used)
    attributes = [c for c in MAIN_JOB if c in flagged.columns]
    narrow = flagged.select(*EPISODE_KEYS, "entry_year", "exit_year", "rel_contract", *YEAR_FLAGS)
    years = monthly_days(expand_to_years(narrow, first_year, last_year))
    firms = firm_years(years, contributions, per_key, flags, attributes=[])
    days = " + ".join(f"coalesce(max({c}), 0)" for c in DAYS)
    df = firms.groupBy("person_id", "year").agg(
        F.expr("sum(firm_cents) AS _cents"),
        *[F.expr(f"max({c}) AS {y}") for c, y in YEAR_FLAGS.items()],
        F.expr(f"CAST(CASE WHEN max(worked) = 1 THEN {days} END AS INT) AS days"),
        F.expr("min(struct(-firm_cents AS debit, firm_cc2, first_episode)) AS _main"),
    )
    df = with_days_lags(df.selectExpr(
        "person_id", "year", "CAST(_cents AS DOUBLE) / 100 AS total_contribution",
        *YEAR_FLAGS.values(), "_main.firm_cc2 AS firm_cc2",
        "CAST(-_main.debit AS DOUBLE) / 100 AS main_firm_contrib",
        "_main.first_episode div 100000000 AS entry_date",
        "_main.first_episode % 100000000 AS exit_date", "days",
    ), calendar_lags)
    # a missing firm code is a firm of its own here, hence the null-safe equality
    main = flagged.select(*[F.col(c).alias(f"_{c}") for c in EPISODE_KEYS], *attributes)
    same = [F.col(c) == F.col(f"_{c}") for c in EPISODE_KEYS if c != "firm_cc2"]
    same.append(F.col("firm_cc2").eqNullSafe(F.col("_firm_cc2")))
    return df.join(main, same, "left").select(
        "person_id", "year", "total_contribution", *YEAR_FLAGS.values(),
        F.col("firm_cc2").alias("main_firm_cc2"), "main_firm_contrib", *attributes,
        "days", "days_lag1", "days_lag2", "days_lag3")
