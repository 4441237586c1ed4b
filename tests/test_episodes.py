"""Day rules on hand-made episodes, and episode clean-up."""

import datetime as dt

from pyspark.sql import functions as F

from annualis import operators as op
from annualis.operators.episodes import DAYS

# entry, exit, year -> {month: days}
GOLDEN = [
    (20000201, 20000228, 2000, {2: 30}),
    (20000131, 20000131, 2000, {1: 1}),
    (20000131, 20000331, 2000, {1: 1, 2: 30, 3: 30}),
    (20001231, 20010101, 2000, {12: 1}),
    (20001231, 20010101, 2001, {1: 1}),
    (20000201, 20000315, 2000, {2: 30, 3: 15}),
    (20000115, 20000229, 2000, {1: 16, 2: 30}),
    (20000228, 20000228, 2000, {2: 1}),
    (20000210, 20000228, 2000, {2: 19}),
    (20001201, 20001231, 2000, {12: 30}),
    (20001202, 20020110, 2000, {12: 30}),
    (20001203, 20020110, 2000, {12: 29}),
    (20001202, 20020110, 2001, {m: 30 for m in range(1, 13)}),
    (20001202, 20020110, 2002, {1: 10}),
    (20001202, 20020110, 2003, {}),
    (20000105, None, 2000, {}),
    (None, 20000105, 2000, {}),
]


def test_golden_days(spark):
    rows = [(i, a, b, y) for i, (a, b, y, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "i int, entry_date long, exit_date long, year int")
    got = {r["i"]: {m: r[f"days{m}"] for m in range(1, 13) if r[f"days{m}"] is not None}
           for r in op.monthly_days(df).collect()}
    assert got == {i: want for i, (_, _, _, want) in enumerate(GOLDEN)}


def test_days_against_counted_calendar(spark):
    """Where a month has 30 days the rule is the calendar, so days can be counted one by one."""
    start = dt.date(2001, 1, 1)
    spans = [(start + dt.timedelta(days=i * 13 % 700), (i * 29) % 400) for i in range(300)]
    rows = []
    for a, length in spans:
        b = a + dt.timedelta(days=length)
        number = lambda d: d.year * 10000 + d.month * 100 + d.day
        for year in range(a.year, b.year + 1):
            for month in (4, 6, 9, 11):
                days = sum(a <= dt.date(year, month, d) <= b for d in range(1, 31))
                rows.append((number(a), number(b), year, month, days or None))
    df = spark.createDataFrame(
        rows, "entry_date long, exit_date long, year int, month int, want int")
    days = F.element_at(F.array(*DAYS), F.col("month"))
    wrong = op.monthly_days(df).filter(~days.eqNullSafe(F.col("want")))
    assert wrong.count() == 0


def test_prepare_drops_negative_open_and_copies(spark):
    df = spark.createDataFrame(
        [("a", "f", 20000101, 20000201, 7), ("a", "f", 20000101, 20000201, 3),
         ("a", "f", 20000101, 19990101, 1), ("a", "f", 20000101, None, 1),
         ("a", None, 20000101, 20000101, 2)],
        "person_id string, firm_cc2 string, entry_date long, exit_date long, ptcoef long")
    got = {(r["firm_cc2"], r["ptcoef"], r["entry_year"], r["exit_year"])
           for r in op.prepare_episodes(df).collect()}
    assert got == {("f", 3, 2000, 2000), (None, 2, 2000, 2000)}


def test_expansion_is_limited_and_never_counts_down(spark):
    df = spark.createDataFrame([(1, 1950, 1961), (2, 2023, 2030), (3, 2026, 2030), (4, 1950, 1955)],
                               "i int, entry_year short, exit_year short")
    got = sorted((r["i"], r["year"]) for r in op.expand_to_years(df).collect())
    assert got == [(1, 1960), (1, 1961), (2, 2023), (2, 2024)]


def _episodes(spark, rows):
    return op.prepare_episodes(spark.createDataFrame(
        rows, "person_id string, firm_cc2 string, entry_date long, exit_date long, "
              "contribution_regime long, job_relationship long, firm_muni long, "
              "firm_cc string"))


def _bases(spark, rows):
    """(person, firm, year, cents in January) as merged contributions."""
    df = spark.createDataFrame(rows, "person_id string, firm_cc2 string, year short, c long")
    months = [F.when(F.lit(m) == 1, F.col("c")).alias(f"contribution_{m}") for m in range(1, 13)]
    return op.merge_contributions(df.select("person_id", "firm_cc2", "year", *months))


def test_main_job_totals_and_options(spark):
    episodes = _episodes(spark, [
        ("a", "f1", 20010101, 20010131, 111, 100, 28079, "c1"),
        ("a", "f1", 20010301, 20010331, 530, 100, 48020, "c2"),
        ("a", "f2", 20010101, 20010228, 111, 100, 28079, "c3"),
        ("a", "f3", 20030101, 20031231, 111, None, 28079, "c4"),
        ("a", "f3", 20040101, 20041231, 111, 751, 28079, "c5"),
        ("a", "f4", 20050101, 20051231, 111, 1, 28079, "c6"),
    ])
    bases = _bases(spark, [("a", "f1", 2001, 100), ("a", "f2", 2001, 200), ("a", "f2", 2001, 150)])
    got = {r["year"]: r for r in op.annualise(episodes, bases).collect()}
    first = got[2001]
    # f1 counts its base once per episode, so it ties with f2 and wins by its code
    assert (first["total_contribution"], first["main_firm_cc2"], first["main_firm_contrib"],
            first["firm_cc"]) == (4.0, "f1", 2.0, "c1")
    # flags come from the first episode of each firm
    assert (first["self_emp_year"], first["basque_navarra_year"]) == (0, 0)
    # January in both firms counts once; March is not relevant work
    assert first["days"] == 60
    # no relevant work: no days, and the lag of a later year skips it
    assert got[2003]["days"] is None and got[2003]["rel_contract"] is None
    assert got[2004]["days"] is None and got[2004]["unemp_year"] == 1
    assert (got[2005]["days"], got[2005]["days_lag1"], got[2005]["days_lag2"]) == (360, 60, None)

    other = {r["year"]: r for r in op.annualise(episodes, bases, per_key="max", flags="any",
                                                calendar_lags=True).collect()}
    assert (other[2001]["total_contribution"], other[2001]["main_firm_cc2"]) == (3.0, "f2")
    assert (other[2001]["self_emp_year"], other[2001]["basque_navarra_year"]) == (1, 1)
    assert other[2003]["days_lag2"] == 60 and other[2005]["days_lag1"] is None


def test_missing_firm_code_is_a_firm(spark):
    episodes = _episodes(spark, [("a", None, 20010101, 20010131, 111, 1, 28079, "c1")])
    row = op.annualise(episodes).collect()[0]
    assert (row["main_firm_cc2"], row["firm_cc"], row["days"]) == (None, "c1", 30)


def test_contributions_without_second_source(spark):
    merged = _bases(spark, [("a", "f", 2001, 5), ("a", "f", 2001, 9)]).collect()
    assert [(r["contribution_1"], r["contribution_2"], r["contribution_aut_1"])
            for r in merged] == [(9, None, None)]
