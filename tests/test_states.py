"""Mergeable states of persons, sketches, row-wise typing, and incomes of a person."""

import random

import pytest
from pyspark.sql import functions as F

from annualis import operators as op
from annualis.functions import safe_int, strip
from annualis.functions.text import ascii_row, plain_row, row_int, row_strip
from annualis.operators.income import person_income, personal_income


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SNAPSHOT = ("person_id long, extract_year short, birth_date string, sex tinyint, nationality int, education int, "
            "birth_date2 string, sex2 string")


def snapshots(spark, seed):
    rng = random.Random(seed)
    data = {}
    for _ in range(400):
        person, year = rng.randrange(60), 2005 + rng.randrange(8)
        data[person, year] = (person, year, rng.choice([None, f"{1950 + person % 40}01", f"{1950 + person % 40}07"])
                              if person % 9 else rng.choice(["195001", "195101"]),
                              rng.choice([None, 0, 1 + person % 2]) if person % 7 else 3, rng.choice([None, 34, 5]),
                              rng.choice([None, 10, 40]), rng.choice([None, "200101"]), rng.choice([None, "1"]))
    return spark.createDataFrame(list(data.values()), SNAPSHOT)


@pytest.mark.parametrize("seed,parts", [(1, 2), (2, 3), (3, 5)])
def test_states_of_parts_merge_to_the_whole(spark, seed, parts):
    """Any split of the snapshots, merged in any order and in any grouping, gives the same persons."""
    df = snapshots(spark, seed)
    want = op.consolidate_entity(df)
    states = [op.entity_state(df.filter(F.pmod(F.xxhash64("person_id", "extract_year"), F.lit(parts)) == k))
              for k in range(parts)]
    whole = op.entity_of_state(op.merge_entity_states(*reversed(states)))
    assert whole.columns == want.columns and whole.dtypes == want.dtypes
    assert rows(whole) == rows(want) and want.count() > 20
    pair = op.merge_entity_states(op.merge_entity_states(*states[:2]), *states[2:])
    assert rows(op.entity_of_state(pair)) == rows(want)


def test_a_later_extract_can_undo_a_person(spark):
    """A second birth year drops a person who was fine before, and a sex that was missing adds one."""
    old = spark.createDataFrame([(1, 2005, "198001", 1), (2, 2005, "198001", None)],
                                "person_id long, extract_year short, birth_date string, sex tinyint")
    new = spark.createDataFrame([(1, 2006, "198101", 1), (2, 2006, None, 2)], old.schema)
    before = op.entity_state(old)
    assert [r["person_id"] for r in op.entity_of_state(before).collect()] == [1]
    after = op.entity_of_state(op.merge_entity_states(before, op.entity_state(new)))
    assert [(r["person_id"], r["sex"], r["last_extract"]) for r in after.collect()] == [(2, 0, 2006)]


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 20_011).alias("person_id"), (F.col("id") % 7).alias("year"))
    states = op.person_states(df, ["year"])
    every = op.merge_states(states.withColumn("all", F.lit(1)), ["all"])
    assert abs(op.estimated(every).first()["n_estimated"] - 20_011) <= 20_011 * op.ERROR
    exact = {r["year"]: r["n_entities"] for r in op.exact(df, ["year"]).collect()}
    for r in op.estimated(states).collect():
        assert abs(r["n_estimated"] - exact[r["year"]]) <= exact[r["year"]] * op.ERROR
    none = op.person_states(df.withColumn("person_id", F.lit(None).cast("long")), ["year"])
    assert {(r["n_rows"] > 0, r["n_estimated"]) for r in op.estimated(none).collect()} == {(True, 0)}
    assert "SortAggregate" not in op.exact(df, ["year"])._jdf.queryExecution().executedPlan().toString()


ODD = ["1", " 2 ", "-3", "+4", "", " ", None, "0005", "12x", "1 2", "\t6", "7 ", "9" * 18, "9" * 19, "9" * 20, "0" * 30 + "8",
       "1e3", "1.0", "٣", "5;6", "300", "40000", " 8", "é", "--1", "+", "null"]


def test_typing_by_row_equals_typing_by_field(spark):
    """Every odd text beside plain ones and beside another odd one."""
    rng = random.Random(4)
    data = [(a, "7") for a in ODD] + [("7", a) for a in ODD] + [(rng.choice(ODD), rng.choice(ODD)) for _ in range(200)]
    df = spark.createDataFrame(data, "a string, b string")
    marked = df.selectExpr("*", f"{plain_row(['a', 'b'])} AS _plain", f"{ascii_row(['a', 'b'])} AS _ascii")
    for dtype in ("tinyint", "smallint", "int", "bigint"):
        got = marked.select(*[F.expr(row_int(c, dtype)).alias(c) for c in "ab"])
        assert rows(got) == rows(df.select(*[safe_int(c, dtype).alias(c) for c in "ab"]))
    got = marked.select(*[F.expr(row_strip(c)).alias(c) for c in "ab"])
    assert rows(got) == rows(df.select(*[strip(c).alias(c) for c in "ab"]))


def test_personal_income_is_one_table(spark):
    """The same as the tables of each kind joined, person-years of one kind only included."""
    payments = spark.createDataFrame(
        [(1, "01", 2010, "C", None, 500, 10), (1, "2", 2010, "C", None, 700, 0), (1, "2", 2010, "G", 1, 900, 5),
         (2, "3", 2011, "G", 1, 40, 0), (3, "3", 2011, "A", None, 99, 0), (4, "3", 2011, "B", None, 9, 0)],
        "person_id long, firm_id string, year short, payment_type string, payment_subtype int, wage_cents long, "
        "inkind_cents long")
    by_firm = op.income_by_firm(payments)
    each = person_income(by_firm, "unemp").join(person_income(by_firm, "prof"), ["person_id", "year"], "full")
    got = personal_income(by_firm)
    assert rows(got.select(each.columns)) == rows(each) and got.count() == 2
