"""Keys, text typing, firms and persons on small hand-made rows."""

from pyspark.sql import functions as F

from annualis import operators as op
from annualis.functions import (
    birth_year, clamp, safe_int, scattered_join, strip, strip_zeros, without_prefix,
)
from annualis.operators.attributes import family_composition


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_conflicts_drop_the_key_but_copies_do_not(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, "x", 1), (2, "x", None),
                                (3, None, 4)], "k int, a string, b int")
    assert rows(op.drop_conflicting_keys(df, ["k"])) == [(1, "x", None), (3, None, 4)]


def test_dedup_takes_the_smallest_row_nulls_first(spark):
    df = spark.createDataFrame([(5, 1, "b"), (5, 1, None), (4, 2, "c")], "a int, k int, b string")
    assert rows(op.dedup_by_key(df, ["k"])) == [(4, 2, "c"), (5, 1, None)]


def test_keep_top(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 30, "b"), (1, 30, "c")], "k int, v int, s string")
    assert rows(op.keep_top(df, ["k"], [-F.col("v"), "s"])) == [(1, 30, "b")]


def test_text_typing(spark):
    texts = ["34", " 34\t", " 34 ", "12.5", "1e3", "", "+5", "00123", "x", None,
             "99999999999", "3 4", "-7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(safe_int("t", "int")).collect()]
    assert got == [34, 34, 34, None, None, None, 5, 123, None, None, None, None, -7]
    assert [r[0] for r in df.select(safe_int(F.col("t"), "int")).collect()] == got
    df = spark.createDataFrame([("00000000000000000000123",), ("-" + "0" * 30 + "5",), ("9" * 20,)], "t string")
    assert [r[0] for r in df.select(safe_int("t")).collect()] == [123, -5, None]
    df = spark.createDataFrame([("N34",), (" N 5 ",), ("NN1",), ("7",), (None,)], "t string")
    assert [r[0] for r in df.select(without_prefix("t")).collect()] == ["34", "5", "N1", "7", None]
    df = spark.createDataFrame([("0000",), (" 0012 ",), ("",), ("a0",), (None,)], "t string")
    assert [r[0] for r in df.select(strip_zeros("t")).collect()] == ["0", "12", "0", "a0", None]
    df = spark.createDataFrame([("197 01",), ("197001",), ("19",)], "t string")
    assert [r[0] for r in df.select(birth_year("t")).collect()] == [None, 1970, 19]
    assert spark.range(1).select(strip(F.lit("\n a 　"))).collect()[0][0] == "a"


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5,), (5,), (50,)], "v int")
    assert [r[0] for r in df.select(clamp(F.col("v"), 0, 30)).collect()] == [None, 0, 5, 30]


def test_scattered_join_equals_plain_join(spark):
    facts = spark.range(5000).select(F.col("id"), (F.col("id") % 7 % 3).alias("k"))
    facts = facts.withColumn("k", F.when(F.col("id") % 11 > 0, F.col("k")))
    lookup = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    plain = rows(facts.join(lookup, "k", "left"))
    assert rows(scattered_join(facts, lookup, ["k"], "left", ["id"])) == plain
    semi = rows(facts.join(lookup, "k", "left_semi").select("id", "k"))
    assert rows(scattered_join(facts, lookup, ["k"], "left_semi", ["id"]).select("id", "k")) == semi
    wanted = F.col("id") % 2 == 0
    half = rows(scattered_join(facts, lookup, ["k"], "left", ["id"], wanted=wanted))
    assert half == [(k, i, v if i % 2 == 0 else None) for k, i, v in plain] or (
        sorted((r[0], r[1], r[2]) for r in half if r[2]) ==
        sorted((k, i, v) for k, i, v in plain if v and i % 2 == 0))


def test_firm_id_correction(spark):
    data = [("two", 0, 2005), ("two", 9, 2006), ("three", 0, 2005), ("three", 7, 2005),
            ("three", 8, 2010), ("four", 0, 2005), ("four", 1, 2005), ("four", 2, 2005),
            ("four", 3, 2005), ("nozero", 1, 2005), ("nozero", 2, 2005), ("null", 0, 2005),
            ("null", None, 2006), ("mixed", 0, 2005), ("mixed", None, 2007), ("mixed", 4, 2006),
            ("tie", 0, 2005), ("tie", 6, 2006), ("tie", 5, 2006), (None, 0, 2005), (None, 1, 2005)]
    df = spark.createDataFrame([(c, i, y, 20040101) for c, i, y in data]
                               + [("old", 0, 2005, 20040101), ("old", 1, 2005, 20011231)],
                               "firm_cc string, firm_id long, extract_year int, exit_date long")
    got = dict(rows(op.firm_id_correction(df)))
    assert got == {"two": 9, "three": 8, "mixed": 4, "tie": 5}
    panel = spark.createDataFrame([(1, "two", 0), (2, "two", 3), (3, "four", 0), (4, None, 0),
                                   (5, "two", None)], "i int, firm_cc string, firm_id long")
    fixed = op.apply_firm_id(panel, op.firm_id_correction(df), ["i"])
    assert [r[2] for r in rows(fixed)] == [9, 3, 0, 0, None]


def test_firm_panel(spark):
    df = spark.createDataFrame(
        [("f", 2005, 1990, 10, "A", None), ("f", 2005, None, None, "Z", 3),
         ("f", 2006, 1985, None, "B", 2), ("f", 2006, 1991, 20, "B", 2), ("f", 2008, 1990, None, "?", 1)],
        "firm_cc2 string, extract_year int, firm_age long, firm_workers long, "
        "firm_jur_status string, firm_jur_type long")
    got = [(r["year"], r["firm_age"], r["firm_workers"], r["firm_jur_status"], r["firm_jur_type"],
            r["ini_year"], r["end_year"]) for r in op.firm_panel(df).orderBy("year").collect()]
    assert got == [(2005, None, None, None, 3, 2005, 2008), (2006, 1991, 20, "B", 2, 2005, 2008),
                   (2008, 1990, 20, "B", 1, 2005, 2008)]


def test_consolidation(spark):
    df = spark.createDataFrame(
        [("a", 2005, "198003", 2, None, "196001"), ("a", 2006, None, 0, 7, None),
         ("b", 2005, "198003", 1, 1, None), ("b", 2006, "198103", 1, 1, None),
         ("c", 2005, None, 1, 1, None), ("d", 2005, "198003", 3, 1, None),
         ("e", 2005, "1980", 3, 1, "x"), ("e", 2007, "198012", 1, None, "y")],
        "person_id string, extract_year int, birth_date string, sex byte, education int, "
        "birth_date2 string")
    got = {r["person_id"]: r.asDict() for r in op.consolidate_entity(df).collect()}
    assert set(got) == {"a", "e"}
    assert got["a"] == {"person_id": "a", "first_extract": 2005, "last_extract": 2006,
                        "birth_year": 1980, "birth_month": 3, "birth_date": "198003", "sex": 0,
                        "education": 7, "birth_date2": None}
    assert (got["e"]["birth_month"], got["e"]["education"], got["e"]["birth_date2"]) == (12, 1, "y")
    years = {(r["person_id"], r["year"])
             for r in op.rectangularise(op.consolidate_entity(df), 2009).collect()}
    assert years == {(p, y) for p in ("a", "e") for y in range(1996, 2010)}


def test_demographics_join_equals_the_rectangular_panel(spark):
    persons = spark.createDataFrame(
        [("a", 1980, 2005, 2006), ("b", 2000, 2010, 2012), ("c", 1950, 2024, 2024)],
        "person_id string, birth_year int, first_extract short, last_extract short")
    years = spark.createDataFrame([(p, y) for p in "abcd" for y in range(1960, 2025)],
                                  "person_id string, year short")
    panel = op.rectangularise(persons)
    want = rows(years.join(panel, ["person_id", "year"], "left").select(
        "person_id", "year", "birth_year", "first_extract", "last_extract"))
    got = op.demographics_join(years, persons)
    assert rows(got.select("person_id", "year", "birth_year", "first_extract",
                           "last_extract")) == want


def test_family(spark):
    df = spark.createDataFrame(
        [(2010, "2004", " 200501 ", "1940xx"), (2010, None, "2015", "bad"), (2010, "188901", "1994", "200311")],
        "year short, birth_date2 string, birth_date3 string, birth_date4 string")
    got = family_composition(df).select("famsize", "famsize_06", "famsize_715", "famsize_a65")
    assert [tuple(r) for r in got.collect()] == [(4, 2, 0, 1), (1, 0, 0, 0), (4, 0, 1, 0)]


def test_results_do_not_depend_on_partitioning(spark):
    from catalog.queries import QUERIES

    def hashed(name):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        return df.select(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).collect()[0][0]

    names = ["person_year", "firm_panel", "read_households", "firm_id_fix"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    many = [hashed(n) for n in names]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert [hashed(n) for n in names] == many
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
