"""What the physical plans must look like, and how hot keys spread."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from annualis import operators as op
from annualis.functions import prefilter, scattered_join
from annualis.functions.lookups import packed_filter
from annualis.operators.income import income_by_firm
from catalog.queries import QUERIES, clean_episodes, merged_contributions, projection

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shuffled(spark):
    """No broadcast and no runtime changes: what a plan does when every side is large."""
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                    spark__sql__adaptive__enabled="false")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    clean_episodes(spark, SF).write.parquet(f"{root}/episodes")
    merged_contributions(spark, SF).write.parquet(f"{root}/contributions")
    projection(spark, SF, "payments").write.parquet(f"{root}/payments")
    return {n: spark.read.parquet(f"{root}/{n}") for n in ("episodes", "contributions", "payments")}


def test_days_are_narrow_and_compiled(spark, tables):
    df = op.monthly_days(op.expand_to_years(tables["episodes"]))
    text = plan(df)
    assert "Exchange" not in text and "*(1)" in text


def test_annual_exchanges(spark, tables):
    """Firm-years, contributions, person-years, lags, and both sides of the main job."""
    with shuffled(spark):
        text = plan(op.annualise(tables["episodes"], tables["contributions"]))
    assert text.count("Exchange hashpartitioning") <= 6
    # the wide attributes are not part of the repeated rows
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert any("contract_type" not in s and "entry_date" in s for s in scans)
    # the self-employed bases are not read for the panel
    assert "contribution_aut_1" not in text
    # the join leaves its rows in the order the next aggregate needs
    below = text[:text.index("SortMergeJoin [person_id", text.index("partial_"))]
    assert "Sort [" not in below[below.rindex("partial_"):]


def test_aggregates_combine_before_the_shuffle(spark, tables):
    for df in (op.dedup_by_key(tables["payments"], ["person_id", "year"]),
               op.drop_conflicting_keys(tables["payments"], ["person_id"]),
               op.keep_top(tables["payments"], ["person_id"], ["wage_cents"]),
               op.merge_contributions(tables["contributions"]),
               income_by_firm(tables["payments"])):
        text = plan(df)
        assert "partial_" in text[text.index("Exchange"):]


def test_numbers_only_aggregates_are_hash_based(spark, tables):
    for df in (op.merge_contributions(tables["contributions"]), income_by_firm(tables["payments"])):
        assert "SortAggregate" not in plan(df)


def test_filters_and_columns_reach_the_scan(spark, tables):
    df = op.prepare_episodes(tables["episodes"]).filter(F.col("person_id") == 7)
    assert "EqualTo(person_id,7)" in plan(df)
    unemployed = income_by_firm(tables["payments"]).select("person_id", "year", "unemp_wage")
    assert "inkind_cents" not in plan(unemployed)


@pytest.mark.parametrize("name", ["person_year", "firm_id_applied", "household_join", "family",
                                  "contract_class", "geography", "cohort_episodes"])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert word not in text


def largest_share(df) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_person_is_spread(spark):
    """A third of all facts belongs to one person."""
    facts = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000).alias("person_id"),
        F.col("id").alias("row"), F.lit(2020).alias("extract_year"))
    cohort = spark.range(5000).select(F.col("id").alias("person_id"),
                                      F.lit(2020).alias("last_extract"))
    with shuffled(spark), settings(spark, spark__sql__shuffle__partitions="64"):
        lookup = cohort.withColumnRenamed("last_extract", "extract_year")
        plain = facts.join(lookup, ["person_id", "extract_year"], "left_semi")
        spread = op.restrict_to_cohort(facts, cohort, ["row"])
        assert largest_share(plain) > 0.33
        assert largest_share(spread) < 0.1
        assert spread.count() == plain.count() == 60_000


def test_cohort_is_applied_before_the_shuffle(spark):
    """Facts of other extracts are dropped where they are read, by a filter of bounded size."""
    facts = spark.range(40_000).select((F.col("id") % 2000).alias("person_id"), F.col("id").alias("row"),
                                       (2000 + F.col("id") % 20).cast("smallint").alias("extract_year"))
    cohort = spark.range(2000).select(F.col("id").cast("int").alias("person_id"),
                                      (2000 + F.col("id") % 20).cast("smallint").alias("last_extract"))
    with shuffled(spark):
        kept = op.restrict_to_cohort(facts, cohort, ["row"])
        text = plan(kept)
        side = text[:text.index("Exchange hashpartitioning(person_id")]
        assert "BroadcastHashJoin" in text[len(side):] and "BroadcastHashJoin" not in side
        lookup = cohort.withColumnRenamed("last_extract", "extract_year")
        near = prefilter(facts, lookup, ["person_id", "extract_year"])
        assert near.columns == facts.columns
        assert kept.count() == 40_000 and near.count() == 40_000
        moved = facts.withColumn("extract_year", (2000 + F.col("row") % 19).cast("smallint"))
        want = op.restrict_to_cohort(moved, cohort, ["row"], filter_slots=0).count()
        assert op.restrict_to_cohort(moved, cohort, ["row"]).count() == want
        assert want <= prefilter(moved, lookup, ["person_id", "extract_year"]).count() <= want + 20


def test_filter_is_packed(spark):
    """64 slots a row, whatever the number of keys; none that is there is lost."""
    lookup = spark.range(50_000).withColumnRenamed("id", "k")
    rows = packed_filter(lookup, ["k"], 1 << 10).collect()
    assert len(rows) == 16 and all(r["bits"] == -1 for r in rows)
    assert prefilter(lookup, lookup, ["k"], 1 << 14).count() == 50_000


def test_unwanted_rows_do_not_gather(spark):
    """Most rows have no identifier to repair; they share one account and still spread."""
    facts = spark.range(60_000).withColumn("k", F.lit("same"))
    lookup = spark.createDataFrame([("same", 1)], "k string, v int")
    with shuffled(spark), settings(spark, spark__sql__shuffle__partitions="64"):
        out = scattered_join(facts, lookup, ["k"], "left", ["id"], wanted=F.col("id") < 0)
        assert largest_share(out) < 0.05


def test_hot_firm_is_combined_before_the_shuffle(spark):
    facts = spark.range(0, 40_000, 1, 8).select(
        (F.col("id") * 0).alias("firm_cc2"), (F.col("id") * 0 + 2020).alias("extract_year"),
        F.col("id").alias("firm_age"), F.col("id").alias("firm_workers"))
    df = op.firm_panel(facts)
    text = plan(df)
    assert "Exchange" not in text[text.index("partial_min"):]
    assert [r["firm_age"] for r in df.collect()] == [39_999]


def test_salted_lookup_is_not_broadcast(spark):
    """The lookup repeated once per salt is larger than its estimate; it is shuffled, not sent through the driver."""
    facts = spark.range(2_000).select(F.col("id"), (F.col("id") % 500).alias("k"))
    lookup = spark.range(500).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10m"):
        out = scattered_join(facts, lookup, ["k"], "left", ["id"])
        assert "Broadcast" not in plan(out)
        assert sorted(out.select("id", "v").collect()) == sorted(facts.join(lookup, "k", "left").select("id", "v").collect())
