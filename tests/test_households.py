from catalog.queries import projection

SF = "/root/testdata/sf0.001"


def test_households_hold_every_order(spark):
    rows = projection(spark, SF, "raw_households")
    assert rows.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert 0 < rows.filter("trim(c0) LIKE 'H%'").count() < rows.count()
