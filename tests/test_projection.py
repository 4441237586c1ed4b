import catalog.queries as queries
from pyspark.sql import functions as F


def test_line_items_are_dealt_by_their_stored_size(spark, tmp_path, monkeypatch):
    """A task's share of the line items stays the same as the table grows: with shuffle partitions
    fixed at 8, a table of 40 units of stored bytes is dealt over 40 partitions."""
    folder = str(tmp_path)
    orders = spark.range(4000).selectExpr("id AS o_orderkey", "id % 300 AS o_custkey")
    orders.write.parquet(f"{folder}/orders.parquet")
    spark.range(16000).selectExpr(
        "id % 4000 AS l_orderkey", "id % 50 AS l_suppkey", "DATE'2020-01-01' + CAST(id % 700 AS INT) AS l_shipdate",
        "IF(id % 3 = 0, 'R', 'N') AS l_returnflag", "CAST(id AS DECIMAL(15, 2)) AS l_extendedprice",
    ).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    stored = queries.stored_bytes(spark, f"{folder}/lineitem.parquet")
    monkeypatch.setattr(queries, "STORED_BYTES_A_PARTITION", -(-stored // 40))

    rows = queries.projection(spark, folder, "contributions")
    assert rows.count() == 16000
    assert rows.select(F.spark_partition_id()).distinct().count() == 40
