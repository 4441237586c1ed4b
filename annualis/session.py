"""Session settings the operators are designed for. All are runtime SQL settings."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: small sides become broadcasts, tiny partitions are merged, and
    # hot partitions of a sort-merge join are split even if that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A generated method above 8000 bytes of bytecode is never compiled by the JVM's JIT; wide
    # rows are faster as a chain of smaller generated projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the settings to a running session.

    With AQE the shuffle partition number is only the starting point, so on a cluster give a
    generous one (input bytes / 128 MB is a good rule); partitions are merged from there.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


@contextmanager
def lean(spark: SparkSession, more: dict[str, str] | None = None) -> Iterator[None]:
    """For a job that writes a table: its shuffle files go when it ends, instead of staying on the disks
    until the driver happens to collect garbage. ``more`` are other settings of the job."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **(more or {})}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
