"""What the operators share: typed input, Arrow batches in slices, tables in the shared folder."""

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20  # text that a Python worker holds as objects at a time
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Whole texts travel to Python: few rows a batch, so that long ones fit.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings that the operators are designed for."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text only, so that no other column can clash; a null text counts as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where that is
    unset (tests), a new one is made and set for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="annualis-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage, outlives executors, and its
    size is known to the optimizer. Its life is that of the shared folder."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MEMORIES: list[dict] = []


def memory(kept: dict) -> dict:
    """A dict in which a module of a Python worker keeps things between tasks."""
    _MEMORIES.append(kept)
    return kept


def forget() -> None:
    """Empties what other operators left in this Python worker, which Spark uses again."""
    for kept in _MEMORIES:
        kept.clear()


_TABLES: dict[str, np.ndarray] = memory({})


class Table:
    """A byte array that travels with the tasks: compressed, and unpacked once in a Python worker.
    destroy() it when what read it is written."""

    def __init__(self, spark: SparkSession, values: np.ndarray):
        self.key = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast(zlib.compress(values.astype(np.uint8).tobytes(), 1))

    def get(self) -> np.ndarray:
        if self.key not in _TABLES:
            forget()
            _TABLES[self.key] = np.frombuffer(zlib.decompress(self.sent.value), np.uint8)
        return _TABLES[self.key]

    def destroy(self) -> None:
        self.sent.destroy()


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about SLICE_BYTES of text each (one row at least)."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def hex64(c: Column) -> Column:
    """A long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))
