"""A training corpus from documents: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annualis.llm.common import configure, written
from annualis.llm.exact_dedup import exact_dedup
from annualis.llm.neighbour_quality import fit, keep_good
from annualis.llm.packing import pack_documents
from annualis.llm.pii import redact
from annualis.llm.queries import table, tokenizer
from annualis.llm.simhash import near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the quality classifier predicts to be label 0."""
    configure(spark)
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id and text are in gone (doc_id, text_sha256); all columns of
    docs stay, whatever their names."""
    rows = _keyed(docs)
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_sha256"] == gone["text_sha256"])
    return rows.join(gone.hint("merge"), same, "left_anti")  # gone grows with the copies


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays; of rows that share it too, one. Null
    counts as empty and as the smallest doc_id."""
    configure(spark)
    classes = written(exact_dedup(docs), "pipeline-classes")
    key = ["doc_id", "text_sha256"]
    dropped = classes.filter("NOT kept").select(*key).distinct()
    tied = written(classes.filter("kept").groupBy(*key).count().filter("count > 1").select(*key), "pipeline-tied")
    gone = written(dropped.union(tied), "pipeline-dropped")
    rows = _keyed(docs)
    same = rows["doc_id"].eqNullSafe(tied["doc_id"]) & (rows["text_sha256"] == tied["text_sha256"])
    one = rows.join(tied, same, "left_semi").dropDuplicates(key)
    return _without(docs, gone).union(one).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that the SimHash near-dedup operator groups, with the shingle length and distance of its
    query, the one with the smallest doc_id stays.

    A null doc_id comes after all others; of several texts under the smallest one, the text with the
    smallest hash stays. Rows are dropped by doc_id and text, so others under the same id stay.
    """
    configure(spark)
    return _without(docs, written(near_copies(docs), "pipeline-near")).select("row.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind; n_chars follows."""
    configure(spark)
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of the texts into sequences of 2048."""
    configure(spark)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("pii", pii),
          ("packing", packing)]
ORACLE_SQL = None  # the stages are trained, hash or tokenise; they are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from documents to packed sequences: the rows of the last one.

    Rows with null or empty texts, null or repeated ids and further columns go through every stage as
    its function says; an empty table gives no sequences.
    """
    docs = table(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
