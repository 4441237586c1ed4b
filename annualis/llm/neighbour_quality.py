"""Quality by votes of the nearest labelled texts in a latent-semantic space.

A text is a vector of tf-idf weights of hashed byte triplets and of how much of it repeats. A
truncated SVD of a bounded sample of labelled texts gives the latent space; the sample's vectors are
broadcast, and every text gets the exact cosines to all of them, in blocks. The nearest ones vote
with their labels, weighted by similarity.
"""

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import forget, slices, texts

TERMS = 4096
TERM_BITS = 12
REPEATS = 2  # adjacent equal words, words met before
REPEAT_WEIGHT = 0.7
MAX_LABELLED = 6000  # rows of each table are sampled to this many: 6000 x 64 floats are 1.5 MB
DIMENSIONS = 64
NEIGHBOURS = 15
THRESHOLD = 0.3


def counts(texts_: list[str]) -> np.ndarray:
    """Rows of log counts of hashed byte triplets, and of shares of repetition."""
    out = np.zeros((len(texts_), TERMS + REPEATS), dtype=np.float32)
    for row, text in zip(out, texts_):
        data = text.encode()
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        if len(b) >= 3:
            h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
            h = (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - TERM_BITS)
            row[:TERMS] = np.log1p(np.bincount(h, minlength=TERMS))
        words = data.split()
        n = len(words) + 1
        row[TERMS:] = sum(map(eq, words, words[1:])) / n, (len(words) - len(set(words))) / n
    return out


@dataclass
class Neighbours:
    idf: np.ndarray
    axes: np.ndarray  # (TERMS + REPEATS) x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, of length one
    labels: np.ndarray

    def place(self, rows: np.ndarray) -> np.ndarray:
        latent = weigh(rows, self.idf) @ self.axes
        return latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9)

    def score(self, rows: np.ndarray, neighbours: int) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled texts, 0 to 1."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        k = min(neighbours, len(self.labels))
        cosines = self.place(rows) @ self.vectors.T
        top = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, top, axis=1), 0).astype(np.float64) + 1e-6
        return np.clip((weight * self.labels[top]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def weigh(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    terms = rows[:, :TERMS] * idf
    terms /= np.linalg.norm(terms, axis=1, keepdims=True) + 1e-9
    return np.hstack([terms, REPEAT_WEIGHT * np.sqrt(rows[:, TERMS:])])


def fit_vectors(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Neighbours:
    """Latent space of labelled rows (which are overwritten), by randomised subspace iteration."""
    found = np.count_nonzero(rows[:, :TERMS], axis=0)
    idf = (np.log((1 + len(rows)) / (1 + found)) + 0.2).astype(np.float32)
    weights = rows  # the sample is weighed in place: the driver holds it once
    for k in range(0, len(rows), 256):
        weights[k:k + 256] = weigh(rows[k:k + 256], idf)
    width = min(dimensions + 8, *weights.shape) if len(rows) else 1
    basis = np.random.default_rng(1).standard_normal((weights.shape[1], width)).astype(np.float32)
    for _ in range(4 if len(rows) else 0):
        basis, _ = np.linalg.qr(weights.T @ (weights @ basis))
    if len(rows):
        _, _, turn = np.linalg.svd(weights @ basis, full_matrices=False)
        basis = basis @ turn[:dimensions].T
    basis = basis.astype(np.float32)
    latent = weights @ basis
    return Neighbours(idf, basis, latent / (np.linalg.norm(latent, axis=1, keepdims=True) + 1e-9), labels)


def held_out(doc_id) -> F.Column:
    """Rows that no label may be learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Neighbours:
    """Fits on at most max_labelled labelled rows that are not held out: those with the least hash
    of their id. Labels that are null are no labels. Without any, every score is 0.5. Of several
    rows with the same id in docs the smallest text counts, so max_labelled rows reach the driver
    at most."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    def terms(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                rows = counts(part.column("text").to_pylist())
                # Sparse and short: what the driver gets is bounded by the sample.
                sent = [_packed(r) for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array(sent, pa.binary())],
                    ["doc_id", "label", "terms"])

    chosen = (texts(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")  # max_labelled narrow rows
              .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    rows = (chosen
            .mapInArrow(terms, "doc_id long, label int, terms binary").toArrow())
    rows = rows.sort_by([("doc_id", "ascending"), ("terms", "ascending")])
    matrix = np.zeros((rows.num_rows, TERMS + REPEATS), dtype=np.float32)
    for r, sent in enumerate(rows["terms"]):
        _unpack(sent.as_py(), matrix[r])
    marks = rows["label"].to_numpy().astype(np.float64)
    del rows
    return fit_vectors(matrix, marks)


def _packed(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row).astype("<u2")
    return len(at).to_bytes(4, "little") + at.tobytes() + row[at].astype("<f4").tobytes()


def _unpack(data: bytes, row: np.ndarray) -> None:
    n = int.from_bytes(data[:4], "little")
    row[np.frombuffer(data, "<u2", n, 4)] = np.frombuffer(data, "<f4", n, 4 + 2 * n)


def score(docs: DataFrame, model: Neighbours, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS,
          id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold) of every text.

    Only the text decides the score; a null one counts as empty. Repeated rows get equal scores.
    keep: further columns of docs to pass through.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by max_labelled x dimensions
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *keep)
    out = [c for c in rows.columns if c != "text"]

    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                found = shared.value.score(counts(part.column("text").to_pylist()), neighbours)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in out), pa.array(found)], [*out, "score"])
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "text")
    return (rows.mapInArrow(run, f"{schema}, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), *keep))


def keep_good(docs: DataFrame, model: Neighbours, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS,
              text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores `threshold` or more, with all their columns; a null text
    counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_labelled x dimensions

    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch, text_col):
                column = [t or "" for t in part.column(text_col).to_pylist()]
                yield part.filter(pa.array(shared.value.score(counts(column), neighbours) >= threshold))
    return docs.mapInArrow(run, docs.schema)
