"""Resampling documents towards a target distribution by hashed n-gram importance weights.

A document's words are normalised to be parted by one space and scanned once for the running CRC-32
at the end of every word. The CRC of the words i to j follows from two of these prefixes: CRC is
linear over GF(2), so the part before word i, shifted by the length of the n-gram, cancels out.
Counts of hashed n-grams over all documents and over the target give each bucket a gain; a
document's weight is the mean gain of its n-grams, and Gumbel noise from its id makes the draw.
"""

import math
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.llm.common import SLICE_BYTES, forget, slices, texts, written

SIZES = (1, 1)  # shortest and longest n-gram
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

# Bytes of a word: ASCII letters and digits, and all bytes of other characters; the rest separates.
KEPT = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
POLYNOMIAL = 0xEDB88320  # CRC-32, reflected
TABLED = 256  # shifts of fewer bytes have a table each; longer ones are put together from these


@lru_cache
def byte_table() -> np.ndarray:
    """What one more byte does to a CRC register."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


def _applied(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    return table[0][c & 255] ^ table[1][c >> 8 & 255] ^ table[2][c >> 16 & 255] ^ table[3][c >> 24]


@lru_cache(maxsize=4096)
def shift_table(length: int) -> np.ndarray:
    """The GF(2) operator of `length` zero bytes, as one table for each byte of the CRC."""
    if length == 0:
        return (np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).astype(np.uint32)
    if length == 1:
        c = shift_table(0)
        return (c >> 8) ^ byte_table()[c & 255]
    half = shift_table(length // 2)
    both = np.stack([_applied(half, row) for row in half])
    return both if length % 2 == 0 else np.stack([_applied(shift_table(1), row) for row in both])


@lru_cache
def _shifts() -> np.ndarray:
    return np.stack([shift_table(n) for n in range(TABLED)])


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved past `length` bytes."""
    tables, short = _shifts(), length < TABLED
    n = np.where(short, length, 0)
    out = (tables[n, 0, crc & 255] ^ tables[n, 1, crc >> 8 & 255] ^ tables[n, 2, crc >> 16 & 255]
           ^ tables[n, 3, crc >> 24])
    for n in np.unique(length[~short]).tolist():
        at = length == n
        out[at] = _applied(shift_table(n), crc[at])
    return out


def sections(data: bytes, size: int = SLICE_BYTES):
    """Parts of normalised text of about `size` bytes, cut at separators."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def running(text: str) -> tuple[np.ndarray, np.ndarray]:
    """CRC and length of the normalised text up to the end of each word; a space comes before every
    word, the first one too."""
    crcs, ends, crc = [], [], 0
    for part in sections(text.encode().lower().translate(KEPT)):
        words = [b" " + w for w in part.split()]
        if words:
            found = list(accumulate(words, lambda c, w: crc32(w, c), initial=crc))
            crc = found[-1]
            crcs.append(np.array(found[1:], dtype=np.uint32))
            ends.append(np.fromiter(map(len, words), np.int64, len(words)))
    if not crcs:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    return np.concatenate(crcs), np.cumsum(np.concatenate(ends))


def ngram_crcs(text: str, sizes: tuple[int, int] = SIZES) -> np.ndarray:
    """CRC-32 of every run of sizes[0] to sizes[1] words joined by one space."""
    crc, end = running(text)
    before = np.concatenate([np.zeros(1, np.uint32), crc[:-1]])
    start = np.concatenate([np.zeros(1, np.int64), end[:-1]]) + 1
    space = ~before  # the space before a word, in the register's own form
    before = ~((space >> 8) ^ byte_table()[(space ^ 32) & 255])
    out = []
    for size in range(sizes[0], sizes[1] + 1):
        n = max(0, len(crc) - size + 1)
        out.append(crc[size - 1:size - 1 + n] ^ shifted(before[:n], (end[size - 1:size - 1 + n] - start[:n])))
    return np.concatenate(out)


def hashed(docs: DataFrame, sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all features (little-endian unsigned 32 or, if
    they fit, 16 bits)."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                column = part.column("text").to_pylist()
                found = [ngram_crcs(t, sizes) for t in column]
                words = [len(f) if sizes == (1, 1) else len(ngram_crcs(t, (1, 1))) for f, t in zip(found, column)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words, pa.int64()), pa.array(map(len, found), pa.int64()),
                     pa.array([(f % np.uint32(buckets)).astype(kind).tobytes() for f in found], pa.binary())],
                    ["doc_id", "n_words", "n_features", "buckets"])
    return texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_words long, n_features long, buckets binary")


def _flat(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows of hashed(); the driver gets one row a bucket."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("buckets"), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])
    rows = (found.select("buckets").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(buckets, dtype=np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the source)) of every bucket, one added to each."""
    n, m, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (n + k) / ((s + 1.0) * (m + k))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of rows of hashed()."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(batches):
        for batch in batches:
            n = batch.column("n_features").to_numpy(False)
            sums = np.concatenate([[0], np.cumsum(gain[_flat(batch.column("buckets"), kind)])])
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")),
                                              pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])
    return found.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 g) of Gumbel noise g that only the id and the seed decide; a null id is empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, wanted: int) -> DataFrame:
    """Adds rank 1 to `wanted` by descending score, ascending doc_id (null last) and row to scored,
    a written table with a unique column row; other rows get null.

    Nothing gathers in a task: rows that may be drawn are sorted by ranges, and a row's rank is its
    place in its range after the rows of the ranges before, one number a range.
    """
    none = F.lit(None).cast("long").alias("rank")
    # Scores are thousandths of logarithms, so there are not many of them, whatever the rows.
    sizes = scored.filter("eligible").groupBy("score").count()
    above = F.sum("count").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    last = sizes.select("score", above.alias("above")).filter(F.coalesce("above", F.lit(0)) < wanted).agg(F.min("score")).first()[0]
    if not wanted or last is None:
        return scored.select("*", none)
    near = scored.filter(F.col("eligible") & (F.col("score") >= last))
    order = [F.desc("score"), F.col("doc_id").isNull(), "doc_id", "row"]
    placed = written(near.repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("_at", F.monotonically_increasing_id()), "importance-ranges")
    part = F.shiftright("_at", 33).alias("_part")
    counts = placed.groupBy(part).count()  # one row a partition
    offsets = counts.select("_part", F.coalesce(F.sum("count").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
             .withColumn("rank", F.when(rank <= wanted, rank)))
    rest = scored.filter(~F.col("eligible") | (F.col("score") < last)).select("*", none)
    return drawn.select(rest.columns).union(rest)


def resample(docs: DataFrame, target: DataFrame, sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS,
             seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT, id_col: str = "doc_id",
             text_col: str = "text", target_text: str = "text") -> DataFrame:
    """Draws floor(percent * N / 100) of the N documents of `least_words` words or more, without
    replacement, towards the target's distribution of n-grams.

    Returns doc_id, n_features, weight, score and rank (null if not drawn) of every document. A null
    or empty text has no features and weight 0. Repeated rows each come back, and tie: any order of
    them is a right one, the one taken is kept. A null doc_id comes after others of its score. An
    empty target or an empty table is no error; further columns of either are not read.
    """
    found = written(hashed(docs, sizes, buckets, id_col, text_col), "importance-buckets")
    aim = hashed(target.select(F.lit(0).alias("doc_id"), F.col(target_text).alias("text")), sizes, buckets)
    rows = weighed(found, gains(bucket_counts(found, buckets), bucket_counts(aim, buckets)))
    scored = written(rows.select(
        "doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"), F.monotonically_increasing_id().alias("row")),
        "importance-scores")
    drawn = ranked(scored, percent * scored.filter("eligible").count() // 100)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
