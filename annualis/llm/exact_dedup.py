"""Exact dedup by composable polynomial fingerprints.

A text's fingerprint is a pair of polynomials in its bytes, modulo two primes below 2**31, and its
length. Chunks are hashed independently (one matrix product for many chunks) and combine by
length-shifted arithmetic, H(ab) = H(a) * B**len(b) + H(b), so that a huge text is hashed in parts.
Texts with equal fingerprints are then compared chunk by chunk.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import forget, texts, written

CHUNK = 4096  # 256 * 2**31 * 4096 = 2**51: sums are exact in float64
MODULI = np.array([2147483647, 2147483629], dtype=np.int64)
BASES = np.array([1222333467, 908070605], dtype=np.int64)
BLOCK = 256  # chunks hashed by one matrix product
COMPARE_BYTES = 1 << 20  # chunk of a text that is compared at a time
HELD_BYTES = 16 << 20  # texts a task remembers for comparison

KEY = ["f1", "f2", "n_bytes"]


def _powers() -> np.ndarray:
    """powers[k, j] = BASES[j] ** k mod MODULI[j] for k up to CHUNK."""
    out = np.ones((CHUNK + 1, len(BASES)), dtype=np.int64)
    for k in range(1, CHUNK + 1):
        out[k] = out[k - 1] * BASES % MODULI
    return out


POWERS = _powers()
WEIGHTS = POWERS[CHUNK - 1::-1].astype(np.float64)  # of the bytes of a chunk, first to last


def combine(left: np.ndarray, right: np.ndarray, right_bytes: int) -> np.ndarray:
    """Hash of the concatenation of two texts, from their hashes and the length of the second."""
    shift = np.array([pow(int(b), int(right_bytes), int(m)) for b, m in zip(BASES, MODULI)])
    return (left * shift + right) % MODULI


def hash_chunks(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the chunks data[start:start + length], length at most CHUNK."""
    out = np.empty((len(starts), len(BASES)), dtype=np.int64)
    for b in range(0, len(starts), BLOCK):
        rows = np.zeros((min(BLOCK, len(starts) - b), CHUNK))
        for r, (s, n) in enumerate(zip(starts[b:b + BLOCK], lengths[b:b + BLOCK])):
            rows[r, CHUNK - n:] = data[s:s + n]
            rows[r, CHUNK - n:] += 1  # so that leading zero bytes count
        out[b:b + BLOCK] = (rows @ WEIGHTS).astype(np.int64) % MODULI
    return out


def fingerprints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (rows x 2) and lengths in bytes of a column of texts."""
    binary = column.cast(pa.large_string())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:binary.offset + len(binary) + 1]
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)
    n_bytes = np.diff(offsets)
    chunks = -(-n_bytes // CHUNK)
    row = np.repeat(np.arange(len(n_bytes)), chunks)
    ordinal = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    starts = offsets[row] + ordinal * CHUNK
    lengths = np.minimum(CHUNK, offsets[row + 1] - starts)
    hashes = hash_chunks(data, starts, lengths)
    total = np.zeros((len(n_bytes), len(BASES)), dtype=np.int64)
    order = np.argsort(ordinal, kind="stable")
    bounds = np.searchsorted(ordinal[order], np.arange(int(chunks.max(initial=0)) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):  # the k-th chunk of every text that has one
        at = order[a:b]
        total[row[at]] = (total[row[at]] * POWERS[lengths[at]] + hashes[at]) % MODULI
    return total, n_bytes


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """Adds f1, f2, n_bytes to (doc_id, text, ...)."""
    def add(batches):
        forget()
        for batch in batches:
            hashes, n_bytes = fingerprints(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(n_bytes)],
                [*batch.schema.names, *KEY])
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(add, f"{schema}, f1 long, f2 long, n_bytes long")


def _to_compare(batches):
    """Chunks of texts to compare. Within a task a text is compared with those of its fingerprint
    that were seen before, chunk by chunk; only one that differs from all of them is sent on."""
    seen, held = {}, 0
    for batch in batches:
        out = []
        for key in zip(*(batch.column(c).to_pylist() for c in [*KEY, "text"])):
            *fp, text = key
            data, known = text.encode(), seen.setdefault(tuple(fp), [])
            if any(len(k) == len(data) and all(
                    k[s:s + COMPARE_BYTES] == data[s:s + COMPARE_BYTES]
                    for s in range(0, len(data), COMPARE_BYTES)) for k in known):
                continue
            if held + len(data) > HELD_BYTES:
                seen, held = {}, 0
            seen.setdefault(tuple(fp), []).append(data)
            held += len(data)
            out += [(*fp, n, data[s:s + COMPARE_BYTES])
                    for n, s in enumerate(range(0, len(data), COMPARE_BYTES))]
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.binary())],
                [*KEY, "chunk_no", "chunk"])


def colliding(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """Keys of fingerprints under which two different texts were found. The least and the greatest
    chunk of a key and position are equal exactly if all texts agree there; both are aggregates,
    so a key with a third of all rows leaves each task as one row."""
    marked = with_fingerprint(docs.select("text")).withColumn("mark", F.xxhash64(*KEY))
    found = marked.join(repeated, "mark", "left_semi").drop("mark")
    chunks = found.mapInArrow(_to_compare, "f1 long, f2 long, n_bytes long, chunk_no long, chunk binary")
    return (chunks.groupBy(*KEY, "chunk_no")
            .agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
            .filter("least <> greatest").select(*KEY).distinct())


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of equal texts: one row per input row.

    Returns doc_id, keep_id (the largest doc_id of the class), group_size, kept, text_sha256 and
    the fingerprint (f1, f2, n_bytes). Null texts count as empty, and empty texts are equal to each
    other. A null doc_id is never the largest; in a class with no other, keep_id is null and all
    rows are kept. Rows that repeat a doc_id with the same text are both kept or both dropped.
    """
    rows = texts(docs, id_col, text_col)
    marks = written(with_fingerprint(rows.withColumn("text_sha256", F.sha2("text", 256)))
                    .select("doc_id", "text_sha256", *KEY), "exact-marks")
    # One long a fingerprint: a chance match only means a text is compared without need.
    repeated = written(marks.groupBy(*KEY).count().filter("count > 1 AND n_bytes > 0")
                       .select(F.xxhash64(*KEY).alias("mark")), "exact-repeated")
    split = written(colliding(rows, repeated), "exact-split").withColumn("split", F.lit(True))
    # Where a fingerprint holds different texts, the class is told by the digest too.
    marks = (marks.join(split, KEY, "left")
             .withColumn("part", F.when(F.col("split"), F.col("text_sha256")).otherwise("")))
    classes = (marks.groupBy(*KEY, "part")
               .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return (marks.join(classes, [*KEY, "part"])
            .select("doc_id", "keep_id", "group_size",
                    F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", *KEY))
