"""Quartile bucket digests of texts.

Byte triplets within a window of five bytes are hashed into buckets. The digest holds, for every
bucket, which quartile of all bucket counts it lies in, and the logarithm of the length; two digests
are compared by a bounded difference score.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annualis.llm.common import forget, slices, texts, written

BUCKETS = 256
TRIPLETS = [(0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4)]  # offsets in the window
FACTORS = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]
SPREAD = np.uint32(0x27D4EB2F)
STEP = 6  # difference of the first and last quartile, as three steps are a stronger sign than one
UNRELATED = 416  # expected bucket difference of unrelated digests: 1.625 a bucket
LENGTH_BASE = np.log(1.2)


def histograms(data: list[bytes]) -> np.ndarray:
    """Bucket counts of each text (rows x BUCKETS)."""
    sizes = np.array([len(d) for d in data])
    joined = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(data)), sizes)
    after = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(joined))  # bytes left in the text
    scaled = [joined * f for f in FACTORS]
    out = np.zeros((len(data) + 1) * BUCKETS, dtype=np.int64)  # the last row is for window ends
    for kind, (a, b, c) in enumerate(TRIPLETS):
        n = len(joined) - c
        if n <= 0:
            continue
        h = scaled[0][a:a + n] ^ scaled[1][b:b + n] ^ (scaled[2][c:c + n] + np.uint32(kind))
        bucket = ((h * SPREAD) >> np.uint32(24)).astype(np.int64)
        whole = after[:n] > c
        out += np.bincount(np.where(whole, row[:n], len(data)) * BUCKETS + bucket, minlength=len(out))
    return out.reshape(-1, BUCKETS)[:-1]


def digests(texts_: list[str]) -> np.ndarray:
    """Rows of a length code and a quartile code (0 to 3) for each bucket."""
    data = [t.encode() for t in texts_]
    counts = histograms(data)
    ordered = np.sort(counts, axis=1)
    codes = sum((counts > ordered[:, [BUCKETS * q // 4 - 1]]).astype(np.int16) for q in (1, 2, 3))
    length = np.rint(np.log1p([len(d) for d in data]) / LENGTH_BASE).astype(np.int16)
    return np.hstack([length[:, None], codes])


def spell(digest: np.ndarray) -> list[str]:
    """Digests as text: two hexadecimal digits of length, then four buckets in each two."""
    quads = digest[:, 1:].reshape(len(digest), -1, 4)
    packed = (quads * np.array([64, 16, 4, 1])).sum(axis=2).astype(np.uint8)
    return [f"{min(int(n), 255):02x}" + p.tobytes().hex() for n, p in zip(digest[:, 0], packed)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, falling with the difference score to 0 for unrelated ones."""
    steps = np.abs(a[:, 1:] - b[:, 1:])
    body = np.where(steps == 3, STEP, steps).sum(axis=1)
    length = np.abs(a[:, 0] - b[:, 0])
    return 1 - np.minimum(body + length, UNRELATED) / UNRELATED


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every text; null counts as empty, whose digest is all zero."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = spell(digests(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)],
                                                 ["doc_id", "fingerprint"])
    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _compared(ids: list, texts_: list[str], found: np.ndarray) -> list[list]:
    """Columns of FIELDS for all rows but the last, each with the one after it."""
    edited = []
    for text, after in zip(texts_[:-1], texts_[1:]):
        cut = len(text) // 3
        edited.append(text[:len(text) - cut] + after[:cut])
    changed = digests(edited)
    return [ids[:-1], [len(t) for t in texts_[:-1]],
            [hashlib.sha256(t.encode()).hexdigest() for t in edited], spell(found[:-1]), spell(changed),
            likeness(found[:-1], changed).tolist(), likeness(found[:-1], found[1:]).tolist()]


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How fingerprints tell an edited text from the next document.

    In descending doc_id (null last; equal ones by hash of the text, then by text), the last third of each text is replaced by
    the start of the next one (after the last: the first). Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited and near_next. A null text counts as empty.

    Rows are range-partitioned by doc_id, hash and number, so that rows of one id spread too, and
    streamed in order, so a row meets the next one in its own task. The first and last row of each partition are written out and meet in a join of one
    row per partition.
    """
    # The number only parts repeated rows; it is the same if a task runs again.
    ties = [F.desc("doc_id"), "th", "text", "row"]
    ordered = (texts(docs, id_col, text_col)
               .withColumns({"th": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
               .repartitionByRange(F.desc("doc_id"), "th", "row").sortWithinPartitions(*ties).select("doc_id", "text"))

    def stream(batches):
        forget()
        part = TaskContext.get().partitionId()
        held_ids, held_texts, held_digest = [], [], np.empty((0, BUCKETS + 1), dtype=np.int16)
        edges = []
        for batch in batches:
            for rows in slices(batch):
                ids, column = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
                if not held_ids:
                    edges.append((ids[0], 1, column[0]))
                held_ids, held_texts = held_ids + ids, held_texts + column
                held_digest = np.vstack([held_digest, digests(column)])
                if len(held_ids) > 1:
                    done = _compared(held_ids, held_texts, held_digest)
                    n = len(done[0])
                    yield _batch(done, [part] * n, [0] * n, [None] * n)
                held_ids, held_texts, held_digest = held_ids[-1:], held_texts[-1:], held_digest[-1:]
        if held_ids:
            edges.append((held_ids[0], 2, held_texts[0]))
            blank = [[e[0] for e in edges], *[[None] * len(edges)] * (len(NAMES) - 1)]
            yield _batch(blank, [part] * len(edges), [e[1] for e in edges], [e[2] for e in edges])

    def _batch(columns, parts, edges, kept):
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(columns, types)), pa.array(parts, pa.int32()),
             pa.array(edges, pa.int32()), pa.array(kept, pa.string())], [*NAMES, "part", "edge", "text"])

    found = written(ordered.mapInArrow(stream, f"{FIELDS}, part int, edge int, text string"), "digests")
    firsts = found.filter("edge = 1").select("part", F.col("text").alias("next_text"))
    parts = firsts.select("part")
    order = Window.orderBy("part")  # one row per partition
    following = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    lasts = (found.filter("edge = 2").select("doc_id", "text", "part").join(following, "part")
             .join(firsts.withColumnRenamed("part", "next_part"), "next_part")
             .select("doc_id", "text", "next_text"))

    def meet(batches):
        for batch in batches:
            for doc_id, text, after in zip(*(c.to_pylist() for c in batch.columns)):
                done = _compared([doc_id, None], [text, after], digests([text, after]))
                yield _batch(done, [0], [0], [None]).select(NAMES)
    return found.filter("edge = 0").select(*NAMES).union(lasts.mapInArrow(meet, FIELDS))
