"""Substring dedup by suffix automata of reference shards.

Every document streams past suffix automata of earlier documents for its matching statistics, and
words covered by a match of `window` words or more are removed. Not every document against every
shard, which would grow with the square of the corpus: anchors tell which shards a document shares
anything with. The anchor of a window is the least hash of its word runs of GRAM words, so equal
windows have equal anchors; an anchor's shard is named by the smallest document that has it.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.automaton import Automaton
from annualis.llm.common import forget, slices, texts, written

WINDOW = 50
GRAM = 8
BLOCK = 2048  # windows of one row of a shard; blocks overlap by a window less a word
SHARD_WORDS = 100_000  # a shard with more is split by document; its parts meet by window hashes
LANES = 64
MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def run_hashes(hashes: np.ndarray, size: int, multiplier: np.uint64) -> np.ndarray:
    """A hash of every run of `size` words."""
    total = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for k in range(size):
        total = total * multiplier + hashes[k:k + len(total)]
    return (total ^ (total >> np.uint64(32))) * MULTIPLIERS[1]


def anchors(words: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window of each stretch of windows with the same anchor."""
    gram = min(GRAM, window)
    least = run_hashes(word_hashes(words), gram, MULTIPLIERS[0])
    span, done = window - gram + 1, 1
    while done < span:  # the least of `done` runs becomes that of up to twice as many
        step = min(done, span - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[starts], starts, np.append(starts[1:], len(least)) - 1


def _anchor_rows(window: int):
    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                ids, keys, columns = [], [], []
                for doc_id, key, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "th", "text"))):
                    words = text.encode().split()
                    if len(words) >= window:
                        found = anchors(words, window)
                        columns.append(found)
                        ids += [doc_id] * len(found[0])
                        keys += [key] * len(found[0])
                if ids:
                    a, w1, w2 = (np.concatenate(x) for x in zip(*columns))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(a.view(np.int64)),
                         pa.array(w1, pa.int64()), pa.array(w2, pa.int64())], ["doc_id", "th", "anchor", "w1", "w2"])
    return run


def _merged(ranges: list[dict]) -> Iterator[tuple[int, int, int, int]]:
    """(owner, parts, first window, last window) of neighbouring stretches with one owner."""
    held = None
    for r in sorted((r["owner"], r["w1"], r["w2"], r["parts"]) for r in ranges):
        owner, w1, w2, parts = r
        if held and held[0] == owner and w1 <= held[3] + 1:
            held[3] = max(held[3], w2)
        else:
            if held:
                yield tuple(held)
            held = [owner, parts, w1, w2]
    if held:
        yield tuple(held)


def _block_rows(window: int):
    """Rows of shards: the words of stretches of windows, in blocks."""
    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, th, text, ranges in zip(*(part.column(c).to_pylist()
                                                      for c in ("doc_id", "th", "text", "ranges"))):
                    words = text.encode().split()
                    for owner, parts, w1, w2 in _merged(ranges):
                        salt = xxhash.xxh64_intdigest(f"{doc_id}:{th}".encode()) % parts
                        out += [(owner, salt, parts, doc_id, th, w, b" ".join(words[w:min(w + BLOCK, w2 + 1) + window - 1]))
                                for w in range(w1, w2 + 1, BLOCK)]
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                        ["owner", "salt", "parts", "doc_id", "th", "start", "words"])
    return run


def _stretches(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """First and last index of each run of true flags."""
    start = None
    for k, flag in enumerate([*flags, False]):
        if flag and start is None:
            start = k
        elif not flag and start is not None:
            yield start, k - 1
            start = None


class _Shard:
    """One group of rows (an owner and salt), in ascending document order."""

    def __init__(self, window: int):
        self.window, self.automaton, self.ids = window, Automaton(), {}

    def add(self, doc_id: int, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Stretches of windows that an earlier document has, and of those that none has, be they new
        or this document's own from before."""
        ids = self.ids
        numbers = [ids.setdefault(w, len(ids)) for w in words]
        found = self.automaton.matches(numbers, self.window)[self.window - 1:]
        earlier = list(_stretches([d is not None and d < doc_id for d in found]))
        for a, b in _stretches([d is None for d in found]):
            self.automaton.insert(numbers[a:b + self.window], doc_id)
        return earlier, list(_stretches([d is None or d == doc_id for d in found]))


def _match_rows(window: int):
    """Covered windows (h1 null), and by hash the windows of split shards that no earlier document in
    the part has."""
    names = ["doc_id", "th", "w1", "w2", "h1", "h2"]

    def run(batches):
        forget()
        group, shard = None, None
        for batch in batches:
            out = []
            for owner, salt, parts, doc_id, th, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if group != (owner, salt):
                    group, shard = (owner, salt), _Shard(window)
                words = text.split()
                earlier, first = shard.add(doc_id, words)
                out += [(doc_id, th, start + a, start + b, None, None) for a, b in earlier]
                if parts > 1 and first:
                    two = [run_hashes(word_hashes(words, seed), window, m).view(np.int64).tolist()
                           for seed, m in enumerate(MULTIPLIERS)]
                    out += [(doc_id, th, start + w, start + w, two[0][w], two[1][w])
                            for a, b in first for w in range(a, b + 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
    return run


def repeated_windows(rows: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Stretches (doc_id, th, w1, w2) of windows that also start in a document with a smaller id."""
    found = written(rows.filter("doc_id IS NOT NULL").mapInArrow(
        _anchor_rows(window), "doc_id long, th long, anchor long, w1 long, w2 long"), "substring-anchors")
    shared = (found.groupBy("anchor").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("most"))
              .filter("owner < most").select("anchor", "owner"))
    placed = written(found.join(shared, "anchor").select("doc_id", "th", "owner", "w1", "w2"),
                     "substring-ranges")
    # Words by shard; a large one is split by document.
    sizes = (placed.groupBy("owner").agg(F.sum(F.col("w2") - F.col("w1") + GRAM).alias("words"))
             .select("owner", F.ceil(F.col("words") / shard_words).alias("parts")).filter("parts > 1"))
    # The few split owners are repeated for each lane, so that their many rows go to many tasks.
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    ranges = (placed.withColumn("lane", F.pmod(F.xxhash64("doc_id", "th"), F.lit(LANES)).cast("int"))
              .join(sizes.withColumn("lane", lanes), ["owner", "lane"], "left")
              .groupBy("doc_id", "th").agg(F.collect_set(F.struct(
                  "owner", "w1", "w2", F.coalesce("parts", F.lit(1)).alias("parts"))).alias("ranges")))
    blocks = rows.join(ranges, ["doc_id", "th"]).mapInArrow(
        _block_rows(window), "owner long, salt long, parts long, doc_id long, th long, start long, words binary")
    matched = written(
        blocks.repartition("owner", "salt").sortWithinPartitions("owner", "salt", "doc_id", "th", "start")
        .mapInArrow(_match_rows(window), "doc_id long, th long, w1 long, w2 long, h1 long, h2 long"),
        "substring-matches")
    # What nobody has before in its part of a shard may be older in another part.
    hashed = matched.filter("h1 IS NOT NULL")
    older = (hashed.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
             .filter("least < most").drop("most"))
    other = hashed.join(older, ["h1", "h2"]).filter("least < doc_id")
    names = ["doc_id", "th", "w1", "w2"]
    return matched.filter("h1 IS NULL").select(*names).union(other.select(*names))


def _kept_rows(window: int):
    def run(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, text, ranges in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "ranges"))):
                    words = text.encode().split()
                    n = len(words)
                    if ranges:
                        gone = np.zeros(n + 1, dtype=np.int64)
                        for r in ranges:
                            gone[r["w1"]] += 1
                            gone[r["w2"] + window] -= 1
                        stays = np.cumsum(gone[:n]) == 0
                        words = [w for w, s in zip(words, stays.tolist()) if s]
                    kept = b" ".join(words)
                    out.append((doc_id, n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """Removes words covered by `window` consecutive words that an earlier document (a smaller
    doc_id) also has. Words are separated by ASCII white space and otherwise unchanged.

    Returns doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by one space).
    A null or empty text has no words. Rows with the same doc_id are no repeats of each other, and
    rows with a null doc_id neither lose words nor make others lose them.
    """
    rows = texts(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    gone = (repeated_windows(rows, window, shard_words).groupBy("doc_id", "th")
            .agg(F.collect_set(F.struct("w1", "w2")).alias("ranges")))
    return (rows.join(gone, ["doc_id", "th"], "left").select("doc_id", "text", "ranges")
            .mapInArrow(_kept_rows(window), "doc_id long, n_words long, n_removed long, "
                                            "kept_sha256 string, kept_text string"))
