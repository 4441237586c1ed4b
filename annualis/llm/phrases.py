"""Phrase mining by dynamic itemset counting.

The documents lie in SHARDS shards that are scanned in turn, over and over. All lengths are counted
in the same scans: a phrase becomes active at the first shard border at which both subphrases that
are one word shorter have reached the threshold's share of a shard, and is then counted in each of
the next SHARDS scans, one full cycle. A phrase that reaches the threshold in its cycle has the share
in one of its shards at least, so none is missed, and no sums over shards need to be kept. Words are
active from the start. A last cycle counts the phrases that reached their share by their words, where
the scans before it tell them apart by hash, and the threshold is applied to these exact counts.

Which phrases reached their share, and at which border, stands in a table of FILTER_SLOTS bytes
that travels with the tasks: a phrase's slots hold the border at which they were first set, and are
never changed again. So the border at which a phrase becomes active is a fixed function of its
words, which every task finds on its own, and nothing else is broadcast. Phrases that share slots by
chance may make others active too early; these are counted like all others and fail the threshold in
the end.

Texts are split into words once: a block holds the words of many texts of a language as numbers
within its own dictionary.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annualis.llm.common import Table, forget, written

LONGEST = 5
THRESHOLD = 100
TOP = 2000
COVER = 100  # percent of a phrase's occurrences within one longer phrase from which it is dropped
SHARDS = 4
LANES = 256
FILTER_SLOTS = 1 << 24
SECTION = 1 << 20  # bytes of a long text that are split into words at a time
BLOCK_WORDS = 1 << 18
HELD = 1 << 21  # hashes that a task holds before it sends their counts
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
NEVER = 255

END = b"."
# Piece ends become END, tabs become spaces; A-Z are lowered before.
MAP = bytes(ord(END) if chr(c) in ".,;:!?\n\v\f\r" else 32 if c == 9 else c for c in range(256))
MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and that of the last word."""
    total = (prefix ^ (prefix >> np.uint64(29))) * MIX[0] + word
    return total ^ (total >> np.uint64(32))


def salted(hashes: np.ndarray, lang: str) -> np.ndarray:
    return hashes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 7))


def slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Two slots of each phrase."""
    two = [(hashes * m) >> np.uint64(20) for m in MIX]
    return (np.stack(two) % np.uint64(size)).astype(np.int64)


def reached(times: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The border at which each phrase had reached the threshold, or NEVER."""
    return times[slots(hashes, len(times))].max(axis=0)


def tokens(text: str, longest: int = LONGEST, section: int = SECTION) -> Iterator[tuple[list[bytes], int]]:
    """Words and END marks of a text in sections, and how many of a section's tokens begin phrases;
    the others are the next section's first ones, so that no phrase is cut."""
    data = text.encode().lower().translate(MAP).replace(END, b" . ")
    held: list[bytes] = []
    at = 0
    while at < len(data):
        end = data.find(b" ", at + section)
        end = len(data) if end < 0 else end
        found = held + data[at:end].split()
        at = end
        n = len(found) if at >= len(data) else max(0, len(found) - longest + 1)
        if n:
            yield found, n
        held = found[n:]


BLOCK = "lang string, words binary, ids binary, skip binary"


def blocks(docs: DataFrame, longest: int) -> DataFrame:
    """(lang, words, ids, skip) of (lang, text): the different words of some texts, the texts as their
    numbers with END marks, and where in them no phrase begins."""
    def flush(lang: str, found: list[bytes], skip: list[int]) -> pa.RecordBatch:
        coded = pa.array(found, pa.binary()).dictionary_encode()
        ids = coded.indices.to_numpy(False)
        kind = "<u2" if len(coded.dictionary) <= 1 << 16 else "<u4"
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([b" ".join(coded.dictionary.to_pylist())], pa.binary()),
             pa.array([ids.astype(kind).tobytes()], pa.binary()),
             pa.array([np.array(skip, "<u4").tobytes()], pa.binary())], ["lang", "words", "ids", "skip"])

    def run(batches):
        forget()
        held: dict[str, tuple[list, list]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for found, n in tokens(text, longest):
                    words, skip = held.setdefault(lang, ([], []))
                    skip += range(len(words) + n, len(words) + len(found))
                    words += found
                    words.append(END)
                    size += len(found)
                    if size > BLOCK_WORDS:
                        for key in sorted(held):
                            yield flush(key, *held[key])
                        held, size = {}, 0
        for key in sorted(held):
            yield flush(key, *held[key])
    return docs.mapInArrow(run, BLOCK)


class Block:
    """A block's words, their hashes, the texts as numbers, and where phrases may begin."""

    def __init__(self, lang: str, words: bytes, ids: bytes, skip: bytes):
        self.lang, self.words = lang, words.split(b" ")
        self.ids = np.frombuffer(ids, "<u2" if len(self.words) <= 1 << 16 else "<u4").astype(np.int64)
        self.hashes = word_hashes(self.words)
        self.is_end = np.array([w == END for w in self.words])
        self.begins = np.ones(len(self.ids), dtype=bool)
        self.begins[np.frombuffer(skip, "<u4")] = False

    def when(self, times: np.ndarray) -> np.ndarray:
        """The border at which each place's word had reached its share; NEVER for END marks."""
        return np.where(self.is_end, NEVER, reached(times, salted(self.hashes, self.lang)))[self.ids]


def _blocks(batch: pa.RecordBatch) -> Iterator[Block]:
    for row in zip(*(c.to_pylist() for c in batch.columns)):
        yield Block(*row)


def active_hashes(block: Block, times: np.ndarray, step: int, shards: int, longest: int) -> Iterator[np.ndarray]:
    """Hashes of the phrases that are active in a scan, one for each occurrence."""
    at = block.hashes[block.ids]
    if step < shards:  # words are active from the start
        yield salted(at[block.begins & ~block.is_end[block.ids]], block.lang)
    places, whole, when = np.arange(len(at)), at, block.when(times)
    since = np.zeros(len(at), dtype=np.uint8)  # words are scanned from the start
    for length in range(2, longest + 1):
        # Phrases go on where the one at the next place has reached its share too. A phrase is scanned
        # from the border at which every shorter one inside it has its share, not only its two parts:
        # a part's slots may have been set by others before the part itself was scanned.
        ready = np.full(len(at) + 1, NEVER, dtype=np.uint8)
        ready[places] = np.maximum(when, since)
        since = np.maximum(ready[places], ready[places + 1])
        alive = since != NEVER
        places, whole, since = places[alive], whole[alive], since[alive]
        if not len(places):
            return
        whole = extended(whole, at[places + length - 1])
        found = salted(whole, block.lang)
        counted = (step < since.astype(np.int64) + shards) & block.begins[places]
        if counted.any():
            yield found[counted]
        when = reached(times, found)


def scan(shard: DataFrame, times: Table, step: int, shards: int, longest: int, share: int) -> DataFrame:
    """(h, n) of the active phrases that have their share in a shard of blocks."""
    def flush(held):
        h, n = np.unique(np.concatenate(held), return_counts=True)
        for k in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(h[k:k + (1 << 16)].view(np.int64)), pa.array(n[k:k + (1 << 16)])],
                                             ["h", "n"])

    def run(batches):
        table = times.get()
        held, size = [], 0
        for batch in batches:
            for block in _blocks(batch):
                for found in active_hashes(block, table, step, shards, longest):
                    held.append(found)
                    size += len(found)
                if size > HELD:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)
    return shard.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= share)


def _encoded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(False).astype(np.int64), coded.dictionary


def counted(block: Block, times: np.ndarray, longest: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(length, phrases, counts) of the phrases of a block that have reached their share, told apart by
    their words."""
    words = pa.array(block.words, pa.binary())
    keys, names, whole = block.ids, words, block.hashes
    places, when = np.arange(len(keys)), reached(times, salted(whole, block.lang))
    when[block.is_end] = NEVER
    for length in range(1, longest + 1):
        if length > 1:
            here = np.full(len(block.ids) + 1, NEVER, dtype=np.uint8)
            here[places] = when[keys]
            alive = np.maximum(here[places], here[places + 1]) != NEVER
            places = places[alive]
            if not len(places):
                return
            keys, firsts = _encoded(pa.array(keys[alive] * len(words) + block.ids[places + length - 1]))
            firsts = firsts.to_numpy(False)
            prefix, last = firsts // len(words), firsts % len(words)
            whole = extended(whole[prefix], block.hashes[last])
            names = pc.binary_join_element_wise(names.take(pa.array(prefix)), words.take(pa.array(last)), b" ")
            when = reached(times, salted(whole, block.lang))
        n = np.bincount(keys[block.begins[places]], minlength=len(names))
        wanted = (n > 0) & (when != NEVER)
        if wanted.any():
            yield length, names.filter(pa.array(wanted)), n[wanted]


def exact_counts(found: DataFrame, times: Table, longest: int) -> DataFrame:
    """(lang, size, phrase, n) of the phrases that have reached their share, and of all words as one row a
    language, of size 0."""
    schema = pa.schema([("lang", pa.string()), ("size", pa.int8()), ("phrase", pa.binary()), ("n", pa.int64())])

    def run(batches):
        table = times.get()
        for batch in batches:
            for block in _blocks(batch):
                total = int((block.begins & ~block.is_end[block.ids]).sum())
                parts = [(0, pa.array([b""], pa.binary()), np.array([total]))]
                for size, names, n in [*parts, *counted(block, table, longest)]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.lang] * len(n)), pa.array([size] * len(n), pa.int8()), names,
                         pa.array(n, pa.int64())], schema=schema)
    return (found.mapInArrow(run, "lang string, size tinyint, phrase binary, n long")
            .groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")))


def new_slots(found: DataFrame, size: int) -> np.ndarray:
    """The slots of a column h of hashes, ascending; the driver gets a bitmap of at most `size` bits."""
    def run(batches):
        for batch in batches:
            at = slots(batch.column("h").to_numpy(False).view(np.uint64), size)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at) + 1)], ["slot"])  # Spark counts from one
    bits = (found.select("h").mapInArrow(run, "slot long").groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    places = [np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little"))
              + (r["bucket"] - 1) * 32768 for r in bits]
    return np.sort(np.concatenate([np.empty(0, np.int64), *places]))


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS,
                  filter_slots: int = FILTER_SLOTS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, size, phrase, n): the words and phrases of up to `longest` words with `threshold`
    occurrences or more, and each language's number of words as size 0."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turn = F.monotonically_increasing_id() + F.spark_partition_id()  # blocks of a task, and tasks, in turn
    found = written(blocks(rows, longest).withColumn("shard", F.pmod(turn, F.lit(shards))), "phrases-blocks",
                    partition_by="shard").select("lang", "words", "ids", "skip", "shard")
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, "8")  # a block is large
    try:
        times = np.full(filter_slots, NEVER, dtype=np.uint8)
        step, last = 0, 0
        while step < last + shards:
            if step + 1 >= NEVER:
                raise RuntimeError("too many scans")
            shared = Table(spark, times)  # filter_slots bytes at most
            shard = found.filter(F.col("shard") == step % shards).drop("shard")
            new = new_slots(written(scan(shard, shared, step, shards, longest, -(-threshold // shards)), "phrases-scan"),
                            filter_slots)
            shared.destroy()
            new = new[times[new] == NEVER]
            step += 1
            if len(new):
                times = times.copy()
                times[new] = last = step
        shared = Table(spark, times)
        counts = written(exact_counts(found.drop("shard"), shared, longest)
                         .filter((F.col("size") == 0) | (F.col("n") >= threshold)), "phrases-counts")
        shared.destroy()
        return counts
    finally:
        spark.conf.set(BATCH_ROWS, before)


def _part(first: int | Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def scored(counts: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, cover: int = COVER) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all candidates that no longer one covers, from phrase_counts."""
    counts = counts.select("lang", "size", F.col("phrase").cast("string").alias("phrase"), F.col("n").alias("f"))
    words = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    frequent = counts.filter((F.col("f") >= threshold) & (F.col("size") > 0))
    found = frequent.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = found.select("lang", "phrase", "size", F.col("f").alias("a"), "words",
                        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("left"),
                       _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    known = frequent.select("lang", "phrase", "f")
    parts = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
             .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
             .join(words, "lang"))
    big = "decimal(38,0)"
    score = F.expr(f"(cast(1000 AS {big}) * a * n) div (cast(l AS {big}) * r)")
    best = (parts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda s: F.array_join(F.slice("words", s, m), " "))))
    covered = (found.filter("size > 2").select("lang", "f", F.explode(inner).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    kept = best.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("cut.a") * cover))
    return kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP,
                 cover: int = COVER, shards: int = SHARDS, filter_slots: int = FILTER_SLOTS, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """Each language's first `top` phrases by score: lang, rank, phrase, a, l, r, n and score.

    A null text is empty, a null language is `und`; repeated rows count each time. Ties go to the
    more frequent phrase, then to the smaller one by UTF-8 bytes. An empty table has no phrases.
    Further columns are not read.
    """
    counts = phrase_counts(docs, threshold, longest, shards, filter_slots, lang_col, text_col)
    rows = scored(counts, threshold, longest, cover)
    # The first `top` of each lane, then of these: a task never gets all candidates of a language.
    order = (F.desc("score"), F.desc("a"), "phrase")
    for keys in (["lang", "_lane"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = (rows.withColumn("_lane", F.pmod(F.xxhash64("phrase"), F.lit(LANES)))
                .withColumn("rank", place).filter(F.col("rank") <= top))
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
