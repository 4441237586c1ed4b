"""SimHash near-dedup by covering locality-sensitive hashing.

Each bit position of the fingerprint gets a nonzero vector of radius + 1 bits; a table's mask keeps
the positions whose vector has an odd product with the table's own nonzero vector. The vectors of
`radius` differing positions cannot span the space, so some table's vector is orthogonal to all of
them: its mask leaves them out, and the pair collides there. No pair within the radius is missed.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import forget, hex64, slices, texts, written
from annualis.llm.components import components

BITS = 64
SEED = 42
RADIUS = 2
PAIR_BUCKET = 64  # buckets of more fingerprints are linked by their neighbours instead of pairs

# LANES[b] has bit k of the byte b in byte k: 8 counters that hold 255 additions.
LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], dtype=np.uint64)


def shingle_hashes(text: str, size: int = 3) -> list[int]:
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII space separates
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest = xxhash.xxh64_intdigest
    return [digest(s, SEED) for s in map(b" ".join, zip(*(words[k:] for k in range(size))))]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """For each list, the bits that are set in over half of its hashes."""
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    out = np.zeros(len(hashes), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(counts.sum()))
    lanes = LANES[flat.view(np.uint8).reshape(-1, 8)]
    ends = np.cumsum(counts[full])
    starts = ends - counts[full]
    pieces = [np.arange(s, e, 255) for s, e in zip(starts, ends)]  # no counter overflows in one
    sums = np.add.reduceat(lanes, np.concatenate(pieces), axis=0).view(np.uint8).reshape(-1, BITS)
    first = np.cumsum([0, *map(len, pieces[:-1])])
    ones = np.add.reduceat(sums.astype(np.int64), first, axis=0)
    bits = 2 * ones > counts[full][:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def simhash(docs: DataFrame, size: int = 3) -> DataFrame:
    """All columns of docs but text, and fp."""
    keep = [c for c in docs.columns if c != "text"]

    def add(batches):
        forget()
        for batch in batches:
            for part in slices(batch):
                hashes = [shingle_hashes(t, size) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(majority(hashes).view(np.int64))], [*keep, "fp"])
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(add, f"{schema}, fp long")


def masks(radius: int = RADIUS) -> list[int]:
    """The 2**(radius + 1) - 1 covering masks, as signed longs."""
    vectors = range(1, 1 << (radius + 1))
    out = []
    for v in vectors:
        mask = sum(1 << i for i in range(BITS) if bin((1 + i % len(vectors)) & v).count("1") % 2)
        out.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return out


def links(distinct: DataFrame, radius: int = RADIUS, pair_bucket: int = PAIR_BUCKET) -> DataFrame:
    """Edges (a, b) between different fingerprints of a column fp, with the same components as the
    graph of all pairs that differ in `radius` (1 or 2) bits at most.

    Buckets up to pair_bucket are compared pairwise. The members of larger ones are linked exactly,
    without pairs: two fingerprints differ in two bits at most if and only if they share a member
    of {x and x with one bit changed}, and at most 65 fingerprints share one.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for t, m in enumerate(masks(radius))])).alias("k")).select("fp", "k.table", "k.key")
    sizes = keys.groupBy("table", "key").count().filter("count > 1")
    members = written(keys.join(sizes, ["table", "key"]), "simhash-buckets")
    small = members.filter(F.col("count") <= pair_bucket)
    a, b = small.alias("a"), small.alias("b")
    pairs = a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key"))
                   & (F.col("a.fp") < F.col("b.fp"))
                   & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
                   ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    crowded = members.filter(F.col("count") > pair_bucket).select("fp").distinct()
    one = [1 << i if i < BITS - 1 else -(1 << i) for i in range(BITS)]
    if radius == 2:
        near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(m)) for m in one])
        hubs = (crowded.select("fp", F.explode(near).alias("hub")).groupBy("hub")
                .agg(F.collect_set("fp").alias("fps")).filter("size(fps) > 1"))
        stars = hubs.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:  # a neighbour is a fingerprint itself
        near = F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in one])
        moved = crowded.select(F.col("fp").alias("a"), F.explode(near).alias("b"))
        stars = moved.join(crowded.withColumnRenamed("fp", "b"), "b").select("a", "b")
    return pairs.union(stars.filter("a <> b")).distinct()


def groups(marks: DataFrame, radius: int = RADIUS) -> DataFrame:
    """marks, a written table with doc_id and fp, with the root of each row's component and
    component_id, the component's smallest doc_id (null last)."""
    distinct = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(written(links(distinct.select("fp"), radius), "simhash-links"))
    named = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return marks.join(named.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               size: int = 3, radius: int = RADIUS) -> DataFrame:
    """Components of texts whose fingerprints differ in `radius` bits at most.

    Returns doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that
    is reachable. A text without words, or a null one, has fingerprint zero and is linked like any
    other; one of fewer than `size` words is one shingle. Repeated rows each come back. A null
    doc_id is never the smallest; a component with no other has a null component_id.
    """
    marks = written(simhash(texts(docs, id_col, text_col), size), "simhash-marks")
    return groups(marks, radius).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                radius: int = RADIUS) -> DataFrame:
    """doc_id and text_sha256 (of the text; null is empty) of all rows of docs but one in each component.

    The row with the smallest doc_id stays (null last, then by the text's hash); repeated rows are
    one. An empty table has none.
    """
    rows = texts(docs, id_col, text_col).withColumn("text_sha256", F.sha2("text", 256))
    found = written(groups(written(simhash(rows, size), "simhash-marks"), radius), "simhash-groups")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_sha256")
    kept = found.groupBy("root").agg(F.min(order).alias("least"))
    return (found.join(kept, "root").filter(~order.eqNullSafe(F.col("least")))
            .select("doc_id", "text_sha256").distinct())
