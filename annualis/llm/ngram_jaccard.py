"""Documents linked by the Jaccard index of their word n-grams: an exact prefix-filter join.

All sets follow one order of the n-grams, rare ones first, by how many documents hold them. Two sets
of a and b members with an index of NUM/DEN or more share need(a + b) members, so they share one of
the first members of each, and a pair meets in the list of its first shared n-gram. Filters on the
way to a pair:

* sieve: in any order, so also in that of the hashes, a set and its partner share several of the
  first third of their members. Sets that don't find as many there that any other set holds drop out
  before anything else is counted.
* rarity: an n-gram of one document only is shared with nobody, and comes first; a set that has
  more of these than a partner may lack drops out before anything is joined.
* length: sizes that differ too much cannot be similar.
* position: at its first shared n-gram a pair still has at most as many members as follow in either
  set. The smaller set may only lack about half of what the larger one may, so it is listed under
  fewer n-grams: a text that a common line brought here, but that differs too much from every text
  of its size, meets nobody.
* suffix: halves of both sets around a probe bound the overlap before whole sets are compared.

Lists are not paired up. Each list's members are compared with one of them, the pivot; then only
members that are still in another component than most of the list meet the rest of it, each pair
once. A group of near copies costs a few comparisons a member, and every pair of a list that is not
connected already is compared.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import Table, forget, slices, texts, written
from annualis.llm.components import components
from annualis.llm.simhash import shingle_hashes

SIZE = 5
NUM, DEN = 4, 5  # the least Jaccard index, 0.8
LEAD = 10  # the sieve looks for a tenth of a set
FILTER_BITS = 1 << 27
FLUSH = 1 << 20  # n-grams that a task holds before it sends their counts
PIVOTS = 6  # rounds of pivots at most, while there would be many pairs
PAIRS_A_MEMBER = 32  # pairs for each member of a list from which another pivot is taken
LANES = 64
HOT = 1000  # copies of one set from which its rows are spread over lanes

LEVEL_BITS, LEVEL_SHIFT = 56, 8
MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def need(total: Column | int):
    """Members that two sets of `total` members together share at least."""
    if isinstance(total, int):
        return -(-total * NUM // (NUM + DEN))
    return F.ceil(total * NUM / F.lit(float(NUM + DEN)) - F.lit(1e-9))


def spare(n: int) -> int:
    """Members that a set may lack in its smallest partner."""
    return n - -(-n * NUM // DEN)


def lead(n: int) -> int:
    """Shared members that the sieve looks for in a set of n."""
    return -(-n // LEAD)


def sieve(found: np.ndarray) -> np.ndarray:
    """The members, by hash, among which a set and any partner share lead() of the smaller: it may lack
    spare() of its members, so the first lead() that they share come within as many more."""
    return found[:spare(len(found)) + lead(len(found))]


def ngram_set(text: str, size: int = SIZE) -> np.ndarray:
    """The different n-gram hashes of a text, in ascending order; fewer words are one n-gram."""
    return np.unique(np.array(shingle_hashes(text, size), dtype=np.uint64))


def digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two places of each hash in a table of `bits` bits."""
    return (np.stack([(hashes * m) >> np.uint64(20) for m in MIX]) % np.uint64(bits)).astype(np.int64)


def maybe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the table (packed bits); none that is gets lost."""
    at = positions(hashes, len(table) * 8)
    return ((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def sieve_counts(docs: DataFrame, size: int) -> DataFrame:
    """(h, c) of n-grams that more than one set has in its sieve, over all documents. Copies that one
    task meets count once."""
    def run(batches):
        forget()
        seen: set[bytes] = set()
        held, total = [], 0

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            for k in range(0, len(h), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[k:k + (1 << 16)].view(np.int64)), pa.array(c[k:k + (1 << 16)])], ["h", "c"])
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    found = ngram_set(text, size)
                    mark = digest(found)
                    if not len(found) or mark in seen:
                        continue
                    if len(seen) >= 1 << 16:
                        seen.clear()
                    seen.add(mark)
                    held.append(sieve(found))
                    total += len(held[-1])
                    if total >= FLUSH:
                        yield from flush()
                        held, total = [], 0
        if held:
            yield from flush()
    return (docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
            .filter("c > 1"))


def bit_table(found: DataFrame, bits: int) -> np.ndarray:
    """A table of `bits` bits with those of a column h set; that many bits come to the driver at most."""
    def run(batches):
        for batch in batches:
            at = positions(batch.column("h").to_numpy(False).view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(at) + 1)], ["at"])  # Spark counts from one
    rows = (found.select("h").mapInArrow(run, "at long").groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
    table = np.zeros(max(1 << 15, bits) // 8, dtype=np.uint8)
    for r in rows:
        table[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return table


def marked(docs: DataFrame, repeated: Table, size: int) -> DataFrame:
    """doc_id, n (members of the set), digest, and the members where the sieve leaves the set."""
    def run(batches):
        table = repeated.get()
        for batch in batches:
            for part in slices(batch):
                found = [ngram_set(t, size) for t in part.column("text").to_pylist()]
                kept = [s if len(s) and maybe(table, sieve(s)).sum() >= lead(len(s) - spare(len(s))) else s[:0]
                        for s in found]
                ends = np.cumsum([0, *map(len, kept)]).astype(np.int32)
                flat = np.concatenate([np.empty(0, np.uint64), *kept]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, found), pa.int64()),
                     pa.array([digest(s) for s in found], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "n", "digest", "hashes"])
    return docs.mapInArrow(run, "doc_id long, n long, digest binary, hashes array<long>")


def ordered(classes: DataFrame) -> DataFrame:
    """(node, n, members): the repeated members of each set that may have a partner, rare ones first, by
    exact counts over all sets that the sieve left.

    A member is one number: the logarithm of its count above the leading bits of its hash.
    """
    level = F.least(F.floor(F.log2("c") * 3), F.lit((1 << (63 - LEVEL_BITS)) - 1)).cast("long")
    member = F.shiftleft(level, LEVEL_BITS) + F.shiftrightunsigned("h", LEVEL_SHIFT)
    posts = classes.filter("size(hashes) > 0").select("node", "n", F.explode("hashes").alias("h"))
    counts = posts.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1")
    return (posts.join(counts, "h").groupBy("node", "n").agg(F.array_sort(F.collect_list(member)).alias("members"))
            .filter(F.size("members") >= F.ceil(F.col("n") * NUM / F.lit(float(DEN)) - F.lit(1e-9))))


def postings(sets: DataFrame) -> DataFrame:
    """(t, node, n, at, small): the n-grams under which a set is listed and their place in it; small
    if it also meets larger sets there. Lists without anyone to meet are left out."""
    n, unique = F.col("n"), F.col("n") - F.size("members")
    last = n - F.ceil(n * NUM / F.lit(float(DEN)) - F.lit(1e-9))
    posts = sets.select("node", "n", unique.alias("unique"), F.posexplode(
        F.slice("members", F.lit(1), (last - unique + 1).cast("int"))).alias("i", "t"))
    at = F.col("unique") + F.col("i")
    posts = posts.select("t", "node", "n", at.alias("at"), (n - at >= need(2 * n)).alias("small"))
    lists = (posts.groupBy("t").agg(F.count("*").alias("m"), F.min(F.when(F.col("small"), n)).alias("least"))
             .filter("m > 1 AND least IS NOT NULL").select("t", "least"))
    reach = F.floor((n - F.col("at")) * (NUM + DEN) / F.lit(float(NUM)) + F.lit(1e-9)) - n  # largest partner
    return posts.join(lists, "t").filter(F.col("small") | (reach >= F.col("least"))).drop("least")


def fits(x: str, y: str) -> Column:
    """Length and position filter of postings aliased x and y, in either order of size."""
    a, b, i, j = (F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.at"), F.col(f"{y}.at"))
    least = need(a + b)
    return ((a * DEN >= b * NUM) & (b * DEN >= a * NUM) & (a - i >= least) & (b - j >= least)
            & F.when(a < b, F.col(f"{x}.small")).otherwise(F.col(f"{y}.small") | (a == b)))


def overlap_bound(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """At most so many members do two sets in the same order share: the smaller of both parts on each
    side of a probe, which are bounded in the same way."""
    if depth == 0 or len(x) < 8 or len(y) < 8:
        return min(len(x), len(y))
    middle = len(y) // 2
    cut = int(np.searchsorted(x, y[middle]))
    return overlap_bound(x[:cut], y[:middle], depth - 1) + overlap_bound(x[cut:], y[middle:], depth - 1)


def similar(n: int, m: int, x: np.ndarray, y: np.ndarray) -> bool:
    """Whether sets of n and m members with the repeated members x and y have the least index."""
    least = need(n + m)
    if overlap_bound(x, y) < least:
        return False
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) >= least


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of pairs (a, b) of nodes."""
    def run(batches):
        forget()
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            flat = [c.flatten().to_numpy(False) for c in (x, y)]
            ends = [np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(False))]) for c in (x, y)]
            n, m = (batch.column(c).to_pylist() for c in ("n", "m"))
            linked = [similar(n[k], m[k], flat[0][ends[0][k]:ends[0][k + 1]], flat[1][ends[1][k]:ends[1][k + 1]])
                      for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                                             ["a", "b", "linked"])
    one = sets.select(F.col("node").alias("a"), "n", F.col("members").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("members").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(
        run, "a long, b long, linked boolean")


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def links(posts: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of all nodes that are linked to another one."""
    spark = posts.sparkSession
    roots = spark.createDataFrame([], "node long, root long")
    done = spark.createDataFrame([], "a long, b long, linked boolean")
    for turn in range(PIVOTS + 1):
        named = posts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = named.groupBy("t", "root").count()
        lists = (sizes.groupBy("t").agg(F.max(F.struct("count", "root")).alias("top"), F.sum("count").alias("m"))
                 .filter(F.col("top.count") < F.col("m")))
        lists = written(lists.select("t", F.col("top.root").alias("top"), "m", (F.col("m") - F.col("top.count")).alias("rest")),
                        "jaccard-open")
        members, pairs = lists.agg(F.sum("m"), F.sum(F.col("m").cast("decimal(38,0)") * F.col("rest"))).first()
        if not members:
            break
        live = written(named.join(lists.select("t", "top"), "t"), "jaccard-members")
        final = turn == PIVOTS or pairs <= PAIRS_A_MEMBER * members
        if final:  # who is apart from most of the list, with everyone of another component
            first = live.filter("root <> top")
        else:  # pivots: first the one with the fewest rare members, then any
            order = ["at", "node", "n", "small", "root"] if not turn else [
                F.xxhash64("node", F.lit(turn)).alias("order"), "node", "n", "small", "root", "at"]
            first = live.groupBy("t").agg(F.min(F.struct(*order)).alias("p")).select("t", "p.*")
        x, y = first.alias("x"), live.alias("y")
        met = _pairs(x.join(y, F.col("x.t") == F.col("y.t")).filter((F.col("x.root") != F.col("y.root")) & fits("x", "y")))
        new = written(verified(met.join(done.select("a", "b"), ["a", "b"], "left_anti"), sets), "jaccard-verified")
        done = done.union(new)
        roots = written(components(written(done.filter("linked").select("a", "b"), "jaccard-links")), "jaccard-roots")
        if final:
            break
    return roots


def jaccard_components(docs: DataFrame, size: int = SIZE, filter_bits: int = FILTER_BITS, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of `size`-word n-grams have a Jaccard index of 0.8 or more.

    Returns doc_id, n_shingles (members of the set) and component_id, the smallest doc_id that is
    reachable. A text of fewer words is one n-gram; one without words, or a null one, has none and is
    linked with nothing, not even its copies. Repeated rows each come back. A null doc_id is never
    the smallest; a component with no other has a null component_id. Further columns are not read.
    """
    rows = texts(docs, id_col, text_col)
    counts = written(sieve_counts(rows, size), "jaccard-counts")
    repeated = Table(docs.sparkSession, bit_table(counts, filter_bits))  # filter_bits at most
    marks = written(marked(rows, repeated, size).withColumn("row", F.monotonically_increasing_id()), "jaccard-marks")
    repeated.destroy()
    classes = written(marks.filter("n > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.first("n").alias("n"),
        F.first("hashes").alias("hashes"), F.count("*").alias("rows")), "jaccard-classes")
    sets = written(ordered(classes), "jaccard-sets")
    roots = links(written(postings(sets), "jaccard-lists"), sets)
    named = classes.join(roots, "node", "left").select("digest", "least", "rows", F.coalesce("root", "node").alias("root"))
    parts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = written(named.join(parts, "root").select("digest", "rows", "component_id"), "jaccard-groups")
    return _with_group(marks, groups)


def _with_group(marks: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of marks with their set's component_id. The few sets with many copies are repeated for
    each lane, and their rows leave the join on the digest."""
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    hot = groups.filter(F.col("rows") > HOT).select(
        "digest", F.struct("component_id").alias("hot"), lanes.alias("lane"))
    laned = marks.select("doc_id", "n", "digest", "row", F.pmod(F.xxhash64("row"), F.lit(LANES)).cast("int").alias("lane"))
    first = laned.join(hot, ["digest", "lane"], "left")
    alone = F.col("hot").isNotNull() | (F.col("n") == 0)  # nothing to look for: a key of its own
    keyed = first.withColumn("digest", F.when(alone, F.col("row").cast("string").cast("binary")).otherwise(F.col("digest")))
    found = keyed.join(groups.select("digest", "component_id"), "digest", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("hot").isNotNull(), F.col("hot.component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(alone, own).otherwise(F.col("component_id")).alias("component_id"))
