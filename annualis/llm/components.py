"""Connected components of a graph of long nodes, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annualis.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("m").alias("a"), "b").filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b")
    return moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the component's smallest node.

    Both steps keep the components and are joins on a node with its minimum, an aggregate that
    combines before the shuffle; rounds grow with the logarithm of the nodes. Each round is
    written to the shared folder. Rounds end when the edges stay the same, which shows in their
    number and an order-free checksum. Raises if max_rounds is not enough.
    """
    state = None
    for _ in range(max_rounds):
        edges = written(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now
    raise RuntimeError(f"components are not stable after {max_rounds} rounds")
