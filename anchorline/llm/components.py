"""Connected components of a graph held in a DataFrame, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an undirected graph; root is one node of its component.

    Each node first takes the one of itself and its neighbours whose hash is smallest, then
    the graph is contracted to these and solved again. Hashes are new at each level, so a
    third of the nodes that still have edges remain in the mean, paths and stars alike.
    Nothing is gathered; each level is a written table.
    """
    edges = stored(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("a"), F.col(b).alias("b")).distinct())
    answer: DataFrame | None = None
    level = 0
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c, F.lit(level)).alias("h"), F.col(c).alias("x"))  # noqa: E731, B023
        least = both.groupBy("a").agg(F.min(ranked("b")).alias("m"))
        smaller = stored(least.select(F.col("a").alias("node"), F.least("m", ranked("a"))["x"].alias("to")))
        level += 1
        to_a, to_b = smaller.select(F.col("node").alias("a"), F.col("to").alias("ta")), smaller.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        contracted = edges.join(to_a, "a").join(to_b, "b").where("ta != tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        if answer is None:
            answer = smaller.select("node", F.col("to").alias("root"))
        else:
            step = smaller.select(F.col("node").alias("root"), "to")
            answer = answer.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        edges = stored(contracted)
    if answer is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stored(answer)
