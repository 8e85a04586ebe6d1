"""Connected components of a distributed edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import BROADCAST_BYTES, kept


#: Bytes of a row in memory beside what its node and root take.
ROW_BYTES = 96


def _sum(edges: DataFrame) -> tuple:
    size = F.octet_length(F.concat(F.col("node").cast("string"), F.col("root").cast("string")))
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root")), F.sum(size)).first())


def components(edges: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """``node, root`` for every node of an undirected edge list; ``root`` is the smallest node that a node reaches.

    A round first hangs the larger neighbours of each node under the smallest node around it, then the smaller ones; the
    rounds grow with the logarithm of the longest path. Minima combine before the shuffle and no list of neighbours is
    ever built, so a node with very many edges is no larger than any other. Each round is a table in the shared folder.
    Loops and repeated edges change nothing, null ends are left out, no edges give an empty table.
    """
    high, low = F.greatest(source, target), F.least(source, target)
    now = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(high.alias("node"), low.alias("root"))
    now = kept(now.where("node <> root").distinct(), "graph")
    before = _sum(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        # Minima are at most two per edge, each made of ends of its node's edges: number and length of the edges bound what
        # would be sent to every executor.
        near = F.broadcast if 2 * (before[0] * ROW_BYTES + before[2]) <= BROADCAST_BYTES else lambda df: df
        least = both.groupBy("node").agg(F.min("root").alias("least")).select("node", F.least("node", "least").alias("least"))
        large = both.join(near(least), "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        hung = large.join(near(least), "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        now = kept(hung.unionByName(least.select("node", F.col("least").alias("root"))).distinct(), "graph")
        after = _sum(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("root").alias("node"), "root").distinct()
    return now.unionByName(roots)
