"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import stored
from cohortloom.operators.skew import spread_join


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u")
    return spread_join(larger, least, ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = spread_join(down, least, ["u"], "inner").filter("v <> m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node with an edge.

    ``edges`` has two long columns ``u`` and ``v``. Each round hangs neighbours below the least
    node they know; the number of rounds grows with the logarithm of the nodes. Every round is
    written to the shared folder, so lost executors cost one round and plans stay short. Nodes with
    very many edges are split by the joins. Loops and repeated edges do no harm; without edges
    there are no rows.
    """
    edges = stored(edges.filter("u <> v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges).distinct()).filter("u <> v").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
