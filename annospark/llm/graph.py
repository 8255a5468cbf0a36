"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import dropped, written


def _simple(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, comp: the smallest node reachable, for every node of ``edges``
    (a, b bigint) that has another neighbour than itself.

    Each round gives every node its smallest neighbour's name, if that is
    smaller, and goes on with the edges between different names: what has become
    one node is not looked at again, so rounds shrink by a factor where names
    are hashes. The names of all rounds are then put together from the last
    round to the first. Nothing is collected but whether edges are left. Minima
    are combined before they are shuffled, so a node of very many edges is no
    bottleneck."""
    spark = edges.sparkSession
    live, live_at = written(_simple(edges), f"{name}-edges")
    rounds = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        names, at = written(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("comp")), name)
        rounds.append((names, at))
        first, second = names.toDF("a", "x"), names.toDF("b", "y")
        left = live.join(first, "a").join(second, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        then, then_at = written(_simple(left), f"{name}-edges")
        dropped(spark, live_at)
        live, live_at = then, then_at
    dropped(spark, live_at)
    if not rounds:
        return edges.where("false").select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out, out_at = rounds.pop()
    while rounds:
        names, at = rounds.pop()
        later = names.join(out.toDF("comp", "top"), "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
        both, both_at = written(later, name)
        dropped(spark, at, out_at)
        out, out_at = both, both_at
    return out
