"""Connected components over a written table of links (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import stage


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Each node passes the smallest of its neighbours and itself to its larger (or its other) neighbours.

    Links lead from the larger node, ``a``, to the smaller. Minima are partial aggregates, so a node with
    very many neighbours is not gathered."""
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not small:  # towards larger neighbours too
        near = links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                              F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("l")).select("l.*")
    low = near.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    up = low.where("u != low").select(F.col("u").alias("a"), F.col("low").alias("b"))
    hub, other = ("a", "b") if small else ("b", "a")
    passed = links.select(F.col(hub).alias("u"), F.col(other).alias("v")).join(low, "u").where("v != low")
    return passed.select(F.col("v").alias("a"), F.col("low").alias("b")).unionAll(up).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node reachable.

    Rounds end when the links are stars: each larger node has one link, to a node that has none.
    Links of an earlier result, ``(node, root)``, may stand for the links it was made of.
    Large and small stars are written one by one, which keeps plans, and so the driver's memory, small."""
    now = stage(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        deeper = now.join(now.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        several = now.groupBy("a").count().where("count > 1").select("a")
        if deeper.select("a").unionAll(several).isEmpty():
            break
        now = stage(_stars(stage(_stars(now, small=False), "large-stars"), small=True), "stars")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())


def as_links(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
