"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, emit) -> DataFrame:
    """Joins each pair (a, b) with m, the least of a and its partners."""
    least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    out = emit(pairs.join(least, "a"))
    return out.where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Partners above a node are linked to the node's least partner."""
    return _star(
        _both_ways(links), lambda p: p.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its partners below it are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return _star(
        down,
        lambda p: p.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            p.select("a", F.col("m").alias("b"))
        ),
    )


def _print_of(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the component's least node.

    ``links`` has the columns a and b, null-free.  Every round is written to the
    shared folder; the driver sees a count and a check sum of it.  The number of
    rounds grows with the logarithm of the size.
    """
    now, before = stored(links.select("a", "b").where("a <> b").distinct(), "links"), None
    mark = _print_of(now)
    while mark != before:
        before = mark
        now = stored(_small_star(_large_star(now)), "links")
        mark = _print_of(now)
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
