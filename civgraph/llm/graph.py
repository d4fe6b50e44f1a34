"""Connected components of a table of links by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civgraph.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links`` (a, b), root the smallest
    vertex of its component.

    Each round hangs the larger neighbours of every vertex on its smallest
    one, then the smaller ones; the number of rounds grows with the logarithm
    of the longest chain.  Minima are pre-aggregated per task.  The joins have
    one row per vertex on one side, but that side is still being grouped by the
    vertex, so a vertex with very many links is not split within a round; links
    of a star contract to one per vertex.  Every round is written to the shared folder.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "a").alias("x"), F.least("b", "a").alias("y"), "m", "a")
        turned = small.where("y <> m").select(F.col("y").alias("a"), F.col("m").alias("b")).unionAll(
            small.select("a", F.col("m").alias("b"))).distinct()
        turned = stored(turned, "edges")
        # settled: every vertex hangs on one smaller vertex that hangs on none
        many = turned.groupBy("a").count().where("count > 1").limit(1).count()
        if not many and not turned.join(turned.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count():
            roots = turned.select(F.col("b").alias("v")).distinct().select("v", F.col("v").alias("root"))
            return turned.select(F.col("a").alias("v"), F.col("b").alias("root")).unionAll(roots)
        edges = turned
