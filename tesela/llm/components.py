"""Connected components of a link table by alternating large-star and small-star steps (Kiveris et al.,
Connected Components in MapReduce and Beyond, 2014), as joins and aggregations. Each round is written to the
shared folder; nothing is collected but a count and a checksum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, few, kept_at


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every neighbour above u is hung on the least node of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = few(both.groupBy("u").agg(F.min("v").alias("m")), rows).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    hung = few(both.join(least, F.col("u") == F.col("c")), rows)
    return few(hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """u and its neighbours below it are hung on the least of them; edges point downwards."""
    least = few(edges.groupBy("u").agg(F.min("v").alias("m")), rows).withColumnRenamed("u", "c")
    hung = few(edges.join(least, F.col("u") == F.col("c")), rows)
    moved = hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return few(moved.unionByName(hung.select("u", F.col("m").alias("v"))).distinct(), rows)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root for every node that a link (u, v) names; root is the least node reachable. Links are
    undirected, may repeat and may join a node to itself (which adds nothing). links: a table that is cheap to count."""
    rows = links.count()
    edges, path = kept_at(few(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows), "links")
    seen = None
    for _ in range(most_rounds):
        last = path
        edges, path = kept_at(_small_star(_large_star(edges, 2 * rows), 2 * rows), "links")
        drop(edges.sparkSession, last)
        rows, *_ = now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(few(roots.select(F.col("root").alias("node"), "root").distinct(), rows))
