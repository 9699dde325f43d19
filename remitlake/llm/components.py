"""Connected components of a graph given by its links, all of it in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.sources.shared import dropped, stored

#: So few links go to every task, a few megabytes at most, and only their aggregates are shuffled.
FEW = 1 << 16


def _least(edges: DataFrame, few: bool) -> tuple[DataFrame, DataFrame]:
    """(u, m), the least v of each u, as it is and as it is joined."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return least, F.broadcast(least) if few else least


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    _, least = _least(edges.unionAll(turned), few)
    return turned.join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is tied to the least of them."""
    own, least = _least(edges, few)
    tied = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionAll(own.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger node has one link, and none to a node that has a smaller one itself: no step changes that."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another one; root is the least node of its component.

    Large-star and small-star steps take turns until stars are left; each round is stored in the shared folder. The
    links of a node with many of them are spread by the join. Links to null or to the node itself count for nothing.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), "edges")
    done = not (n := edges.count())
    while not done:
        few = n <= FEW
        old, edges = edges, stored(_small_star(_large_star(edges, few), few).distinct(), "edges")
        dropped(old)
        done = _are_stars(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
