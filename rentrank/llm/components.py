"""Connected components of a link table, with large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentrank.llm.store import saved


def _nearest(links: DataFrame) -> DataFrame:
    """(u, v, m): each link with the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every link points from the larger to the smaller end here."""
    near = _nearest(links)
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = near.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node that is not the smallest of its component, and that smallest.

    ``links``: long columns u, v, in any direction. Links of a node to itself and NULLs are
    ignored. Each round is a written table; the number of rounds grows with the logarithm of
    the longest path. Nothing but a count and a checksum reaches the driver.
    """
    links = saved(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    mark = _mark(links)
    while mark[0]:
        links = saved(_small_star(saved(_large_star(links).distinct(), "large-star")), "small-star")
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links
