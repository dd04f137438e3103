"""Connected components of links by alternating large and small stars; every round is an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored

MOST_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """u, v for links u, v of longs: each node but the least of its component, and that least node."""
    e = stored(links.where("u <> v").distinct())
    before = None
    for _ in range(MOST_ROUNDS):
        last, e = e, stored(_small_star(_large_star(e)).where("u <> v").distinct())
        dropped(last)
        now = e.agg(F.count("u"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20))).first()
        if tuple(now) == before:
            return e
        before = tuple(now)
    raise RuntimeError("components did not settle")
