"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``id``, ``comp`` (smallest id of the component) for every end of an edge.

    Each step points a vertex's neighbours to the smallest of them; edges only ever shrink to
    stars, and the loop ends when a step changes nothing, whatever the number of rounds. The
    smallest neighbour is a partial aggregate, so a hub is summed map-side; joins on a hub's
    key are split by adaptive execution. Every round is a table in the shared folder.
    """
    x, y = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    now = edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u <> v")
    now = written(now.distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == before or mark["n"] == 0:
            break
        before = mark
        # large star: every neighbour above u points to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: u and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        now = written(small.where("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
