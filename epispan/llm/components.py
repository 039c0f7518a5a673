"""Connected components by alternating stars, every round kept as a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epispan.session import materialize

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, under its smallest
    neighbour. Neighbourhoods are never gathered: a node's smallest neighbour is an aggregate
    that combines before the shuffle, and joining it back leaves hubs to skew handling. The
    number of rounds grows with the logarithm of a component's width. Null ends and loops link
    nothing; repeated links change nothing.
    """
    stars = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links",
    )
    before = _state(stars)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        after = _state(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(stars: DataFrame) -> tuple:
    """Size and order-free checksum of a set of links."""
    row = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
    return row["n"], row["s"]
