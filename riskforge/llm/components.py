"""Connected components of a link table, by alternating star contractions.

Every step is a distributed group-by and join; only counts reach the driver,
and each round goes on from a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction. ``links`` has a > b. Large star: a node's larger
    neighbours move to its least neighbour; small star: its smaller ones do."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    near = both.join(least, "a")
    if large:
        moved = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    moved = moved.filter(F.col("a") != F.col("b"))
    return moved if large else moved.distinct()


def near_labels(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (id, label): each linked node with the least of itself
    and its neighbours, or that one's least neighbour. Nodes of one label are of
    one component; a component may have several labels."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "near")
    upper = least.select(F.col("a").alias("m"), F.col("m").alias("label"))
    return least.join(upper, "m").select(F.col("a").alias("id"), "label")


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs in any order -> (id, label): each linked node with
    the least node of its component."""
    now = stored(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "near",
    )
    print_of = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())
    before = print_of(now)
    while True:
        now = stored(_star(_star(now, True), False), "near")
        after = print_of(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    )
