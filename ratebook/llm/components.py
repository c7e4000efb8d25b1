"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import stored


def _larger_to_least(links: DataFrame) -> DataFrame:
    """Every neighbour above u is linked to the least of u and its neighbours instead."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _smaller_to_least(links: DataFrame) -> DataFrame:
    """u and its neighbours below are linked to the least of those."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    below = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node of its component, for every node of a link (a, b).

    Alternates two star operations until every node hangs on its least one.  Groups are
    only ever reduced to their least member, so a node may have any number of links.
    """
    flat = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    state = None
    while True:
        flat = stored(
            _smaller_to_least(_larger_to_least(flat).distinct()).distinct(), "stars"
        )
        now = flat.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))
        ).first()
        if now == state:
            break
        state = now
    return flat.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        flat.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
