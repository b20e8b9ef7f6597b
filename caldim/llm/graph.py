"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import stored


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root): each node of ``edges`` with the smallest node reachable.

    Alternating large-star and small-star steps: every step moves each node's
    larger (smaller) neighbours to the smallest one it sees, by a grouped
    minimum and a join, until the edges no longer change; the number of rounds
    grows with the logarithm of a component's size. Each round is a table in
    the shared folder. Self loops and null ends are ignored (such nodes are
    absent from the result); an empty edge table gives an empty result.
    """
    e = stored(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .filter("u is not null and v is not null and u <> v")
        .distinct(),
        "edges",
    )
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        e = stored(small, "edges")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]
