"""Gapless numbers over a whole table, and running totals, in two passes.

A window without a partition would pull all rows into one task. Instead rows are
spread over range partitions by their order and stored once, so that both passes
see the same ones: the first counts (or sums) each partition, the prefix sums of
these few figures are what comes before each partition, and the second adds them
to the place within the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caldim.session import work_dir

#: Bits of a row's place within its partition in a monotonically increasing id.
PLACE_BITS = 33


def _ordered(df: DataFrame, order: Sequence[str], partitions: int, part: str, place: str) -> DataFrame:
    """``df`` in order over range partitions, stored, with partition and place (from 0)."""
    spark = df.sparkSession
    number = F.monotonically_increasing_id()
    rows = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    rows = rows.withColumns({part: F.shiftright(number, PLACE_BITS).cast("int"), place: number.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})
    path = work_dir(spark, "ordered")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _before(spark, totals: dict[int, object], ddl: str) -> DataFrame:
    """(part, before): the sum over all partitions before each; a row a partition."""
    rows, at = [], None
    for part in sorted(totals):
        rows.append((part, at))
        at = totals[part] if at is None else at + totals[part]
    return spark.createDataFrame(rows, ddl)


def number_rows(
    df: DataFrame, order: Sequence[str], key: str = "row_key", first: int = 1, partitions: int | None = None
) -> DataFrame:
    """``df`` with the column ``key``: first, first + 1, ... in the order of the
    columns ``order`` (nulls first), without gaps.

    The numbers are the same on every run and for any number of partitions if
    ``order`` tells all rows apart that differ; so name further columns behind
    the wanted ones. One value of the first column may hold any share of all rows:
    the further ones split it over tasks. An empty table stays empty."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _ordered(df, order, n, "_part", "_place")
    counts = {r["_part"]: r["n"] for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a partition
    before = _before(df.sparkSession, counts, "_part int, _before long")
    number = F.coalesce("_before", F.lit(0)) + F.col("_place") + F.lit(first)
    return rows.join(F.broadcast(before), "_part").select(number.cast("long").alias(key), *df.columns)


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column], block: Column | None = None
) -> DataFrame:
    """``df`` with a running total of each value within its group ``by``, over
    the rows in ``order``, this one included.

    A group's rows are cut by ``block``, a column that grows with the order:
    running totals within blocks, the totals of blocks before (a window over one
    row a block), and both added. So a task holds a block, not a group. Without
    ``block`` it holds a group, which needs ``df`` once: for groups of a row a date."""
    if block is None:
        sofar = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        kept = [c for c in df.columns if c not in values]
        types = df.agg(*(F.sum(v).alias(name) for name, v in values.items())).schema  # of sums, so that totals are as wide as sums of sums
        return df.select(*kept, *(F.sum(v.cast(types[name].dataType)).over(sofar).alias(name) for name, v in values.items()))
    df = df.withColumn("_block", block)
    within = Window.partitionBy(*by, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumns({name: F.sum(v).over(within) for name, v in values.items()})
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*by, "_block").agg(*(F.sum(v).alias(f"_sum_{name}") for name, v in values.items()))
    sums = sums.select(
        *(F.col(c).alias(f"_by_{c}") for c in by), F.col("_block").alias("_at"),
        *(F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in values),
    )
    on = F.col("_block") == F.col("_at")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    both = rows.join(sums, on)
    kept = [c for c in df.columns if c not in values and c != "_block"]
    add = lambda name: F.when(
        F.col(name).isNotNull() | F.col(f"_before_{name}").isNotNull(),
        F.coalesce(name, F.lit(0)) + F.coalesce(f"_before_{name}", F.lit(0)),
    )
    return both.select(*kept, *(add(name).alias(name) for name in values))
