"""Runs and gaps of activity, and series without gaps.

A key's activity is first reduced to the units (weeks, periods, days) it has,
map-side, so a key with a third of all rows sends one row a unit from each task.
Runs are then found in two steps, within blocks of units and across them, so a
task holds a block of a key's series at most, and a few rows for each block.
Balances are found over the days that have a movement, a row a key and day, and
spread over the days between afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caldim.operators.numbering import running_total

#: Units of the blocks that runs are first found in.
BLOCK = 64


def week_number(d: Column) -> Column:
    """Weeks from Monday to Sunday, counted from the one that holds 1970-01-01."""
    return F.floor((F.unix_date(d) + 3) / 7).cast("int")


def runs(activity: DataFrame, key: str, unit: str) -> DataFrame:
    """(key, first, last): the longest stretches of consecutive ``unit`` numbers
    that a key has in ``activity`` (repeats and nulls do not matter)."""
    units = activity.select(key, F.col(unit).cast("long").alias("u")).where("u is not null").distinct()
    units = units.withColumn("block", F.floor(F.col("u") / BLOCK))
    place = F.row_number().over(Window.partitionBy(key, "block").orderBy("u"))
    pieces = units.withColumn("island", F.col("u") - place).groupBy(key, "block", "island").agg(F.min("u").alias("a"), F.max("u").alias("e"))
    # pieces that meet across blocks
    by_start = Window.partitionBy(key).orderBy("a")
    breaks = pieces.withColumn("new", F.when(F.col("a") == F.lag("e").over(by_start) + 1, 0).otherwise(1))
    numbered = breaks.withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(key, "run").agg(F.min("a").alias("first"), F.max("e").alias("last")).drop("run")


def gap_summary(found: DataFrame, key: str) -> DataFrame:
    """For each key of ``runs``: units with activity, runs, the longest run, the
    gaps between runs, the longest gap and the first unit of the earliest such gap
    (0 and null without a gap), the first and the last unit."""
    later = Window.partitionBy(key).orderBy("first")
    gaps = found.withColumn("gap", F.lead("first").over(later) - F.col("last") - 1)
    longest = F.max(F.struct(F.col("gap"), -F.col("last")))  # of equally long gaps the earliest
    out = gaps.groupBy(key).agg(
        F.sum(F.col("last") - F.col("first") + 1).alias("active"), F.count(F.lit(1)).alias("runs"),
        F.max(F.col("last") - F.col("first") + 1).alias("longest_run"), F.count("gap").alias("gaps"),
        longest.alias("g"), F.min("first").alias("first"), F.max("last").alias("last"),
    )
    return out.select(
        key, "active", "runs", "longest_run", "gaps", F.coalesce("g.gap", F.lit(0).cast("long")).alias("longest_gap"),
        F.when(F.col("g.gap").isNotNull(), 1 - F.col("g.col2")).alias("longest_gap_from"), "first", "last",
    )


def densified(daily: DataFrame, key: str, date: str, zeros: Sequence[str], held: Sequence[str] = ()) -> DataFrame:
    """``daily`` (one row a key and date) with a row for every date between a
    key's first and last: ``zeros`` are 0 there, ``held`` keep the row before's
    value, other columns are null. Each row makes the days up to the key's next
    one, so nothing is joined or multiplied by the whole calendar, and only the
    rows of ``daily`` are sorted."""
    following = F.lead(date).over(Window.partitionBy(key).orderBy(date))
    rows = daily.where(F.col(date).isNotNull()).withColumn("_until", F.greatest(F.col(date), F.date_sub(following, 1)))
    days = rows.select("*", F.explode(F.sequence(F.col(date), F.col("_until"))).alias("_d"))
    own = F.col("_d") == F.col(date)

    def value(c: str) -> Column:
        if c in held:
            return F.col(c)
        if c in zeros:
            zero = F.lit(0).cast(daily.schema[c].dataType)
            return F.when(own, F.coalesce(F.col(c), zero)).otherwise(zero)
        return F.when(own, F.col(c))

    return days.select(key, F.col("_d").alias(date), *(value(c).alias(c) for c in daily.columns if c not in (key, date)))


def carried_forward(series: DataFrame, by: Sequence[str], order: str, values: Sequence[str], block: Column | None = None) -> DataFrame:
    """``series`` with nulls of ``values`` replaced by the last value before them
    in the group: within blocks first, then from the last block that has one.
    Without ``block`` a task holds a group: for groups of a row a date."""
    if block is None:
        sofar = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return series.withColumns({v: F.last(v, ignorenulls=True).over(sofar) for v in values})
    rows = series.withColumn("_block", block)
    within = Window.partitionBy(*by, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.groupBy(*by, "_block").agg(
        *(F.max(F.when(F.col(v).isNotNull(), F.struct(F.col(order).alias("o"), F.col(v).alias("v")))).alias(f"_end_{v}") for v in values)
    )
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        *(F.col(c).alias(f"_by_{c}") for c in by), F.col("_block").alias("_at"),
        *(F.last(f"_end_{v}", ignorenulls=True).over(earlier)["v"].alias(f"_before_{v}") for v in values),
    )
    on = F.col("_block") == F.col("_at")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    filled = rows.withColumns({v: F.last(v, ignorenulls=True).over(within) for v in values})
    both = filled.join(ends, on)
    return both.select(*(F.coalesce(F.col(c), F.col(f"_before_{c}")).alias(c) if c in values else F.col(c) for c in series.columns))


def daily_balance(daily: DataFrame, key: str, date: str, movement: str, as_type: str | None = None) -> DataFrame:
    """(key, date, movement, balance, last_movement): every day between a key's
    first and last movement, the running balance, and the last movement carried;
    the figures of ``as_type``, to which they are cast after they are summed.

    ``daily`` has one row a key and date, so a key's rows are bounded by the
    calendar: they meet in one task, are sorted once, and the days between them
    are made last."""
    moves = daily.where(F.col(date).isNotNull()).select(key, date, movement)
    moves = moves.withColumns({"balance": F.coalesce(F.col(movement), F.lit(0).cast(daily.schema[movement].dataType)), "last_movement": F.col(movement)})
    summed = running_total(moves, [key], [date], {"balance": F.col("balance")})
    carried = carried_forward(summed, [key], date, ["last_movement"])
    if as_type:  # a few rows a key here, one a day below
        carried = carried.withColumns({c: F.col(c).cast(as_type) for c in (movement, "balance", "last_movement")})
    return densified(carried, key, date, [movement], ["balance", "last_movement"]).select(key, date, movement, "balance", "last_movement")
