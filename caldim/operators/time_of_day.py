"""Time-of-day dimension: 86 400 rows, one per second."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.functions import timeofday as tod
from caldim.operators.dimension import ts_literal
from caldim.sources.spine import second_spine

# The dimension has exactly this many rows: a proven broadcast bound.
TIME_OF_DAY_ROWS = tod.SECONDS_PER_DAY


def time_of_day_dim(spark: SparkSession, load_ts: dt.datetime | None = None) -> DataFrame:
    s = F.col("second_of_day")
    cols = tod.time_of_day_columns(s)
    return second_spine(spark).select(
        *[v.alias(k) for k, v in cols.items()], ts_literal(load_ts).alias("last_update_date")
    )


def with_time_of_day(df: DataFrame, ts: str, prefix: str = "", load_ts: dt.datetime | None = None) -> DataFrame:
    """Add the time-of-day columns of a timestamp column to a fact (X4) by a
    broadcast join to the dimension on its key (second of day + 1).

    The dimension always has exactly 86 400 rows (a fixed bound, about 10 MB
    broadcast) and covers every second, so the join never loses a row; per
    fact row it costs a hash probe instead of building six labels (on 6 M
    rows 1.0 s against 1.6 s for ``functions.timeofday.with_time_of_day``,
    and 4.5 s for printf-style formatting)."""
    dim = time_of_day_dim(df.sparkSession, load_ts).drop("last_update_date")
    dim = dim.select(*[F.col(c).alias(prefix + c) for c in dim.columns])
    key = prefix + "time_of_day_key"
    joined = df.withColumn(key, tod.time_key(tod.second_of_day(F.col(ts)))).join(F.broadcast(dim), key, "left")
    return joined.select(*df.columns, *dim.columns)
