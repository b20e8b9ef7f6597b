"""Design measurements on inputs derived from the sf0.1 tables by repetition
(nothing synthetic): per-row expressions vs broadcast joins to a dimension,
rollups with and without daily pre-aggregation, and a skewed input where one
date holds a third of all rows. Usage:

    python tools/scale_experiments.py [/root/testdata/sf0.1] [copies]

Prints one JSON line of median seconds (3 runs, ``noop`` sink)."""

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from caldim.functions import calendar as cal  # noqa: E402
from caldim.functions import timeofday as tod  # noqa: E402
from caldim.operators import facts  # noqa: E402
from caldim.operators.dimension import calendar_dim  # noqa: E402
from caldim.operators.time_of_day import with_time_of_day  # noqa: E402
from caldim.session import build_session  # noqa: E402


def repeat(df, n):
    out = df
    for _ in range(n - 1):
        out = out.unionByName(df)
    return out.repartition(16).cache()


def timed(make):
    runs = []
    for _ in range(3):
        t = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main():
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session(app="caldim-scale")
    li = repeat(spark.read.parquet(f"{base}/lineitem.parquet").select("l_orderkey", "l_shipdate", "l_quantity"), copies)
    ev = repeat(spark.read.parquet(f"{base}/events.parquet").select("event_id", "ts"), copies * 6)
    n_li, n_ev = li.count(), ev.count()
    lo, hi = li.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    start, end = dt.date(lo.year, 1, 1), dt.date(hi.year + 1, 1, 1)
    cdim = calendar_dim(spark, start, end).cache()
    cdim.count()
    q = {"q": F.col("l_quantity").cast("decimal(18,2)")}
    # skew: a third of all rows moved onto one date, same total volume
    hot = li.withColumn(
        "l_shipdate", F.when(F.col("l_orderkey") % 3 == 0, F.lit("1998-07-15").cast("timestamp_ntz")).otherwise(F.col("l_shipdate"))
    ).cache()
    hot.count()

    def rollup_direct(df):
        cols = cal.calendar_columns(cal.as_date("l_shipdate"))
        lv = ["cal_year", "cal_quarter", "month"]
        return df.select(*[cols[x].alias(x) for x in lv], q["q"].alias("q")).groupBy(*lv).agg(
            F.count(F.lit(1)), F.sum("q"))

    out = {
        "rows_lineitem": n_li,
        "rows_events": n_ev,
        "tod_expressions": timed(lambda: tod.with_time_of_day(ev, "ts")),
        "tod_broadcast_join": timed(lambda: with_time_of_day(ev, "ts")),
        "calendar_expressions": timed(lambda: cal.with_date_attributes(li, "l_shipdate")),
        "calendar_broadcast_join": timed(lambda: facts.with_calendar_attributes(li, "l_shipdate", cdim, True)),
        "rollup_direct": timed(lambda: rollup_direct(li)),
        "rollup_daily_first": timed(lambda: facts.calendar_rollup(li, "l_shipdate", q, ["cal_year", "cal_quarter", "month"])),
        "rollup_daily_first_skewed": timed(
            lambda: facts.calendar_rollup(hot, "l_shipdate", q, ["cal_year", "cal_quarter", "month"])),
        "calendar_join_skewed": timed(lambda: facts.with_calendar_attributes(hot, "l_shipdate", cdim, True)),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
