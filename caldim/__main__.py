"""Command line for scheduled runs, e.g. with spark-submit:

    python -m caldim generate --start 2015-01-01 --end 2031-01-01 --fin <path> --base <path> [--as-of D] [--initial-load]
    python -m caldim roll --base <path> [--as-of D] [--zone Pacific/Auckland]
    python -m caldim time-of-day --base <path>
    python -m caldim step --base <path> --procedure P --step S --sql "select count(*) from fact_sales" \
        [--view fact_sales=<parquet path> ...]
    python -m caldim load --base <path> --source <parquet path> --table T --time-column C [--schema S] [--country C] [--until D]

``--base`` is the folder holding ``dim_date``, ``dim_time_of_day`` and the log
tables. Without --as-of, generate uses today and roll uses yesterday, both in
--zone. ``load`` appends the source's rows from the table's high-water mark up
to --until (today's midnight in --zone) to ``<base>/<T>`` and moves the mark;
rows that arrived below it are counted in the audit table.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from zoneinfo import ZoneInfo

from pyspark.sql import SparkSession


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="caldim")
    sub = ap.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate", help="stage a span and merge it into the date dimension")
    g.add_argument("--start", type=_date, required=True)
    g.add_argument("--end", type=_date, required=True, help="excluded")
    g.add_argument("--fin", required=True, help="financial calendar dataset")
    g.add_argument("--fin-format", default="parquet")
    g.add_argument("--initial-load", action="store_true")
    r = sub.add_parser("roll", help="roll the as-of columns of the date dimension")
    t = sub.add_parser("time-of-day", help="build the time-of-day dimension")
    st = sub.add_parser("step", help="run one SQL statement and log its first value or its error")
    st.add_argument("--procedure", required=True)
    st.add_argument("--step", required=True)
    st.add_argument("--sql", required=True)
    st.add_argument("--view", action="append", default=[], help="name=parquet path, exposed to the SQL")
    ld = sub.add_parser("load", help="append the rows behind a table's high-water mark")
    ld.add_argument("--source", required=True)
    ld.add_argument("--table", required=True)
    ld.add_argument("--time-column", required=True)
    ld.add_argument("--schema")
    ld.add_argument("--country")
    ld.add_argument("--until", type=_date)
    for p in (g, r, t, st, ld):
        p.add_argument("--base", required=True)
        p.add_argument("--as-of", type=_date)
        p.add_argument("--zone", default="Pacific/Auckland")
    a = ap.parse_args(argv)

    from caldim.operators import steps
    from caldim.session import apply_conf
    from caldim.sources.fincal import read_financial_calendar
    from caldim.sources.logs import LogTables
    from caldim.sources.store import VersionedTable

    spark = SparkSession.builder.appName(f"caldim-{a.cmd}").getOrCreate()
    apply_conf(spark)
    base = a.base.rstrip("/")
    logs = LogTables(spark, f"{base}/logs")
    today = dt.datetime.now(ZoneInfo(a.zone)).date()
    if a.cmd == "generate":
        fin = read_financial_calendar(spark, a.fin, a.fin_format, header="true") if a.fin_format == "csv" else \
            read_financial_calendar(spark, a.fin, a.fin_format)
        out = steps.generate_dim_date_procedure(
            spark, VersionedTable(spark, f"{base}/dim_date"), logs, a.start, a.end, fin,
            a.as_of or today, initial_load=a.initial_load,
        )
    elif a.cmd == "roll":
        out = steps.roll_dim_date_procedure(
            spark, VersionedTable(spark, f"{base}/dim_date"), logs, a.as_of or today - dt.timedelta(days=1)
        )
    elif a.cmd == "time-of-day":
        out = steps.build_time_of_day_procedure(spark, VersionedTable(spark, f"{base}/dim_time_of_day"), logs)
    elif a.cmd == "load":
        from caldim.operators import facts

        source = spark.read.parquet(a.source)
        of = dict(table_name=a.table, schema_name=a.schema, country=a.country)
        late = facts.late_rows(logs, source, a.time_column, **of)
        until = dt.datetime.combine(a.until or today, dt.time())
        done = facts.incremental_load(spark, logs, source, a.time_column, f"{base}/{a.table}", upper=until, **of)
        out = f"rows loaded: {done.rows}, late: {late}, without time: {done.rows_without_time}, mark: {done.mark}"
    else:

        def action():
            # views are registered inside the step, so a bad path is logged too
            for v in a.view:
                name, sep, path = v.partition("=")
                if not sep or not name or not path:
                    raise ValueError(f"--view expects name=path, got {v!r}")
                spark.read.parquet(path).createOrReplaceTempView(name)
            return steps.first_value(spark, a.sql)

        out = steps.run_step(spark, logs, a.procedure, a.step, action)
    print(out)
    return 0 if a.cmd != "step" or not out.startswith(f"{a.step} failed:") else 1


if __name__ == "__main__":
    sys.exit(main())
