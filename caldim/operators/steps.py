"""Logged steps and the two procedures (generate, roll) built from them.

``run_step`` executes one statement, records its first result value in the
audit table, or the error in the error table, and returns a message. The
procedures run their steps in order, keep the dimension in a versioned table
and, unlike the original, re-raise after logging a failure.
"""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable
from typing import Union

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caldim.operators import dimension as dim_ops
from caldim.sources.logs import LogTables
from caldim.sources.store import VersionedTable

# A step is SQL text, a DataFrame (its first row is the result), or a
# callable returning (result name, result value).
Step = Union[str, DataFrame, Callable[[], tuple[str, object]]]


class EmptyResult(RuntimeError):
    """The statement returned no row, so it has no first value to log."""


def first_value(spark: SparkSession, action: Step) -> tuple[str, object]:
    """Name and value of the first column of the first row of a step.

    The whole statement runs, every row and column of it, in one job: its
    rows go to the ``noop`` sink and the first value is observed on the way
    (``take(1)`` would run a prefix and miss an error further on)."""
    if callable(action) and not isinstance(action, DataFrame):
        return action()
    df = spark.sql(action) if isinstance(action, str) else action
    if not df.columns:
        raise EmptyResult("the statement returned no row")
    rows = df.toDF(*[f"c{k}" for k in range(len(df.columns))]).withColumn("n", F.monotonically_increasing_id())
    seen = Observation()
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.min_by("c0", "n").alias("value"))
    rows.write.format("noop").mode("overwrite").save()
    if not seen.get["rows"]:
        raise EmptyResult("the statement returned no row")
    return df.columns[0], seen.get["value"]


def _error_fields(err: BaseException) -> tuple[str, str, str | None]:
    if isinstance(err, PySparkException):
        return err.getCondition() or type(err).__name__, err.getMessage(), err.getSqlState()
    return type(err).__name__, str(err), None


def run_step(
    spark: SparkSession,
    logs: LogTables,
    procedure: str,
    step: str,
    action: Step,
    raise_errors: bool = False,
    ts: dt.datetime | None = None,
) -> str:
    """Run ``action``; on success log 'name: value' to the audit table and
    return it; on failure log the error and return '<step> failed: <message>'
    (or re-raise when ``raise_errors``). If the step succeeds but its audit row
    cannot be written, that is logged as an error of the step "<step> (audit)"."""
    try:
        name, value = first_value(spark, action)
    except Exception as err:  # noqa: BLE001 - every failure is logged
        code, message, state = _error_fields(err)
        logs.log_error(procedure, step, code, message, state, traceback.format_exc(), ts=ts)
        if raise_errors:
            raise
        return f"{step} failed: {message}"
    message = f"{name}: {value}"
    try:
        logs.log_audit(procedure, step, message, ts=ts)
    except Exception as err:  # noqa: BLE001
        code, text, state = _error_fields(err)
        logs.log_error(procedure, f"{step} (audit)", code, text, state, traceback.format_exc(), ts=ts)
        if raise_errors:
            raise
        return f"{step} (audit) failed: {text}"
    return message


def _logged(logs: LogTables, procedure: str, step: str, ts: dt.datetime | None, action):
    """Run ``action``; a failure is logged under ``step`` and raised."""
    try:
        return action()
    except Exception as err:
        code, message, state = _error_fields(err)
        logs.log_error(procedure, step, code, message, state, traceback.format_exc(), ts=ts)
        raise


def generate_dim_date_procedure(
    spark: SparkSession,
    dim_table: VersionedTable,
    logs: LogTables,
    start: dt.date,
    end: dt.date,
    fin_cal: DataFrame,
    as_of: dt.date,
    initial_load: bool = False,
    load_ts: dt.datetime | None = None,
) -> str:
    """Stage the span, merge it into the current version of ``dim_table``
    (ignored when ``initial_load``) and commit the result as a new version.

    The statements of the procedure are one plan and one write; each has its
    audit row with the rows it made, observed during that write."""
    proc, counts = "GENERATE_DIM_DATE", dim_ops.Counts()

    def build() -> tuple[DataFrame | None, DataFrame]:
        before = dim_table.read()
        return before, dim_ops.generate_date_dim(
            spark, start, end, fin_cal, as_of, target=before, initial_load=initial_load, load_ts=load_ts, counts=counts
        )

    before, new_dim = _logged(logs, proc, "stage dates", load_ts, build)
    deleted = before.count() if initial_load and before is not None else 0
    _logged(logs, proc, "merge into dim_date", load_ts, lambda: dim_table.write(new_dim))
    steps = [
        (f"insert {name}", f"number of rows inserted: {counts[name]['rows']}")
        for name in ("date spine", "calendar", "financial calendar", "joined", "stage")
    ]
    if initial_load:
        steps.append(("truncate dim_date", f"number of rows deleted: {deleted}"))
    done = counts["merge"]
    steps.append(
        ("merge into dim_date", f"number of rows inserted: {done['inserted']}, number of rows updated: {done['updated']}")
    )
    logs.log_audits(proc, steps, ts=load_ts)
    return "ALL OK"


def roll_dim_date_procedure(
    spark: SparkSession,
    dim_table: VersionedTable,
    logs: LogTables,
    as_of: dt.date | None = None,
    load_ts: dt.datetime | None = None,
) -> str:
    """Roll the current version to ``as_of`` (default: yesterday in the
    business zone) and commit the result as a new version."""
    proc = "ROLL_DIM_DATE"
    as_of = as_of or dim_ops.default_roll_as_of()

    def current() -> DataFrame:
        dim = dim_table.read()
        if dim is None:
            raise FileNotFoundError(f"no committed version of {dim_table.path}")
        return dim

    dim = _logged(logs, proc, "read dim_date", load_ts, current)
    rolled = _logged(logs, proc, "read position", load_ts, lambda: dim_ops.roll_date_dim(dim, as_of, load_ts=load_ts))
    _, rows = _logged(logs, proc, "update dim_date", load_ts, lambda: dim_table.write(rolled))
    logs.log_audit(proc, "update dim_date", f"number of rows updated: {rows}", ts=load_ts)
    return "ALL OK"


def build_time_of_day_procedure(
    spark: SparkSession, tod_table: VersionedTable, logs: LogTables, load_ts: dt.datetime | None = None
) -> str:
    """Build the 86 400-row time-of-day dimension and commit it as a new
    version (the CREATE OR REPLACE TABLE AS SELECT of the original)."""
    from caldim.operators.time_of_day import time_of_day_dim

    proc, step = "BUILD_DIM_TIME_OF_DAY", "create dim_time_of_day"
    _, rows = _logged(logs, proc, step, load_ts, lambda: tod_table.write(time_of_day_dim(spark, load_ts)))
    logs.log_audit(proc, step, f"number of rows inserted: {rows}", ts=load_ts)
    return "ALL OK"
