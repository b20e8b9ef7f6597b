"""Sessions of users on a stream of events that come repeated, late or without a time.

Repeats of an event id within the watermark are dropped, events of a user less
than ``gap`` apart form a session, and a session is written once the watermark has
passed its end. Nothing vanishes unseen: rows without a time, repeats and rows
that come later than the watermark are counted (``batch_counts``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

#: Name of the metrics observed on arriving rows.
ARRIVED = "arrived"
COUNTS = "batch_id long, rows long, without_time long, late long, repeated long"


def counted(stream: DataFrame, ts_col: str) -> DataFrame:
    """A stream whose rows, and those without a time, are counted as they arrive
    (see ``batch_counts``); rows without a time, which no window can hold, go."""
    seen = stream.observe(ARRIVED, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ts_col).isNull()).alias("without_time"))
    return seen.where(F.col(ts_col).isNotNull())


def batch_counts(query: StreamingQuery) -> list[tuple[int, int, int, int, int]]:
    """COUNTS rows of the micro-batches that a query has run: rows that arrived,
    those without a time, those too late for its watermark, and dropped repeats."""
    out = []
    for p in query.recentProgress:
        seen = p.observedMetrics.get(ARRIVED)
        ops = p.stateOperators
        late = sum(op.numRowsDroppedByWatermark for op in ops)
        repeated = sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in ops)
        rows, without = (seen["rows"], seen["without_time"]) if seen else (0, 0)
        out.append((p.batchId, rows, without, late, repeated))
    return out


def sessions(events: DataFrame, ts_col: str, id_col: str, user_col: str, value_col: str, gap: str, watermark: str) -> DataFrame:
    """(user, session_start, session_end, events, value_sum) of a stream (or a
    table) of events with times."""
    ntz = dict(events.dtypes)[ts_col] == "timestamp_ntz"
    # watermarks need an instant: the wall clock is read in the session zone (UTC)
    rows = events.select(F.col(ts_col).cast("timestamp").alias("t"), id_col, F.col(user_col).alias("user"), F.col(value_col).alias("value"))
    once = rows.withWatermark("t", watermark).dropDuplicatesWithinWatermark([id_col])
    found = once.groupBy(F.session_window("t", gap).alias("w"), "user").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value_sum")
    )
    back = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
    return found.select(
        F.col("user").alias(user_col), back(F.col("w.start")).alias("session_start"), back(F.col("w.end")).alias("session_end"), "events", "value_sum"
    )


def start_session_stream(
    spark: SparkSession, source: str, schema: T.StructType, out_path: str, checkpoint: str, gap: str = "30 minutes",
    watermark: str = "2 hours", available_now: bool = True,
) -> StreamingQuery:
    """Start the stream over the parquet files that ``source`` (a folder or glob)
    has and gets; schema: event_id, ts, user_id, value and others. Each batch's
    sessions go to ``batch_id=<n>``, replaced if the batch is run again."""
    stream = counted(spark.readStream.schema(schema).parquet(source), "ts")
    found = sessions(stream, "ts", "event_id", "user_id", "value", gap, watermark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={number}")

    w = found.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def run_once(spark: SparkSession, counts_path: str, **stream) -> None:
    """Run the stream over what has arrived, and store its counts: a folder a run,
    named by its first batch, so that a run repeated after a failure replaces its own."""
    q = start_session_stream(spark, **stream)
    q.awaitTermination()
    rows = batch_counts(q)
    if rows:
        spark.createDataFrame(rows, COUNTS).coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/from={rows[0][0]}")
