"""Time-of-day enrichment on a stream (X7): events per time window and
daypart, with a watermark.

The daypart is a column expression of the event time, so the stream needs
no join and no state beyond the windowed counts. The query runs in update
mode; each micro-batch writes its changed (window, daypart) rows to its own
``batch_id=<n>`` folder with overwrite, so a retried batch replaces its own
output (idempotent sink). Readers take, per key, the row of the latest batch.
State is bounded by the watermark: windows older than it are dropped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caldim.functions import timeofday as tod
from caldim.sources.store import single_file
from caldim.streaming.sessions import counted


def daypart_windows(stream: DataFrame, ts_col: str, window: str, watermark: str, value_col: str | None) -> DataFrame:
    part = tod.daypart(tod.second_of_day(F.col(ts_col)))
    ntz = dict(stream.dtypes)[ts_col] == "timestamp_ntz"
    if ntz:
        # watermarks need an instant: read the wall clock in the session zone
        # (UTC in caldim sessions) and turn the window bounds back afterwards
        stream = stream.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
        ts_col = "_event_time"
    back = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
    aggs = [F.count(F.lit(1)).alias("events")]
    if value_col:
        aggs.append(F.sum(F.col(value_col).cast("decimal(18,2)")).alias("value_sum"))
    return (
        stream.withWatermark(ts_col, watermark)
        .groupBy(F.window(ts_col, window).alias("w"), part.alias("daypart"))
        .agg(*aggs)
        .select(
            back(F.col("w.start")).alias("window_start"),
            back(F.col("w.end")).alias("window_end"),
            "daypart",
            *[a for a in ("events", "value_sum") if a == "events" or value_col],
        )
    )


def start_daypart_stream(
    spark: SparkSession,
    source_path: str,
    out_path: str,
    checkpoint_path: str,
    ts_col: str = "ts",
    value_col: str | None = "value",
    window: str = "30 minutes",
    watermark: str = "1 hour",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Start the stream over the parquet files at ``source_path``: a folder
    (or glob), or one file (then its folder is watched for files of that
    name). Without ``schema`` it is read from a file's footer."""
    reader = spark.readStream.schema(schema or spark.read.parquet(source_path).schema)
    file = single_file(spark, source_path)
    if file:
        folder, _, name = file.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
        source_path = folder
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # no window holds rows without a time: they are counted (``sessions.batch_counts``), as are late ones
    windows = daypart_windows(counted(reader.parquet(source_path), ts_col), ts_col, window, watermark, value_col)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # A batch updates at most (windows it touches x 6 dayparts) rows, so
        # one file per batch instead of one per state partition (200 by
        # default on a cluster) keeps the sink free of small files. The
        # changed rows are shuffled to it: coalesce(1) would pull the state
        # update of all partitions into that one task as well.
        batch.repartition(1).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = windows.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint_path)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


KEYS = ["window_start", "window_end", "daypart"]


def _out_schema(value_col: bool) -> T.StructType:
    fields = [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("daypart", T.StringType()),
        T.StructField("events", T.LongType()),
    ]
    if value_col:
        fields.append(T.StructField("value_sum", T.DecimalType(28, 2)))
    return T.StructType([*fields, T.StructField("batch_id", T.LongType())])


def _batches(spark: SparkSession, out_path: str, value_col: bool) -> DataFrame | None:
    """All batch output, read with its declared schema (so an emptied folder
    reads as no rows); None when the folder does not exist."""
    from caldim.sources.store import path_exists

    if path_exists(spark, out_path) is False:
        return None
    try:
        return spark.read.schema(_out_schema(value_col)).parquet(out_path)
    except AnalysisException as e:
        from caldim.sources.store import _missing

        if _missing(e):
            return None
        raise


def read_latest(
    spark: SparkSession, out_path: str, value_col: bool = True, snapshot=None, upto: int | None = None
) -> DataFrame:
    """Current result: for each (window, daypart) the row of the latest batch
    (a partial-then-final max_by aggregate, no sort). With a ``snapshot``
    (a ``VersionedTable`` filled by ``compact``), only batches after the
    snapshot are read, the rest come from the snapshot. ``upto`` ignores
    batches after that id."""
    cols = ["events"] + (["value_sum"] if value_col else [])
    snap = snapshot.read() if snapshot is not None else None
    through = snap.agg(F.max("through_batch")).first()[0] if snap is not None else None
    parts = []
    if snap is not None:
        parts.append(snap.withColumn("batch_id", F.col("through_batch").cast("long")).select(*KEYS, *cols, "batch_id"))
    batches = _batches(spark, out_path, value_col)
    if batches is not None:
        if through is not None:
            batches = batches.where(F.col("batch_id") > through)  # partition pruning
        if upto is not None:
            batches = batches.where(F.col("batch_id") <= upto)
        parts.append(batches.select(*KEYS, *cols, "batch_id"))
    if not parts:
        return spark.createDataFrame([], _out_schema(value_col)).select(*KEYS, *cols)
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    return df.groupBy(*KEYS).agg(*[F.max_by(c, "batch_id").alias(c) for c in cols])


def compact(spark: SparkSession, out_path: str, snapshot, value_col: bool = True) -> tuple[int, int] | None:
    """Fold every completed batch written so far into a new version of
    ``snapshot`` (a ``VersionedTable``), tagged with the last batch it
    covers; later reads skip those batch folders, which storage lifecycle
    rules may then remove. The newest batch counts as completed only once its
    ``_SUCCESS`` marker exists, so a compaction that overlaps the stream's
    write of that batch leaves it for the next compaction. Returns None when
    there is nothing new to fold."""
    from caldim.sources.store import path_exists

    batches = _batches(spark, out_path, value_col)
    last = batches.agg(F.max("batch_id")).first()[0] if batches is not None else None
    if last is not None and path_exists(spark, f"{out_path}/batch_id={last}/_SUCCESS") is False:
        last -= 1
    snap = snapshot.read()
    through = snap.agg(F.max("through_batch")).first()[0] if snap is not None else None
    if last is None or last < 0 or (through is not None and last <= through):
        return None
    current = read_latest(spark, out_path, value_col, snapshot, upto=last)
    return snapshot.write(current.withColumn("through_batch", F.lit(last).cast("long")))
