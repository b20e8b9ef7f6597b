"""Rows in one global order, for operators that go through sequences.

A sequence (a conversation) may hold any share of all rows, so none is gathered
in a task: rows are sorted over range partitions, and a sequence is handled as
its segments, the runs of its rows within a partition. Only sequences that cross
partitions have more than one segment; as at most two do so at each border,
there are at most two such segments for each partition.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from caldim.llm.common import stored

#: Tabs, spaces and line ends that separate words. Fixed value.
WHITE = " \t\n\x0b\x0c\r"


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` sorted by ``keys`` (nulls first) and stored, with the partition
    (part) and a number that grows in this order (rid)."""
    tied = rows.withColumn("rid", F.monotonically_increasing_id())
    spread = tied.repartitionByRange(partitions(rows), *keys, "rid").sortWithinPartitions(*keys, "rid")
    return stored(spread.withColumns({"part": F.spark_partition_id(), "rid": F.monotonically_increasing_id()}), name)


def by_part(rows: DataFrame, *then: str) -> DataFrame:
    """Rows of a partition of ``ordered`` together, in order."""
    return rows.repartition("part").sortWithinPartitions("part", *then)


def crossing(segments: DataFrame) -> DataFrame:
    """The segments (conv_id, part) of sequences that have several: at most two
    for each partition, so they may be broadcast and collected."""
    several = segments.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1")
    several = several.select(F.col("conv_id").alias("several"))
    return segments.join(F.broadcast(several), F.col("conv_id").eqNullSafe(F.col("several")), "left_semi")


def types_of(df: DataFrame, column: str) -> tuple[str, pa.DataType]:
    """A column's type for Spark and for Arrow."""
    kind = df.schema[column].dataType
    return kind.simpleString(), to_arrow_type(kind)


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def sql_crc32(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of an ASCII text, bit by bit (3988292384
    is its polynomial, reversed)."""
    shift = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"
