"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.session import work_dir

#: Rows of an Arrow batch handed to Python: with texts of some KB a batch
#: stays at a few MB, and no batch depends on how large a partition is.
ARROW_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Session settings of the Python-backed operators; sends this package to
    the executors' Python workers, once a context."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if not any(name.startswith("caldim-") for name in sc._python_includes or ()):
        top = Path(__file__).resolve().parents[1]
        path = os.path.join(tempfile.mkdtemp(prefix="caldim-"), f"caldim-{os.getpid()}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        sc.addPyFile(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Frees a query's shuffle files with its end, as nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block; what held before holds again."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet below the shared work folder and read back:
    cuts lineage, and survives the loss of executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    with settings(spark, {CLEANUP: "true"}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, like the given ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(col: str = "text") -> Column:
    """A text column as string, null as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """A-Z lowered, every other character kept."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without copying them, and the offsets of its
    rows (one more than rows). Nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) else b"")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off
