"""Versioned parquet tables: the replacement for TRUNCATE, UPDATE and MERGE.

Layout under a table folder:

    <path>/v=<n>/     version n, written once
    <path>/current   the number of the current version

A writer computes version n+1 from version n, writes it to its folder and only
then replaces the pointer, by renaming a new one over it. A reader resolves the
pointer first, so it never sees a half-written version, and a failed or
interrupted write leaves version n current: its folder is written anew by the
retry. There is one writer, as the procedures that write are scheduled one after
another. Older versions stay until storage rules remove them.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _missing(e: AnalysisException) -> bool:
    cond = e.getCondition() or ""
    return cond.startswith("PATH_NOT_FOUND") or "Path does not exist" in str(e)


def path_exists(spark: SparkSession, path: str) -> bool | None:
    """Whether ``path`` exists, asked of the Hadoop file system behind the
    session (no Spark job, no failed query in the logs); None where that is
    not reachable (e.g. a Spark Connect client), and callers then try the
    read and catch PATH_NOT_FOUND."""
    try:
        fs, jpath = _file_system(spark, path)
        return bool(fs.exists(jpath))
    except Exception:  # noqa: BLE001
        return None


def single_file(spark: SparkSession, path: str) -> str | None:
    """The full path if ``path`` names one file; None for a folder or a glob."""
    if any(ch in path for ch in "*?["):
        return None
    fs, jpath = _file_system(spark, path)
    return fs.makeQualified(jpath).toString() if fs.exists(jpath) and fs.getFileStatus(jpath).isFile() else None


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    fs, jpath = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory()] if fs.exists(jpath) else []


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(sc._jsc.hadoopConfiguration()), jpath


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """The file at ``path`` with new content, in one step: readers see the old
    file or the new one."""
    sc = spark.sparkContext
    fs, new = _file_system(spark, f"{path}.new")
    fs.mkdirs(new.getParent())
    out = fs.create(new, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    hadoop = sc._jvm.org.apache.hadoop.fs
    how = sc._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(fs.makeQualified(new).toUri(), sc._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(new), fs.makeQualified(hadoop.Path(path)), how)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def current_version(self) -> int | None:
        pointer = f"{self.path}/current"
        if path_exists(self.spark, pointer) is False:
            return None
        return int(self.spark.read.text(pointer).first()[0])

    def version_path(self, version: int) -> str:
        current = self.current_version()
        if current is None or not 1 <= version <= current:
            raise FileNotFoundError(f"{self.path} has no version {version}")
        return f"{self.path}/v={version}"

    def read(self, version: int | None = None) -> DataFrame | None:
        """The given version (FileNotFoundError if there is none) or the current
        one (None if nothing is written yet)."""
        if version is None:
            version = self.current_version()
            if version is None:
                return None
        return self.spark.read.parquet(self.version_path(version))

    def write(self, df: DataFrame, row_count_name: str = "number of rows inserted") -> tuple[int, int]:
        """Write ``df`` as the next version; returns (version, rows). The row
        count is observed during the write itself, not by a second job."""
        n = (self.current_version() or 0) + 1
        obs = Observation()
        df.observe(obs, F.count(F.lit(1)).alias(row_count_name)).write.mode("overwrite").parquet(f"{self.path}/v={n}")
        rows = obs.get[row_count_name]
        _replace(self.spark, f"{self.path}/current", f"{n}\n")
        return n, rows
