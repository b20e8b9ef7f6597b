"""Audit, error and process-date tables: append-only parquet datasets.

The surrogate keys (AUDIT_KEY, ERROR_KEY) are assigned by the single writer.
Each append of rows with keys is a folder named by its first key, so the next
key follows from the newest folder alone, however long the log is. A procedure
hands over all its audit rows at once: one read of that folder, one append.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim import schemas
from caldim.sources.store import _missing, folders, path_exists

#: Folders of appended rows are named by their first key.
FOLDER = "from="


def utc_now() -> dt.datetime:
    """The wall clock in UTC, as every other time of the library."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class LogTables:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.audit_path = f"{self.base}/audit_table"
        self.error_path = f"{self.base}/error_table"
        self.process_date_path = f"{self.base}/dw_process_date"

    def _read(self, path: str, schema) -> DataFrame:
        if path_exists(self.spark, path) is False:
            return self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
        except AnalysisException as e:
            if _missing(e):
                return self.spark.createDataFrame([], schema)
            raise

    def audit(self) -> DataFrame:
        return self._read(self.audit_path, schemas.AUDIT)

    def errors(self) -> DataFrame:
        return self._read(self.error_path, schemas.ERROR)

    def process_dates(self) -> DataFrame:
        return self._read(self.process_date_path, schemas.PROCESS_DATE)

    def _next_key(self, path: str, schema, key: str) -> int:
        """One more than the highest key of the newest folder (folders without
        rows, of appends that failed, are passed over)."""
        for folder in sorted((f for f in folders(self.spark, path) if f.startswith(FOLDER)), reverse=True):
            last = self.spark.read.schema(schema).parquet(f"{path}/{folder}").agg(F.max(key)).first()[0]
            if last is not None:
                return last + 1
        return 1

    def _append(self, path: str, schema, *rows: tuple, key: int | None = None) -> None:
        w = self.spark.createDataFrame(rows, schema).coalesce(1).write
        if key is None:
            w.mode("append").parquet(path)
        else:
            w.mode("overwrite").parquet(f"{path}/{FOLDER}{key:020d}")

    def log_audit(
        self,
        procedure: str,
        step: str,
        result: str,
        schema_name: str | None = None,
        table_name: str | None = None,
        ts: dt.datetime | None = None,
    ) -> int:
        return self.log_audits(procedure, [(step, result)], schema_name, table_name, ts)

    def log_audits(
        self,
        procedure: str,
        steps: list[tuple[str, str]],
        schema_name: str | None = None,
        table_name: str | None = None,
        ts: dt.datetime | None = None,
    ) -> int:
        """Audit rows of (step, result) pairs, in order; the first one's key."""
        key, ts = self._next_key(self.audit_path, schemas.AUDIT, "audit_key"), ts or utc_now()
        rows = [(key + k, procedure, step, result, schema_name, table_name, ts) for k, (step, result) in enumerate(steps)]
        self._append(self.audit_path, schemas.AUDIT, *rows, key=key)
        return key

    def log_error(
        self,
        procedure: str,
        step: str | None,
        code: str | None,
        message: str | None,
        state: str | None,
        stack: str | None,
        ts: dt.datetime | None = None,
    ) -> int:
        key = self._next_key(self.error_path, schemas.ERROR, "error_key")
        self._append(
            self.error_path, schemas.ERROR, (key, procedure, step, code, message, state, stack, ts or utc_now()), key=key
        )
        return key

    def log_process_date(
        self,
        table_name: str,
        schema_name: str | None,
        last_process_date: dt.datetime | None,
        rowcount: int,
        country: str | None = None,
        ts: dt.datetime | None = None,
    ) -> None:
        self._append(
            self.process_date_path,
            schemas.PROCESS_DATE,
            (table_name, schema_name, last_process_date, rowcount, ts or utc_now(), country),
        )

    def last_process_date(self, table_name: str, schema_name: str | None = None, country: str | None = None):
        """High-water mark of a table: the latest last_process_date logged for
        exactly this schema and country, where none is a value of its own."""
        return self._loads(table_name, schema_name, country).agg(F.max("last_process_date")).first()[0]

    def rows_processed(self, table_name: str, schema_name: str | None = None, country: str | None = None) -> int:
        """Rows of all loads logged for exactly this table, schema and country."""
        return self._loads(table_name, schema_name, country).agg(F.sum("last_process_rowcount")).first()[0] or 0

    def _loads(self, table_name: str, schema_name: str | None, country: str | None) -> DataFrame:
        return self.process_dates().where(
            (F.col("table_name") == table_name)
            & F.col("schema_name").eqNullSafe(F.lit(schema_name))
            & F.col("country").eqNullSafe(F.lit(country))
        )
