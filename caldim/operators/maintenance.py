"""A daily rollup kept up to date from changes, without reading the fact again.

Changes are rows with an operation: ``I`` inserts a row, ``D`` takes one back
(with the values it had); a correction is both. Each batch becomes signed daily
totals, stored in a folder of its own (``batch=<n>``, replaced if the batch is run
again), and the rollup is the sum of all batches: late rows and deletions reach
closed days like any others, and are counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim.functions import calendar as cal

INSERT, DELETE = "I", "D"


def signed_totals(changes: DataFrame, op: str, date_col: str, by: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """(day, by..., inserted, deleted, measures): totals of a batch of changes,
    deletions negative. Rows without a date have a null day; an operation other
    than ``I`` and ``D`` raises."""
    sign = F.when(F.col(op) == INSERT, 1).when(F.col(op) == DELETE, -1)
    sign = F.when(sign.isNotNull(), sign).otherwise(F.raise_error(F.concat(F.lit("unknown operation: "), F.coalesce(op, F.lit("null")))))
    return changes.groupBy(cal.as_date(date_col).alias("day"), *by).agg(
        F.count_if(sign > 0).alias("inserted"), F.count_if(sign < 0).alias("deleted"), *(F.sum(m * sign).alias(n) for n, m in measures.items())
    )


class MaintainedRollup:
    """Signed daily totals of all batches below ``path``."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], measures: dict[str, Column]):
        self.spark, self.path, self.by, self.measures = spark, path.rstrip("/"), list(by), dict(measures)

    def apply(self, batch: int, changes: DataFrame, op: str, date_col: str, mark: dt.date | None = None) -> None:
        """Store the totals of a batch. ``mark`` is the day up to which the
        batches before were complete; inserted rows of days before it are late."""
        totals = signed_totals(changes, op, date_col, self.by, self.measures)
        late = F.when(F.col("day") < F.lit(mark), F.col("inserted")).otherwise(0).cast("long")
        totals = totals.withColumn("late", F.coalesce(late, F.lit(0)))
        totals.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def batches(self) -> DataFrame:
        """All stored totals, with their batch."""
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")

    def read(self) -> DataFrame:
        """(day, by..., rows, measures) of all changes so far; groups whose rows
        are all taken back are gone."""
        sums = self.batches().groupBy("day", *self.by).agg(
            (F.sum("inserted") - F.sum("deleted")).alias("rows"), *(F.sum(n).alias(n) for n in self.measures)
        )
        return sums.where("rows <> 0")

    def counts(self) -> DataFrame:
        """(batch, inserted, deleted, late, without_day, days): what each batch held."""
        return self.batches().groupBy("batch").agg(
            *(F.sum(c).alias(c) for c in ("inserted", "deleted", "late")),
            F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("inserted") + F.col("deleted"))), F.lit(0)).alias("without_day"),
            F.count_distinct("day").alias("days"),
        )

    def fold(self, path: str) -> MaintainedRollup:
        """The same rollup with all batches so far as one, below another path."""
        out = MaintainedRollup(self.spark, path, self.by, self.measures)
        last = self.batches().agg(F.max("batch")).first()[0]
        sums = ("inserted", "deleted", *self.measures, "late")
        one = self.batches().groupBy("day", *self.by).agg(*(F.sum(c).alias(c) for c in sums))
        one.write.mode("overwrite").parquet(f"{out.path}/batch={last}")
        return out
