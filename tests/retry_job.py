"""Run by test_retry.py in its own process: a session that retries failed
tasks (local[4,3]); each input fails once in its first task attempt."""

import datetime as dt
import json
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from caldim.operators import facts  # noqa: E402
from caldim.operators.dimension import generate_date_dim, roll_date_dim  # noqa: E402
from caldim.session import apply_conf  # noqa: E402
from caldim.sources.fincal import formula_financial_calendar  # noqa: E402
from caldim.sources.logs import LogTables  # noqa: E402
from caldim.sources.spine import date_spine  # noqa: E402
from caldim.sources.store import VersionedTable  # noqa: E402

spark = (
    SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
apply_conf(spark)
spark.sparkContext.setLogLevel("OFF")
root = tempfile.mkdtemp(prefix="caldim-retry-")


def flaky(df):
    """Identity, except that the first attempt of the first task dies."""
    schema = df.schema

    def go(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task loss")
        yield from batches

    return df.repartition(4).mapInPandas(go, schema)


orders = spark.read.parquet(f"{sys.argv[2]}/orders.parquet")
out = {"orders": orders.count()}

t = VersionedTable(spark, f"{root}/t")
out["write"] = t.write(flaky(orders))
out["read"] = t.read().count()
out["distinct"] = t.read().select("o_orderkey").distinct().count()

logs = LogTables(spark, root)
n, _, _ = facts.incremental_load(spark, logs, flaky(orders), "o_orderdate", f"{root}/inc", "orders")
out["incremental"] = n
out["incremental_read"] = spark.read.parquet(f"{root}/inc").count()

start, end = dt.date(1994, 1, 1), dt.date(2002, 1, 1)
fin = formula_financial_calendar(date_spine(spark, start, end))
dim = roll_date_dim(generate_date_dim(spark, start, end, fin, dt.date(1998, 7, 14)), dt.date(1998, 7, 15))
r = facts.period_to_date(flaky(orders), "o_orderdate", {}, dim).first()
out["ytd"] = r["ytd_rows"]
print("RESULT " + json.dumps(out))
spark.stop()
