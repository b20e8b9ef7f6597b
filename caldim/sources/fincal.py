"""The financial calendar (one row per day), supplied by the business.

``read_financial_calendar`` reads it with an explicit schema.
``formula_financial_calendar`` derives one from a date spine with a public
4-4-5 rule; tests and the registered queries use it because the driver's
tables do not include a financial calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caldim import schemas


def read_financial_calendar(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read the financial calendar into its declared schema, matching
    columns by name (case-insensitive), never by position: parquet and ORC
    with the schema applied at the scan; text formats (csv with a header,
    json) read as text and cast column by column (ANSI casts: bad values
    raise instead of turning NULL)."""
    if fmt in ("csv", "json"):
        # without inferSchema every csv column is text; json keeps primitives as text
        opts = {"header": "true", **options} if fmt == "csv" else {"primitivesAsString": "true", **options}
        raw = spark.read.format(fmt).options(**opts).load(path)
        return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FIN_CALENDAR])
    return spark.read.format(fmt).schema(schemas.FIN_CALENDAR).options(**options).load(path)


def _monday_of_week_holding_july_1(year: Column) -> Column:
    j1 = F.make_date(year, F.lit(7), F.lit(1))
    return F.date_sub(j1, F.weekday(j1))


def formula_financial_calendar(spine: DataFrame, date_col: str = "calendar_date") -> DataFrame:
    """A 52/53-week financial calendar over the dates of ``spine``.

    Financial year N starts on the Monday of the week holding 1 July of N-1;
    weeks count from 1; each quarter has 13 weeks (week 53 stays in quarter
    4); periods follow 4-4-5 within a quarter. Text columns follow the input
    contract: 'YYYY-WW' weeks and 'YYYY-P-PP' periods.
    """
    d = F.col(date_col)
    y = F.year(d)
    fy = F.when(d >= _monday_of_week_holding_july_1(y), y + 1).otherwise(y)
    year_start = _monday_of_week_holding_july_1(fy - 1)
    w = (F.floor(F.datediff(d, year_start) / 7) + 1).cast("int")
    q = F.least(F.lit(4), (F.floor((w - 1) / 13) + 1).cast("int"))
    wq = w - (q - 1) * 13
    p = ((q - 1) * 3 + F.when(wq <= 4, 1).when(wq <= 8, 2).otherwise(3)).cast("int")
    return spine.select(
        d.alias("calendar_date"),
        F.date_sub(d, F.weekday(d)).alias("week_commencing"),
        F.format_string("%d-%02d", fy, w).alias("financial_week"),
        F.format_string("%d-P-%02d", fy, p).alias("financial_period"),
        q.alias("financial_quarter"),
        fy.cast("string").alias("financial_year"),
        F.concat(F.lit("FY"), fy.cast("string")).alias("financial_year_format"),
    )
