"""Dayparts from a table: bands of the day that may overlap, leave gaps, cross
midnight and differ from group to group.

Bands and facts meet by equal hours of the day, then by the exact bound, so no
row is compared with all bands, and facts are first reduced to one row for each
group and minute of the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caldim.functions import timeofday as tod
from caldim.sources.spine import BROADCAST_MAX_ROWS

MINUTES = 24 * 60
#: Minutes of the cells that bands and facts meet by.
CELL = 60

BANDS = "band_group string, band string, from_minute int, to_minute int"


def band_pieces(bands: DataFrame) -> DataFrame:
    """(band_group, band, cell, a, e): the bands by hours of the day; a <= minute < e.

    A band runs from ``from_minute`` to ``to_minute``, not included (0 to 1440);
    one whose end is not after its beginning crosses midnight, so equal ends mean
    the whole day. Bands with a null bound cover nothing."""
    a, e = F.col("from_minute"), F.col("to_minute")
    whole = F.array(F.struct(a.alias("a"), e.alias("e")))
    split = F.array(F.struct(a.alias("a"), F.lit(MINUTES).alias("e")), F.struct(F.lit(0).alias("a"), e.alias("e")))
    parts = bands.where("from_minute is not null and to_minute is not null").select(
        "band_group", "band", F.explode(F.when(a < e, whole).otherwise(split)).alias("p")
    )
    cells = F.sequence(F.expr(f"p.a div {CELL}"), F.expr(f"(p.e - 1) div {CELL}"))
    return parts.where("p.a < p.e").select("band_group", "band", "p.a", "p.e", F.explode(cells).alias("cell"))


def band_totals(fact: DataFrame, ts_col: str, group_col: str, bands: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(group, band, rows, measures): totals of the fact rows in each band of
    their group. Bands with a null ``band_group`` hold for every group. A row in
    several bands counts in each; rows in none, or without a time, have a null
    band. Bands without rows are absent."""
    minute = F.expr("second_ div 60")
    facts = (
        fact.withColumn("second_", tod.second_of_day(F.col(ts_col)))
        .groupBy(F.col(group_col).alias("g"), minute.cast("int").alias("minute"))
        .agg(F.count(F.lit(1)).alias("rows"), *(F.sum(m).alias(n) for n, m in measures.items()))
        .withColumn("hour", F.expr(f"minute div {CELL}").cast("int"))
    )
    pieces = band_pieces(bands)
    few = pieces.count() <= BROADCAST_MAX_ROWS
    within = (F.col("hour") == F.col("cell")) & (F.col("minute") >= F.col("a")) & (F.col("minute") < F.col("e"))
    side = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    own = facts.join(side(pieces.where("band_group is not null")), within & (F.col("g") == F.col("band_group")))
    general = facts.join(side(pieces.where("band_group is null")), within)
    columns = ["g", "minute", "band", "rows", *measures]
    # a band may cover a minute twice (its pieces, or rows of the table that repeat it)
    met = own.select(*columns).unionByName(general.select(*columns)).dropDuplicates(["g", "minute", "band"])
    keys = met.select(F.col("g").alias("mg"), F.col("minute").alias("mm")).distinct()
    same = F.col("g").eqNullSafe(F.col("mg")) & F.col("minute").eqNullSafe(F.col("mm"))
    rest = facts.join(keys, same, "left_anti").withColumn("band", F.lit(None).cast("string")).select(*columns)
    out = met.unionByName(rest).groupBy("g", "band").agg(F.sum("rows").alias("rows"), *(F.sum(n).alias(n) for n in measures))
    return out.withColumnRenamed("g", group_col)


def daypart_bands(spark) -> DataFrame:
    """The fixed dayparts as bands for every group."""
    rows = [(None, name, lo * 60, (hi + 1) * 60) for name, lo, hi in tod.DAYPARTS]
    covered = {h for _, lo, hi in tod.DAYPARTS for h in range(lo, hi + 1)}
    rows += [(None, tod.OTHER_DAYPART, h * 60, (h + 1) * 60) for h in range(24) if h not in covered]
    return spark.createDataFrame(rows, BANDS)
