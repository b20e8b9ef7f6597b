"""Date dimension: build the stage, merge it into the target, roll it.

All three are DataFrame -> DataFrame functions over one lazy plan: the five
stage tables of the original collapse into projections of one ``Range`` scan,
joined once (broadcast) to the financial calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caldim import schemas
from caldim.functions import asof as asof_rules
from caldim.functions import calendar as cal
from caldim.functions import fiscal as fis
from caldim.functions.asof import DuplicateCalendarDate, Position
from caldim.sources.spine import broadcast_if_bounded, date_spine, span_is_broadcastable, to_date


def ts_literal(ts: dt.datetime | None) -> Column:
    """A timestamp_ntz literal, built from text so no time zone applies."""
    ts = ts or dt.datetime.now(dt.timezone.utc)
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


class Counts:
    """Row counts of the logical statements inside one plan, observed while
    the plan's single write runs."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        return self.observe(df, name, rows=F.count(F.lit(1)))

    def observe(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        self._seen[name] = Observation()
        return df.observe(self._seen[name], *[v.alias(k) for k, v in metrics.items()])

    def __getitem__(self, name: str) -> dict[str, int]:
        return self._seen[name].get


def assert_unique_dates(fin_cal: DataFrame) -> None:
    """Raise if a calendar date occurs twice: it would fan out the join and
    reach the merge with two source rows for one key."""
    dates = fin_cal.where(F.col("calendar_date").isNotNull())  # NULL dates join nothing
    dup = dates.groupBy("calendar_date").count().where(F.col("count") > 1).limit(1).take(1)
    if dup:
        raise DuplicateCalendarDate(f"calendar date {dup[0]['calendar_date']} occurs {dup[0]['count']} times")


def check_and_positions(fin_cal: DataFrame, as_ofs: list[dt.date]) -> dict[dt.date, Position]:
    """One job over the financial calendar, however many as-of dates: raise on
    duplicate dates (they would fan out the join and reach the merge twice) and
    read each as-of position (raise if an as-of date is missing)."""
    pos = F.struct(
        fis.year_no(F.col("financial_year")).alias("y"),
        F.col("financial_quarter").cast("int").alias("q"),
        fis.period_no(F.col("financial_period")).alias("p"),
        fis.week_no(F.col("financial_week")).alias("w"),
    )
    found = []
    for k, as_of in enumerate(as_ofs):
        hit = F.col("calendar_date") == F.lit(as_of)
        found += [F.count_if(hit).alias(f"hits{k}"), F.max(F.when(hit, pos)).alias(f"pos{k}")]
    r = fin_cal.agg((F.count("calendar_date") - F.count_distinct("calendar_date")).alias("dups"), *found).first()
    if r["dups"]:
        raise DuplicateCalendarDate(f"{r['dups']} duplicate calendar date(s) in the financial calendar")
    out = {}
    for k, as_of in enumerate(as_ofs):
        if not r[f"hits{k}"]:
            raise asof_rules.AsOfNotFound(f"as-of date {as_of} has no row in the financial calendar")
        p = r[f"pos{k}"]
        out[as_of] = Position(as_of, p["y"], p["q"], p["p"], p["w"])
    return out


def check_and_position(fin_cal: DataFrame, as_of: dt.date) -> Position:
    """``check_and_positions`` of one as-of date."""
    return check_and_positions(fin_cal, [as_of])[as_of]


def _asof_inputs() -> dict[str, Column]:
    return {
        c: F.col(c)
        for c in (
            "calendar_date",
            "month",
            "cal_quarter",
            "cal_year",
            "fin_year",
            "fin_quarter_no",
            "fin_period",
            "fin_week_in_year",
        )
    }


def stage_date(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    fin_cal: DataFrame,
    as_of: dt.date,
    variant: str = "generate",
    load_ts: dt.datetime | None = None,
    position: Position | None = None,
    check_unique: bool = True,
    counts: Counts | None = None,
) -> DataFrame:
    """The 46 stage columns for every day from ``start`` to ``end`` (excluded).

    The financial position of ``as_of`` is read from the whole financial
    calendar (one row) unless given. Dates may be given as 'YYYY-MM-DD'.
    ``counts`` observes the rows of the spine, the calendar, the financial
    calendar within the span, and the two joined.
    """
    seen = counts.rows if counts else lambda df, name: df
    start, end, as_of = to_date(start), to_date(end), to_date(as_of)
    fin = fin_cal.select(*fis.FIN_COLUMNS)
    if position is not None:
        pos = position
        if check_unique:
            assert_unique_dates(fin)
    else:
        pos = check_and_position(fin, as_of) if check_unique else asof_rules.position_from_fin_calendar(fin, as_of)
    # Unique dates inside the span: at most one row per spine day, a proven
    # bound, so the calendar is broadcast and the spine never shuffles.
    fin_in_span = fin.where((F.col("calendar_date") >= F.lit(start)) & (F.col("calendar_date") < F.lit(end)))
    d = F.col("calendar_date")
    calendar = seen(seen(date_spine(spark, start, end), "date spine").withColumns(cal.calendar_columns(d)), "calendar")
    fin_in_span = seen(fin_in_span, "financial calendar")
    base = (
        seen(
            calendar.join(
                broadcast_if_bounded(fin_in_span, span_is_broadcastable(start, end)), "calendar_date", "left"
            ),
            "joined",
        )
        .withColumns(fis.fiscal_columns(d, {c: F.col(c) for c in fis.FIN_COLUMNS[1:]}))
        .withColumn("day_status", asof_rules.day_status(d, as_of, variant))
    )
    rolled = asof_rules.asof_columns(_asof_inputs(), pos, variant)
    return base.select(
        *[F.col(c) for c in schemas.STAGE_COLUMNS if c not in rolled and c != "last_update_date"],
        *[rolled[c].alias(c) for c in schemas.ASOF_COLUMNS],
        ts_literal(load_ts).alias("last_update_date"),
    ).select(*schemas.STAGE_COLUMNS)


def calendar_dim(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """date_key, calendar_date and the calendar columns that depend on the
    date alone, one row per day from ``start`` to ``end`` (excluded)."""
    d = F.col("calendar_date")
    cols = cal.calendar_columns(d)
    return date_spine(spark, start, end).select(
        cal.date_key(d).alias("date_key"), d, *[v.alias(k) for k, v in cols.items()]
    )


def insert_rows(stage: DataFrame, load_ts: dt.datetime | None = None) -> DataFrame:
    """Stage rows as inserted into an empty target: DATE_KEY assigned,
    LAST_UPDATE_DATE = load time."""
    return stage.select(
        cal.date_key(F.col("calendar_date")).alias("date_key"),
        *[c for c in schemas.STAGE_COLUMNS if c != "last_update_date"],
        ts_literal(load_ts).alias("last_update_date"),
    )


def merge_dim(
    target: DataFrame | None, stage: DataFrame, load_ts: dt.datetime | None = None, counts: Counts | None = None
) -> DataFrame:
    """Upsert ``stage`` into ``target`` on calendar_date.

    matched      -> each column coalesce(stage, target) (a NULL never clears),
                    DATE_KEY kept, LAST_UPDATE_DATE from the stage
    stage only   -> inserted with DATE_KEY and LAST_UPDATE_DATE = load time
    target only  -> kept unchanged

    Presence markers on both sides tell "no row" from "row with NULLs". The
    full outer join shuffles both sides on the date key; a dimension has one
    row per day, so this stays small at any fact volume. ``counts`` observes
    the inserted and the updated rows.
    """
    if target is None:
        out = insert_rows(stage, load_ts)
        return counts.observe(out, "merge", inserted=F.count(F.lit(1)), updated=F.count_if(F.lit(False))) if counts else out
    t = target.select(*[F.col(c).alias("t_" + c) for c in schemas.DIM_DATE_COLUMNS], F.lit(True).alias("_t"))
    s = stage.select(*[F.col(c).alias("s_" + c) for c in schemas.STAGE_COLUMNS], F.lit(True).alias("_s"))
    j = t.join(s, F.col("t_calendar_date") == F.col("s_calendar_date"), "full_outer")
    ts = ts_literal(load_ts)
    in_t, in_s = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    if counts:
        j = counts.observe(j, "merge", inserted=F.count_if(~in_t), updated=F.count_if(in_t & in_s))
    return j.select(
        F.when(in_t, F.col("t_date_key")).otherwise(cal.date_key(F.col("s_calendar_date"))).alias("date_key"),
        F.when(in_t, F.col("t_calendar_date")).otherwise(F.col("s_calendar_date")).alias("calendar_date"),
        *[F.coalesce(F.col("s_" + c), F.col("t_" + c)).alias(c) for c in schemas.MERGE_UPDATE_COLUMNS],
        F.when(~in_s, F.col("t_last_update_date"))
        .when(~in_t, ts)
        .otherwise(F.coalesce(F.col("s_last_update_date"), ts))
        .alias("last_update_date"),
    )


def generate_date_dim(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    fin_cal: DataFrame,
    as_of: dt.date,
    target: DataFrame | None = None,
    initial_load: bool = False,
    load_ts: dt.datetime | None = None,
    variant: str = "generate",
    counts: Counts | None = None,
    position: Position | None = None,
) -> DataFrame:
    """Stage the span and merge it into ``target`` (emptied first when
    ``initial_load``); returns the new dimension, 47 columns. ``counts``
    observes the rows of each logical statement. A ``position`` comes from
    ``check_and_positions`` of the same calendar, which is then not read again
    for it."""
    stage = stage_date(
        spark, start, end, fin_cal, as_of, variant=variant, load_ts=load_ts, counts=counts, position=position, check_unique=position is None
    )
    if counts:
        stage = counts.rows(stage, "stage")
    return merge_dim(None if initial_load else target, stage, load_ts, counts)


def roll_date_dim(
    dim: DataFrame,
    as_of: dt.date,
    load_ts: dt.datetime | None = None,
    variant: str = "roll",
    position: Position | None = None,
) -> DataFrame:
    """Rewrite the as-of columns of every row for a new as-of date (the
    daily roll). The position is read from the dimension itself."""
    as_of = to_date(as_of)
    pos = position or asof_rules.position_from_dim(dim, as_of)
    new = {
        "day_status": asof_rules.day_status(F.col("calendar_date"), as_of, variant),
        **asof_rules.asof_columns(_asof_inputs(), pos, variant),
        "last_update_date": ts_literal(load_ts),
    }
    return dim.withColumns(new).select(*schemas.DIM_DATE_COLUMNS)


def default_roll_as_of(zone: str = "Pacific/Auckland") -> dt.date:
    """The roll's default as-of: yesterday in the business time zone."""
    from zoneinfo import ZoneInfo

    return dt.datetime.now(ZoneInfo(zone)).date() - dt.timedelta(days=1)
