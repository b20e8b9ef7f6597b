"""Calendar, financial and as-of columns of the date dimension."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caldim import schemas
from caldim.functions.asof import AsOfNotFound, DuplicateCalendarDate, position_from_fin_calendar
from caldim.operators.dimension import generate_date_dim, roll_date_dim, stage_date
from caldim.sources.spine import EmptySpan, date_spine, day_count
from conftest import END, START
import pyref

AS_OFS = [dt.date(1996, 2, 29), dt.date(1997, 1, 1), dt.date(1998, 7, 15),
          dt.date(1999, 7, 4), dt.date(2000, 12, 31), dt.date(2001, 3, 1)]

# FIXTURES §3: counts of YES, roll variant; last value: generate variant of
# previous_yr_cal_wtd.
EXPECTED = {
    dt.date(1996, 2, 29): (4, 29, 11, 60, 60, 4, 4, 9, 59, 59, 358),
    dt.date(1997, 1, 1): (3, 1, 3, 1, 1, 3, 3, 1, 1, 1, 6),
    dt.date(1998, 7, 15): (3, 15, 17, 15, 196, 3, 3, 16, 15, 196, 787),
    dt.date(1999, 7, 4): (7, 4, 7, 4, 185, 7, 7, 6, 4, 185, 562),
    dt.date(2000, 12, 31): (7, 31, 7, 92, 366, 7, 7, 28, 92, 365, 736),
    dt.date(2001, 3, 1): (4, 1, 11, 60, 60, 4, 4, 10, 61, 61, 63),
}
FLAGS = schemas.ASOF_COLUMNS[4:]


@pytest.fixture(scope="module")
def gen_dim(spark, fin):
    return generate_date_dim(spark, START, END, fin, dt.date(1998, 7, 15), load_ts=dt.datetime(2020, 1, 1)).cache()


def test_spine_is_gapless_and_end_exclusive(spark):
    rows = date_spine(spark, START, END).agg(F.count("*"), F.countDistinct("calendar_date"),
                                             F.min("calendar_date"), F.max("calendar_date")).first()
    assert rows[0] == rows[1] == (END - START).days == 2922
    assert rows[2] == START and rows[3] == END - dt.timedelta(days=1)


def test_empty_span_raises():
    with pytest.raises(EmptySpan):
        day_count(dt.date(2000, 1, 2), dt.date(2000, 1, 1))


def test_dimension_shape(gen_dim):
    assert gen_dim.columns == schemas.DIM_DATE_COLUMNS
    assert len(gen_dim.columns) == 47
    assert gen_dim.count() == 2922


def test_calendar_columns_match_python(gen_dim):
    cols = list(pyref.calendar_row(START).keys())
    for r in gen_dim.select("calendar_date", *cols).collect():
        exp = pyref.calendar_row(r["calendar_date"])
        got = {c: r[c] for c in cols}
        assert got == exp, r["calendar_date"]


def test_financial_fixture_values(fin):
    r = {x["calendar_date"]: x for x in fin.where(F.col("calendar_date").isin(
        dt.date(1994, 1, 1), dt.date(1996, 6, 24))).collect()}
    a = r[dt.date(1994, 1, 1)]
    assert (a["financial_week"], a["financial_period"], a["financial_quarter"]) == ("1994-27", "1994-P-07", 3)
    b = r[dt.date(1996, 6, 24)]
    assert (b["financial_week"], b["financial_period"]) == ("1996-53", "1996-P-12")
    assert fin.where(F.col("financial_week").endswith("-53")).count() == 7


def test_fiscal_columns(gen_dim):
    for r in gen_dim.select("calendar_date", *schemas.FISCAL_COLUMNS).collect():
        fy, q, p, w = pyref.fin_position(r["calendar_date"])
        assert r["fin_year"] == str(fy) and r["fin_quarter_no"] == q
        assert r["fin_period"] == f"{fy}-P-{p:02d}" and r["fin_week_in_year"] == f"{fy}-{w:02d}"
        assert r["fin_quarter"] == f"{fy}-0{q}" and r["fin_yearhalf"] == (1 if q <= 2 else 2)
        assert r["fin_day_in_year"] == (w - 1) * 7 + r["calendar_date"].isoweekday()
        assert r["fin_year_name"] == f"FY{fy}"


@pytest.mark.parametrize("as_of", AS_OFS)
def test_flag_counts_roll(gen_dim, as_of):
    rolled = roll_date_dim(gen_dim, as_of)
    got = rolled.agg(*[F.count_if(F.col(c) == "YES").alias(c) for c in FLAGS]).first()
    assert tuple(got) == EXPECTED[as_of][:10]


@pytest.mark.parametrize("as_of", AS_OFS)
def test_prev_year_wtd_generate_variant(spark, fin, as_of):
    st = stage_date(spark, START, END, fin, as_of, variant="generate")
    assert st.where(F.col("previous_yr_cal_wtd") == "YES").count() == EXPECTED[as_of][10]


BOUNDARY = [
    dt.date(1995, 6, 26),  # first day of FY1996, a 53-week year
    dt.date(1996, 6, 30),  # last day of FY1996 (week 53)
    dt.date(1996, 7, 1),  # first day of FY1997, a 52-week year
    dt.date(1997, 6, 29),  # last day of FY1997
    dt.date(1999, 12, 27),  # a Monday; its financial period spans New Year
    dt.date(2000, 1, 2),  # a Sunday, second day of the year
]


@pytest.mark.parametrize("as_of,variant", [(dt.date(1998, 7, 15), "roll"), (dt.date(1997, 1, 1), "roll"),
                                           (dt.date(2000, 12, 31), "generate"), (dt.date(1996, 2, 29), "generate")]
                         + [(a, v) for a in BOUNDARY for v in ("roll", "generate")])
def test_asof_rules_match_python(spark, fin, gen_dim, as_of, variant):
    dim = roll_date_dim(gen_dim, as_of, variant=variant)
    cols = ["day_status", *schemas.ASOF_COLUMNS]
    for r in dim.select("calendar_date", *cols).collect():
        exp = pyref.asof_row(r["calendar_date"], as_of, variant)
        assert {c: r[c] for c in cols} == exp, r["calendar_date"]


def test_status_label_counts(gen_dim):
    dim = roll_date_dim(gen_dim, dt.date(1998, 7, 15))
    c = lambda col: {r[0]: r[1] for r in dim.groupBy(col).count().collect()}
    assert c("fin_year_status") == {"Current Year": 364, "Previous Year": 364, "2 Year Back": 364, None: 2922 - 3 * 364}
    q = c("fin_quarter_status")
    assert q["Current Quarter"] == 91 and q["Current Quarter Last Year"] == 91 and "Previous Quarter" not in q
    p = c("fin_period_status")
    assert p["Current Period"] == 28 and p["Current Period Last Year"] == 28
    w = c("fin_week_status")
    assert len(w) == 9 and all(v == 7 for k, v in w.items() if k is not None)
    w1 = c_week = {r[0]: r[1] for r in roll_date_dim(gen_dim, dt.date(1999, 7, 4)).groupBy("fin_week_status").count().collect()}
    assert c_week == w1 and set(w1) == {"Current Week", "Current Week Last Year", "Current Week 2 Year Back", None}


@pytest.mark.parametrize("as_of,n", [(dt.date(1997, 12, 31), 0), (dt.date(1998, 12, 31), 2)])
def test_previous_day_last_year_quirk(gen_dim, as_of, n):
    dim = roll_date_dim(gen_dim, as_of)
    assert dim.where(F.col("day_status") == "Previous Day Last Year").count() == n


def test_one_today_and_subsets(gen_dim):
    for a in AS_OFS:
        dim = roll_date_dim(gen_dim, a)
        assert dim.where(F.col("day_status") == "Today").count() == 1
        bad = dim.where((F.col("current_cal_mtd") == "YES") & (F.col("current_cal_qtd") != "YES")).count()
        bad += dim.where((F.col("current_cal_qtd") == "YES") & (F.col("current_cal_ytd") != "YES")).count()
        assert bad == 0


def test_week_has_seven_days(gen_dim):
    assert gen_dim.groupBy("week_commencing_date").count().where("count != 7").count() == 2  # partial first/last week


def test_missing_as_of_raises(spark, fin):
    with pytest.raises(AsOfNotFound):
        position_from_fin_calendar(fin, dt.date(2030, 1, 1))


def test_duplicate_financial_dates_raise(spark, fin):
    dup = fin.unionByName(fin.where(F.col("calendar_date") == dt.date(1995, 3, 3)))
    with pytest.raises(DuplicateCalendarDate):
        stage_date(spark, START, END, dup, dt.date(1998, 7, 15))


def test_date_without_financial_row(spark, fin):
    part = fin.where(F.col("calendar_date") >= dt.date(1995, 1, 1))
    st = stage_date(spark, START, END, part, dt.date(1998, 7, 15))
    r = st.where(F.col("calendar_date") == dt.date(1994, 6, 1)).first()
    assert r["fin_year"] is None and r["fin_year_status"] is None and r["current_cal_ptd"] == "NO"
    assert r["fin_yearhalf"] == 2


def test_text_dates_are_accepted_and_checked(spark, fin):
    ts = dt.datetime(2020, 1, 1)
    a = stage_date(spark, "1998-01-01", "1998-02-01", fin, "1998-07-15", load_ts=ts)
    b = stage_date(spark, dt.date(1998, 1, 1), dt.date(1998, 2, 1), fin, dt.date(1998, 7, 15), load_ts=ts)
    assert a.count() == 31 and a.exceptAll(b).count() == 0
    with pytest.raises(ValueError):
        stage_date(spark, "1998-13-01", "1998-02-01", fin, "1998-07-15")
