"""Property tests: random as-of dates, any interval width, CSV input."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caldim import schemas
from caldim.functions import timeofday as tod
from caldim.operators.dimension import generate_date_dim, roll_date_dim
from caldim.sources.fincal import read_financial_calendar
from caldim.sources.spine import second_spine
from conftest import END, START
import pyref


@pytest.fixture(scope="module")
def base_dim(spark, fin):
    return generate_date_dim(spark, START, END, fin, dt.date(1998, 7, 15)).cache()


@settings(max_examples=8, deadline=None)
@given(
    as_of=st.dates(min_value=dt.date(1996, 1, 1), max_value=dt.date(2001, 12, 31)),
    variant=st.sampled_from(["roll", "generate"]),
)
def test_random_as_of_matches_python(base_dim, as_of, variant):
    cols = ["day_status", *schemas.ASOF_COLUMNS]
    rows = roll_date_dim(base_dim, as_of, variant=variant).select("calendar_date", *cols).collect()
    bad = [r["calendar_date"] for r in rows if {c: r[c] for c in cols} != pyref.asof_row(r["calendar_date"], as_of, variant)]
    assert not bad, bad[:5]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 6, 10, 12, 20])
def test_any_interval_width(spark, width):
    s = second_spine(spark).select("second_of_day", tod.interval_label(F.col("second_of_day"), width).alias("lab"))
    for r in s.where(F.col("second_of_day") % 97 == 0).collect():
        sec = r["second_of_day"]
        h, m = sec // 3600, sec % 3600 // 60
        lo = m // width * width
        assert r["lab"] == f"{h:02d}:{lo:02d}:00-{h:02d}:{lo + width - 1:02d}:59"
    assert s.groupBy("lab").count().where(F.col("count") != width * 60).count() == 0


def test_bad_interval_width_rejected():
    with pytest.raises(ValueError):
        tod.interval_label(F.lit(0), 7)


def test_financial_calendar_from_csv(spark, fin, scratch):
    fin.write.option("header", "true").csv(f"{scratch}/fin_csv")
    back = read_financial_calendar(spark, f"{scratch}/fin_csv", "csv", header="true")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in schemas.FIN_CALENDAR]
    assert back.exceptAll(fin).count() == 0 and back.count() == fin.count()


def test_financial_calendar_csv_columns_matched_by_name(spark, fin, scratch):
    cols = list(reversed(fin.columns))
    shuffled = fin.select(*[F.col(c).alias(c.upper()) for c in cols])
    shuffled.write.option("header", "true").csv(f"{scratch}/fin_upper_reversed")
    back = read_financial_calendar(spark, f"{scratch}/fin_upper_reversed", "csv")
    assert back.columns == fin.columns and back.exceptAll(fin).count() == 0


def test_financial_calendar_bad_text_raises(spark, scratch):
    import pytest

    spark.createDataFrame([("1998-13-45", "1998-07-13", "1999-03", "1999-P-01", "1", "1999", "FY1999")],
                          "calendar_date string, week_commencing string, financial_week string, "
                          "financial_period string, financial_quarter string, financial_year string, "
                          "financial_year_format string").write.option("header", "true").csv(f"{scratch}/bad")
    with pytest.raises(Exception):
        read_financial_calendar(spark, f"{scratch}/bad", "csv").collect()
