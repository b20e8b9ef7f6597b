"""Plain-Python second reading of the dimension rules, written from the rule
table rather than from the Spark code; tests compare the two row by row."""

from __future__ import annotations

import datetime as dt

DAY = dt.timedelta(days=1)


def monday(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())


def key(d: dt.date) -> int:
    return int(d.strftime("%Y%m%d"))


def calendar_row(d: dt.date) -> dict:
    wc = monday(d)
    nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return {
        "date_key": key(d),
        "date_desc": f"{d.strftime('%A')}, {d.strftime('%B')} {d.day:02d},{d.year}",
        "day_name": d.strftime("%A"),
        "day_name_abrv": d.strftime("%a"),
        "day_in_week_no": (d.weekday() + 1) % 7,
        "day_in_month": d.day,
        "weekday_flag": 0 if d.weekday() >= 5 else 1,
        "weekend_flag": 1 if d.weekday() >= 5 else 0,
        "week_commencing_date_key": key(wc),
        "week_commencing_date": wc,
        "week_ending_date_key": key(wc + 6 * DAY),
        "week_ending_date": wc + 6 * DAY,
        "month_no": d.month,
        "month": f"{d.year:04d}-{d.month:02d}",
        "month_name": d.strftime("%B"),
        "month_name_abrv": d.strftime("%b"),
        "monthend_flag": "Y" if d == nxt - DAY else "N",
        "cal_day_in_year": d.timetuple().tm_yday,
        "cal_week_in_year": d.isocalendar()[1],
        "cal_quarter_no": (d.month - 1) // 3 + 1,
        "cal_quarter": f"{d.year}0{(d.month - 1) // 3 + 1}",
        "cal_year": d.year,
    }


def fin_position(d: dt.date) -> tuple[int, int, int, int]:
    """(year, quarter, period, week) of the FIXTURES 4-4-5 calendar."""
    fy = d.year + 1 if d >= monday(dt.date(d.year, 7, 1)) else d.year
    w = (d - monday(dt.date(fy - 1, 7, 1))).days // 7 + 1
    q = min(4, (w - 1) // 13 + 1)
    wq = w - (q - 1) * 13
    p = (q - 1) * 3 + (1 if wq <= 4 else 2 if wq <= 8 else 3)
    return fy, q, p, w


def asof_row(d: dt.date, a: dt.date, variant: str = "roll") -> dict:
    fy, fq, fp, fw = fin_position(d)
    cy, cq, cp, cw = fin_position(a)
    yes = lambda b: "YES" if b else "NO"
    mmdd = lambda x: x.strftime("%m%d")
    after_leap = (d.year - 1) % 4 == 0
    if d == a:
        day = "Today"
    elif d == a - DAY:
        day = "Previous Day"
    elif variant == "roll" and d == a - 2 * DAY:
        day = "2 Days Ago"
    elif (after_leap and d == a - 365 * DAY) or (not after_leap and d == a - 364 * DAY):
        day = "Previous Day Last Year"
    else:
        day = "Other"
    year_st = {cy: "Current Year", cy - 1: "Previous Year", cy - 2: "2 Year Back"}.get(fy)
    q_st = {(cy, cq): "Current Quarter", (cy, cq - 1): "Previous Quarter", (cy - 1, cq): "Current Quarter Last Year"}
    p_st = {(cy, cp): "Current Period", (cy, cp - 1): "Previous Period", (cy - 1, cp): "Current Period Last Year"}
    w_st = {
        (cy, cw): "Current Week",
        (cy, cw - 1): "Previous Week",
        (cy - 1, cw): "Current Week Last Year",
        (cy - 1, cw - 1): "Previous Week Last Year",
    }
    if variant == "roll":
        w_st.update(
            {
                (cy, cw - 2): "2 Weeks Back",
                (cy - 1, cw - 2): "2 Weeks Back Last Year",
                (cy - 2, cw): "Current Week 2 Year Back",
                (cy - 2, cw - 1): "Previous Week 2 Year Back",
            }
        )
    # first matching CASE branch wins: insert in branch order
    order_w = (
        [(cy, cw), (cy, cw - 1), (cy, cw - 2), (cy - 1, cw), (cy - 1, cw - 1), (cy - 1, cw - 2), (cy - 2, cw), (cy - 2, cw - 1)]
        if variant == "roll"
        else [(cy, cw), (cy, cw - 1), (cy - 1, cw), (cy - 1, cw - 1)]
    )
    week_st = next((w_st[k] for k in order_w if k == (fy, fw)), None)
    quarter_st = next((q_st[k] for k in [(cy, cq), (cy, cq - 1), (cy - 1, cq)] if k == (fy, fq)), None)
    period_st = next((p_st[k] for k in [(cy, cp), (cy, cp - 1), (cy - 1, cp)] if k == (fy, fp)), None)
    if variant == "roll":
        ly = a - 364 * DAY
        ly_wtd = monday(ly) <= d <= ly
    else:
        back = a - (366 if after_leap else 365) * DAY
        ly_wtd = monday(back) <= d and mmdd(d) <= mmdd(a)
    aq = (a.month - 1) // 3 + 1
    dq = (d.month - 1) // 3 + 1
    return {
        "day_status": day,
        "fin_year_status": year_st,
        "fin_quarter_status": quarter_st,
        "fin_period_status": period_st,
        "fin_week_status": week_st,
        "current_cal_wtd": yes(monday(a) <= d <= a),
        "current_cal_mtd": yes((d.year, d.month) == (a.year, a.month) and d <= a),
        "current_cal_ptd": yes((fy, fp) == (cy, cp) and d <= a),
        "current_cal_qtd": yes((d.year, dq) == (a.year, aq) and d <= a),
        "current_cal_ytd": yes(d.year == a.year and d <= a),
        "previous_wk_cal_wtd": yes(monday(a - 7 * DAY) <= d <= a - 7 * DAY),
        "previous_yr_cal_wtd": yes(ly_wtd),
        "previous_yr_cal_ptd": yes((fy, fp) == (cy - 1, cp) and mmdd(d) <= mmdd(a)),
        "previous_yr_cal_qtd": yes((d.year, dq) == (a.year - 1, aq) and mmdd(d) <= mmdd(a)),
        "previous_yr_cal_ytd": yes(d.year == a.year - 1 and mmdd(d) <= mmdd(a)),
    }


def time_row(s: int) -> dict:
    h, m, sec = s // 3600, s % 3600 // 60, s % 60
    h12 = h % 12 or 12

    def lab(w):
        lo = m // w * w
        return f"{h:02d}:{lo:02d}:00-{h:02d}:{lo + w - 1:02d}:59"

    part = (
        "BREAKFAST" if 9 <= h <= 10 else "LUNCH" if 11 <= h <= 14 else "AFTERNOON" if 15 <= h <= 16
        else "DINNER" if 17 <= h <= 20 else "LATE NIGHT" if 21 <= h <= 22 else "OTHER"
    )
    return {
        "time_of_day_key": s + 1,
        "time_of_day_hh24": f"{h:02d}:{m:02d}:{sec:02d}",
        "time_of_day_hh12": f"{h12:02d}:{m:02d}:{sec:02d} {'AM' if h < 12 else 'PM'}",
        "minute_of_day": (s + 1) // 60,
        "interval_05_min": lab(5),
        "interval_15_min": lab(15),
        "interval_30_min": lab(30),
        "interval_01_hour": lab(60),
        "serving_time": part,
    }
