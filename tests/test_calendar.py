import datetime as dt

from orderlens.contracts import DATE_DIM_COLS
from orderlens.operators import calendar as cal_ops


def make(spark, lo, hi):
    return cal_ops.generate_calendar(cal_ops.bounds_from(spark, lo, hi))


def test_contiguous_days_and_schema(spark):
    cal = make(spark, "2020-04-21", "2024-02-21")
    assert cal.columns == DATE_DIM_COLS
    assert cal.count() == 1402
    assert cal.select("date_key").distinct().count() == 1402
    years = {r.year for r in cal.select("year").distinct().collect()}
    assert years == {2020, 2021, 2022, 2023, 2024}


def test_weekday_and_iso_week(spark):
    cal = {r.date_key: r for r in make(spark, "2022-12-30", "2023-01-09").collect()}
    sat = cal[dt.date(2023, 1, 7)]
    assert sat.day_of_week == "Saturday" and sat.is_weekend
    assert not cal[dt.date(2023, 1, 9)].is_weekend
    # ISO week next to the calendar year: 2023-01-01 is year 2023, week 52
    assert (cal[dt.date(2023, 1, 1)].year, cal[dt.date(2023, 1, 1)].week) == (2023, 52)


def test_holidays_including_observed_days(spark):
    cal = make(spark, "2021-12-01", "2023-12-31")
    hol = {r.date_key: r.holiday_name for r in cal.filter("is_holiday").collect()}
    assert hol[dt.date(2022, 7, 4)] == "Independence Day"
    assert hol[dt.date(2022, 11, 24)] == "Thanksgiving"
    assert hol[dt.date(2022, 5, 30)] == "Memorial Day"
    assert hol[dt.date(2023, 1, 16)] == "Martin Luther King Jr. Day"
    assert hol[dt.date(2022, 6, 19)] == "Juneteenth National Independence Day"
    # 2022-12-25 is a Sunday → observed Monday; 2022-01-01 is a Saturday → observed 2021-12-31
    assert hol[dt.date(2022, 12, 26)] == "Christmas Day (observed)"
    assert hol[dt.date(2021, 12, 31)] == "New Year's Day (observed)"
    # no holiday row duplicates a calendar day
    assert cal.count() == cal.select("date_key").distinct().count()


def test_month_end_snapshots_partial_last_month(spark):
    cal = make(spark, "2023-01-15", "2023-03-10")
    snaps = sorted(r.snapshot_date for r in cal_ops.month_end_snapshots(cal).collect())
    assert snaps == [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 10)]
    inner = sorted(r.snapshot_date for r in
                   cal_ops.month_end_snapshots(cal, "2023-02-01", "2023-02-20").collect())
    assert inner == [dt.date(2023, 2, 20)]
