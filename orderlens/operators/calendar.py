"""Generated calendar dimension and snapshot-date generators.

The calendar covers every day between the first and last order date, so a join from
orders to the calendar can never drop a row. It is built from a one-row bounds
DataFrame with `sequence` + `explode` — its size is the number of days spanned, which is
what makes broadcasting it (and tables derived from it) safe.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contracts import DATE_DIM_COLS
from ..functions.holidays import holiday_table


def date_bounds(s_items_or_orders: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row (lo, hi): the first and last order date. A single global aggregate —
    each task reduces its share, one row per task reaches the final merge."""
    return s_items_or_orders.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))


def bounds_from(spark: SparkSession, lo: str | _dt.date, hi: str | _dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(str(lo)).cast("date").alias("lo"),
                                 F.lit(str(hi)).cast("date").alias("hi"))


def generate_calendar(bounds: DataFrame, with_holidays: bool = True) -> DataFrame:
    """bounds(lo date, hi date) → one row per day in [lo, hi], DATE_DIM_COLS. Rows are in no
    order (a stored table has none); whoever shows the calendar sorts it, see `in_order`."""
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key"))
    cal = days.select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.weekofyear("date_key").alias("week"),
        F.date_format("date_key", "EEEE").alias("day_of_week"),
        F.dayofweek("date_key").isin(1, 7).alias("is_weekend"),
    )
    if not with_holidays:
        return cal.select("*", F.lit(False).alias("is_holiday"),
                          F.lit(None).cast("string").alias("holiday_name"))
    # Observed New Year's Day can fall on 31 Dec of the year before, hence hi + 1 year.
    years = bounds.select(F.explode(F.sequence(F.year("lo"), F.year("hi") + 1)).alias("year"))
    hol = holiday_table(years)
    # Holidays: a few rows for each of the years (at most 9,999) that a date can name.
    cal = cal.join(F.broadcast(hol), cal.date_key == hol.h_date, "left")
    return cal.select(*DATE_DIM_COLS[:-2], F.col("h_date").isNotNull().alias("is_holiday"),
                      "holiday_name")


def in_order(calendar: DataFrame) -> DataFrame:
    """The calendar by date."""
    return calendar.orderBy("date_key")


def holidays_in_range(calendar: DataFrame) -> DataFrame:
    """Holiday rows (date_key, holiday_name) of a generated calendar."""
    return calendar.filter(F.col("is_holiday")).select("date_key", "holiday_name")


def daily_snapshot(spark: SparkSession, run_date: str | _dt.date) -> DataFrame:
    """One snapshot date."""
    return spark.range(1).select(F.lit(str(run_date)).cast("date").alias("snapshot_date"))


def month_end_snapshots(calendar: DataFrame, lo=None, hi=None) -> DataFrame:
    """Last calendar day of each (year, month) inside [lo, hi] (a partial last month
    yields `hi`). `lo`/`hi` may be literals or omitted (whole calendar)."""
    cal = calendar
    if lo is not None:
        cal = cal.filter(F.col("date_key") >= F.lit(str(lo)).cast("date"))
    if hi is not None:
        cal = cal.filter(F.col("date_key") <= F.lit(str(hi)).cast("date"))
    return cal.groupBy("year", "month").agg(F.max("date_key").alias("snapshot_date")).select("snapshot_date")
