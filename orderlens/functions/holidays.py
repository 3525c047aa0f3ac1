"""US federal holidays as Spark expressions (no third-party holiday library).

Holidays are generated per year from a rule table: one `explode` of a fixed array of
(name, date) structs per year row, so the holiday table grows with the number of years
spanned and never needs a join to build.

Observed days: a fixed-date holiday falling on a Saturday is also observed on the
Friday before, one on a Sunday on the Monday after; those rows are named
"<name> (observed)". Weekday-anchored holidays never need an observed day.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The federal holiday rules.
#   ("fixed",   name, month, day,  first_year)
#   ("nth",     name, month, weekday (1=Sun..7=Sat), n, first_year)
#   ("last",    name, month, weekday (1=Sun..7=Sat),    first_year)
HOLIDAY_RULES = [
    ("fixed", "New Year's Day", 1, 1, 1870),
    ("nth", "Martin Luther King Jr. Day", 1, 2, 3, 1986),
    ("nth", "Washington's Birthday", 2, 2, 3, 1971),
    ("last", "Memorial Day", 5, 2, 1971),
    ("fixed", "Juneteenth National Independence Day", 6, 19, 2021),
    ("fixed", "Independence Day", 7, 4, 1870),
    ("nth", "Labor Day", 9, 2, 1, 1894),
    ("nth", "Columbus Day", 10, 2, 2, 1971),
    ("fixed", "Veterans Day", 11, 11, 1938),
    ("nth", "Thanksgiving", 11, 5, 4, 1942),
    ("fixed", "Christmas Day", 12, 25, 1870),
]
OBSERVED_SUFFIX = " (observed)"


def _nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    shift = (F.lit(weekday) - F.dayofweek(first) + F.lit(7)) % F.lit(7)
    return F.date_add(first, shift + F.lit(7 * (n - 1)))


def _last_weekday(year: Column, month: int, weekday: int) -> Column:
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    back = (F.dayofweek(last) - F.lit(weekday) + F.lit(7)) % F.lit(7)
    return F.date_sub(last, back)


def _observed(d: Column) -> Column:
    dow = F.dayofweek(d)
    return (F.when(dow == 7, F.date_sub(d, 1))
            .when(dow == 1, F.date_add(d, 1)))


def holiday_table(years: DataFrame, year_col: str = "year") -> DataFrame:
    """years(year int) → holidays(h_date date, holiday_name string), one row per date."""
    y = F.col(year_col)
    entries = []
    for rule in HOLIDAY_RULES:
        kind, name = rule[0], rule[1]
        since = rule[-1]
        if kind == "fixed":
            d = F.make_date(y, F.lit(rule[2]), F.lit(rule[3]))
            entries.append((name, d, since))
            entries.append((name + OBSERVED_SUFFIX, _observed(d), since))
        elif kind == "nth":
            entries.append((name, _nth_weekday(y, rule[2], rule[3], rule[4]), since))
        else:
            entries.append((name, _last_weekday(y, rule[2], rule[3]), since))
    structs = [F.struct(F.when(y >= since, d).alias("h_date"), F.lit(name).alias("holiday_name"))
               for name, d, since in entries]
    rows = years.select(F.explode(F.array(*structs)).alias("h")).select("h.*")
    rows = rows.filter(F.col("h_date").isNotNull())
    # Two rules on one date would duplicate calendar rows on the join: fold them.
    return (rows.groupBy("h_date")
            .agg(F.array_join(F.sort_array(F.collect_set("holiday_name")), ", ")
                 .alias("holiday_name")))
