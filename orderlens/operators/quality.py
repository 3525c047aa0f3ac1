"""Quality gates over Silver and Gold.

The gates are (gate, passed, observed) rows made of a few figures. The daily chain observes
these while it writes the tables (`sinks.write_table(observe=...)`), so no table is read again but the
dates of the orders; `qc_report` takes them from stored tables, each read once. Only the few
report rows ever reach the driver, in `raise_if_failed`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import MONEY
from .cleaning import DROP_REASONS, line_counts, standardize_casing
from .clv import TIER_HIGH, TIER_LOW
from .views import as_money

# Tier-share tolerance around 20 % and the net ≥ gross slack.
TIER_SHARE_LO, TIER_SHARE_HI = 0.18, 0.22
NET_GROSS_SLACK = 0.01


class QualityGateError(RuntimeError):
    pass


def calendar_gaps(s_orders: DataFrame, s_calendar: DataFrame) -> DataFrame:
    """Distinct order dates the calendar does not cover (a NULL date counts as missing).
    The calendar (one row a day, at most the days that a date can name) is broadcast."""
    dates = s_orders.select("order_date").distinct()
    cal = F.broadcast(s_calendar.select("date_key"))
    return dates.join(cal, dates.order_date == cal.date_key, "left_anti")


def expected_lines(raw_counts: dict[str, int]) -> int:
    """What Silver must hold: the lines that came in without those that were left out, reason
    by reason (`cleaning.line_counts`)."""
    return raw_counts["lines"] - sum(raw_counts[r] for r in DROP_REASONS)


#: What `gates` reads, with types, beside the missing dates.
FIGURES = {"items": "long", "expected": "long", "customers": "long", "high": "long", "low": "long", "net": MONEY, "gross": MONEY}


# Aggregates that the gates are made of. They can be observed while a table is written, or
# taken from the stored table.
def item_figures() -> list[Column]:
    return [F.count(F.lit(1)).alias("items")]


def tier_figures() -> list[Column]:
    """Of one snapshot's CLV rows."""
    return [F.count(F.lit(1)).alias("customers"), F.count_if(F.col("clv_tier") == TIER_HIGH).alias("high"),
            F.count_if(F.col("clv_tier") == TIER_LOW).alias("low")]


def sales_figures() -> list[Column]:
    return [F.sum(as_money("net_revenue")).cast(MONEY).alias("net"), F.sum(as_money("gross_revenue")).cast(MONEY).alias("gross")]


def latest_tiers(clv: DataFrame) -> DataFrame:
    """`tier_figures` of the latest snapshot: CLV is read once, and reduced by date."""
    by_date = clv.groupBy("snapshot_date").agg(*tier_figures())
    return by_date.agg(F.max_by(F.struct("customers", "high", "low"), "snapshot_date").alias("t")).select("t.*")


def gates(figures: DataFrame) -> DataFrame:
    """(gate, passed, observed) of one row of figures: items, expected (null: only that there are
    any), missing_dates, customers, high, low, net, gross."""
    share = lambda c: F.try_divide(F.col(c), F.col("customers"))
    fair = lambda x: (x >= TIER_SHARE_LO) & (x <= TIER_SHARE_HI)
    items_ok = F.when(F.col("expected").isNull(), F.col("items") > 0).otherwise(F.col("items") == F.col("expected"))
    margin = (F.col("net") - F.col("gross")).cast(MONEY)
    each = [("silver_order_items_count", items_ok, F.col("items")),
            ("calendar_missing_dates", F.col("missing_dates") == 0, F.col("missing_dates")),
            ("clv_high_tier_share", fair(share("high")), share("high")),
            ("clv_low_tier_share", fair(share("low")), share("low")),
            ("net_minus_gross", margin >= -NET_GROSS_SLACK, margin)]
    rows = F.array(*[F.struct(F.lit(n).alias("gate"), F.coalesce(ok, F.lit(False)).alias("passed"), x.cast("double").alias("observed"))
                     for n, ok, x in each])
    return figures.select(F.explode(rows).alias("g")).select("g.*")


def qc_report(s_items: DataFrame, s_orders: DataFrame, s_calendar: DataFrame, clv: DataFrame, trends: DataFrame,
              expected_items: int | None = None, raw_items: DataFrame | None = None, dev_app_name: str | None = None) -> DataFrame:
    """The gates over stored tables, each read once. What Silver must hold follows from the raw
    lines if these are given, or is `expected_items`."""
    one = [s_items.agg(*item_figures()), calendar_gaps(s_orders, s_calendar).agg(F.count(F.lit(1)).alias("missing_dates")),
           latest_tiers(clv), trends.agg(*sales_figures())]
    if raw_items is not None:
        counts = standardize_casing(raw_items).agg(*line_counts(dev_app_name))
        one.append(counts.select((F.col("lines") - sum((F.col(r) for r in DROP_REASONS), F.lit(0))).alias("expected")))
    # Five rows of one aggregate each, as five scalars of one row.
    figures = s_items.sparkSession.range(1).select(*[t.select(F.struct("*")).scalar().alias(f"t{i}") for i, t in enumerate(one)])
    named = [F.col(f"t{i}")[c].alias(c) for i, t in enumerate(one) for c in t.columns]
    if raw_items is None:
        named.append(F.lit(expected_items).cast("long").alias("expected"))
    return gates(figures.select(*named))


def raise_if_failed(report: DataFrame) -> list[tuple]:
    """Collect the (five-row) report and raise when a gate failed."""
    rows = [(r["gate"], bool(r["passed"]), r["observed"]) for r in report.collect()]
    failed = [r for r in rows if not r[1]]
    if failed:
        raise QualityGateError(f"{len(failed)} quality gate(s) failed: {failed}")
    return rows
