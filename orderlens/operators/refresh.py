"""CLV snapshots brought from one order batch to the next.

A batch is a full extract, so yesterday's orders may be corrected in today's. `changes` finds
what differs, `refresh` returns the CLV rows of the snapshots that it touches, and no others:

1. Every day's rows are reduced to their number and two hash sums, map-side, in both batches;
   only days whose digests differ are compared row by row. So a day's append or correction
   shuffles that day, not the history.
2. A customer whose past changed is computed again from all their orders. All others are
   carried forward: a new snapshot is the last stored one plus the orders since.
3. A tier depends on all customers of a snapshot, so a touched snapshot is tiered as a whole;
   one before the earliest change has no touched customer and isn't read, written or tiered.

Equal to a full run over the new batch: days are told apart by 128 bits of hash sums and the
row count, rows by their values.
"""
from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import MONEY
from ..session import stored
from . import clv
from .cutpoints import small_frame

#: What a customer's value is made of.
ROW = ("user_id", "order_id", "order_date", "order_net")


def _rows(orders: DataFrame) -> DataFrame:
    return clv.identified(orders).filter(F.col("order_date").isNotNull()).select(*ROW)


def _digests(rows: DataFrame, name: str) -> DataFrame:
    hashed = lambda seed: F.sum(F.xxhash64(F.lit(seed), *ROW).cast("decimal(20,0)"))
    return rows.groupBy("order_date").agg(F.struct(F.count(F.lit(1)), hashed(0), hashed(1)).alias(name))


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(user_id, order_id, order_date, order_net, n): rows of identified customers that `after`
    has more (n > 0) or fewer (n < 0) times than `before`."""
    before, after = _rows(before), _rows(after)
    days = (_digests(before, "old").join(_digests(after, "new"), "order_date", "full")
            .filter(~F.col("old").eqNullSafe(F.col("new"))).select("order_date"))
    # One row a day: at most the days that a date can name.
    old, new = (x.join(F.broadcast(days), "order_date", "left_semi").select(*ROW, F.lit(n).alias("n")) for x, n in ((before, -1), (after, 1)))
    return old.unionByName(new).groupBy(*ROW).agg(F.sum("n").alias("n")).filter("n != 0")


def _money(c: str) -> Column:
    """A published amount (the nearest double) as the exact decimal it stands for."""
    return F.col(c).cast(MONEY)


class Refreshed(NamedTuple):
    """CLV rows to write, and the dates that they replace (a date may have no rows left)."""

    rows: DataFrame
    dates: list[_dt.date]


def refresh(before: DataFrame, after: DataFrame, snapshots_stored: DataFrame, snapshots: list[_dt.date]) -> Refreshed | None:
    """CLV rows of those of `snapshots` that have to be written so that the stored table equals
    a full run over `after` at these dates; None if there is nothing to write. `snapshots_stored`
    are the CLV rows computed from `before` (columns of `clv.CLV_COLUMNS`)."""
    spark = after.sparkSession
    frame = lambda days: small_frame(spark, [(d,) for d in days], "snapshot_date date")
    have = sorted(r[0] for r in snapshots_stored.select("snapshot_date").distinct().collect())  # one row a snapshot
    wanted = sorted(set(snapshots))
    if not have:
        return Refreshed(clv.clv_as_of(after, frame(wanted)), wanted) if wanted else None
    upto = have[-1]
    past = F.col("order_date") <= F.lit(str(upto)).cast("date")
    # A snapshot beyond the stored ones starts from the last of them and adds the rows since;
    # one that lies between stored ones and is missing is computed anew.
    new, missing = [s for s in wanted if s > upto], [s for s in wanted if s < upto and s not in have]
    changed = stored(changes(before.filter(past), after.filter(past)), "order-changes")
    since = changed.agg(F.min("order_date")).first()[0]
    stale = [s for s in wanted if s in have and since is not None and s >= since]
    if not (new or missing or stale):
        return None
    rows = _rows(after)
    later = rows.filter(~past)
    # Customers whose past changed, or who have an order with rows on both sides of the last
    # stored snapshot, which must be counted once.
    orders = ["user_id", "order_id"]
    split = rows.filter(past).select(*orders).join(later.select(*orders).distinct(), orders, "left_semi")
    rebuilt = stored(changed.select("user_id").unionByName(split.select("user_id")).distinct(), "customers-rebuilt")
    # A customer whose past stays has the stored rows at the stale snapshots, and goes on from the
    # last of them at new ones. No customer has two rows of a date, so nothing is merged again.
    same = snapshots_stored.join(rebuilt, "user_id", "left_anti")
    parts = []
    if stale:
        parts.append(same.join(F.broadcast(frame(stale)), "snapshot_date", "left_semi"))
    if new:
        start = same.filter(F.col("snapshot_date") == F.lit(str(upto)).cast("date")).select(
            "user_id", _money("cum_net_revenue").alias("net"), "cum_orders", "first_order_date", "last_order_date")
        parts.append(clv.clv_as_of(later.join(rebuilt, "user_id", "left_anti"), frame(new), with_tiers=False, start=start))
    for orders_of, days in ((rows.join(rebuilt, "user_id", "left_semi"), stale + new), (rows, missing)):
        if days:
            parts.append(clv.clv_as_of(orders_of, frame(days), with_tiers=False))
    state = reduce(DataFrame.unionByName, [p.select(
        "user_id", "snapshot_date", _money("cum_net_revenue").alias("cum_net_revenue"), "cum_orders", "first_order_date", "last_order_date")
        for p in parts])
    return Refreshed(clv.finish(stored(state, "clv-refreshed")), sorted(stale + new + missing))
