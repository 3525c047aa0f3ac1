"""What queries leave on disk: passes, shuffle files, codecs, stored tables."""
import datetime as dt
import os
import time
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderlens import session
from orderlens.contracts import ORDER_ITEM_OPTIONS_COLS, ORDER_ITEMS_COLS, SILVER_TABLES
from orderlens.operators import calendar as cal_ops
from orderlens.operators import marts, profile
from orderlens.plans import daily, io_queries, queries
from orderlens.sources import fixtures, versions
from orderlens.sources.sinks import write_table

DEV = fixtures.DEV_APP_NAME


def rows_of(df) -> list:
    return sorted(map(str, df.collect()))


@pytest.fixture
def small_passes(monkeypatch):
    """Any scan takes three passes at least; returns the passes asked for."""
    asked = []
    for module in (session, daily, fixtures):
        monkeypatch.setattr(module, "passes", lambda *scans: asked.append(scans) or 3)
    return asked


@pytest.fixture
def raw(spark):
    """Lines and options with null and repeated keys, orders whose lines disagree, test and malformed lines."""
    def line(order, item, user="u", price="1.50", app="shop", day="2024-01-05", name="n"):
        return (app, "R1", f"{day}T10:00:00Z", order, user, None, "TRUE", "USD", item, "c", name, price, "2")
    items = [line(str(k), f"{n}-{k}", user=f"u{k % 5}", day=f"2024-01-{k % 27 + 1:02d}") for k in range(40) for n in range(k % 4 + 1)]
    items += [line("7", "0-7"), line("7", "0-7"), line("7", "9", user=""), line(None, "1"), line(None, "1"), line("8", None), line("9", "3", app=DEV),
              line("9", "4", app=None), line("9", "5", name=None), line("11", "6", price="x")]
    options = [(str(k), f"0-{k}", "G", "a", "0.25", "1") for k in range(0, 40, 2)] * 2 + [(None, "1", "G", "a", "1", "1"), ("7", "0-7", "G", "b", "2", "1"), ("99", "1", "G", "b", "2", "1")]
    types = lambda cols: ", ".join(f"{c} string" for c in cols)
    return (session.stored(spark.createDataFrame(items, types(ORDER_ITEMS_COLS)), "t-items"),
            session.stored(spark.createDataFrame(options, types(ORDER_ITEM_OPTIONS_COLS)), "t-options"))


def shuffle_files(spark) -> int:
    top = os.path.dirname(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    here = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getName()
    return sum(f.startswith("shuffle_") for _, _, files in os.walk(f"{top}/{here}") for f in files)


def test_parts_hold_every_row_once_and_keep_keys_together(spark):
    rows = spark.createDataFrame([(str(k % 9) if k % 4 else None, k) for k in range(200)], "a string, b int")
    parts = [{(r.a, r.b) for r in part.collect()} for part in session.split(rows, 5, "a")]
    assert sum(map(len, parts)) == 200 == len(set().union(*parts))
    keys = [{a for a, _ in part} for part in parts]
    assert sum(map(len, keys)) == 10 == len(set().union(*keys))


def test_silver_in_passes_equals_silver_at_once(spark, tmp_path, raw, monkeypatch, request):
    at_once, figures = f"{tmp_path}/once", {}
    counts = daily.write_silver(spark, *raw, DEV, at_once, figures)
    want = {t: rows_of(df) for t, df in daily.read_silver(spark, at_once).items()}
    asked = request.getfixturevalue("small_passes")
    in_passes, found = f"{tmp_path}/passes", {}
    assert daily.write_silver(spark, *raw, DEV, in_passes, found, raw_passes=3) == counts
    assert asked and found == figures and found["items"] == found["expected"]
    assert {t: rows_of(df) for t, df in daily.read_silver(spark, in_passes).items()} == want
    for t in SILVER_TABLES:
        files = [f for f in os.listdir(versions.resolve(spark, f"{in_passes}/{t}").removeprefix("file:")) if f.endswith(".parquet")]
        assert files and all(".zstd." in f for f in files)


def test_shuffle_files_go_with_the_query_that_wrote_them(spark, tmp_path, raw):
    spark._jvm.System.gc()
    time.sleep(1)
    before = shuffle_files(spark)
    daily.write_silver(spark, *raw, DEV, f"{tmp_path}/s")
    until = time.time() + 20
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before


def test_duplicates_are_counted_in_passes(spark, raw, small_passes):
    items = raw[0]
    want = rows_of(items.groupBy("order_id", "lineitem_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    got = profile.grain_duplicates(items)
    assert len(want) == 2 and rows_of(got) == want
    assert small_passes and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # each pass is done and stored


def test_sales_are_summed_in_passes(spark, small_passes):
    line = "order_date date, restaurant_id string, item_category string, order_id string, gross_line decimal(18,2), net_line decimal(18,2)"
    rows = [(dt.date(2024, 1, k % 5 + 1) if k % 7 else None, f"R{k % 3}" if k % 11 else None, f"c{k % 4}", str(k % 13), D(k), D(k) + 1 if k % 5 else None) for k in range(300)]
    lines = spark.createDataFrame(rows, line)
    calendar = cal_ops.generate_calendar(cal_ops.date_bounds(lines))
    got = marts.build_sales_trends(lines, calendar)
    assert small_passes and got._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1  # of stored sums
    cells = {}
    for day, place, kind, order, gross, net in rows:
        cell = cells.setdefault((day, place, kind), [set(), D(0), None])
        cell[0].add(order)
        cell[1] += gross
        cell[2] = cell[2] if net is None else (cell[2] or 0) + net
    want = {k: (len(o), float(g), None if n is None else float(n)) for k, (o, g, n) in cells.items()}
    assert {(r.order_date, r.restaurant_id, r.item_category): (r.orders, r.gross_revenue, r.net_revenue) for r in got.collect()} == want


def scratch_of(spark) -> set:
    top = f"{session.checkpoint_root(spark).removeprefix('file:')}/orderlens-scratch"
    return set(os.listdir(top))


def test_steps_leave_no_stored_rows(spark, tmp_path, raw):
    zones = daily.Zones.under(str(tmp_path))
    daily.write_silver(spark, *raw, DEV, zones.silver)
    before = scratch_of(spark)
    assert daily.clv(spark, zones) and daily.marts(spark, zones)
    orders = daily.read_silver(spark, zones)["s_orders"]
    write_table(orders.filter("user_id <> 'u3'"), f"{zones.silver}/s_orders")
    assert daily.refresh_clv(spark, zones, [dt.date(2024, 2, 1)])
    assert scratch_of(spark) == before
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    held = daily.read_zone(spark, zones.gold, daily.CLV_TABLE)
    assert held.filter("user_id = 'u3'").isEmpty() and not held.isEmpty()


@pytest.fixture
def copy_of_small(sf_small, tmp_path):
    """Another path, of which no Silver was built yet."""
    path = f"{tmp_path}/again"
    os.makedirs(path)
    for f in os.listdir(sf_small):
        os.symlink(f"{sf_small}/{f}", f"{path}/{f}")
    return path


def test_snapshots_of_silver_in_passes(spark, sf_small, copy_of_small, request):
    want = rows_of(queries.q_clv_month_end(spark, sf_small))
    asked = request.getfixturevalue("small_passes")
    assert rows_of(queries.q_clv_month_end(spark, copy_of_small)) == want
    assert len(asked) == 3  # the raw lines, their join with the options, the orders


def test_landed_and_reloaded_orders_in_passes(spark, sf_small, request, monkeypatch):
    want = rows_of(queries.q_orders(spark, sf_small))
    asked = request.getfixturevalue("small_passes")
    monkeypatch.setattr(io_queries, "passes", session.passes)
    roots, scratch = {}, io_queries.scratch_path
    monkeypatch.setattr(io_queries, "scratch_path", lambda s, name: roots.setdefault(name, scratch(s, name)))
    landed = io_queries.q_landing_stream_ingest(spark, sf_small)
    assert len(asked) == 1 and "Join" not in landed._jdf.queryExecution().executedPlan().toString()  # each pass is done and stored
    assert rows_of(landed) == want
    files = [f for _, _, names in os.walk(f"{roots['landing'].removeprefix('file:')}/landing") for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert rows_of(io_queries.q_daily_reload(spark, sf_small)) == want
