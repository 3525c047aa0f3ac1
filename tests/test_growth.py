"""What a task holds doesn't grow with the input: plans and settings behind it."""
import datetime as dt
import re

from pyspark.sql import functions as F

from orderlens import session
from orderlens.operators import clv, cutpoints, profile, refresh


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffles_are_dealt_by_input_and_scans_are_small(spark, tmp_path, monkeypatch):
    key, scan = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    least, before = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get(scan)
    spark.range(10_000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    try:
        assert session.deal_out(spark, df) == least  # a small input keeps the session's number
        monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", 1_000)
        assert session.deal_out(spark, df) == int(spark.conf.get(key)) > 5 * least
        for given, kept in (("128MB", str(session.SCAN_BYTES)), ("134217728b", str(session.SCAN_BYTES)), ("16m", "16m")):
            spark.conf.set(scan, given)
            session.prepare(spark)
            assert spark.conf.get(scan) == kept
    finally:
        spark.conf.set(scan, before)
        spark.conf.set(key, str(least))


def test_cut_points_sort_no_rows(spark, monkeypatch):
    plans, running = [], cutpoints._running
    monkeypatch.setattr(cutpoints, "_running", lambda counted, *a: plans.append(plan_of(counted)) or running(counted, *a))
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"), F.col("id").cast("string").alias("t"))
    for group in (["g"], []):
        got = {r.t: r.tile for r in cutpoints.ntile(rows, 5, F.col("v"), "t", group, "tile").collect()}
        window = f"ntile(5) OVER ({'PARTITION BY g ' if group else ''}ORDER BY v, t)"
        assert got == {r.t: r.w for r in rows.select("t", F.expr(window).alias("w")).collect()}
    assert plans and not any("SortAggregate" in p for p in plans)


def test_refresh_merges_no_snapshot_rows(spark, monkeypatch):
    day = lambda m, d=1: dt.date(2024, m, d)
    order = "user_id string, order_id string, order_date date, order_net decimal(18,2)"
    one = lambda u, o, d, n: (u, o, d, n)
    from decimal import Decimal as D
    before = [one("a", "1", day(1, 5), D("10.00")), one("b", "2", day(1, 9), D("4.50")), one("c", "3", day(2, 2), D("7.00"))]
    after = [*before[:2], one("c", "3", day(2, 2), D("8.00")), one("a", "4", day(3, 3), D("2.25")), one("d", "5", day(4, 1), None)]
    old, new = (spark.createDataFrame(x, order) for x in (before, after))
    frame = lambda days: spark.createDataFrame([(d,) for d in days], "snapshot_date date")
    ends = [day(1, 31), day(2, 29), day(3, 31), day(4, 30)]
    held = session.stored(clv.clv_as_of(old, frame(ends[:2])), "test-held")
    plans, stored = {}, refresh.stored
    monkeypatch.setattr(refresh, "stored", lambda df, name: plans.update({name: plan_of(df)}) or stored(df, name))
    found = refresh.refresh(old, new, held, ends)
    assert found.dates == ends[1:]
    want = clv.clv_as_of(new, frame(ends)).filter(F.col("snapshot_date") > str(ends[0]))
    assert sorted(map(tuple, found.rows.select(*clv.CLV_COLUMNS).collect())) == sorted(map(tuple, want.select(*clv.CLV_COLUMNS).collect()))
    assert not re.search(r"Aggregate\(keys=\[user_id#\d+L?, snapshot_date#", plans["clv-refreshed"])


def test_guest_profile_repeats_no_lines(spark):
    lines = spark.createDataFrame([(False, "1", "a"), (False, "1", "a"), (False, "2", "a"), (False, None, "b"), (True, "3", None), (True, None, None)],
                                  "is_guest boolean, order_id string, user_id string")
    got = profile.guest_profile(lines)
    assert sorted(map(tuple, got.collect())) == [(False, 4, 2, 2), (True, 2, 1, 0)]
    assert "Expand" not in plan_of(got)


def test_batches_are_written_from_one_stored_extract(spark, sf_small, monkeypatch):
    from orderlens.plans import io_queries

    plans, write = [], io_queries.write_batch
    monkeypatch.setattr(io_queries, "write_batch", lambda df, *a: plans.append(plan_of(df)) or write(df, *a))
    rows = io_queries.q_batch_overwrite(spark, sf_small).collect()
    assert len(plans) == 5 and not any("Join" in p for p in plans)
    assert len(rows) == 2 and rows[0].rows == rows[1].rows > 0
