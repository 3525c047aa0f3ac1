"""Incremental CLV and versioned tables: equal to a full run, and only what changed is written."""
import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators import clv, refresh
from orderlens.plans import daily
from orderlens.session import scratch_path
from orderlens.sources import readers, sinks, versions

SCHEMA = ("order_id string, user_id string, restaurant_id string, is_loyalty boolean, "
          "is_guest boolean, order_date date, order_net decimal(18,2)")
DAY = dt.date(2023, 1, 1)
SNAPS = [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 31), dt.date(2023, 4, 30)]


def row(order, user, day, net):
    return (order, user, "R1", False, user is None, DAY + dt.timedelta(days=day), Decimal(str(net)))


def base(seed=3):
    rnd = random.Random(seed)
    return [row(f"o{i}", rnd.choice([None, *(f"u{k}" for k in range(25))]), rnd.randrange(85), rnd.randint(1, 9000) / 100) for i in range(220)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def dates(spark, days):
    return spark.createDataFrame([(d,) for d in days], "snapshot_date date")


def full(spark, rows, days):
    return {(r.user_id, r.snapshot_date): tuple(r) for r in clv.clv_as_of(frame(spark, rows), dates(spark, days), method="window").collect()}


def edits():
    rows = base()
    appended = rows + [row(f"n{i}", f"u{i % 30}", 92 + i % 25, 5 + i) for i in range(40)]
    split = rows + [row("o7", rows[7][1] or "u1", 95, 3.5), row("o8", "u3", 95, 1)]  # an old order's later rows
    corrected = [r if i != 9 else (*r[:-1], r[-1] + 7) for i, r in enumerate(rows)] + [row("x", "u2", 40, 1), row("x", "u2", 40, 1)]
    removed = [r for r in rows if r[1] not in ("u4", "u5")][:-3]
    moved = [r if r[1] != "u6" else (r[0], "u7", *r[2:]) for r in appended]
    return {"same": rows, "appended": appended, "split": split, "corrected": corrected, "removed": removed, "moved": moved, "none left": rows[:0]}


@pytest.mark.parametrize("name", list(edits()))
def test_refreshed_snapshots_equal_a_full_run(spark, name):
    rows, after = base(), edits()[name]
    have = [SNAPS[0], SNAPS[1]] if name != "corrected" else [SNAPS[0], SNAPS[2]]  # one between is missing
    held = clv.clv_as_of(frame(spark, rows), dates(spark, have)).cache()
    got = refresh.refresh(frame(spark, rows), frame(spark, after), held, SNAPS)
    new = {(r.user_id, r.snapshot_date): tuple(r) for r in got.rows.collect()}
    assert {d for _, d in new} <= set(got.dates)
    table = {(r.user_id, r.snapshot_date): tuple(r) for r in held.collect() if r.snapshot_date not in got.dates} | new
    assert table == full(spark, after, SNAPS)
    held.unpersist()


def test_no_change_and_no_new_date_writes_nothing(spark):
    rows = base()
    held = clv.clv_as_of(frame(spark, rows), dates(spark, SNAPS[:3]))
    assert refresh.refresh(frame(spark, rows), frame(spark, rows[::-1]), held, SNAPS[:3]) is None


def test_nothing_stored_is_a_full_run(spark):
    rows = base()
    got = refresh.refresh(frame(spark, []), frame(spark, rows), clv.clv_as_of(frame(spark, []), dates(spark, SNAPS)), SNAPS)
    assert {(r.user_id, r.snapshot_date): tuple(r) for r in got.rows.collect()} == full(spark, rows, SNAPS)


def test_changes_are_signed_rows(spark):
    a, b = row("o1", "u1", 1, 5), row("o2", "u1", 2, 5)
    got = refresh.changes(frame(spark, [a, a, b, row("g", None, 1, 1)]), frame(spark, [a, b, row("o3", "u2", 2, 1)]))
    assert {(r.order_id, r.n) for r in got.collect()} == {("o1", -1), ("o3", 1)}


def test_files_of_untouched_dates_stay(spark):
    """A correction of the second month rewrites the snapshots from there on only."""
    zones = daily.Zones.under(scratch_path(spark, "t-refresh"))
    rows = base()
    table = f"{zones.gold}/{daily.CLV_TABLE}"
    sinks.write_table(frame(spark, rows), f"{zones.silver}/s_orders")
    sinks.upsert_snapshots(clv.clv_as_of(frame(spark, rows), dates(spark, SNAPS[:3])), table)
    files = lambda: {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(table.removeprefix("file:")) for f in fs if f.endswith(".parquet")}
    old = files()
    assert old
    after = [*rows, row("late", "u2", 45, 11)]
    sinks.write_table(frame(spark, after), f"{zones.silver}/s_orders")
    wrote = daily.refresh_clv(spark, zones, [SNAPS[3]])
    assert set(wrote) == {str(d) for d in SNAPS[1:]}
    stayed = {f for f in files().items() if f in old.items()}
    assert stayed and all(str(SNAPS[0]) in f for f, _ in stayed)
    back = readers.read_zone(spark, zones.gold, daily.CLV_TABLE).select(*clv.CLV_COLUMNS)
    assert {(r.user_id, r.snapshot_date): tuple(r) for r in back.collect()} == full(spark, after, SNAPS)
    assert daily.refresh_clv(spark, zones, [], before=frame(spark, after)) == {}
    sinks.write_table(frame(spark, []), f"{zones.silver}/s_orders")
    assert set(daily.refresh_clv(spark, zones, []).values()) == {0}  # nobody is left
    assert readers.read_zone(spark, zones.gold, daily.CLV_TABLE).count() == 0


# ------------------------------------------------------------------ versions
def test_readers_and_dead_writers_see_whole_versions(spark):
    root = scratch_path(spark, "t-versions")
    sinks.write_table(spark.range(3), f"{root}/t")
    old = readers.read_zone(spark, root, "t")
    name, folder = versions.begin(f"{root}/t")
    spark.range(9).write.parquet(folder)  # a writer that dies before its commit
    assert readers.read_zone(spark, root, "t").count() == 3
    sinks.write_table(spark.range(5).withColumn("new", F.lit(1)), f"{root}/t")
    new = readers.read_zone(spark, root, "t")
    assert new.count() == 5 and new.columns == ["id", "new"]
    assert old.count() == 3  # made before the replacement
    assert readers.read_zone(spark, root, "t", back=1).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_zone(spark, root, "t", back=2)
    versions.commit(spark, f"{root}/t", name)  # of two writers the last to commit wins, whole
    assert readers.read_zone(spark, root, "t").count() == 9


def test_a_failing_write_leaves_the_table(spark):
    root = scratch_path(spark, "t-failing")
    sinks.write_table(spark.range(4), f"{root}/t")
    bad = spark.range(100).select(F.when(F.col("id") > 50, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_table(bad, f"{root}/t")
    assert readers.read_zone(spark, root, "t").count() == 4 and len(versions.versions(spark, f"{root}/t")) == 1


def test_old_versions_go(spark):
    root = scratch_path(spark, "t-keep")
    for n in range(1, 7):
        sinks.write_table(spark.range(n), f"{root}/t", keep=2)
    kept = versions.versions(spark, f"{root}/t")
    assert [v.number for v in kept] == [5, 6]
    folder = versions.Folder(spark, f"{root}/t")
    assert {n for n in folder.names() if n.startswith("_v-")} == {f"_v-{v.id}" for v in kept}
    assert readers.read_zone(spark, root, "t").count() == 6


# ------------------------------------------------------------------ catalog
def test_published_tables_follow_their_folders(spark):
    """Dates added and removed, and a table replaced, by another session."""
    root, other = scratch_path(spark, "t-reconcile"), spark.newSession()
    schema = "user_id string, v int, snapshot_date date"
    put = lambda session, d, v: sinks.upsert_snapshots(session.createDataFrame([("u", v, d)], schema), f"{root}/g_clv")
    put(spark, SNAPS[0], 1)
    put(spark, SNAPS[1], 2)
    sinks.write_table(spark.range(2), f"{root}/g_mart")
    sinks.publish_tables(spark, "t_reconcile", root, ["g_clv", "g_mart"], partitioned={"g_clv": "snapshot_date"})
    put(other, SNAPS[2], 3)
    put(other, SNAPS[1], 9)
    versions.Folder(other, f"{root}/g_clv").delete(f"snapshot_date={SNAPS[0]}")
    sinks.write_table(other.range(7), f"{root}/g_mart")
    read = lambda: {r.snapshot_date: r.v for r in sinks.read_published(spark, "t_reconcile", "g_clv").collect()}
    assert read() == {SNAPS[1]: 9, SNAPS[2]: 3}
    assert sinks.read_published(spark, "t_reconcile", "g_mart").count() == 7
    assert spark.sql("SELECT count(*) FROM t_reconcile.g_clv").first()[0] == 2


def test_empty_reload_of_the_newest_date(spark):
    """The date keeps its (empty) batch: Silver doesn't fall back to the one before it."""
    root = scratch_path(spark, "t-empty")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "a int, day string")
    for day in ("2024-01-01", "2024-01-02"):
        sinks.write_batch(sinks.stamp_ingest(rows.filter(rows.day == day), "t", day), f"{root}/t", day)
    assert sinks.write_batch(sinks.stamp_ingest(rows.filter("false"), "t", "2024-01-02"), f"{root}/t", "2024-01-02") == 0
    back = readers.read_zone(spark, root, "t")
    assert [r.a for r in back.collect()] == [1]
    for day in ("2024-01-01", "2024-01-02"):
        sinks.write_batch(sinks.stamp_ingest(rows.filter("false"), "t", day), f"{root}/t", day)
    assert readers.read_zone(spark, root, "t").drop("batch_date").columns == ["a", "day", "ingest_ts", "source"]
