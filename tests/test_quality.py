import datetime as dt

import pytest

from orderlens.operators import quality


def frames(spark, missing_date=False, null_date=False):
    items = spark.range(10)
    od = [dt.date(2023, 1, 1), dt.date(2023, 1, 2)]
    if missing_date:
        od.append(dt.date(2023, 3, 1))
    if null_date:
        od.append(None)
    orders = spark.createDataFrame([(d,) for d in od], "order_date date")
    cal = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),)], "date_key date")
    tiers = ["High"] * 2 + ["Medium"] * 6 + ["Low"] * 2
    clv = spark.createDataFrame([(f"u{i}", dt.date(2023, 1, 2), t) for i, t in enumerate(tiers)]
                                + [("old", dt.date(2022, 1, 1), "High")],
                                "user_id string, snapshot_date date, clv_tier string")
    trends = spark.createDataFrame([(100.0, 90.0)], "net_revenue double, gross_revenue double")
    return items, orders, cal, clv, trends


def test_gates_pass(spark):
    report = quality.qc_report(*frames(spark), expected_items=10)
    rows = quality.raise_if_failed(report)
    assert len(rows) == 5 and all(r[1] for r in rows)


def test_wrong_count_raises(spark):
    with pytest.raises(quality.QualityGateError):
        quality.raise_if_failed(quality.qc_report(*frames(spark), expected_items=11))


def test_missing_and_null_order_dates_fail_coverage(spark):
    _, orders, cal, _, _ = frames(spark, missing_date=True, null_date=True)
    assert quality.calendar_gaps(orders, cal).count() == 2


def test_empty_snapshot_fails_cleanly(spark):
    items, orders, cal, clv, trends = frames(spark)
    report = {r.gate: r for r in quality.qc_report(items, orders, cal, clv.limit(0), trends).collect()}
    assert report["clv_high_tier_share"].passed is False
    assert report["clv_high_tier_share"].observed is None


def test_a_lost_row_turns_the_count_red(spark, sf_small):
    """The expectation comes from the raw lines: read, less those dropped for a reason."""
    from orderlens.operators import cleaning
    from orderlens.plans.queries import silver
    from orderlens.sources import fixtures

    s = silver(spark, sf_small)
    raw = fixtures.order_items(spark, sf_small)
    rest = list(frames(spark))[1:]
    gate = lambda items: quality.qc_report(items, *rest, raw_items=raw, dev_app_name=fixtures.DEV_APP_NAME).first()
    items = s["s_order_items"]
    assert gate(items).passed and gate(items).observed == items.count()
    one = items.select("order_id", "lineitem_id").first()
    assert not gate(items.filter(~((items.order_id == one[0]) & (items.lineitem_id == one[1])))).passed
    counts = raw.agg(*cleaning.line_counts(fixtures.DEV_APP_NAME)).first().asDict()
    assert quality.expected_lines(counts) == items.count() and counts["test_app"]


def test_each_dropped_line_has_one_reason(spark):
    from orderlens.contracts import ORDER_ITEMS_COLS, string_schema
    from orderlens.operators import cleaning

    base = dict.fromkeys(ORDER_ITEMS_COLS, "x")
    rows = [base, base | {"lineitem_id": None}, base | {"item_name": None, "app_name": " dev "}, base | {"app_name": None}, base | {"app_name": "dev"}]
    raw = spark.createDataFrame([tuple(r[c] for c in ORDER_ITEMS_COLS) for r in rows], string_schema(ORDER_ITEMS_COLS))
    counts = raw.agg(*cleaning.line_counts("dev")).first().asDict()
    assert counts == {"lines": 5, "malformed": 2, "no_app": 1, "test_app": 1}
    assert cleaning.clean_order_items(raw, "dev").count() == quality.expected_lines(counts) == 1


def test_chain_gates_read_no_table_again(spark, sf_small, monkeypatch):
    """The chain's gates come from figures observed during the writes; a row that is lost while
    Silver is written fails the run."""
    from orderlens.plans import daily
    from orderlens.session import scratch_path
    from orderlens.sources import fixtures

    sources = {"order_items": fixtures.order_items(spark, sf_small), "order_item_options": fixtures.order_item_options(spark, sf_small)}
    monkeypatch.setattr(quality, "qc_report", lambda *a, **k: pytest.fail("tables are read again"))
    zones = daily.Zones.under(scratch_path(spark, "t-gates"))
    out = daily.run_daily(spark, sources, zones, "2024-03-01", fixtures.DEV_APP_NAME)
    assert len(out["qc"]) == 5 and all(passed for _, passed, _ in out["qc"])
    clean = daily.cleaning.clean_order_items
    monkeypatch.setattr(daily.cleaning, "clean_order_items", lambda *a: clean(*a).filter("order_id != '7'"))
    with pytest.raises(quality.QualityGateError, match="silver_order_items_count"):
        daily.run_daily(spark, sources, zones, "2024-03-02", fixtures.DEV_APP_NAME)
