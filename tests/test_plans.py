"""Physical-plan properties the engine is built for."""
import importlib

import pytest

E = importlib.import_module("__spark_entry__")
IO_QUERIES = {"casing", "csv_scan", "csv_multiline_scan", "bronze_stamp", "batch_overwrite",
              "zone_overwrite", "snapshot_upsert", "write_row_counts", "publish_catalog",
              "daily_reload", "landing_stream_ingest", "publish_partitions", "clv_refresh_append",
              "clv_refresh_correction", "gold_read", "csv_header_groups", "csv_rejects"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_products_or_nested_loop_joins(spark, sf_small):
    bad = {}
    for name, fn in E.queries().items():
        if name in IO_QUERIES:
            continue
        plan = plan_of(fn(spark, sf_small))
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_clv_daily_scan_is_pruned_and_filtered(spark, sf_small):
    from orderlens.operators import clv
    from orderlens.plans.queries import silver

    df = clv.clv_daily(silver(spark, sf_small)["s_orders"], with_tiers=False)
    plan = plan_of(df)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert any("ReadSchema: struct<order_date:date>" in line for line in scans)  # the subquery
    scan = [line for line in scans if "user_id" in line][0]
    assert "IsNotNull(user_id)" in scan and "LessThanOrEqual(order_date" in scan
    read_schema = scan.split("ReadSchema: ")[1]
    assert "restaurant_id" not in read_schema and "is_loyalty" not in read_schema


def test_churn_is_a_single_aggregation(spark, sf_small):
    from orderlens.operators import marts
    from orderlens.plans.queries import silver

    plan = plan_of(marts.build_churn(silver(spark, sf_small)["s_orders"]))
    main = plan.split("Subqueries")[0] if "Subqueries" in plan else plan
    assert "Join" not in main.split("Subquery")[0]


def test_as_of_clv_has_no_range_join(spark, sf_small):
    from orderlens.operators import calendar as cal_ops
    from orderlens.operators import clv
    from orderlens.plans.queries import silver

    s = silver(spark, sf_small)
    plan = plan_of(clv.clv_as_of(s["s_orders"], cal_ops.month_end_snapshots(s["s_date_dim"]),
                                 with_tiers=False))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin" in plan
