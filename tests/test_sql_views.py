"""Views as SQL functions: arguments, defaults, both kinds of functions; distinct counts."""
from pyspark.sql import functions as F

from orderlens.operators import views
from orderlens.operators.distinct import distinct_counts
from orderlens.plans import io_queries, sql_views


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_views_take_arguments(spark, sf_small):
    database = io_queries.published_gold(spark, sf_small)
    sql_views.publish_views(spark, database, temporary=True)
    sales, churn = spark.table(f"{database}.g_fact_sales_trends"), spark.table(f"{database}.g_fact_churn_indicators")
    assert rows(spark.sql("SELECT * FROM v_sales_monthly(array('PROMO'), array('R1', 'R2'))")) == rows(
        views.sales_monthly(views.filter_sales(sales, ["PROMO"], ["R1", "R2"])))
    assert rows(spark.sql("SELECT * FROM v_sales_kpis(locations => array('R3'))")) == rows(views.sales_kpis(views.filter_sales(sales, [], ["R3"])))
    for days in (0, 30, 400):
        assert rows(spark.sql(f"SELECT * FROM v_at_risk_share({days})")) == rows(views.at_risk_share(churn, days))
        assert rows(spark.sql(f"SELECT * FROM v_at_risk_customers({days})")) == rows(views.at_risk_customers(churn, days))
    assert rows(spark.sql("SELECT * FROM v_churn_histogram()")) == rows(views.churn_histogram(churn))
    assert spark.sql("SELECT half_up(5, 2, 0), half_up(-5, 2, 0), half_up(1, 3, 2), half_up(1, 0, 2)").first() == (3, -3, 33, None)


def test_filters_reach_the_scan(spark, sf_small):
    sql_views.publish_views(spark, io_queries.published_gold(spark, sf_small), temporary=True)
    plan = spark.sql("SELECT net_revenue FROM v_sales() WHERE restaurant_id = 'R5'")._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    assert "EqualTo(restaurant_id,R5)" in scan and "holiday_name" not in scan.split("ReadSchema")[1]


def test_functions_of_the_database(spark, sf_small):
    database = io_queries.published_gold(spark, sf_small)
    names = sql_views.publish_views(spark, database)
    before = spark.catalog.currentDatabase()
    try:
        spark.catalog.setCurrentDatabase(database)
        assert all(spark.catalog.functionExists(f"{database}.{n}") for n in names)
        assert spark.sql("SELECT * FROM v_filter_values()").count() > 0
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "x"), (None, 2, None), ("b", None, None)], "g string, n int, t string")
    got = distinct_counts(df, {"ns": F.col("n"), "ts": F.col("t")}, ["g"])
    assert rows(got) == [("a", 1, 2), (None, 1, 0)]  # a group without values has no row
    assert rows(distinct_counts(df, {"ns": F.col("n"), "ts": F.col("t")})) == [(2, 2)]
    assert rows(distinct_counts(df.limit(0), {"ns": F.col("n")})) == [(0,)]
