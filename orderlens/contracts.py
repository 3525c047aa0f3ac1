"""Column contracts of the source and published tables: fixed values."""
from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

ORDER_ITEMS_COLS = [
    "app_name", "restaurant_id", "creation_time_utc", "order_id", "user_id",
    "printed_card_number", "is_loyalty", "currency", "lineitem_id",
    "item_category", "item_name", "item_price", "item_quantity",
]
ORDER_ITEM_OPTIONS_COLS = [
    "order_id", "lineitem_id", "option_group_name", "option_name",
    "option_price", "option_quantity",
]
DATE_DIM_COLS = [
    "date_key", "year", "month", "week", "day_of_week",
    "is_weekend", "is_holiday", "holiday_name",
]
SOURCE_COLUMNS = {
    "order_items": ORDER_ITEMS_COLS,
    "order_item_options": ORDER_ITEM_OPTIONS_COLS,
}


def string_schema(cols: list[str], upper: bool = False) -> StructType:
    """All-string schema for a raw source (sources arrive as text, never inferred)."""
    return StructType([StructField(c.upper() if upper else c, StringType(), True) for c in cols])


# Published Gold tables (the registry a reader checks names against).
GOLD_TABLES = [
    "g_fact_customer_clv_daily", "g_dim_customer_rfm", "g_fact_churn_indicators",
    "g_fact_sales_trends", "g_fact_loyalty_impact", "g_fact_location_performance",
    "g_fact_addon_revenue",
]
SILVER_TABLES = ["s_order_items", "s_order_item_options", "s_date_dim", "s_order_lines", "s_orders"]
