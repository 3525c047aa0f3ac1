"""Source profiling: the integrity figures published about the raw extract.

One aggregate for the plain counts, one for the distinct ones. Medians are actual data values (the lower middle one for an
even count), found as cut points.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import parse_price, parse_quantity
from ..functions.timeparse import parse_iso_ts
from ..session import in_passes
from .cleaning import standardize_casing
from .cutpoints import key_cuts
from .distinct import distinct_counts


_MICRO = 1_000_000  # prices have six places


def _medians(values: DataFrame) -> tuple[int | None, int | None]:
    """values(price DECIMAL(18,6), qty) → of each the least value that half of the non-null
    rows don't exceed, in millionths: both medians are found in one pass."""
    each = [F.struct(F.lit(c).alias("of"), (F.col(c) * _MICRO).cast("long").alias("value")) for c in ("price", "qty")]
    long = values.select(F.explode(F.array(*each)).alias("x")).select("x.of", "x.value").filter("value IS NOT NULL")
    cuts = key_cuts(long, 2, "value", ["of"])
    return tuple(cuts.get((c,), [None])[0] for c in ("price", "qty"))


def source_profile(raw_items: DataFrame) -> DataFrame:
    df = standardize_casing(raw_items)
    blank_user = F.col("user_id").isNull() | (F.trim(F.col("user_id")) == "")
    loyalty = F.lower(F.trim(F.col("is_loyalty")))
    price, qty = parse_price(F.col("item_price")), parse_quantity(F.col("item_quantity"))
    medians = _medians(df.select(price.alias("price"), qty.cast("long").alias("qty")))
    df = df.select("order_id", "user_id", "restaurant_id", "item_category", "printed_card_number", "currency",
                   blank_user.alias("_guest"), loyalty.alias("_loyalty"),
                   price.cast("double").alias("_price"), qty.alias("_qty"), (price * qty).alias("_gross"))
    g = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_guest")).alias("guest_lines"),
        F.count_if(F.col("item_category").isNull()).alias("null_categories"),
        F.count_if(F.col("printed_card_number").isNull()).alias("null_cards"),
        F.count_if(F.col("_loyalty") == "true").alias("loyalty_true_lines"),
        F.count_if(F.col("_loyalty") == "false").alias("loyalty_false_lines"),
        F.min("_price").alias("price_min"), F.max("_price").alias("price_max"),
        F.min("_qty").alias("qty_min"), F.max("_qty").alias("qty_max"),
        F.count_if(F.col("_price") == 0).alias("zero_price_lines"),
        F.count_if(F.col("_qty") == 0).alias("zero_qty_lines"),
        F.count_if(F.col("_price") < 0).alias("negative_price_lines"),
        F.count_if(F.col("_price").isNull()).alias("unparsed_price_lines"),
        F.round(F.sum("_gross"), 2).cast("double").alias("gross_revenue"),
    )
    different = distinct_counts(df, {
        "distinct_orders": F.col("order_id"), "distinct_users": F.when(~F.col("_guest"), F.col("user_id")),
        "distinct_locations": F.col("restaurant_id"), "distinct_categories": F.col("item_category"), "distinct_currencies": F.col("currency")})
    found = different.select(F.struct("*")).scalar()
    price_median, qty_median = medians
    return g.withColumn("_d", found).select(*g.columns, *[F.col("_d")[c].alias(c) for c in different.columns], (F.lit(price_median).cast("decimal(38,0)") / _MICRO).cast("double").alias("price_median"),
                    F.lit(None if qty_median is None else qty_median // _MICRO).cast("int").alias("qty_median"),
                    F.try_divide(F.col("guest_lines"), F.col("rows")).alias("guest_share"),
                    F.try_divide(F.col("null_cards"), F.col("rows")).alias("null_card_share"))


def lines_by_year(raw_items: DataFrame) -> DataFrame:
    """Raw lines of each year (null: no readable date) and the share of all lines that a
    calendar of that year alone would match."""
    df = standardize_casing(raw_items)
    g = (df.groupBy(F.year(parse_iso_ts(F.col("creation_time_utc"))).alias("year"))
         .agg(F.count(F.lit(1)).alias("lines")))
    # One row a year: an unpartitioned window here is cheap.
    total = F.sum("lines").over(Window.partitionBy())
    return g.select("year", "lines", F.when(F.col("year").isNotNull(), F.try_divide(F.col("lines"), total)).alias("calendar_share"))


def grain_duplicates(s_items: DataFrame) -> DataFrame:
    """(order_id, lineitem_id) keys that occur more than once in Silver. Keys of a large table are counted in passes."""
    key = ["order_id", "lineitem_id"]
    counted = lambda rows: rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
    return in_passes(s_items.select(*key), key, counted, "grain-duplicates")


def orders_by_year(s_orders: DataFrame) -> DataFrame:
    total = s_orders.select(F.count_distinct("order_id")).scalar()
    g = (s_orders.groupBy(F.year("order_date").alias("year"))
         .agg(F.count_distinct("order_id").alias("orders")))
    return g.withColumn("share", F.try_divide(F.col("orders"), total))


def option_integrity(s_items: DataFrame, s_options: DataFrame) -> DataFrame:
    """Options with no matching line (orphans) and the share of lines with an option."""
    keys = ["order_id", "lineitem_id"]
    lines = s_items.select(*keys)
    opts = s_options.select(*keys)
    orphans = opts.join(lines.distinct(), keys, "left_anti").select(F.count(F.lit(1))).scalar()
    with_opt = lines.join(opts.distinct(), keys, "left_semi").select(F.count(F.lit(1))).scalar()
    total_opts = opts.select(F.count(F.lit(1))).scalar()
    g = lines.agg(F.count(F.lit(1)).alias("lines"))
    return g.select(total_opts.alias("options"), orphans.alias("orphan_options"), "lines",
                    with_opt.alias("lines_with_option"),
                    F.try_divide(with_opt, F.col("lines")).alias("lines_with_option_share"))


def guest_profile(items: DataFrame) -> DataFrame:
    """Lines, orders and customers of guests and of identified customers. Two narrow aggregates
    that combine map-side, by order and by customer, instead of one over an `Expand` of all lines."""
    orders = (items.groupBy("is_guest", "order_id").agg(F.count(F.lit(1)).alias("lines"))
              .groupBy("is_guest").agg(F.sum("lines").alias("lines"), F.count("order_id").alias("orders")))
    customers = distinct_counts(items, {"customers": F.col("user_id")}, ["is_guest"]).withColumnRenamed("is_guest", "_g")
    return (orders.join(customers, orders.is_guest.eqNullSafe(customers["_g"]), "left")
            .select("is_guest", "lines", "orders", F.coalesce("customers", F.lit(0)).alias("customers")))
