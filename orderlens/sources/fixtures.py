"""Driver tables → the engine's raw source contracts.

The engine consumes two all-string source tables, `order_items` and
`order_item_options` (see `contracts.py`). The test data available here is a TPC-H
style star schema, so this module maps `lineitem ⋈ orders ⋈ part` onto those contracts
with a fixed, documented rule set (FIXTURES.md §2): the same rules are written as SQL in
the oracle, so the cleaning steps themselves are checked rather than assumed.

Only the columns the mapping needs are read, and the joins are plain equi-joins on the
TPC-H keys, so Catalyst prunes the scans and may broadcast `part` when it is small.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import deal_out, default_parallelism, passes, spare_disk

# Fixed values of the mapping (FIXTURES.md §2).
DEV_APP_NAME = "shop - DEVELOPMENT"
LIVE_APP_NAME = "shop"
DEV_ORDER_MODULUS = 251          # every 251st order is a test-app order
LOCATIONS = 27                   # restaurant_id = 'R' || orderkey % 27
GUEST_CUSTOMER_MODULUS = 11      # customers with custkey % 11 = 0 order as guests
MALFORMED_MODULUS = 9973         # (orderkey*7 + linenumber) % 9973 = 0 → malformed line
OPTION_DUP_MODULUS = 89          # options of orderkey % 89 = 0 are landed twice


def _read(spark: SparkSession, sf_dir: str, table: str, spread_by: tuple = ()) -> DataFrame:
    """Scan one table. A file that is one row group is read by one task, and everything
    up to the first shuffle would run there; such an under-split scan is spread by a hash
    of `spread_by` — the full line key, so even an order holding a third of all lines is
    spread over its line numbers, parts and suppliers (and, unlike round-robin, no sort is
    needed to make the spread repeatable). A real table with enough splits is left alone
    (no extra shuffle)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    if spread_by:  # the largest table
        deal_out(spark, df)
        spare_disk(spark)
        par = default_parallelism(spark)
        try:
            splits = df.rdd.getNumPartitions()
        except Exception:  # noqa: BLE001 - no RDD view on this session kind: leave as is
            splits = par
        if splits < par:
            df = df.repartition(par, *spread_by)
    return df


def join_passes(spark: SparkSession, sf_dir: str) -> int:
    """The passes over orders in which `order_items` is best evaluated: both of its joins shuffle the lines."""
    return passes(*[_read(spark, sf_dir, t) for t in ("lineitem", "orders")])


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _lineitem_id(l: DataFrame):
    return F.concat(l.l_linenumber.cast("string"), F.lit("-"), l.l_partkey.cast("string"),
                    F.lit("-"), l.l_suppkey.cast("string"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _read(spark, sf_dir, "lineitem", LINE_KEY).alias("l")
    o = _read(spark, sf_dir, "orders").alias("o")  # broadcast when small, else shuffled by key
    p = _read(spark, sf_dir, "part").alias("p")
    key = F.col("o.o_orderkey")
    malformed = ((F.col("l.l_orderkey") * 7 + F.col("l.l_linenumber")) % MALFORMED_MODULUS) == 0
    urgent = F.col("o.o_orderpriority") == "1-URGENT"
    j = (l.join(o, F.col("l.l_orderkey") == key)
         .join(p, F.col("l.l_partkey") == F.col("p.p_partkey")))
    return j.select(
        F.when(key % DEV_ORDER_MODULUS == 0,
               F.when(key % 2 == 0, F.lit(DEV_APP_NAME))
                .otherwise(F.lit(f"  {DEV_APP_NAME}  ")))
         .otherwise(F.lit(LIVE_APP_NAME)).alias("app_name"),
        F.concat(F.lit("R"), (key % LOCATIONS).cast("string")).alias("restaurant_id"),
        F.concat(F.col("o.o_orderdate").cast("date").cast("string"), F.lit("T10:00:00"),
                 F.when(key % 3 == 0, F.lit("Z")).otherwise(F.lit(".123Z")))
         .alias("creation_time_utc"),
        key.cast("string").alias("order_id"),
        F.when(F.col("o.o_custkey") % GUEST_CUSTOMER_MODULUS != 0,
               F.col("o.o_custkey").cast("string"))
         .when(key % 3 == 0, F.lit(None).cast("string"))
         .when(key % 3 == 1, F.lit(""))
         .otherwise(F.lit("   ")).alias("user_id"),
        F.when(urgent, F.concat(F.lit("C"), F.col("o.o_custkey").cast("string")))
         .alias("printed_card_number"),
        F.when(urgent, F.lit("TRUE")).otherwise(F.lit("FALSE")).alias("is_loyalty"),
        F.lit("USD").alias("currency"),
        F.when(malformed, F.lit(None).cast("string"))
         .otherwise(_lineitem_id(l)).alias("lineitem_id"),
        F.col("p.p_type").alias("item_category"),
        F.when(malformed, F.lit(None).cast("string"))
         .otherwise(F.col("p.p_name")).alias("item_name"),
        F.col("p.p_retailprice").cast("string").alias("item_price"),
        F.col("l.l_quantity").cast("int").cast("string").alias("item_quantity"),
    )


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = _read(spark, sf_dir, "lineitem", LINE_KEY)
    even = l.filter(l.l_linenumber % 2 == 0)
    price = ((F.round(even.l_tax * 100).cast("int") * 25).cast("decimal(18,0)")
             / F.lit(100)).cast("decimal(9,2)").cast("string")
    opts = even.select(
        even.l_orderkey.cast("string").alias("order_id"),
        _lineitem_id(even).alias("lineitem_id"),
        F.concat(F.lit("G"), even.l_linenumber.cast("string")).alias("option_group_name"),
        even.l_returnflag.alias("option_name"),
        price.alias("option_price"),
        F.lit("1").alias("option_quantity"),
        even.l_orderkey.alias("_k"),
    )
    dup = opts.filter(F.col("_k") % OPTION_DUP_MODULUS == 0)
    return opts.unionByName(dup).drop("_k")
