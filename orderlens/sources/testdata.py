"""Mapping of the TPC-H-style test tables onto the source and star schemas.

The test folders hold ``orders``, ``lineitem``, ``customer``, ``nation`` and
``part``; this module shapes them into the restaurant-order tables the ETL and
the reports read (see FIXTURES.md §4). Every frame is a lazy plan over the
parquet scans, so filters and column pruning reach the files.

Joins are left to the optimizer: none of the joined tables has a size bound
that holds at every scale (customers grow with the data), so no broadcast is
forced here; AQE broadcasts a side at run time when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and sort-merges otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.operators import conform

# Fixed values of the mapping (FIXTURES.md §4).
NULL_APP_EVERY = 97                      # every 97th order key has no app name
ANONYMOUS_PRIORITY = "4-NOT SPECIFIED"   # with status 'P': anonymous user
ANONYMOUS_STATUS = "P"
LOYALTY_SEGMENTS = ("BUILDING", "HOUSEHOLD")
CARD_MODULUS = 10000
HOURS_IN_DAY = 24
DISCOUNT_MIN = 0.08                      # l_discount >= this: a DISCOUNT option row
EXTRA_MIN = 0.06                         # l_tax >= this: an EXTRA option row
HOLIDAY_MONTH, HOLIDAY_DAY = 12, 25

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the test tables used here: reads never infer (no footer-reading
# job per read; on a cluster, no listing of every file's footer).
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TEST_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _creation_time() -> F.Column:
    hours = (F.col("o_orderkey") % HOURS_IN_DAY).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(hours=hours)


def _orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = (read_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey))


def order_items_typed(spark: SparkSession, sf_dir: str, creation_time: Callable[[], F.Column] = _creation_time) -> DataFrame:
    """``order_items`` with typed columns (timestamp, int, decimal)."""
    # once an order, below the join with its lines
    oc = _orders_with_customer(spark, sf_dir).withColumn("creation_time_utc", creation_time())
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    joined = (oc.join(lineitem, oc.o_orderkey == lineitem.l_orderkey)
              .join(part, lineitem.l_partkey == part.p_partkey))
    anonymous = (F.col("o_orderpriority") == ANONYMOUS_PRIORITY) & (F.col("o_orderstatus") == ANONYMOUS_STATUS)
    return joined.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("lineitem_id"),
        F.when(F.col("o_orderkey") % NULL_APP_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_orderpriority")).alias("app_name"),
        F.col("n_name").alias("restaurant_id"),
        F.when(anonymous, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        (F.col("o_custkey") % CARD_MODULUS).cast("string").alias("printed_card_number"),
        F.col("c_mktsegment").isin(*LOYALTY_SEGMENTS).alias("is_loyalty"),
        "creation_time_utc",
        F.lit("USD").alias("currency"),
        F.col("p_type").alias("item_category"),
        F.col("p_name").alias("item_name"),
        F.col("l_quantity").cast("int").alias("item_quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("decimal(20,4)").alias("item_price"),
    )


def order_items_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_items`` as the landing zone holds it: creation time as ISO text."""
    return order_items_typed(
        spark, sf_dir, lambda: F.date_format(_creation_time(), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def order_item_options_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_item_options``: a DISCOUNT row (negative price) and an EXTRA row per line."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    price = F.col("l_extendedprice").cast("decimal(12,2)")

    def branch(cond, group, name_col, amount):
        return li.filter(cond).select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("string").alias("lineitem_id"),
            F.lit(group).alias("option_group_name"),
            F.col(name_col).alias("option_name"),
            F.lit(1).alias("option_quantity"),
            amount.cast("decimal(20,4)").alias("option_price"))

    discount = branch(F.col("l_discount") >= DISCOUNT_MIN, "DISCOUNT", "l_returnflag",
                      -price * F.col("l_discount").cast("decimal(4,2)"))
    extra = branch(F.col("l_tax") >= EXTRA_MIN, "EXTRA", "l_linestatus",
                   price * F.col("l_tax").cast("decimal(4,2)"))
    return discount.unionByName(extra)


def date_dim_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderdate")
    return orders.select(
        F.to_date("o_orderdate").alias("date_key"),
        F.year("o_orderdate").cast("int").alias("year"),
        ((F.month("o_orderdate") == HOLIDAY_MONTH) & (F.dayofmonth("o_orderdate") == HOLIDAY_DAY))
        .alias("is_holiday"),
    ).distinct()


def date_dim_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date_dim`` as the landing zone holds it: key as ``dd-MM-yyyy`` text, year as text."""
    return date_dim_typed(spark, sf_dir).select(
        F.date_format("date_key", "dd-MM-yyyy").alias("date_key"),
        F.col("year").cast("string").alias("year"),
        "is_holiday")


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated ``fact_orders`` straight from ``orders`` (so some orders have no items)."""
    oc = _orders_with_customer(spark, sf_dir)
    anonymous = (F.col("o_orderpriority") == ANONYMOUS_PRIORITY) & (F.col("o_orderstatus") == ANONYMOUS_STATUS)
    return oc.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("n_name").alias("restaurant_id"),
        F.when(anonymous, F.lit("UNKNOWN")).otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        (F.col("o_custkey") % CARD_MODULUS).cast("string").alias("printed_card_number"),
        F.col("c_mktsegment").isin(*LOYALTY_SEGMENTS).alias("is_loyalty"),
        _creation_time().alias("creation_time_utc"),
        F.lit("USD").alias("currency_used"),
    )


@dataclass(frozen=True)
class Star:
    """The curated tables the reports read."""
    fact_orders: DataFrame
    fact_items: DataFrame
    fact_items_options: DataFrame
    date_dim: DataFrame


def star(spark: SparkSession, sf_dir: str) -> Star:
    """Curated star over the test tables; facts go through the conforming transforms."""
    return Star(
        fact_orders=fact_orders(spark, sf_dir),
        fact_items=conform.fact_items(order_items_typed(spark, sf_dir)),
        fact_items_options=conform.fact_item_options(order_item_options_source(spark, sf_dir)),
        date_dim=date_dim_typed(spark, sf_dir),
    )
