"""The driver tables under marketplace names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.joins import dim_join

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def items(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax").cast("decimal(6,2)") * F.col("l_extendedprice").cast("decimal(14,2)"))
        .cast("double")
        .alias("freight"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_shipdate").alias("ship_date"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("kind"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail_price"),
    )


def translations(spark: SparkSession, sf: str) -> DataFrame:
    """English names of the categories; one category has none."""
    return (
        raw(spark, sf, "part")
        .select(F.col("p_brand").alias("category"))
        .distinct()
        .filter(F.col("category") != "Brand#13")
        .withColumn("category_en", F.regexp_replace("category", "Brand#", "category "))
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Nation and region names by nation key (both tables are tiny and fixed)."""
    regions = raw(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state"))
    nations = raw(spark, sf, "nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("city"))
    return dim_join(nations, regions, ["n_regionkey"]).select(F.col("n_nationkey").alias("zip"), "city", "state")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    base = raw(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("market"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("zip"),
    )
    return dim_join(base, places(spark, sf), ["zip"]).withColumnsRenamed(
        {"city": "customer_city", "state": "customer_state", "zip": "customer_zip"}
    )


def sellers(spark: SparkSession, sf: str) -> DataFrame:
    base = raw(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller_name"), F.col("s_nationkey").alias("zip")
    )
    return dim_join(base, places(spark, sf), ["zip"]).withColumnsRenamed(
        {"city": "seller_city", "state": "seller_state", "zip": "seller_zip"}
    )


def geolocation(spark: SparkSession, sf: str) -> DataFrame:
    """Many rows per zip prefix: one per customer, placed by the account balance."""
    base = raw(spark, sf, "customer").select(F.col("c_nationkey").alias("zip"), F.col("c_acctbal").alias("lat"), F.col("c_custkey").cast("double").alias("lng"))
    return dim_join(base, places(spark, sf), ["zip"])


def payments(spark: SparkSession, sf: str) -> DataFrame:
    return orders(spark, sf).select(
        "order_id",
        F.lit(1).alias("payment_sequential"),
        F.col("priority").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("total").alias("payment_value"),
        "customer_id",
    )


def review_score(quantity: Column) -> Column:
    return (1 + quantity.cast("int") % 5).cast("int")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """One review per order that has items; the score (1–5) follows from the largest quantity."""
    return (
        items(spark, sf)
        .groupBy("order_id")
        .agg(review_score(F.max("quantity")).alias("score"))
        .withColumn("review_id", F.concat(F.lit("r"), F.col("order_id").cast("string")))
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    return raw(spark, sf, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price"),
        "props",
    )


def stamp(c: Column | str) -> Column:
    """A timestamp as text, so that results compare across engines."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# SQL counterparts of the derived tables above.
SQL_PLACES = (
    "places AS (SELECT n_nationkey AS zip, n_name AS city, r_name AS state FROM nation "
    "JOIN region ON n_regionkey = r_regionkey)"
)
SQL_REVIEWS = (
    "reviews AS (SELECT l_orderkey AS order_id, CAST(1 + CAST(max(l_quantity) AS INTEGER) % 5 AS INTEGER) AS score "
    "FROM lineitem GROUP BY l_orderkey)"
)
SQL_DELIVERED = (
    "delivered AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, "
    "o_orderdate AS order_date, o_orderdate + INTERVAL 30 DAY AS estimated, "
    "(SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey) AS actual FROM orders)"
)
SQL_DAILY = (
    "daily AS (SELECT CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
    "FROM orders GROUP BY 1)"
)
SQL_MONTHLY = (
    "monthly AS (SELECT p_brand AS category, strftime(l_shipdate, '%Y-%m') AS ym, "
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
    "FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
)
