"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import joins, skew
from mercato.operators.metrics import total as money_total
from mercato.plans import tables as t
from mercato.plans.registry import query, total


@query(
    f"""
    SELECT p_brand AS category, count(*) AS n, {total('l_extendedprice')} AS revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
    """
)
def jn1_items_products(spark: SparkSession, sf: str) -> DataFrame:
    joined = joins.dim_join(t.items(spark, sf), t.products(spark, sf), ["product_id"])
    return joined.groupBy("category").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


_TRANSLATED = "(SELECT DISTINCT p_brand AS b, replace(p_brand, 'Brand#', 'category ') AS category_en FROM part WHERE p_brand <> 'Brand#13')"


@query(
    f"""
    SELECT category_en, {total('l_extendedprice')} AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN {_TRANSLATED} ON b = p_brand GROUP BY 1
    """
)
def jn2_three_way_inner(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.items_enriched(t.items(spark, sf), t.products(spark, sf), t.translations(spark, sf))
    return df.groupBy("category_en").agg(money_total("price").alias("revenue"))


@query(
    f"""
    SELECT category_en, {total('l_extendedprice')} AS revenue FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN {_TRANSLATED} ON b = p_brand GROUP BY 1
    """
)
def jn2_three_way_left(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.items_enriched(t.items(spark, sf), t.products(spark, sf), t.translations(spark, sf), "left")
    return df.groupBy("category_en").agg(money_total("price").alias("revenue"))


_SELLER_SQL = (
    f"WITH {t.SQL_PLACES} SELECT state AS seller_state, count(*) AS n, {total('l_extendedprice')} AS revenue "
    "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN places ON zip = s_nationkey GROUP BY 1"
)


@query(_SELLER_SQL)
def jn3_checked_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.dim_join(t.items(spark, sf), t.sellers(spark, sf), ["seller_id"])
    return df.groupBy("seller_state").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


@query(_SELLER_SQL)
def jn3_salted_beyond_size(spark: SparkSession, sf: str) -> DataFrame:
    """The same join with every seller treated as hot, which is what a dimension too big to broadcast takes."""
    df = skew.skew_join(t.items(spark, sf), t.sellers(spark, sf), ["seller_id"], rows_per_task=200, max_bytes=0)
    return df.groupBy("seller_state").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


@query(
    f"""
    SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, {total('l_extendedprice')} AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
    """
)
def jn4_sort_merge(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.merge_join(t.items(spark, sf), t.orders(spark, sf), ["order_id"])
    return df.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


@query(
    f"""
    WITH {t.SQL_PLACES}
    SELECT p_type AS kind, b.state AS customer_state, s.state AS seller_state, count(*) AS n,
      {total('l_extendedprice')} AS revenue
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN places s ON s.zip = s_nationkey
    JOIN customer ON c_custkey = o_custkey JOIN places b ON b.zip = c_nationkey GROUP BY 1, 2, 3
    """
)
def jn5_five_table_star(spark: SparkSession, sf: str) -> DataFrame:
    df = joins.star(
        t.orders(spark, sf), t.items(spark, sf), t.products(spark, sf), t.sellers(spark, sf), t.customers(spark, sf)
    )
    return df.groupBy("kind", "customer_state", "seller_state").agg(
        F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue")
    )


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def jn6_orders_without_items(spark: SparkSession, sf: str) -> DataFrame:
    return joins.orphans(t.orders(spark, sf), t.items(spark, sf), "order_id", "order_id").select("order_id", "customer_id")


@query(
    f"""
    WITH {t.SQL_PLACES}, geo AS (SELECT c_nationkey AS zip, avg(c_acctbal) AS lat, avg(CAST(c_custkey AS DOUBLE)) AS lng
      FROM customer GROUP BY 1)
    SELECT s_suppkey AS seller_id, round(lat, 8) AS lat, round(lng, 8) AS lng, city, state FROM supplier
    LEFT JOIN geo ON geo.zip = s_nationkey LEFT JOIN places ON places.zip = s_nationkey
    """
)
def jn7_geolocation(spark: SparkSession, sf: str) -> DataFrame:
    centroids = joins.zip_centroids(t.geolocation(spark, sf), "zip", "lat", "lng", "city", "state")
    sellers = t.sellers(spark, sf).select("seller_id", "seller_zip")
    placed = joins.with_geo(sellers, centroids, "seller_zip")
    return placed.select("seller_id", F.round("lat", 8).alias("lat"), F.round("lng", 8).alias("lng"), "city", "state")


_CUT = "TIMESTAMP '2000-01-01'"


@query(
    f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS year_month, {total('o_totalprice')} AS revenue, count(*) AS n
    FROM orders GROUP BY 1
    """
)
def jn9_batch_and_speed_view(spark: SparkSession, sf: str) -> DataFrame:
    """The batch view ends with 1999; the speed view holds what came after and one month both know."""
    monthly = F.date_format("order_date", "yyyy-MM").alias("year_month")
    df = t.orders(spark, sf).groupBy(monthly).agg(money_total("total").alias("revenue"), F.count(F.lit(1)).alias("n"))
    batch = df.filter("year_month < '2000-01'")
    speed = df.filter("year_month >= '1999-12'").withColumn(
        "revenue", F.when(F.col("year_month") == "1999-12", 0.0).otherwise(F.col("revenue"))
    )
    return joins.serve(batch, speed, ["year_month"])


@query(f"SELECT o_orderstatus AS status, count(*) AS n, {total('o_totalprice')} AS revenue FROM orders GROUP BY 1")
def jn9_union_by_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf)
    cutoff = F.lit("2000-01-01").cast("timestamp_ntz")
    merged = joins.serve_by_cutoff(df, df, "order_date", cutoff)
    return merged.groupBy("status").agg(F.count(F.lit(1)).alias("n"), money_total("total").alias("revenue"))


@query(
    f"""
    WITH a AS (SELECT l_suppkey AS k, {total('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1),
    b AS (SELECT l_suppkey AS k, {total('l_extendedprice')} AS revenue FROM lineitem
      WHERE l_returnflag <> 'R' OR l_suppkey > 20 GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS seller_id, CASE WHEN a.k IS NULL THEN 'missing_left' WHEN b.k IS NULL THEN 'missing_right'
      WHEN a.revenue = b.revenue THEN 'matched' ELSE 'differs' END AS status
    FROM (SELECT * FROM a WHERE k <> 3) a FULL JOIN (SELECT * FROM b WHERE k <> 5) b ON a.k = b.k
    """
)
def jn10_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf)
    revenue = money_total("price").alias("revenue")
    a = df.groupBy("seller_id").agg(revenue).filter("seller_id <> 3")
    b = df.filter("return_flag <> 'R' OR seller_id > 20").groupBy("seller_id").agg(revenue).filter("seller_id <> 5")
    return joins.reconcile(a, b, ["seller_id"], ["revenue"]).select("seller_id", "status")
