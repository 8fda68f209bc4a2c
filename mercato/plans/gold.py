"""Aggregates, top-k, custom functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import scalar
from mercato.functions.register import register_all
from mercato.operators import documents, metrics, shaping, windows
from mercato.operators.joins import dim_join, skew_join
from mercato.plans import tables as t
from mercato.plans.registry import query, text, total
from mercato.session import pin


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Items with their product's category and kind."""
    return dim_join(t.items(spark, sf), t.products(spark, sf).select("product_id", "category", "kind"), ["product_id"], spread_by=["order_id"])


@query(
    f"""
    SELECT p_brand AS category, {total('l_extendedprice')} AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """
)
def top1_categories_by_revenue(spark: SparkSession, sf: str) -> DataFrame:
    revenue = metrics.revenue_via(t.items(spark, sf), t.products(spark, sf), "product_id", "category")
    return metrics.top_k(revenue, "revenue", 10, ["category"])


@query("SELECT count(*) AS n FROM lineitem")
def agg1_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return t.items(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT p_brand AS category, {total('l_extendedprice')} AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def agg2_revenue_by_category(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.revenue_via(t.items(spark, sf), t.products(spark, sf), "product_id", "category")


@query("SELECT p_brand AS category, round(sum(l_extendedprice * 0.001), 3) AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def agg2_revenue_of_small_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts below a cent count: the SQL sums plain doubles, without a cast to two decimals."""
    items = t.items(spark, sf).withColumn("price", F.col("price") * 0.001)
    revenue = metrics.revenue_via(items, t.products(spark, sf), "product_id", "category")
    return revenue.withColumn("revenue", F.round("revenue", 3))


@query(
    f"""
    SELECT p_brand AS category, strftime(o_orderdate, '%Y-%m') AS year_month, {total('l_extendedprice')} AS total_revenue,
      count(l_orderkey) AS order_count, {total('l_extendedprice')} / count(l_extendedprice) AS avg_order_value,
      count(DISTINCT o_custkey) AS unique_customers
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    """
)
def agg3_revenue_metrics(spark: SparkSession, sf: str) -> DataFrame:
    sales = skew_join(_lines(spark, sf), t.orders(spark, sf).select("order_id", "customer_id", "order_date"), ["order_id"], spread_by=["product_id"])
    sales = shaping.with_calendar(sales, "order_date")
    return metrics.revenue_metrics(sales, ["category", "year_month"], "price", "order_id", "customer_id")


_RFM = f"""
    rfm AS (SELECT o_custkey AS customer_id, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-02') AS INTEGER) AS recency,
      count(*) AS frequency, {total('o_totalprice')} AS monetary FROM orders GROUP BY 1)
"""
_SEGMENT = """CASE WHEN recency < 30 AND frequency > 10 AND monetary > 1000 THEN 'Champion'
      WHEN recency < 60 AND frequency > 5 THEN 'Loyal' ELSE 'At Risk' END"""


def _rfm(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2001-08-02").cast("date")
    return metrics.rfm(t.orders(spark, sf), "customer_id", "order_date", "total", as_of)


@query(f"WITH {_RFM} SELECT * FROM rfm")
def agg4_rfm(spark: SparkSession, sf: str) -> DataFrame:
    return _rfm(spark, sf)


@query(
    f"""
    WITH {t.SQL_REVIEWS}, lines AS (SELECT l_partkey, l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev, count(*) AS n
      FROM lineitem GROUP BY 1, 2),
    views AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS p, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT l_partkey AS product_id, CAST(sum(rev) AS DOUBLE) AS revenue, CAST(sum(n) AS BIGINT) AS units, count(*) AS orders,
      avg(score) AS avg_score, any_value(views) AS views, count(*) / any_value(views) AS conversion
    FROM lines LEFT JOIN reviews ON order_id = l_orderkey LEFT JOIN views ON p = l_partkey GROUP BY 1
    """
)
def agg5_product_performance(spark: SparkSession, sf: str) -> DataFrame:
    views = t.events(spark, sf).filter("category = 'view'").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id")
    )
    return metrics.product_performance(t.items(spark, sf), t.reviews(spark, sf), views)


@query(
    f"""
    WITH {t.SQL_PLACES} SELECT state AS seller_state, p_type AS kind, year(l_shipdate)::INTEGER AS year,
      {total('l_extendedprice')} AS revenue FROM lineitem JOIN part ON l_partkey = p_partkey
      JOIN supplier ON s_suppkey = l_suppkey JOIN places ON zip = s_nationkey GROUP BY 1, 2, 3
    """
)
def agg6_revenue_by_region_kind_year(spark: SparkSession, sf: str) -> DataFrame:
    df = dim_join(_lines(spark, sf), t.sellers(spark, sf), ["seller_id"], spread_by=["order_id"]).withColumn("year", F.year("ship_date"))
    return metrics.revenue_by(df, ["seller_state", "kind", "year"])


_SELLERS = f"""
    WITH {t.SQL_PLACES}, {t.SQL_REVIEWS}, {t.SQL_DELIVERED},
    so AS (SELECT l_suppkey, l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rev, count(*) AS units FROM lineitem GROUP BY 1, 2)
    SELECT s_suppkey AS seller_id, any_value(city) AS seller_city, any_value(state) AS seller_state, count(l_orderkey) AS total_orders,
      coalesce(CAST(sum(rev) AS DOUBLE), 0) AS total_revenue, avg(score) AS avg_review_score,
      CAST(coalesce(sum(units), 0) AS BIGINT) AS total_products_sold,
      avg(CASE WHEN actual < estimated + INTERVAL 1 DAY THEN 1 WHEN actual IS NOT NULL THEN 0 END) AS on_time_delivery_rate
    FROM supplier JOIN places ON zip = s_nationkey LEFT JOIN so ON l_suppkey = s_suppkey
    LEFT JOIN reviews r ON r.order_id = l_orderkey LEFT JOIN delivered d ON d.order_id = l_orderkey GROUP BY 1
"""


@query(_SELLERS)
def agg7_seller_performance(spark: SparkSession, sf: str) -> DataFrame:
    items = t.items(spark, sf)
    found = metrics.seller_performance(
        items, t.sellers(spark, sf), t.reviews(spark, sf), metrics.deliveries(t.orders(spark, sf), items)
    )
    return found.drop("seller_name", "seller_zip")


@query(
    f"""
    WITH a AS ({_SELLERS})
    SELECT CAST(seller_id AS VARCHAR) AS "sellerId", seller_city AS "sellerCity", seller_state AS "sellerState", CAST(total_orders AS INTEGER) AS "totalOrders",
      total_revenue AS "totalRevenue", avg_review_score AS "avgReviewScore", CAST(total_products_sold AS INTEGER) AS "totalProductsSold",
      on_time_delivery_rate AS "onTimeDeliveryRate", '2001-08-02 00:00:00' AS "lastUpdated" FROM a
    """
)
def agg7_seller_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The seller read model as stored: its field names and types, last updated as of a given time."""
    items = t.items(spark, sf)
    found = metrics.seller_performance(items, t.sellers(spark, sf), t.reviews(spark, sf), metrics.deliveries(t.orders(spark, sf), items))
    docs = documents.as_read_model(found, "seller_performance", documents.SELLER_NAMES, lastUpdated=F.lit("2001-08-02 00:00:00"))
    return docs.withColumns({"totalRevenue": F.col("totalRevenue").cast("double"), "lastUpdated": t.stamp("lastUpdated")})


@query(
    f"""
    WITH {t.SQL_PLACES}, {t.SQL_REVIEWS}, {t.SQL_DELIVERED},
    it AS (SELECT l_orderkey, {total('l_extendedprice')} AS totalItemValue, CAST(count(*) AS INTEGER) AS itemCount,
      string_agg(l_partkey || ':' || l_suppkey || ':' || p_brand, ',' ORDER BY l_partkey, l_suppkey, l_extendedprice) AS items
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT o_orderkey AS orderId, 0 AS part, o_custkey AS customerId, state AS customerState, city AS customerCity,
      o_orderstatus AS orderStatus, {text('o_orderdate')} AS purchaseTimestamp, {text('actual')} AS deliveredDate,
      {text('estimated')} AS estimatedDeliveryDate, items, o_totalprice AS totalPaymentValue,
      o_orderpriority AS primaryPaymentType, score AS reviewScore,
      CAST(date_diff('day', CAST(estimated AS DATE), CAST(actual AS DATE)) AS INTEGER) AS deliveryDelayDays, totalItemValue, itemCount
    FROM orders JOIN delivered d ON d.order_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN places ON zip = c_nationkey LEFT JOIN reviews r ON r.order_id = o_orderkey LEFT JOIN it ON l_orderkey = o_orderkey
    """
)
def agg8_order_analytics(spark: SparkSession, sf: str) -> DataFrame:
    docs = _order_analytics(spark, sf)
    flat = F.transform("items", lambda i: F.concat_ws(":", i["productId"], i["sellerId"], i["categoryName"]))
    stamps = {c: t.stamp(c) for c in ("purchaseTimestamp", "deliveredDate", "estimatedDeliveryDate")}
    money = {c: F.col(c).cast("double") for c in ("totalPaymentValue", "totalItemValue")}
    return docs.withColumns({**stamps, **money, "items": F.array_join(flat, ",")})


def _order_analytics(spark: SparkSession, sf: str) -> DataFrame:
    orders = metrics.deliveries(t.orders(spark, sf), t.items(spark, sf))
    return documents.order_analytics(orders, t.customers(spark, sf), _lines(spark, sf), t.payments(spark, sf), t.reviews(spark, sf))


@query(
    f"""
    WITH {t.SQL_PLACES}, {t.SQL_REVIEWS}, {t.SQL_DELIVERED},
    it AS (SELECT l_orderkey, {total('l_extendedprice')} AS totalItemValue, CAST(count(*) AS INTEGER) AS itemCount,
      string_agg(l_partkey || ':' || l_suppkey || ':' || printf('%.2f', l_extendedprice), ',' ORDER BY l_partkey, l_suppkey, l_extendedprice) AS items
      FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS orderId, CAST(o_custkey AS VARCHAR) AS customerId, state AS customerState, city AS customerCity,
      o_orderstatus AS orderStatus, {text('o_orderdate')} AS purchaseTimestamp, {text('actual')} AS deliveredDate,
      {text('estimated')} AS estimatedDeliveryDate, items, printf('%.2f', o_totalprice) AS totalPaymentValue, o_orderpriority AS primaryPaymentType,
      CAST(score AS INTEGER) AS reviewScore, CAST(date_diff('day', CAST(estimated AS DATE), CAST(actual AS DATE)) AS INTEGER) AS deliveryDelayDays,
      printf('%.2f', totalItemValue) AS totalItemValue, itemCount
    FROM orders JOIN delivered d ON d.order_id = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN places ON zip = c_nationkey LEFT JOIN reviews r ON r.order_id = o_orderkey LEFT JOIN it ON l_orderkey = o_orderkey
    """
)
def agg8_order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The order read model as stored, money as decimals; shown as text."""
    docs = documents.order_documents(_order_analytics(spark, sf))
    flat = F.transform("items", lambda i: F.concat_ws(":", i["productId"], i["sellerId"], i["price"].cast("string")))
    stamps = {c: t.stamp(c) for c in ("purchaseTimestamp", "deliveredDate", "estimatedDeliveryDate")}
    money = {c: F.col(c).cast("string") for c in ("totalPaymentValue", "totalItemValue")}
    return docs.withColumns({**stamps, **money, "items": F.array_join(flat, ",")})


@query(
    f"""
    WITH {t.SQL_REVIEWS}, it AS (SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ','
      ORDER BY l_linenumber, l_partkey, l_suppkey) AS items FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS order_id, o_orderstatus AS status, items, '1:' || o_orderpriority AS payments,
      'r' || order_id AS review_id, score FROM orders LEFT JOIN it ON l_orderkey = o_orderkey LEFT JOIN reviews ON order_id = o_orderkey
    """
)
def agg9_order_document(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.order_doc(
        t.orders(spark, sf),
        t.items(spark, sf),
        t.payments(spark, sf),
        t.reviews(spark, sf),
        ["item_no", "product_id", "seller_id", "price", "freight"],
        ["payment_sequential", "payment_type", "payment_installments", "payment_value"],
        ["review_id", "score"],
    )
    items = F.transform("items", lambda i: F.concat_ws(":", i["item_no"], i["product_id"], i["seller_id"]))
    pays = F.transform("payments", lambda p: F.concat_ws(":", p["payment_sequential"], p["payment_type"]))
    return docs.select(
        "order_id",
        "status",
        F.array_join(items, ",").alias("items"),
        F.array_join(pays, ",").alias("payments"),
        "review.review_id",
        "review.score",
    )


_PAY = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def _state_payments(spark: SparkSession, sf: str) -> DataFrame:
    return dim_join(t.payments(spark, sf), t.customers(spark, sf).select("customer_id", "customer_state"), ["customer_id"], spread_by=["order_id"])


@query(
    f"""
    WITH {t.SQL_PLACES} SELECT state AS customer_state,
      {', '.join(f'''CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = '{p}') AS DOUBLE) AS "{p}"''' for p in _PAY)}
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN places ON zip = c_nationkey GROUP BY 1
    """
)
def agg10_payment_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.pivot_sum(_state_payments(spark, sf), ["customer_state"], "payment_type", _PAY, "payment_value")


@query(
    f"""
    WITH {t.SQL_PLACES}, kinds AS (SELECT unnest({_PAY}) AS payment_type), states AS (SELECT DISTINCT state FROM places)
    SELECT s.state AS customer_state, k.payment_type, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM states s CROSS JOIN kinds k LEFT JOIN
      (SELECT state, o_orderpriority, o_totalprice FROM orders JOIN customer ON c_custkey = o_custkey JOIN places ON zip = c_nationkey) x ON x.state = s.state AND x.o_orderpriority = k.payment_type GROUP BY 1, 2
    """
)
def agg11_payment_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    wide = metrics.pivot_sum(_state_payments(spark, sf), ["customer_state"], "payment_type", _PAY, "payment_value")
    return metrics.unpivot(wide, ["customer_state"], _PAY, "payment_type", "amount")


_YEARS = list(range(1995, 2002))


@query(
    f"""
    SELECT p_brand AS category, {', '.join(f'count(*) FILTER (WHERE year(o_orderdate) = {y}) AS "{y}"' for y in _YEARS)}
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
    """
)
def agg12_category_year_matrix(spark: SparkSession, sf: str) -> DataFrame:
    sales = skew_join(_lines(spark, sf), t.orders(spark, sf).select("order_id", "order_date"), ["order_id"], spread_by=["product_id"])
    counts = sales.groupBy("category", F.year("order_date").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return metrics.pivot_any(counts, ["category"], "year", _YEARS, F.sum("n")).fillna(0)


@query("SELECT o_orderpriority AS payment_type, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share FROM orders GROUP BY 1")
def agg12_payment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.distribution(t.payments(spark, sf), ["payment_type"])


@query(
    f"""
    WITH {t.SQL_REVIEWS}, rated AS (SELECT p_brand, CASE WHEN score > 1 THEN score END AS score, l_quantity FROM lineitem
      JOIN part ON p_partkey = l_partkey JOIN reviews ON order_id = l_orderkey)
    SELECT p_brand AS category, round(sum(score * l_quantity) / sum(CASE WHEN score IS NOT NULL THEN l_quantity END), 8) AS weighted_rating
    FROM rated GROUP BY 1
    """
)
def agg13_weighted_rating(spark: SparkSession, sf: str) -> DataFrame:
    known = t.reviews(spark, sf).select("order_id", F.when(F.col("score") > 1, F.col("score")).alias("score"))
    rated = skew_join(_lines(spark, sf), known, ["order_id"], spread_by=["product_id"])
    found = metrics.weighted_rating(rated, ["category"], "score", "quantity")
    return found.withColumn("weighted_rating", F.round("weighted_rating", 8))


@query(
    f"""
    WITH {t.SQL_MONTHLY}, g AS (SELECT category, revenue / lag(revenue) OVER (PARTITION BY category ORDER BY ym) - 1 AS g FROM monthly)
    SELECT category, round(exp(avg(ln(1 + g))) - 1, 8) AS mean_growth FROM g GROUP BY 1
    """
)
def agg14_geometric_growth(spark: SparkSession, sf: str) -> DataFrame:
    grown = windows.growth(_category_months(spark, sf), ["category"], ["year_month"], "revenue")
    fractions = grown.withColumn("growth", F.col("growth_pct") / 100)
    return metrics.mean_growth(fractions, ["category"], "growth").withColumn("mean_growth", F.round("mean_growth", 8))


def _category_months(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.revenue_by(shaping.with_calendar(_lines(spark, sf), "ship_date"), ["category", "year_month"])


@query(
    f"SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, {total('l_extendedprice')} AS monthly_revenue "
    "FROM lineitem GROUP BY 1, 2"
)
def agg15_monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.monthly(t.items(spark, sf), "ship_date", "price")


@query(
    f"""
    WITH {t.SQL_PLACES} SELECT state AS customer_state, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN places ON zip = c_nationkey GROUP BY 1
    """
)
def agg16_orders_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.distribution(_state_payments(spark, sf), ["customer_state"])


@query(f"WITH {_RFM} SELECT {_SEGMENT} AS segment, count(*) AS n, count(*) / (SELECT count(*) FROM rfm) AS share FROM rfm GROUP BY 1")
def agg16_segment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.distribution(metrics.with_segment(_rfm(spark, sf)), ["segment"])


@query(
    f"""
    WITH {_RFM} SELECT CAST(least(recency // 30, 5) AS INTEGER) AS recency_band, least(frequency // 5, 5) AS frequency_band,
      count(*) AS n, CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS monetary FROM rfm GROUP BY 1, 2
    """
)
def agg16_rfm_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    bands = _rfm(spark, sf).select(
        F.least(F.floor(F.col("recency") / 30), F.lit(5)).cast("int").alias("recency_band"),
        F.least(F.floor(F.col("frequency") / 5), F.lit(5)).cast("bigint").alias("frequency_band"),
        "monetary",
    )
    return bands.groupBy("recency_band", "frequency_band").agg(
        F.count(F.lit(1)).alias("n"), metrics.total("monetary").alias("monetary")
    )


@query(f"WITH {t.SQL_REVIEWS} SELECT score, count(*) AS n, count(*) / (SELECT count(*) FROM reviews) AS share FROM reviews GROUP BY 1")
def agg16_review_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.distribution(t.reviews(spark, sf), ["score"])


@query(
    f"""
    WITH m AS (SELECT o_custkey AS c, strftime(o_orderdate, '%Y-%m') AS ym, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1, 2),
    f AS (SELECT c, min(ym) AS ym FROM m GROUP BY 1),
    s AS (SELECT ym, sum(spend) AS spend FROM m GROUP BY 1), k AS (SELECT ym, count(*) AS n FROM f GROUP BY 1),
    r AS (SELECT s.ym, CAST(sum(spend) OVER (ORDER BY s.ym) AS DOUBLE) AS cumulative_spend,
      CAST(sum(coalesce(n, 0)) OVER (ORDER BY s.ym) AS BIGINT) AS customers FROM s LEFT JOIN k ON k.ym = s.ym)
    SELECT ym AS year_month, cumulative_spend, customers, cumulative_spend / customers AS clv FROM r
    """
)
def agg17_clv_trend(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.clv_trend(t.orders(spark, sf), "customer_id", "order_date", "total")


@query(
    f"""
    WITH {t.SQL_PLACES}, {t.SQL_DELIVERED}
    SELECT state AS customer_state, count(*) AS delivered, avg(date_diff('day', CAST(order_date AS DATE), CAST(actual AS DATE))) AS avg_lead_days,
      avg(date_diff('day', CAST(estimated AS DATE), CAST(actual AS DATE))) AS avg_delay_days,
      avg(CASE WHEN actual < estimated + INTERVAL 1 DAY THEN 1 ELSE 0 END) AS on_time_rate
    FROM delivered JOIN customer ON c_custkey = customer_id JOIN places ON zip = c_nationkey WHERE actual IS NOT NULL GROUP BY 1
    """
)
def agg18_delivery_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = metrics.deliveries(t.orders(spark, sf), t.items(spark, sf))
    df = dim_join(df, t.customers(spark, sf).select("customer_id", "customer_state"), ["customer_id"], spread_by=["order_id"])
    return metrics.delivery_metrics(df, ["customer_state"], "order_date", "estimated", "actual")


@query(
    f"""
    SELECT p_brand AS category, p_type AS kind, {total('l_extendedprice')} AS revenue, CAST(grouping(p_brand, p_type) AS BIGINT) AS level
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_brand, p_type)
    """
)
def agg19_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.revenue_totals(_lines(spark, sf), ["category", "kind"])


@query(
    f"""
    SELECT l_returnflag AS return_flag, p_type AS kind, {total('l_extendedprice')} AS revenue, CAST(grouping(l_returnflag, p_type) AS BIGINT) AS level
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY CUBE (l_returnflag, p_type)
    """
)
def agg19_cube(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.revenue_totals(_lines(spark, sf), ["return_flag", "kind"], cube=True)


@query(
    f"""
    SELECT l_returnflag AS return_flag, p_brand AS category, p_type AS kind, {total('l_extendedprice')} AS revenue,
      count(DISTINCT o_custkey) AS distinct_customer_id, CAST(grouping(l_returnflag, p_brand, p_type) AS BIGINT) AS level
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY CUBE (l_returnflag, p_brand, p_type)
    """
)
def agg19_customers_per_level(spark: SparkSession, sf: str) -> DataFrame:
    """All eight levels with their exact numbers of customers, from one aggregate over the facts."""
    buyers = t.orders(spark, sf).select("order_id", "customer_id")
    sales = skew_join(_lines(spark, sf), buyers, ["order_id"], spread_by=["product_id"])
    return metrics.revenue_totals(sales, ["return_flag", "category", "kind"], cube=True, distinct="customer_id")


@query(
    f"""
    WITH {_RFM}, b AS (SELECT o_custkey AS c, l_partkey AS p, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
    r AS (SELECT c, p, row_number() OVER (PARTITION BY c ORDER BY n DESC, p) AS rank FROM b),
    l AS (SELECT c, string_agg(CAST(p AS VARCHAR), ',' ORDER BY rank) AS recommended_products FROM r WHERE rank <= 3 GROUP BY 1)
    SELECT CAST(customer_id AS VARCHAR) AS _id, recency AS recency_days, frequency, monetary, {_SEGMENT} AS rfm_segment,
      CASE WHEN recency > 90 THEN 1.0::DOUBLE ELSE recency / 90.0::DOUBLE END AS churn_probability, recommended_products
    FROM rfm LEFT JOIN l ON c = customer_id
    """
)
def agg20_customer_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segment documents of a shop without models: a recency rule and favourite products; with models see
    ``agg20_segment_documents``."""
    from mercato.operators.ml import interactions, recommended_lists

    scores = _rfm(spark, sf)
    churn = scores.select(
        "customer_id", F.when(F.col("recency") > 90, 1.0).otherwise(F.col("recency") / 90.0).alias("churn_probability")
    )
    bought = skew_join(t.items(spark, sf).select("order_id", "product_id"), t.orders(spark, sf).select("order_id", "customer_id"), ["order_id"])
    best = windows.top_n(interactions(bought, "customer_id", "product_id"), ["user"], [F.desc("times"), F.asc("item")], 3, "row_number")
    docs = metrics.customer_segments(scores, churn, recommended_lists(best))
    return docs.withColumn("recommended_products", F.array_join("recommended_products", ","))


@query(
    f"""
    WITH {_RFM}, b AS (SELECT DISTINCT o_custkey AS c FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    SELECT CAST(customer_id AS VARCHAR) AS _id, recency AS recency_days, frequency, monetary, {_SEGMENT} AS rfm_segment, true AS probability,
      CASE WHEN c IS NOT NULL THEN CAST(least(10, (SELECT count(DISTINCT l_partkey) FROM lineitem)) AS INTEGER) END AS products
    FROM rfm LEFT JOIN b ON c = customer_id
    """
)
def agg20_segment_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Segment documents from the models: the churn forest's probability and the recommender's ten items, shown as whether
    it is a probability and how many different items there are."""
    from mercato.operators import ml

    orders, reviews = t.orders(spark, sf), t.reviews(spark, sf)
    names = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"]
    churn = ml.fit_forest(pin(ml.churn_features(orders, reviews, F.lit("2001-04-01").cast("date"))), names)
    now = ml.churn_features(orders, reviews, F.lit("2001-08-02").cast("date"))
    bought = skew_join(t.items(spark, sf).select("order_id", "product_id"), orders.select("order_id", "customer_id"), ["order_id"])
    recommender = ml.Recommender.fit(pin(ml.interactions(bought, "customer_id", "product_id")))
    docs = ml.segment_documents(_rfm(spark, sf), now, churn, names, recommender)
    return docs.select(
        "_id", "recency_days", "frequency", "monetary", "rfm_segment",
        F.col("churn_probability").between(0, 1).alias("probability"),
        F.size(F.array_distinct("recommended_products")).alias("products"),
    )


@query(
    f"""
    WITH {t.SQL_PLACES}, c AS (SELECT state, count(*) AS customers FROM customer JOIN places ON zip = c_nationkey GROUP BY 1),
    s AS (SELECT state, count(*) AS sellers FROM supplier JOIN places ON zip = s_nationkey GROUP BY 1),
    o AS (SELECT state, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey JOIN places ON zip = c_nationkey GROUP BY 1)
    SELECT c.state, customers, sellers, orders FROM c JOIN s ON s.state = c.state JOIN o ON o.state = c.state
    """
)
def agg22_geo_distribution(spark: SparkSession, sf: str) -> DataFrame:
    customers, sellers = t.customers(spark, sf), t.sellers(spark, sf)
    state = F.col("customer_state").alias("state")
    orders = dim_join(t.orders(spark, sf), customers.select("customer_id", "customer_state"), ["customer_id"])
    return (
        metrics.geo_distribution(customers.withColumn("state", state), ["state"], {"customers": "customer_id"})
        .join(metrics.geo_distribution(sellers.withColumn("state", F.col("seller_state")), ["state"], {"sellers": "seller_id"}), "state")
        .join(metrics.geo_distribution(orders.withColumn("state", state), ["state"], {"orders": "order_id"}), "state")
    )


# --- top-k -------------------------------------------------------------------------------------------------------


@query(
    f"""
    SELECT l_suppkey AS seller_id, {total('l_extendedprice')} AS revenue FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-04-01' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """
)
def top6_sellers_in_window(spark: SparkSession, sf: str) -> DataFrame:
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in ("1998-01-01", "1998-04-01"))
    window = t.items(spark, sf).filter((F.col("ship_date") >= lo) & (F.col("ship_date") < hi))
    return metrics.top_k(metrics.revenue_by(window, ["seller_id"]), "revenue", 10, ["seller_id"])


@query(
    f"SELECT o_custkey AS customer_id, {total('o_totalprice')} AS revenue FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)
def agg16_top_customers(spark: SparkSession, sf: str) -> DataFrame:
    spent = metrics.revenue_by(t.orders(spark, sf), ["customer_id"], "total")
    return metrics.top_k(spent, "revenue", 10, ["customer_id"])


@query(
    """
    WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS year_month, l_partkey AS product_id, count(*) AS sold FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY sold DESC, product_id) AS rank FROM m)
    SELECT year_month, product_id, sold, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
    """
)
def top6_trending_products(spark: SparkSession, sf: str) -> DataFrame:
    months = shaping.with_calendar(t.items(spark, sf), "ship_date")
    sold = months.groupBy("year_month", "product_id").agg(F.count(F.lit(1)).alias("sold"))
    return windows.top_n(sold, ["year_month"], [F.desc("sold"), F.asc("product_id")], 3, "row_number")


@query("SELECT l_suppkey AS seller_id, l_extendedprice AS price, l_orderkey AS order_id FROM lineitem")
def top5_sorted_layout(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf).select("seller_id", "price", "order_id")
    return shaping.sorted_layout(df, [F.asc("seller_id"), F.desc("price")])


# --- custom functions --------------------------------------------------------------------------------------------


@query(
    """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(CASE WHEN p_retailprice = 0 THEN 0.0
      ELSE (p_retailprice - l_extendedprice) / p_retailprice * 100 END AS FLOAT) AS discount_pct
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """
)
def udf1_discount(spark: SparkSession, sf: str) -> DataFrame:
    priced = dim_join(t.items(spark, sf), t.products(spark, sf).select("product_id", "retail_price"), ["product_id"])
    return priced.select("order_id", "product_id", scalar.discount_pct("price", "retail_price").alias("discount_pct"))


@query(
    f"""
    WITH {t.SQL_DELIVERED} SELECT order_id, CASE WHEN actual IS NULL THEN 'pending' WHEN actual < estimated + INTERVAL 1 DAY THEN 'on_time'
      WHEN actual < estimated + INTERVAL 4 DAY THEN 'slight_delay' ELSE 'late' END AS delivery_status FROM delivered
    """
)
def udf2_delivery_status(spark: SparkSession, sf: str) -> DataFrame:
    df = metrics.deliveries(t.orders(spark, sf), t.items(spark, sf))
    return df.select("order_id", scalar.delivery_status("estimated", "actual").alias("delivery_status"))


@query(
    f"""
    WITH {t.SQL_DELIVERED} SELECT status, CASE WHEN actual IS NULL THEN 'pending' WHEN actual < estimated + INTERVAL 1 DAY THEN 'on_time'
      WHEN actual < estimated + INTERVAL 4 DAY THEN 'slight_delay' ELSE 'late' END AS delivery_status, count(*) AS orders FROM delivered GROUP BY 1, 2
    """
)
def agg18_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = metrics.deliveries(t.orders(spark, sf), t.items(spark, sf))
    return metrics.status_counts(df, ["status"], "estimated", "actual")


@query(f"WITH {_RFM} SELECT customer_id, {_SEGMENT} AS segment FROM rfm")
def udf3_rfm_segment(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.with_segment(_rfm(spark, sf)).select("customer_id", "segment")


def _hits(words: list[str]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w IN ({listed})))"


_SCORE = f"CAST({_hits(scalar.POSITIVE_WORDS)} - {_hits(scalar.NEGATIVE_WORDS)} AS INTEGER)"


@query(
    f"""
    SELECT doc_id, {_SCORE} AS score, CASE WHEN {_SCORE} > 0 THEN 'positive' WHEN {_SCORE} < 0 THEN 'negative' ELSE 'neutral' END AS label
    FROM documents
    """
)
def udf4_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    df = t.raw(spark, sf, "documents").select("doc_id", scalar.sentiment_score("text").alias("score"))
    return df.withColumn("label", scalar.sentiment_label("score"))


@query(
    f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS reviews, avg({_SCORE}) AS mean_score
    FROM documents JOIN orders ON doc_id = o_orderkey GROUP BY 1
    """
)
def udf4_sentiment_trend(spark: SparkSession, sf: str) -> DataFrame:
    scored = t.raw(spark, sf, "documents").select(F.col("doc_id").alias("order_id"), scalar.sentiment_score("text").alias("score"))
    dated = scored.join(t.orders(spark, sf).select("order_id", "order_date"), "order_id")
    return dated.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        F.count(F.lit(1)).alias("reviews"), F.avg("score").alias("mean_score")
    )


@query(
    """
    SELECT o_orderpriority AS priority, round(sum(o_totalprice * (1 + o_orderkey % 3)) / sum(1 + o_orderkey % 3), 4) AS weighted
    FROM orders GROUP BY 1
    """
)
def udf5_registered_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    """The registered aggregate called from SQL, on daily pre-sums so that its groups stay small."""
    register_all(spark)
    df = t.orders(spark, sf).withColumn("weight", (1 + F.col("order_id") % 3).cast("double"))
    daily = df.groupBy("priority", "order_date").agg(
        F.sum("weight").alias("weight"), (F.sum(F.col("total") * F.col("weight")) / F.sum("weight")).alias("value")
    )
    daily.createOrReplaceTempView("daily_weighted")
    return spark.sql("SELECT priority, round(weighted_avg(value, weight), 4) AS weighted FROM daily_weighted GROUP BY priority")


@query(
    f"""
    WITH {t.SQL_DELIVERED}, {_RFM} SELECT d.order_id, CASE WHEN actual IS NULL THEN 'pending' WHEN actual < estimated + INTERVAL 1 DAY THEN 'on_time'
      WHEN actual < estimated + INTERVAL 4 DAY THEN 'slight_delay' ELSE 'late' END AS delivery, {_SEGMENT} AS segment
    FROM delivered d JOIN rfm USING (customer_id)
    """
)
def udf6_function_library_in_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_all(spark)
    metrics.deliveries(t.orders(spark, sf), t.items(spark, sf)).createOrReplaceTempView("deliveries")
    _rfm(spark, sf).createOrReplaceTempView("rfm")
    return spark.sql(
        "SELECT d.order_id, delivery_status(CAST(d.estimated AS TIMESTAMP), CAST(d.actual AS TIMESTAMP)) AS delivery, "
        "customer_segment(r.recency, r.frequency, r.monetary) AS segment "
        "FROM deliveries d JOIN rfm r ON d.customer_id = r.customer_id"
    )
