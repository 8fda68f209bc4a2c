"""Window functions and time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import metrics, quality, shaping, windows
from mercato.operators.joins import dim_join
from mercato.plans import tables as t
from mercato.plans.registry import query, total


def _category_months(spark: SparkSession, sf: str) -> DataFrame:
    lines = dim_join(t.items(spark, sf), t.products(spark, sf).select("product_id", "category"), ["product_id"], spread_by=["order_id"])
    return metrics.revenue_by(shaping.with_calendar(lines, "ship_date"), ["category", "year_month"])


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily(t.orders(spark, sf), "order_date", "total")


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_PRODUCTS = (
    "prod AS (SELECT p_brand AS category, l_partkey AS product_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, "
    "count(*) AS units FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"
)


def _product_revenue(spark: SparkSession, sf: str) -> DataFrame:
    per = t.items(spark, sf).groupBy("product_id").agg(
        metrics.total("price").alias("revenue"), F.count(F.lit(1)).alias("units")
    )
    return dim_join(per, t.products(spark, sf).select("product_id", "category"), ["product_id"])


@query(
    f"""
    WITH {_PRODUCTS}, r AS (SELECT *, rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS k FROM prod)
    SELECT category, product_id, revenue, units, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 10
    """
)
def win1_top_products_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return windows.top_n(_product_revenue(spark, sf), ["category"], [F.desc("revenue")], 10)


@query(
    f"""
    WITH {_PRODUCTS}, r AS (SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY units DESC) AS k FROM prod)
    SELECT category, product_id, revenue, units, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 3
    """
)
def win2_dense_rank(spark: SparkSession, sf: str) -> DataFrame:
    return windows.top_n(_product_revenue(spark, sf), ["category"], [F.desc("units")], 3, "dense_rank")


@query(
    """
    WITH r AS (SELECT l_returnflag, l_orderkey, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag
      ORDER BY l_extendedprice DESC, l_orderkey, l_partkey) AS k FROM lineitem)
    SELECT l_returnflag AS return_flag, l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price, CAST(k AS INTEGER) AS rank
    FROM r WHERE k <= 20
    """
)
def win2_row_number_on_raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three groups hold all items; each task sends at most 20 rows per group."""
    df = t.items(spark, sf).select("return_flag", "order_id", "product_id", "price")
    return windows.top_n(df, ["return_flag"], [F.desc("price"), F.asc("order_id"), F.asc("product_id")], 20, "row_number")


@query(
    f"""
    WITH {t.SQL_MONTHLY}, g AS (SELECT *, lag(revenue) OVER (PARTITION BY category ORDER BY ym) AS previous FROM monthly)
    SELECT category, ym AS year_month, revenue, previous, (revenue - previous) / previous * 100 AS growth_pct FROM g
    """
)
def win3_month_over_month(spark: SparkSession, sf: str) -> DataFrame:
    return windows.growth(_category_months(spark, sf), ["category"], ["year_month"], "revenue")


@query(
    f"""
    WITH {t.SQL_MONTHLY} SELECT category, ym AS year_month, revenue,
      lead(revenue) OVER (PARTITION BY category ORDER BY ym) AS next_value FROM monthly
    """
)
def win4_lead(spark: SparkSession, sf: str) -> DataFrame:
    return windows.lead_of(_category_months(spark, sf), ["category"], ["year_month"], "revenue")


@query(
    """
    SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_spend FROM orders
    """
)
def win5_running_spend(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("order_date"), F.col("order_id")]
    df = windows.running_total(t.orders(spark, sf), ["customer_id"], order, "total", "cumulative_spend")
    return df.select("customer_id", "order_id", "cumulative_spend")


@query(
    """
    SELECT l_returnflag AS return_flag, l_orderkey AS order_id, l_linenumber AS item_no, l_partkey AS product_id,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_returnflag
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM lineitem
    """
)
def win5_running_revenue_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Three keys hold all items, a third each."""
    order = [F.col(c) for c in ("ship_date", "order_id", "item_no", "product_id", "seller_id", "price")]
    df = windows.running_total(t.items(spark, sf), ["return_flag"], order, "price", "running")
    return df.select("return_flag", "order_id", "item_no", "product_id", "running")


_MONTHS = (
    "months AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, "
    "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS monthly_revenue FROM lineitem GROUP BY 1, 2)"
)


@query(
    f"""
    WITH {_MONTHS} SELECT *, CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg_3m
    FROM months WINDOW w AS (ORDER BY year, month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """
)
def win6_moving_average(spark: SparkSession, sf: str) -> DataFrame:
    months = metrics.monthly(t.items(spark, sf), "ship_date", "price")
    return windows.moving_avg(months, [], ["year", "month"], "monthly_revenue", 3, "moving_avg_3m")


_CALENDAR = (
    "cal AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM daily), (SELECT max(d) FROM daily), INTERVAL 1 DAY)) AS DATE) AS d), "
    "dense AS (SELECT cal.d, coalesce(revenue, 0) AS revenue FROM cal LEFT JOIN daily ON daily.d = cal.d)"
)


@query(
    f"""
    WITH {t.SQL_DAILY}, {_CALENDAR} SELECT strftime(d, '%Y-%m-%d') AS date, revenue,
      CAST(sum(CAST(revenue AS DECIMAL(18,2))) OVER a AS DOUBLE) / count(*) OVER a AS avg_7d,
      CAST(sum(CAST(revenue AS DECIMAL(18,2))) OVER b AS DOUBLE) / count(*) OVER b AS avg_30d FROM dense
    WINDOW a AS (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), b AS (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
    """
)
def win7_weekly_and_monthly_averages(spark: SparkSession, sf: str) -> DataFrame:
    dense = windows.densify(_daily(spark, sf), "date", "revenue")
    weekly = windows.moving_avg(dense, [], ["date"], "revenue", 7, "avg_7d")
    return _day_text(windows.moving_avg(weekly, [], ["date"], "revenue", 30, "avg_30d"))


@query(
    f"""
    WITH {t.SQL_DAILY} SELECT strftime(d, '%Y-%m-%d') AS date, revenue, lag(revenue, 1) OVER (ORDER BY d) AS lag_1,
      lag(revenue, 7) OVER (ORDER BY d) AS lag_7 FROM daily
    """
)
def win8_lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return _day_text(windows.lags(_daily(spark, sf), [], ["date"], "revenue", [1, 7]))


@query(
    """
    SELECT o_custkey AS customer_id, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS order_id,
      max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY 1
    """
)
def win10_latest_order(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf).select("customer_id", "order_date", "order_id", "status")
    return shaping.latest_by(df, ["customer_id"], ["order_date", "order_id"]).drop("order_date")


@query(
    f"""
    WITH {_MONTHS} SELECT month AS season, count(*) AS periods,
      CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS season_mean,
      CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) /
        (SELECT CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM months) AS seasonal_index
    FROM months GROUP BY 1
    """
)
def ts1_monthly_seasonality(spark: SparkSession, sf: str) -> DataFrame:
    months = metrics.monthly(t.items(spark, sf), "ship_date", "price")
    return windows.seasonal_index(months, F.col("month"), "monthly_revenue")


@query(
    f"""
    WITH {_MONTHS} SELECT CAST((month + 2) // 3 AS INTEGER) AS season, count(*) AS periods,
      CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS season_mean,
      CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) /
        (SELECT CAST(sum(CAST(monthly_revenue AS DECIMAL(18,2))) AS DOUBLE) / count(*) FROM months) AS seasonal_index
    FROM months GROUP BY 1
    """
)
def ts1_quarterly_seasonality(spark: SparkSession, sf: str) -> DataFrame:
    months = metrics.monthly(t.items(spark, sf), "ship_date", "price")
    quarter = F.floor((F.col("month") + 2) / 3).cast("int")
    return windows.seasonal_index(months, quarter, "monthly_revenue")


@query(
    f"""
    WITH {t.SQL_DAILY} SELECT round(regr_slope(revenue, x), 4) AS slope, round(regr_intercept(revenue, x), 2) AS intercept,
      round(regr_r2(revenue, x), 9) AS r2 FROM (SELECT revenue, CAST(date_diff('day', DATE '1995-01-01', d) AS DOUBLE) AS x FROM daily)
    """
)
def ts2_linear_trend(spark: SparkSession, sf: str) -> DataFrame:
    x = F.datediff("date", F.lit("1995-01-01").cast("date")).cast("double")
    found = windows.linear_trend(_daily(spark, sf), x, "revenue")
    return found.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"), F.round("r2", 9).alias("r2"))


@query(
    f"""
    WITH {t.SQL_DAILY}, {_CALENDAR},
    tr AS (SELECT d, revenue, CAST((row_number() OVER (ORDER BY d) - 1) % 7 AS INTEGER) AS position,
      CASE WHEN count(*) OVER w = 7 THEN sum(revenue) OVER w / 7 END AS trend FROM dense
      WINDOW w AS (ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    raw AS (SELECT position, avg(revenue - trend) AS r FROM tr GROUP BY 1),
    sea AS (SELECT position, r - (SELECT avg(r) FROM raw) AS seasonal FROM raw)
    SELECT strftime(d, '%Y-%m-%d') AS date, revenue, round(trend, 3) AS trend, tr.position, round(seasonal, 3) AS seasonal,
      round(revenue - trend - seasonal, 3) AS residual FROM tr JOIN sea ON sea.position = tr.position
    """
)
def ts3_weekly_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    dense = windows.densify(_daily(spark, sf), "date", "revenue")
    parts = windows.decompose(dense, "date", "revenue", 7)
    return _day_text(parts.withColumns({c: F.round(c, 3) for c in ("trend", "seasonal", "residual")}))


@query(
    f"""
    WITH {_MONTHS}, tr AS (SELECT year, month, monthly_revenue AS v, CAST((row_number() OVER (ORDER BY year, month) - 1) % 12 AS INTEGER) AS position,
      CASE WHEN count(*) OVER w = 13 THEN (sum(monthly_revenue) OVER w - (lag(monthly_revenue, 6) OVER (ORDER BY year, month)
        + lead(monthly_revenue, 6) OVER (ORDER BY year, month)) / 2) / 12 END AS trend FROM months
      WINDOW w AS (ORDER BY year, month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
    raw AS (SELECT position, avg(v - trend) AS r FROM tr GROUP BY 1), sea AS (SELECT position, r - (SELECT avg(r) FROM raw) AS seasonal FROM raw)
    SELECT year, month, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal, round(v - trend - seasonal, 3) AS residual
    FROM tr JOIN sea ON sea.position = tr.position
    """
)
def ts3_yearly_decomposition(spark: SparkSession, sf: str) -> DataFrame:
    months = metrics.monthly(t.items(spark, sf), "ship_date", "price")
    placed = months.withColumn("period", F.make_date("year", "month", F.lit(1)))
    parts = windows.decompose(placed, "period", "monthly_revenue", 12)
    return parts.select("year", "month", *[F.round(c, 3).alias(c) for c in ("trend", "seasonal", "residual")])


@query(
    f"""
    WITH {t.SQL_DAILY}, q AS (SELECT quantile_disc(revenue, 0.25) AS q1, quantile_disc(revenue, 0.75) AS q3 FROM daily)
    SELECT strftime(d, '%Y-%m-%d') AS date, revenue FROM daily, q WHERE revenue < q1 - 1.5 * (q3 - q1) OR revenue > q3 + 1.5 * (q3 - q1)
    """
)
def ts4_iqr_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Daily grain holds a few thousand rows, so rank error 0 is affordable and comparable."""
    return _day_text(quality.iqr_anomalies(_daily(spark, sf), "revenue", eps=0.0))


@query("SELECT count(value) AS n, true AS q1_in_rank, true AS q3_in_rank FROM events")
def dq5_quartile_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """The quartiles that the approximate filter uses lie within the stated rank error of the exact ones."""
    df, eps = t.events(spark, sf).select("price"), 0.01
    checks = []
    for p, q in zip((0.25, 0.75), df.approxQuantile("price", [0.25, 0.75], eps), strict=True):
        below, upto, n = F.count_if(F.col("price") < q), F.count_if(F.col("price") <= q), F.count("price")
        checks.append((below <= (p + eps) * n + 1) & (upto >= (p - eps) * n - 1))
    return df.agg(F.count("price").alias("n"), checks[0].alias("q1_in_rank"), checks[1].alias("q3_in_rank"))


@query()
def dq5_approximate_iqr(spark: SparkSession, sf: str) -> DataFrame:
    return quality.iqr_anomalies(t.events(spark, sf).select("event_id", "price"), "price", eps=0.01)


@query(
    f"""
    WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {total('o_totalprice')} AS revenue FROM orders GROUP BY 1),
    p AS (SELECT *, lag(revenue) OVER (ORDER BY year) AS previous FROM y)
    SELECT *, (revenue - previous) / previous * 100 AS growth_pct FROM p
    """
)
def ts5_yearly_growth(spark: SparkSession, sf: str) -> DataFrame:
    years = t.orders(spark, sf).withColumn("year", F.year("order_date"))
    return windows.growth(metrics.revenue_by(years, ["year"], "total"), [], ["year"], "revenue")


@query(
    f"""
    WITH e AS (SELECT event_type AS category, time_bucket(INTERVAL 1 HOUR, ts) AS h, {total('value')} AS revenue FROM events GROUP BY 1, 2),
    z AS (SELECT *, avg(revenue) OVER w AS m, stddev_samp(revenue) OVER w AS s, count(*) OVER w AS n FROM e
      WINDOW w AS (PARTITION BY category ORDER BY h ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
    SELECT category, {"strftime(h, '%Y-%m-%d %H:%M:%S')"} AS hour, revenue, round((revenue - m) / s, 6) AS zscore,
      CASE WHEN revenue > m THEN 'spike' ELSE 'drop' END AS kind FROM z WHERE n = 6 AND s <> 0 AND abs((revenue - m) / s) >= 3
    """
)
def str10_revenue_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    from mercato.streaming.windows import tumbling

    hourly = tumbling(t.events(spark, sf), "event_time", "1 hour", ["category"], [metrics.total("price").alias("revenue")])
    hit = windows.revenue_anomalies(hourly, ["category"], ["window_start"], "revenue")
    return hit.select("category", t.stamp("window_start").alias("hour"), "revenue", F.round("zscore", 6).alias("zscore"), "kind")


@query(
    f"""
    WITH {_MONTHS}, g AS (SELECT *, lag(monthly_revenue) OVER (ORDER BY year, month) AS previous FROM months)
    SELECT year, month, monthly_revenue, 'revenue_drop' AS rule FROM g WHERE (monthly_revenue - previous) / previous * 100 < -20
    """
)
def str11_revenue_drop_alerts(spark: SparkSession, sf: str) -> DataFrame:
    months = metrics.monthly(t.items(spark, sf), "ship_date", "price")
    grown = windows.growth(months, [], ["year", "month"], "monthly_revenue")
    fired = metrics.alerts(grown, metrics.standard_rules(growth="growth_pct"))
    return fired.select("year", "month", "monthly_revenue", "rule")


@query(
    """
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS hour,
      count(*) FILTER (WHERE event_type = 'error') / count(*) AS error_rate, 'error_rate' AS rule FROM events GROUP BY 1
    HAVING count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.05
    """
)
def str11_error_rate_alerts(spark: SparkSession, sf: str) -> DataFrame:
    from mercato.streaming.windows import tumbling

    rate = F.count_if(F.col("category") == "error") / F.count(F.lit(1))
    hourly = tumbling(t.events(spark, sf), "event_time", "1 hour", [], [rate.alias("error_rate")])
    fired = metrics.alerts(hourly, metrics.standard_rules(error_rate="error_rate"))
    return fired.select(t.stamp("window_start").alias("hour"), "error_rate", "rule")


@query(
    """
    WITH h AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n FROM events GROUP BY 1),
    w AS (SELECT hour, sum(n) OVER (ORDER BY hour DESC) AS lag FROM h)
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, CAST(lag AS BIGINT) AS lag, 'lag' AS rule FROM w WHERE lag > 1000
    """
)
def str11_lag_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """A consumer that stopped at each hour: the events it is behind, alerted beyond 1,000."""
    from mercato.streaming.windows import tumbling

    hourly = tumbling(t.events(spark, sf), "event_time", "1 hour", [], [F.count(F.lit(1)).alias("n")])
    behind = windows.running_total(hourly, [], [F.desc("window_start")], "n", "lag")
    fired = metrics.alerts(behind.withColumn("lag", F.col("lag").cast("bigint")), metrics.standard_rules(lag="lag"))
    return fired.select(t.stamp("window_start").alias("hour"), "lag", "rule")
