"""Scalar functions, and small operators that other plan modules use in passing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import scalar
from mercato.functions.register import register_all
from mercato.operators import documents, metrics, quality, shaping, windows
from mercato.plans import tables as t
from mercato.plans.registry import query, text, total
from mercato.session import pin, scratch_path
from mercato.sources.external import StreamConfig, read_events
from mercato.streaming import sinks


@query(f"SELECT o_orderkey AS order_id, {text('o_orderdate')} AS parsed FROM orders")
def fn1_text_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    as_text = t.orders(spark, sf).select("order_id", t.stamp("order_date").alias("parsed"))
    return as_text.withColumn("parsed", t.stamp(scalar.parse_timestamp("parsed")))


@query(f"SELECT o_orderkey AS order_id, {text('o_orderdate + INTERVAL 45 DAY')} AS moved FROM orders")
def fn2_shift_days(spark: SparkSession, sf: str) -> DataFrame:
    return t.orders(spark, sf).select("order_id", t.stamp(scalar.shift_days("order_date", 45)).alias("moved"))


@query("SELECT count(*) AS n, 0::BIGINT AS out_of_range, true AS spread FROM orders")
def fn3_hashed_day_shift(spark: SparkSession, sf: str) -> DataFrame:
    days = scalar.hashed_days("order_id", F.lit(1))
    return t.orders(spark, sf).select(days.alias("d")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col("d") < 0) | (F.col("d") > 364)).alias("out_of_range"),
        (F.count_distinct("d") > 300).alias("spread"),
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) || '_0' AS order_id, 'v1' AS tag, CAST(floor(o_totalprice) AS INTEGER) AS whole FROM orders")
def fn4_concat_literal_cast(spark: SparkSession, sf: str) -> DataFrame:
    return t.orders(spark, sf).select(
        F.concat(F.col("order_id").cast("string"), F.lit("_0")).alias("order_id"),
        F.lit("v1").alias("tag"),
        F.floor("total").cast("int").alias("whole"),
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) || '_copy' AS order_id, o_orderstatus AS status FROM orders")
def prj4_suffixed_ids(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf)
    return df.select(F.concat(F.col("order_id").cast("string"), F.lit("_copy")).alias("order_id"), "status")


@query("""SELECT event_id, '{"event_id":' || event_id || ',"category":"' || event_type || '"}' AS body FROM events""")
def fn6_object_to_json(spark: SparkSession, sf: str) -> DataFrame:
    return t.events(spark, sf).select("event_id", F.to_json(F.struct("event_id", "category")).alias("body"))


@query("SELECT o_orderkey AS order_id, CAST(o_custkey AS BIGINT) AS customer_id, NULL::BIGINT AS broken, NULL::VARCHAR AS absent FROM orders")
def fn7_dynamic_fields(spark: SparkSession, sf: str) -> DataFrame:
    image = F.create_map(
        F.lit("customer_id"), F.col("customer_id").cast("string"), F.lit("priority"), F.col("priority")
    )
    return t.orders(spark, sf).select(
        "order_id",
        scalar.image_field(image, "customer_id", "bigint").alias("customer_id"),
        scalar.image_field(image, "priority", "bigint").alias("broken"),
        scalar.image_field(image, "no_such_field").alias("absent"),
    )


@query("SELECT event_id, strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS at FROM events")
def fn8_epoch_micros(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.unix_micros(F.col("event_time").cast("timestamp"))
    at = scalar.micros_to_timestamp(micros)
    return t.events(spark, sf).select("event_id", F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS").alias("at"))


@query("SELECT o_orderkey AS order_id, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS age FROM orders")
def fn9_datediff(spark: SparkSession, sf: str) -> DataFrame:
    return t.orders(spark, sf).select("order_id", F.datediff(F.lit("2001-08-02").cast("date"), "order_date").alias("age"))


@query("SELECT l_returnflag AS return_flag, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS band, count(*) AS n FROM lineitem GROUP BY 1, 2")
def fn11_case_when(spark: SparkSession, sf: str) -> DataFrame:
    band = F.when(F.col("quantity") < 10, "small").when(F.col("quantity") < 30, "medium").otherwise("large")
    return t.items(spark, sf).groupBy("return_flag", band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"SELECT l_suppkey AS seller_id, 'price' AS measure, {total('l_extendedprice')} AS amount FROM lineitem GROUP BY 1 "
    f"UNION ALL SELECT l_suppkey, 'quantity', {total('l_quantity')} FROM lineitem GROUP BY 1"
)
def fn12_stack(spark: SparkSession, sf: str) -> DataFrame:
    wide = t.items(spark, sf).groupBy("seller_id").agg(metrics.total("price").alias("price"), metrics.total("quantity").alias("quantity"))
    return metrics.unpivot(wide, ["seller_id"], ["price", "quantity"], "measure", "amount")


@query("SELECT l_orderkey AS order_id, l_linenumber AS item_no, l_discount / nullif(l_tax, 0) * 100 AS pct FROM lineitem")
def fn13_percent_of_zero_is_null(spark: SparkSession, sf: str) -> DataFrame:
    df = t.raw(spark, sf, "lineitem")
    pct = F.try_divide("l_discount", "l_tax") * 100
    return df.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_no"), pct.alias("pct"))


@query(
    f"WITH {t.SQL_DELIVERED} SELECT order_id, CAST(date_diff('day', CAST(estimated AS DATE), CAST(actual AS DATE)) AS INTEGER) AS delay_days FROM delivered"
)
def fn14_delivery_delay(spark: SparkSession, sf: str) -> DataFrame:
    df = metrics.deliveries(t.orders(spark, sf), t.items(spark, sf))
    return df.select("order_id", scalar.delay_days("estimated", "actual").alias("delay_days"))


@query(
    """
    WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS k FROM orders)
    SELECT o_custkey AS customer_id, o_orderkey AS order_id, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 2
    """
)
def flt6_rank_filter(spark: SparkSession, sf: str) -> DataFrame:
    best = windows.top_n(t.orders(spark, sf), ["customer_id"], [F.desc("total")], 2)
    return best.select("customer_id", "order_id", "rank")


@query(
    f"""
    WITH {t.SQL_DAILY}, g AS (SELECT *, lag(revenue) OVER (ORDER BY d) AS previous FROM daily)
    SELECT strftime(d, '%Y-%m-%d') AS date, revenue, previous, (revenue - previous) / previous * 100 AS growth_pct FROM g
    """
)
def win9_daily_growth_series(spark: SparkSession, sf: str) -> DataFrame:
    daily = metrics.daily(t.orders(spark, sf), "order_date", "total")
    return windows.growth(daily, [], ["date"], "revenue").withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query("SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top2_find_with_limit(spark: SparkSession, sf: str) -> DataFrame:
    ranked = t.orders(spark, sf).select("order_id", "total", "status").orderBy(F.desc("total"), "order_id")
    return shaping.find(ranked, F.col("status") == "F", 10).drop("status")


@query("SELECT least(10, count(*)) AS n, least(10, count(*)) AS rows_of_the_table, true AS no_row_too_often FROM lineitem")
def top3_head(spark: SparkSession, sf: str) -> DataFrame:
    """Which ten rows come is open. All of them must be rows of the table, whole, and none more often than it is there."""
    df = t.raw(spark, sf, "lineitem")
    head = pin(shaping.preview(df, df.columns, 10)).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("shown"))
    head = head.withColumnsRenamed({c: f"h_{c}" for c in df.columns})
    same = reduce(lambda a, b: a & b, [F.col(f"h_{c}").eqNullSafe(F.col(c)) for c in df.columns])
    found = df.join(F.broadcast(head), same).groupBy(*[f"h_{c}" for c in df.columns], "shown").agg(F.count(F.lit(1)).alias("there"))
    return found.agg(
        head.agg(F.sum("shown")).scalar().alias("n"),
        F.sum("shown").alias("rows_of_the_table"),
        F.bool_and(F.col("shown") <= F.col("there")).alias("no_row_too_often"),
    )


@query(
    """
    SELECT l_orderkey AS order_id, string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY l_partkey, l_suppkey) AS items
    FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = 5) GROUP BY 1
    """
)
def doc5_find_in_embedded_items(spark: SparkSession, sf: str) -> DataFrame:
    item, order = F.struct("product_id", "seller_id"), ["product_id", "seller_id"]
    docs = documents.find_embedded(t.items(spark, sf), "order_id", F.col("seller_id") == 5, item, order, "items", "item_no")
    return docs.select("order_id", F.array_join(F.transform("items", lambda i: F.concat_ws(":", i["product_id"], i["seller_id"])), ",").alias("items"))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT 'nulls' AS section, '{c}' AS first_cell, CAST(count(*) - count({c}) AS VARCHAR) AS shown FROM orders" for c in _ORDER_COLUMNS)
    + "".join(
        f" UNION ALL SELECT 'outliers', '{c}', CAST((SELECT count(*) FROM orders WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS VARCHAR) "
        f"FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM orders)"
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    )
    + " UNION ALL SELECT 'duplicates', CAST(n AS VARCHAR), CAST(n - d AS VARCHAR) FROM (SELECT count(*) AS n FROM orders), "
    "(SELECT count(*) AS d FROM (SELECT DISTINCT * FROM orders)))"
)
def dq6_html_report(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the orders table, read back from the page it was written to: a row per row of its three sections."""
    df = t.raw(spark, sf, "orders")
    shown = {"nulls": ("column_name", "null_count"), "duplicates": ("total_rows", "total_duplicates"), "outliers": ("column_name", "outliers")}
    sections = {"nulls": quality.null_report(df), "duplicates": quality.duplicate_report(df), "outliers": quality.outlier_report(df)}
    path = quality.html_report({n: r.select(*shown[n]) for n, r in sections.items()}, scratch_path(spark, "report") + ".html")
    page = spark.read.text(path, wholetext=True)
    tables = page.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)(<h2>.*?</table>)"), F.lit(1))).alias("table"))
    rows = tables.select(
        F.regexp_extract("table", "<h2>(.*?)</h2>", 1).alias("section"),
        F.explode(F.regexp_extract_all("table", F.lit("(<tr><td>.*?</tr>)"), F.lit(1))).alias("row"),
    )
    cells = F.regexp_extract_all("row", F.lit("<td>(.*?)</td>"), F.lit(1))
    return rows.select("section", cells[0].alias("first_cell"), cells[1].alias("shown"))


@query("SELECT event_type AS category, count(*) AS n, count(DISTINCT ts < TIMESTAMP '2024-01-16') AS runs FROM events GROUP BY 1")
def snk8_trigger_once_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two one-shot runs with the same checkpoint: the second takes only what arrived in between."""
    events = t.raw(spark, sf, "events")
    turn = F.lit("2024-01-16").cast("timestamp_ntz")
    inbox, path, checkpoint = (scratch_path(spark, n) for n in ("event-files", "stream-table", "checkpoint"))
    for part in (events.filter(F.col("ts") < turn), events.filter(F.col("ts") >= turn)):
        part.write.mode("append").parquet(inbox)
        source = read_events(spark, StreamConfig(fmt="parquet", path=inbox, schema=events.schema))
        store = lambda batch, i: sinks.write_upserts(batch, i, path)
        sinks.write_stream_batch(source, store, checkpoint, trigger=sinks.ONCE).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    return rows.groupBy(F.col("event_type").alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_batch").alias("runs")
    )


@query(
    f"""
    WITH {t.SQL_MONTHLY} SELECT category, ym AS year_month, revenue, (revenue - lag(revenue) OVER (PARTITION BY category ORDER BY ym))
      / lag(revenue) OVER (PARTITION BY category ORDER BY ym) * 100 AS growth FROM monthly
    """
)
def udf6_growth_in_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_all(spark)
    revenue = metrics.revenue_by(
        shaping.with_calendar(
            t.items(spark, sf).join(t.products(spark, sf).select("product_id", "category"), "product_id"), "ship_date"
        ),
        ["category", "year_month"],
    )
    revenue.createOrReplaceTempView("category_months")
    return spark.sql(
        "SELECT category, year_month, revenue, pct_change(revenue, before) AS growth FROM (SELECT *, "
        "lag(revenue) OVER (PARTITION BY category ORDER BY year_month) AS before FROM category_months)"
    )
