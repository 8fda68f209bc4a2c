"""Scans, sinks, projections, predicates, set operations, replication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators import shaping, validation
from mercato.operators.metrics import total as money_total
from mercato.operators.quality import null_report
from mercato.plans import tables as t
from mercato.plans.registry import query, text, total
from mercato.session import scratch_path
from mercato.sources import files, sinks

# --- scans -------------------------------------------------------------------------------------------------------

_ORDERS_CSV = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("order_date", T.TimestampNTZType()),
    ]
)


def _csv_copy(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "orders-csv")
    t.orders(spark, sf).select(*_ORDERS_CSV.fieldNames()).write.option("header", True).csv(path)
    return path


@query(
    f"SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total, {text('o_orderdate')} AS order_date FROM orders"
)
def src1_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    df = files.read_csv(spark, _csv_copy(spark, sf), _ORDERS_CSV)
    return df.withColumn("order_date", t.stamp("order_date"))


@query(f"SELECT o_orderstatus AS status, count(*) AS n, {total('o_totalprice')} AS total FROM orders GROUP BY 1")
def src1_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    df = files.read_csv(spark, _csv_copy(spark, sf))
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"), money_total("total").alias("total"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in t.NAMES))
def src2_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return files.count_tables(files.load_tables(spark, sf, {n: f"{n}.parquet" for n in t.NAMES}))


@query("SELECT l_returnflag AS return_flag, count(*) AS n FROM lineitem GROUP BY 1")
def src3_read_if_exists(spark: SparkSession, sf: str) -> DataFrame:
    absent = files.read_if_exists(spark, f"{sf}/no_such_table.csv")
    df = files.read_if_exists(spark, f"{sf}/lineitem.parquet", "parquet")
    if absent is not None or df is None:
        raise AssertionError("existence check failed")
    return df.groupBy(F.col("l_returnflag").alias("return_flag")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS product_id, p_brand AS category, p_retailprice AS retail_price FROM part")
def src4_layer_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    sinks.write_layer(t.products(spark, sf), "silver", "products", root)
    return files.read_table(spark, "silver", "products", root).select("product_id", "category", "retail_price")


@query("SELECT c_custkey AS id, 'customer' AS type FROM customer")
def src5_catalog_projection(spark: SparkSession, sf: str) -> DataFrame:
    t.raw(spark, sf, "customer").createOrReplaceTempView("customer")
    return files.project_table(spark, "customer", {"id": "c_custkey", "type": "'customer'"})


@query("SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders")
def src4_orc_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    sinks.write_layer(t.orders(spark, sf), "bronze", "orders", root, fmt="orc")
    return files.read_table(spark, "bronze", "orders", root, "orc").select("order_id", "total")


@query("SELECT s_suppkey AS seller_id, s_name AS seller_name, s_nationkey AS seller_zip FROM supplier")
def src9_find_all(spark: SparkSession, sf: str) -> DataFrame:
    return t.sellers(spark, sf).select("seller_id", "seller_name", "seller_zip")


@query(
    """
    SELECT * FROM (VALUES (0,'o_orderkey','bigint'),(1,'o_custkey','bigint'),(2,'o_orderstatus','string'),
      (3,'o_totalprice','double'),(4,'o_orderdate','timestamp_ntz'),(5,'o_orderpriority','string'))
      AS v(position, column_name, data_type)
    CROSS JOIN (SELECT count(*) - count(o_orderkey) AS null_count FROM orders)
    """
)
def src10_schema_with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = t.raw(spark, sf, "orders")
    known = files.describe_schema(df).drop("nullable")
    return known.join(null_report(df).select("column_name", "null_count"), "column_name")


@query(
    """
    SELECT 'currency' AS column_name, 'missing' AS problem, CAST(NULL AS BIGINT) AS null_count
    UNION ALL SELECT 'priority', 'extra', count(*) - count(o_orderpriority) FROM orders
    UNION ALL SELECT 'total', 'type_changed', count(*) - count(o_totalprice) FROM orders
    """
)
def src11_validate_schema(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf)
    expected = T.StructType(
        [f for f in df.schema.fields if f.name not in ("priority", "total")]
        + [T.StructField("total", T.DecimalType(10, 2)), T.StructField("currency", T.StringType())]
    )
    found = files.validate_schema(df, expected).select("column_name", "problem")
    return found.join(null_report(df).select("column_name", "null_count"), "column_name", "left")


@query(
    "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'"
)
def src12_incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf)
    loaded = df.filter(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
    delivered_twice = df.unionByName(df)
    return files.incremental_append(delivered_twice, loaded, ["order_id"]).select("order_id", "status")


# --- sinks -------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total FROM orders")
def snk1_parquet_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    df = t.orders(spark, sf).select("order_id", "customer_id", "total")
    sinks.write_layer(df.withColumn("total", F.lit(0.0)), "bronze", "orders", root)
    sinks.write_layer(df, "bronze", "orders", root)
    return files.read_table(spark, "bronze", "orders", root)


@query(
    f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n,
      {total('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1, 2
    """
)
def snk2_partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    df = shaping.with_calendar(t.items(spark, sf).select("order_id", "price", "ship_date"), "ship_date")
    sinks.write_layer(df.drop("year_month"), "silver", "items", root, partition_by=["year", "month"])
    stored = files.read_table(spark, "silver", "items", root)
    return stored.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


@query(
    f"""
    SELECT o_orderstatus AS status, count(*) AS n, {total('l_extendedprice')} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """
)
def snk3_bucketed_join(spark: SparkSession, sf: str) -> DataFrame:
    left, right = bucketed_pair(spark, sf)
    joined = left.join(right, "order_id")
    return joined.groupBy("status").agg(F.count(F.lit(1)).alias("n"), money_total("price").alias("revenue"))


def bucketed_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Items and orders saved in matching buckets."""
    tables = {"items": t.items(spark, sf).select("order_id", "price"), "orders": t.orders(spark, sf)}
    n = max(sinks.bucket_count(df) for df in tables.values())  # both alike, or the join would shuffle one
    found = []
    for name, df in tables.items():
        path = scratch_path(spark, f"{name}_bucketed")
        table = path.rsplit("/", 1)[-1].replace("-", "_")
        sinks.write_bucketed(df, table, n, ["order_id"], ["order_id"], path)
        found.append(spark.table(table))
    return found[0], found[1]


@query(
    """
    SELECT o_orderkey AS order_id, CAST(o_totalprice AS DOUBLE) AS total,
      CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS priority FROM orders
    """
)
def snk4_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf)
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    old = df.filter(F.col("order_date") < turn).select("order_id", "total")
    new = df.filter(F.col("order_date") >= turn).select("order_id", "total", "priority")
    path = scratch_path(spark, "evolving")
    old.write.parquet(path)
    new.write.mode("append").parquet(path)
    return sinks.evolve(files.read_evolved(spark, path), new.schema)


@query(
    "SELECT CAST(o_custkey AS VARCHAR) AS key, count(*) AS n, CAST(min(o_orderkey) AS VARCHAR) AS first_value "
    "FROM orders GROUP BY 1"
)
def snk11_publish_keyed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    rows = sinks.messages(t.orders(spark, sf), "order_id", "customer_id")
    sinks.publish(rows, "orders_raw", fmt="parquet", path=path)
    sent = spark.read.parquet(path).filter("topic = 'orders_raw'")
    first = F.min(F.col("value").cast("bigint")).cast("string")
    return sent.groupBy("key").agg(F.count(F.lit(1)).alias("n"), first.alias("first_value"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS value FROM orders")
def snk10_publish_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    sinks.publish(sinks.messages(t.orders(spark, sf), "order_id"), "orders_raw", fmt="json", path=path)
    return spark.read.schema("key string, value string").json(path).select("value")


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total FROM orders")
def snk12_publish_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    df = t.orders(spark, sf).select("order_id", "status", "total")
    sinks.publish(sinks.json_messages(df, "order_id"), "orders_raw", fmt="parquet", path=path)
    return spark.read.parquet(path).select(F.from_json("value", df.schema).alias("v")).select("v.*")


@query("SELECT count(*) AS reported, count(*) AS stored FROM lineitem")
def snk13_bulk_insert(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bulk")
    written = sinks.bulk_insert(t.items(spark, sf), path)
    return spark.read.parquet(path).agg(F.lit(written).cast("bigint").alias("reported"), F.count(F.lit(1)).alias("stored"))


@query("SELECT l_partkey AS product_id, count(*) AS n FROM lineitem GROUP BY 1")
def snk15_export_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    out = sinks.export(t.items(spark, sf).select("product_id", "price"), path, "csv", version="3")
    stored = files.read_csv(spark, out, T.StructType([T.StructField("product_id", T.LongType()), T.StructField("price", T.DoubleType())]))
    return stored.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))


@query()
def snk15_export_sample(spark: SparkSession, sf: str) -> DataFrame:
    out = sinks.export(t.items(spark, sf), scratch_path(spark, "export"), fraction=0.1, version="1")
    return spark.read.parquet(out)


@query(
    """
    SELECT CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'cold' ELSE 'hot' END AS tier, count(*) AS n
    FROM lineitem GROUP BY 1
    """
)
def snk16_tiers(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "tiers")
    sinks.write_tiers(t.items(spark, sf), "ship_date", F.lit("1999-01-01").cast("timestamp_ntz"), root)
    return spark.read.parquet(root).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT l_suppkey AS seller_id, {total('l_extendedprice')} AS revenue FROM lineitem GROUP BY 1")
def snk17_materialized_view(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf).groupBy("seller_id").agg(money_total("price").alias("revenue"))
    sinks.materialize(df, "seller_revenue", scratch_path(spark, "lake"))
    return spark.table("seller_revenue")


# --- projections and predicates ----------------------------------------------------------------------------------


@query(
    f"""
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus <> 'P' THEN {text('o_orderdate')} END AS purchased,
      {text('o_orderdate')} AS approved FROM orders
    """
)
def prj1_to_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    as_text = t.orders(spark, sf).select(
        "order_id",
        F.when(F.col("status") == "P", "not a date").otherwise(t.stamp("order_date")).alias("purchased"),
        t.stamp("order_date").alias("approved"),
    )
    parsed = shaping.to_timestamps(as_text, ["purchased", "approved"])
    return parsed.withColumns({c: t.stamp(c) for c in ("purchased", "approved")})


@query(
    f"""
    SELECT {text('o_orderdate')} AS order_purchase_timestamp,
      {text('o_orderdate + INTERVAL 30 DAY')} AS order_estimated_delivery_date FROM orders
    """
)
def prj2_columns_by_pattern(spark: SparkSession, sf: str) -> DataFrame:
    day = F.timestamp_add("DAY", F.lit(30), "order_date")
    df = t.orders(spark, sf).select(
        "order_id",
        t.stamp("order_date").alias("order_purchase_timestamp"),
        t.stamp("order_date").alias("order_approved_at"),
        t.stamp(day).alias("order_estimated_delivery_date"),
    )
    return df.select(*shaping.columns_like(df))


@query("SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def prj3_preview(spark: SparkSession, sf: str) -> DataFrame:
    ranked = t.orders(spark, sf).orderBy(F.desc("total"), "order_id")
    return shaping.preview(ranked, ["order_id", "total"])


@query("SELECT p_partkey AS id, 'product' AS type, p_brand AS category FROM part")
def prj5_alias_and_tag(spark: SparkSession, sf: str) -> DataFrame:
    return t.products(spark, sf).select(F.col("product_id").alias("id"), F.lit("product").alias("type"), "category")


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
      strftime(l_shipdate, '%Y-%m') AS year_month, count(*) AS n FROM lineitem GROUP BY 1, 2, 3
    """
)
def prj6_calendar_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = shaping.with_calendar(t.items(spark, sf), "ship_date")
    return df.groupBy("year", "month", "year_month").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT DISTINCT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%dT%H:%M:%S') || '_' || event_type AS id FROM events
    """
)
def prj7_metric_id(spark: SparkSession, sf: str) -> DataFrame:
    start = F.window("event_time", "5 minutes").start
    return t.events(spark, sf).select(shaping.metric_id(start, "category").alias("id")).distinct()


@query(
    """
    SELECT p_partkey AS id, p_brand AS category_name, length(p_name) AS name_length, p_size AS length_cm,
      p_size * 2 AS height_cm, p_size * 3 AS width_cm FROM part
    """
)
def prj8_product_document(spark: SparkSession, sf: str) -> DataFrame:
    source = t.products(spark, sf).select(
        F.col("product_id"),
        F.col("category").alias("product_category_name"),
        F.length("name").cast("bigint").alias("product_name_lenght"),
        F.col("size").alias("product_length_cm"),
        (F.col("size") * 2).alias("product_height_cm"),
        (F.col("size") * 3).alias("product_width_cm"),
    )
    doc = shaping.product_doc(
        source,
        {
            "id": "product_id",
            "category_name": "product_category_name",
            "name_length": "product_name_lenght",
            "length_cm": "product_length_cm",
            "height_cm": "product_height_cm",
            "width_cm": "product_width_cm",
        },
    )
    return doc.select("id", "category_name", "name_length", "dimensions.*")


@query(
    "SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
)
def flt1_find(spark: SparkSession, sf: str) -> DataFrame:
    found = shaping.find(t.orders(spark, sf), shaping.matching(status="F", priority="1-URGENT"))
    return found.select("order_id", "total")


@query("SELECT count(*) AS n FROM (SELECT * FROM lineitem WHERE l_returnflag = 'R' LIMIT 25)")
def flt1_find_limited(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.find(t.items(spark, sf), shaping.matching(return_flag="R"), 25).agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders WHERE o_orderstatus = 'P' "
    "ORDER BY o_totalprice, o_orderkey LIMIT 1"
)
def flt2_find_one(spark: SparkSession, sf: str) -> DataFrame:
    found = shaping.find_one(t.orders(spark, sf), F.col("status") == "P", ["total", "order_id"])
    return found.select("order_id", "total")


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders WHERE o_orderkey = 7")
def flt3_find_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.find_by_id(t.orders(spark, sf), "order_id", 7).select("order_id", "customer_id")


@query("SELECT event_id, value FROM events WHERE value < 5 OR value > 60")
def flt5_outside_range(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.outside(t.events(spark, sf), "price", 5, 60).select("event_id", F.col("price").alias("value"))


@query(
    """
    SELECT event_id FROM events
    WHERE event_type = 'view' OR ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 604800 SECOND
    """
)
def flt7_retention(spark: SparkSession, sf: str) -> DataFrame:
    undated = F.when(F.col("category") != "view", F.col("event_time"))
    df = t.events(spark, sf).withColumn("event_time", undated)
    return shaping.expire(df, "event_time", 7 * 86_400, F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).select("event_id")


_RULED = """
    ruled AS (SELECT o_orderkey AS order_id,
      concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'customer_id:null' END,
        CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status:domain' END,
        CASE WHEN o_totalprice < 1000 OR o_totalprice > 450000 THEN 'total:range' END,
        CASE WHEN length(o_orderpriority) > 8 THEN 'priority:length' END) AS reasons FROM orders)
"""


def _order_rules() -> list[validation.Rule]:
    return [
        validation.not_null("customer_id"),
        validation.one_of("status", ["F", "O"]),
        validation.between("total", 1000.0, 450000.0),
        validation.max_length("priority", 8),
    ]


def _orders_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    known = F.when(F.col("priority") != "5-LOW", F.col("customer_id"))
    return t.orders(spark, sf).withColumn("customer_id", known)


@query(f"WITH {_RULED} SELECT order_id, reasons FROM ruled WHERE reasons <> ''")
def flt8_rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = validation.validate(_orders_with_gaps(spark, sf), _order_rules())
    return bad.select("order_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {_RULED} SELECT order_id FROM ruled WHERE reasons = ''")
def flt8_valid_rows(spark: SparkSession, sf: str) -> DataFrame:
    ok, _ = validation.validate(_orders_with_gaps(spark, sf), _order_rules())
    return ok.select("order_id")


@query(
    """
    SELECT l_returnflag AS return_flag, count(*) AS n, round(avg(coalesce(nullif(l_discount, 0.0),
      (SELECT avg(nullif(l_discount, 0.0)) FROM lineitem))), 8) AS mean_discount FROM lineitem GROUP BY 1
    """
)
def flt9_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf).withColumn("discount", F.nullif("discount", F.lit(0.0)))
    filled = shaping.impute(df, "mean", ["discount"])
    return filled.groupBy("return_flag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("discount"), 8).alias("mean_discount")
    )


@query("SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority = '5-LOW' THEN -1 ELSE o_custkey END AS customer_id FROM orders")
def flt9_impute_value(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.impute(_orders_with_gaps(spark, sf), "value", ["customer_id"], -1).select("order_id", "customer_id")


# --- replication, sets, scalar functions -------------------------------------------------------------------------

_SHIFTED = text("o_orderdate + to_days(CAST(30 * i AS INTEGER))")


@query(
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) || '_' || i AS order_id, {_SHIFTED} AS order_date, o_totalprice AS total
    FROM orders, range(30) r(i)
    """
)
def aug1_inflate(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf).select("order_id", "order_date", "total")
    return shaping.inflate(df, 30, "order_id", ["order_date"]).withColumn("order_date", t.stamp("order_date"))


@query(
    """
    SELECT CAST(event_id AS VARCHAR) || '_' || i AS event_id, strftime(CAST(ts AS DATE) + CAST(30 * i AS INTEGER), '%Y-%m-%d') AS day
    FROM events, range(3) r(i)
    """
)
def fn2_date_add_truncates(spark: SparkSession, sf: str) -> DataFrame:
    df = t.events(spark, sf).select("event_id", F.col("event_time").alias("day"))
    moved = shaping.inflate(df, 3, "event_id", ["day"], truncate=True)
    return moved.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT count(*) * 11 AS n, count(*) * 11 AS ids, count(*) AS originals, 0 AS out_of_range FROM orders")
def aug2_augment(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf).select(F.col("order_id"), "order_date", F.col("order_date").alias("before"))
    days = F.datediff("order_date", "before")
    copies = F.col("order_id").contains("_gen")
    return shaping.augment(df, 10, "order_id", "order_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("order_id").alias("ids"),
        F.count_if(~copies & (days == 0)).alias("originals"),
        F.count_if((days < 0) | (days > 364)).cast("int").alias("out_of_range"),
    )


@query("SELECT o_orderkey AS order_id, i AS copy FROM orders, range(3) r(i)")
def set1_union_all_copies(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf).select("order_id")
    return shaping.union_all(*[df.withColumn("copy", F.lit(i).cast("bigint")) for i in range(3)])


@query(
    """
    SELECT l_partkey AS product_id, l_suppkey AS seller_id, strftime(max(l_shipdate), '%Y-%m-%d') AS last_shipped
    FROM lineitem GROUP BY 1, 2
    """
)
def set3_batch_dedup(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf).select("product_id", "seller_id", "ship_date")
    last = shaping.latest_by(df, ["product_id", "seller_id"], ["ship_date"])
    return last.select("product_id", "seller_id", F.date_format("ship_date", "yyyy-MM-dd").alias("last_shipped"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def fn5_parse_json(spark: SparkSession, sf: str) -> DataFrame:
    from mercato.sources.external import parse_json

    df = t.events(spark, sf).select("event_id", F.col("props").alias("value"))
    return parse_json(df, T.StructType([T.StructField("k", T.IntegerType())])).select("event_id", "k")


@query(
    """
    SELECT CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week, CAST(month(o_orderdate) AS INTEGER) AS month,
      CAST(year(o_orderdate) AS INTEGER) AS year, sum(CASE WHEN strftime(o_orderdate, '%m-%d') IN ('01-01', '12-25') THEN 1 ELSE 0 END)::BIGINT AS holidays,
      count(*) AS n FROM orders GROUP BY 1, 2, 3
    """
)
def fn10_calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    # Month-day of two public holidays.
    holidays = spark.createDataFrame([("01-01",), ("12-25",)], "month_day string").withColumn("holiday", F.lit(1))
    df = t.orders(spark, sf).withColumn("month_day", F.date_format("order_date", "MM-dd"))
    return (
        df.join(F.broadcast(holidays), "month_day", "left")
        .groupBy(
            F.dayofweek("order_date").alias("day_of_week"), F.month("order_date").alias("month"), F.year("order_date").alias("year")
        )
        .agg(F.coalesce(F.sum("holiday"), F.lit(0)).alias("holidays"), F.count(F.lit(1)).alias("n"))
    )
