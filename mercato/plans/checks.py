"""Data quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import metrics, quality
from mercato.plans import tables as t
from mercato.plans.registry import query, total

# the item table with gaps: nulls in a number and a text column, NaN in another number column
_GAP_SQL = {"l_discount": "nullif(l_discount, 0.0)", "l_returnflag": "nullif(l_returnflag, 'R')", "l_tax": "CASE WHEN l_tax = 0 THEN 'NaN'::DOUBLE ELSE l_tax END"}
_LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return t.raw(spark, sf, "lineitem").withColumns(
        {
            "l_discount": F.nullif("l_discount", F.lit(0.0)),
            "l_returnflag": F.nullif("l_returnflag", F.lit("R")),
            "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
        }
    )


def _nulls_sql(c: str) -> str:
    missing = f"{c} IS NULL" + f" OR isnan({c})" * (c == "l_tax")
    return f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {missing}) AS null_count, count(*) FILTER (WHERE {missing}) / count(*) * 100 AS null_percent FROM gaps"


@query(
    "WITH gaps AS (SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _GAP_SQL.items()) + ") FROM lineitem) "
    + " UNION ALL ".join(map(_nulls_sql, _LINE_COLUMNS))
)
def dq1_null_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_report(_gaps(spark, sf))


@query(
    """
    WITH g AS (SELECT *, count(*) AS n FROM (SELECT * REPLACE (l_orderkey % 1000 AS l_orderkey, 0 AS l_partkey, 0 AS l_suppkey, 0.0 AS l_extendedprice,
      TIMESTAMP '1998-01-01' AS l_shipdate) FROM lineitem) GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS total_duplicates FROM g
    """
)
def dq2_duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the item table, coarsened so that rows do repeat."""
    coarse = {"l_partkey": F.lit(0), "l_suppkey": F.lit(0), "l_extendedprice": F.lit(0.0), "l_shipdate": F.lit("1998-01-01")}
    df = t.raw(spark, sf, "lineitem").withColumns({"l_orderkey": F.col("l_orderkey") % 1000, **coarse})
    return quality.duplicate_report(df)


@query(
    """
    WITH r AS (SELECT event_id, event_type, user_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS k FROM events)
    SELECT event_id, event_type, user_id FROM r WHERE k > 1 ORDER BY event_id LIMIT 10
    """
)
def dq3_duplicate_sample(spark: SparkSession, sf: str) -> DataFrame:
    df = t.raw(spark, sf, "events").select("event_id", "event_type", "user_id")
    return quality.duplicate_sample(df, ["event_id"])


def _outlier_sql(columns: dict[str, str], table: str) -> str:
    parts = []
    for name, source in columns.items():
        parts.append(
            f"SELECT '{name}' AS column_name, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound, "
            f"(SELECT count(*) FROM {table} WHERE {source} < q1 - 1.5 * (q3 - q1) OR {source} > q3 + 1.5 * (q3 - q1)) AS outliers "
            f"FROM (SELECT quantile_cont(CAST({source} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({source} AS DOUBLE), 0.75) AS q3 FROM {table})"
        )
    inner = " UNION ALL ".join(parts)
    return (
        "SELECT column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower_bound, 6) AS lower_bound, "
        f"round(upper_bound, 6) AS upper_bound, outliers FROM ({inner})"
    )


@query(_outlier_sql({"event_id": "event_id", "user_id": "user_id", "value": "value"}, "events"))
def dq4_outlier_report(spark: SparkSession, sf: str) -> DataFrame:
    report = quality.outlier_report(t.raw(spark, sf, "events"))
    return report.withColumns({c: F.round(c, 6) for c in ("q1", "q3", "lower_bound", "upper_bound")})


_ORDER_COLUMNS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


def _profile_sql(c: str, kind: str) -> str:
    number = kind in ("bigint", "double")
    ends = {"double": "printf('%.2f', {}(o_totalprice))", "timestamp_ntz": "strftime({}(o_orderdate), '%Y-%m-%d %H:%M:%S')"}.get(kind, "CAST({}(" + c + ") AS VARCHAR)")
    moments = f"round(avg({c}), 3), round(stddev_samp({c}), 3)" if number else "NULL::DOUBLE, NULL::DOUBLE"
    return f"SELECT '{c}', '{kind}', count(*), count(*) - count({c}), true, {ends.format('min')}, {ends.format('max')}, {moments} FROM orders"


@query(
    "SELECT * FROM (" + " UNION ALL ".join(_profile_sql(c, k) for c, k in _ORDER_COLUMNS.items())
    + ") p(column_name, data_type, row_count, null_count, distinct_near, min_value, max_value, mean, stddev)"
)
def dq7_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Every column of the order table; the approximate distinct count is held against the exact one."""
    df = t.raw(spark, sf, "orders")
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
    exact = exact.unpivot([], df.columns, "column_name", "exact")
    price, day = F.col("column_name") == "o_totalprice", F.col("column_name") == "o_orderdate"

    def plain(c: str):
        # money and timestamps as text have one form per engine
        text = F.format_string("%.2f", F.col(c).try_cast("double"))
        return F.when(price, text).when(day, F.date_format(F.col(c).try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss")).otherwise(F.col(c))

    return quality.profile(df).join(exact, "column_name").select(
        "column_name", "data_type", "row_count", "null_count",
        (F.abs(F.col("approx_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.1 * F.col("exact"))).alias("distinct_near"),
        plain("min_value").alias("min_value"), plain("max_value").alias("max_value"), F.round("mean", 3).alias("mean"), F.round("stddev", 3).alias("stddev"),
    )


@query(
    """
    SELECT 'orders' AS table_name, count(*) AS row_count, 0.0::DOUBLE AS null_percent,
      date_diff('minute', max(o_orderdate), TIMESTAMP '2001-08-02') / 60.0::DOUBLE AS freshness_hours FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_discount = 0) / (count(*) * 2) * 100, NULL FROM lineitem
    """
)
def dq8_quality_metrics(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.items(spark, sf).select("order_id", F.nullif("discount", F.lit(0.0)).alias("discount"))
    return quality.quality_metrics(
        {"orders": (t.orders(spark, sf), "order_date"), "lineitem": (lines, None)},
        F.lit("2001-08-02").cast("timestamp_ntz"),
    )


_AS_OF = "2024-03-01"
_CLOCKS = {"orders": "o_orderdate", "events": "ts"}


def _all_tables_sql(name: str) -> str:
    clock = f"date_sub('minute', (SELECT max({_CLOCKS[name]}) FROM {name}), TIMESTAMP '{_AS_OF}') / 60.0::DOUBLE" if name in _CLOCKS else "NULL::DOUBLE"
    return (
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count, "
        f"count(*) FILTER (WHERE v IS NULL) / count(*) * 100 AS null_percent, {clock} AS freshness_hours FROM "
        f"(SELECT nullif(COLUMNS(*)::VARCHAR, '0') FROM {name}) UNPIVOT INCLUDE NULLS (v FOR c IN (COLUMNS(*)))"
    )


@query(" UNION ALL ".join(_all_tables_sql(name) for name in t.NAMES))
def dq8_metrics_of_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every table and column; a 0 stands for a missing value, as the given tables have few others."""
    tables = {}
    for name in t.NAMES:
        df = t.raw(spark, sf, name)
        clock = _CLOCKS.get(name)
        blank = [F.when(F.col(c).cast("string") != "0", F.col(c)).alias(c) for c in df.columns]
        tables[name] = (df.select(blank), clock)
    return quality.quality_metrics(tables, F.lit(_AS_OF).cast("timestamp_ntz"))


@query("SELECT l_orderkey AS order_id, l_linenumber AS item_no, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq9_unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.unique_violations(t.items(spark, sf), ["order_id", "item_no"])


_PAIRS = [("price", "l_extendedprice"), ("quantity", "l_quantity"), ("discount", "l_discount")]


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({ca}, {cb}), 9) AS correlation FROM lineitem" for a, ca in _PAIRS for b, cb in _PAIRS
    )
)
def dq10_correlations(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.correlations(t.items(spark, sf), ["price", "quantity", "discount"])
    return found.withColumn("correlation", F.round("correlation", 9))


@query(
    """
    WITH b AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders)
    SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n FROM orders, b GROUP BY 1
    """
)
def dq10_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return quality.histogram(t.orders(spark, sf), "total", 20).select("bin", "n")


@query(
    f"""
    SELECT 'rows' AS metric, CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS left_value,
      CAST((SELECT count(*) FROM lineitem WHERE l_discount > 0) AS DOUBLE) AS right_value, false AS agrees
    UNION ALL SELECT 'orders', (SELECT count(DISTINCT l_orderkey) FROM lineitem), (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_discount > 0),
      (SELECT count(DISTINCT l_orderkey) FROM lineitem) = (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_discount > 0)
    UNION ALL SELECT 'revenue', (SELECT {total('l_extendedprice')} FROM lineitem),
      (SELECT {total('l_extendedprice')} FROM lineitem WHERE l_discount > 0), false
    """
)
def dq11_consistency(spark: SparkSession, sf: str) -> DataFrame:
    df = t.items(spark, sf)
    return metrics.consistency(
        df,
        df.filter("discount > 0"),
        {"rows": F.count(F.lit(1)), "orders": F.countDistinct("order_id"), "revenue": metrics.total("price")},
    )


@query(
    """
    WITH p AS (SELECT user_id % 10 AS bin, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS e, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS a FROM events GROUP BY 1),
    s AS (SELECT bin, greatest(e / (SELECT sum(e) FROM p), 1e-6) AS es, greatest(a / (SELECT sum(a) FROM p), 1e-6) AS acs FROM p)
    SELECT bin, round(es, 9) AS expected_share, round(acs, 9) AS actual_share, round((acs - es) * ln(acs / es), 9) AS psi FROM s
    """
)
def ml10_feature_drift(spark: SparkSession, sf: str) -> DataFrame:
    df = t.events(spark, sf).withColumn("bin", F.col("customer_id") % 10)
    turn = F.lit("2024-01-16").cast("timestamp_ntz")
    found = quality.population_stability(df.filter(F.col("event_time") < turn), df.filter(F.col("event_time") >= turn), "bin")
    return found.withColumns({c: F.round(c, 9) for c in ("expected_share", "actual_share", "psi")})
