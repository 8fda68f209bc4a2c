"""Make the reusable functions callable from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mercato.functions import aggregates

# Temporary SQL functions are expanded inline by the optimizer, so they cost no Python worker.
SQL_FUNCTIONS = {
    "discount_pct": """(price DOUBLE, original DOUBLE) RETURNS FLOAT RETURN
        CASE WHEN price IS NULL OR original IS NULL THEN NULL
             WHEN original = 0 THEN 0.0 ELSE try_divide(original - price, original) * 100 END""",
    "days_late": """(estimated TIMESTAMP, actual TIMESTAMP) RETURNS INT RETURN
        CAST(floor((unix_micros(actual) - unix_micros(estimated)) / 86400000000) AS INT)""",
    "delivery_status": """(estimated TIMESTAMP, actual TIMESTAMP) RETURNS STRING RETURN
        CASE WHEN actual IS NULL THEN 'pending'
             WHEN unix_micros(actual) - unix_micros(estimated) < 86400000000 THEN 'on_time'
             WHEN unix_micros(actual) - unix_micros(estimated) < 4 * 86400000000 THEN 'slight_delay'
             ELSE 'late' END""",
    "customer_segment": """(recency INT, frequency BIGINT, monetary DOUBLE) RETURNS STRING RETURN
        CASE WHEN recency < 30 AND frequency > 10 AND monetary > 1000 THEN 'Champion'
             WHEN recency < 60 AND frequency > 5 THEN 'Loyal' ELSE 'At Risk' END""",
    "pct_change": """(value DOUBLE, base DOUBLE) RETURNS DOUBLE RETURN
        try_divide(value - base, base) * 100""",
}


def register_all(spark: SparkSession) -> list[str]:
    """Register every function for this session; returns their names."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    spark.udf.register("weighted_avg", F.pandas_udf(aggregates.weighted_avg_group, "double"))
    spark.udf.register("geo_mean", F.pandas_udf(aggregates.geo_mean_group, "double"))
    return [*SQL_FUNCTIONS, "weighted_avg", "geo_mean"]
