"""Data quality on DataFrames of any size: nulls, duplicates, outliers, profiles, uniqueness, correlation."""

from __future__ import annotations

import html
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.skew import exact_quantiles, numeric_columns


def _is_null(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if isinstance(kind, T.DoubleType | T.FloatType) else missing


def _report(df: DataFrame, names: list[str], fields: dict) -> DataFrame:
    """One pass over the data, then one row per column: ``fields`` maps a field to (column name → aggregate)."""
    wide = df.agg(*[f(c).alias(f"{i}_{k}") for i, c in enumerate(names) for k, f in fields.items()])
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{i}_{k}").alias(k) for k in fields])
            for i, c in enumerate(names)
        ]
    )
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def null_report(df: DataFrame) -> DataFrame:
    """Per column: null_count and null_percent. NaN counts as null; an empty table has a null percent."""
    return _report(
        df,
        df.columns,
        {
            "null_count": lambda c: F.count_if(_is_null(df, c)),
            "null_percent": lambda c: F.try_divide(F.count_if(_is_null(df, c)), F.count(F.lit(1))) * 100,
        },
    )


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies (nulls equal). Copies combine map-side, however many there are."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("total_duplicates"),
    )


def duplicate_sample(df: DataFrame, order_by: list[str], n: int = 10) -> DataFrame:
    """The first n surplus copies in the given order; equality is over all columns outside ``order_by``.

    Only the first n + 1 copies of a group can matter, and the rank filter keeps no more than that per task.
    """
    same = [c for c in df.columns if c not in order_by]
    w = Window.partitionBy(*same).orderBy(*order_by)
    copies = df.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= n + 1)
    return copies.filter(F.col("_nth") > 1).drop("_nth").orderBy(*order_by).limit(n)


def outlier_report(df: DataFrame) -> DataFrame:
    """Per numeric column: exact interpolated Q1 and Q3, bounds ±1.5 · IQR, and how many values lie strictly outside."""
    columns = numeric_columns(df)
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    bounds = (
        quartiles.groupBy("column_name")
        .agg(
            F.max(F.when(F.col("probability") == 0.25, F.col("quantile"))).alias("q1"),
            F.max(F.when(F.col("probability") == 0.75, F.col("quantile"))).alias("q3"),
        )
        .select(
            "column_name",
            "q1",
            "q3",
            (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
            (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper_bound"),
        )
    )
    # one row per column of the schema
    known = {r["column_name"]: r for r in bounds.collect()}
    rows = [(c, *(known[c][k] if c in known else None for k in ("q1", "q3", "lower_bound", "upper_bound"))) for c in columns]
    limits = df.sparkSession.createDataFrame(
        rows, "column_name string, q1 double, q3 double, lower_bound double, upper_bound double"
    )

    def count_outside(c: str) -> Column:
        if c not in known:
            return F.lit(0).cast("bigint")
        value = F.col(c).cast("double")
        lo, hi = known[c]["lower_bound"], known[c]["upper_bound"]
        return F.count_if(~F.isnan(value) & ((value < F.lit(lo)) | (value > F.lit(hi))))

    counts = _report(df, columns, {"outliers": count_outside})
    return limits.join(counts, "column_name")


def iqr_anomalies(df: DataFrame, column: str, eps: float = 0.01) -> DataFrame:
    """Rows outside the IQR bounds of approximate quartiles (relative rank error ``eps``).

    The quantile sketches merge, so one pass of constant memory finds two numbers for the driver. A column without values
    has no bounds and so no anomalies.
    """
    quartiles = df.approxQuantile(column, [0.25, 0.75], eps)
    if not quartiles:
        return df.filter(F.lit(False))
    q1, q3 = quartiles
    spread = q3 - q1
    return df.filter((F.col(column) < q1 - 1.5 * spread) | (F.col(column) > q3 + 1.5 * spread))


def profile(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """Per column: type, rows, nulls, approximate distinct count, min, max, mean, standard deviation."""
    numbers = set(numeric_columns(df))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def number(f, c: str) -> Column:
        return f(F.col(c).cast("double")) if c in numbers else F.lit(None).cast("double")

    return _report(
        df,
        df.columns,
        {
            "data_type": lambda c: F.max(F.lit(kinds[c])),
            "row_count": lambda c: F.count(F.lit(1)),
            "null_count": lambda c: F.count_if(_is_null(df, c)),
            "approx_distinct": lambda c: F.approx_count_distinct(c, rsd),
            "min_value": lambda c: F.min(c).cast("string"),
            "max_value": lambda c: F.max(c).cast("string"),
            "mean": lambda c: number(F.avg, c),
            "stddev": lambda c: number(F.stddev, c),
        },
    )


def quality_metrics(tables: dict[str, tuple[DataFrame, str | None]], as_of: Column) -> DataFrame:
    """Per table: rows, percent of null cells, and hours since the newest row (null without a time column).

    ``tables``: name → (table, time column or None).
    """
    parts = []
    for name, (df, ts) in tables.items():
        nulls = sum((F.count_if(_is_null(df, c)) for c in df.columns), F.lit(0))
        cells = F.count(F.lit(1)) * len(df.columns)
        age = F.timestamp_diff("MINUTE", F.max(ts), as_of) / 60.0 if ts else F.lit(None).cast("double")
        parts.append(
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                (F.try_divide(nulls, cells) * 100).alias("null_percent"),
                age.alias("freshness_hours"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair in one pass; both triangles and the diagonal."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"p{i}").alias("correlation")))
    return one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def histogram(df: DataFrame, column: str, n: int, keys: list[str] | None = None) -> DataFrame:
    """Counts in n equal-width bins between min and max; the last bin includes the max. Null values are left out."""
    keys = keys or []
    value = F.col(column).cast("double")
    bounds = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    placed = df.filter(value.isNotNull()).select(*keys, value.alias("_v"), bounds.alias("_b"))
    width = (F.col("_b.hi") - F.col("_b.lo")) / n
    # all values equal: the width is 0 and everything is in the first bin
    index = F.least(F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_b.lo"), width)), F.lit(0)), F.lit(n - 1))
    binned = placed.groupBy(*keys, index.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_b.lo").alias("_lo"), F.first(width).alias("_w")
    )
    return binned.select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
        "n",
    )


def html_report(reports: dict[str, DataFrame], path: str, generated: datetime | None = None) -> str:
    """Render report tables (one row per column or a short sample, so small by construction) to an HTML file.

    The file goes through the session's file system, so the path may be on an object store.
    """
    parts = ["<html><head><title>Data quality</title></head><body><h1>Data quality</h1>"]
    parts.append(f"<p>{(generated or datetime.now(timezone.utc)).isoformat(timespec='seconds')}</p>")
    for title, report in reports.items():
        parts.append(f"<h2>{html.escape(title)}</h2><table border='1'><tr>")
        parts += [f"<th>{html.escape(c)}</th>" for c in report.columns]
        parts.append("</tr>")
        for row in report.toLocalIterator():
            parts.append("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in row) + "</tr>")
        parts.append("</table>")
    parts.append("</body></html>")
    spark = next(iter(reports.values())).sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target, True)
    try:
        out.write(bytearray("\n".join(parts), "utf-8"))
    finally:
        out.close()
    return path


def population_stability(expected: DataFrame, actual: DataFrame, bin_column: str) -> DataFrame:
    """Drift of a binned feature: per bin both shares and the PSI term (empty shares count as 1e-6)."""
    e = expected.groupBy(bin_column).agg(F.count(F.lit(1)).alias("_e"))
    a = actual.groupBy(bin_column).agg(F.count(F.lit(1)).alias("_a"))
    both = e.join(a, bin_column, "full_outer").fillna(0, subset=["_e", "_a"])
    floor = F.lit(1e-6)
    p = F.greatest(F.try_divide(F.col("_e"), both.agg(F.sum("_e")).scalar()), floor)
    q = F.greatest(F.try_divide(F.col("_a"), both.agg(F.sum("_a")).scalar()), floor)
    return both.select(bin_column, p.alias("expected_share"), q.alias("actual_share")).withColumn(
        "psi",
        (F.col("actual_share") - F.col("expected_share")) * F.log(F.col("actual_share") / F.col("expected_share")),
    )
