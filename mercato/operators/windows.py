"""Window operators. Frames over raw rows go through ``running``; plain windows here hold one row per period or a
pruned top-n, so their groups stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.scalar import money, pct_change
from mercato.operators.skew import running

_RANKS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def top_n(df: DataFrame, part: list[str], order: list[Column], n: int, method: str = "rank") -> DataFrame:
    """Top n per group with ``rank`` (ties may exceed n), ``dense_rank`` or ``row_number``.

    The filter on the rank prunes each task's rows before the shuffle, so a hot group sends only its candidates.
    """
    ranked = df.withColumn("rank", _RANKS[method]().over(Window.partitionBy(*part).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def growth(df: DataFrame, part: list[str], order: list[str], value: str) -> DataFrame:
    """Previous value and growth in percent; null for the first period or after a zero."""
    w = Window.partitionBy(*part).orderBy(*order)
    with_previous = df.withColumn("previous", F.lag(value, 1).over(w))
    return with_previous.withColumn("growth_pct", pct_change(value, "previous"))


def lead_of(df: DataFrame, part: list[str], order: list[str], value: str, n: int = 1) -> DataFrame:
    return df.withColumn("next_value", F.lead(value, n).over(Window.partitionBy(*part).orderBy(*order)))


def running_total(df: DataFrame, part: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Running sum per key, rows unbounded preceding to current, for keys of any size."""
    return running(df, part, order, {name: ("sum", money(value))}).withColumn(name, F.col(name).cast("double"))


def moving_avg(df: DataFrame, part: list[str], order: list[str], value: str, n: int, name: str) -> DataFrame:
    """Mean of the last n rows (fewer at the start). For period-grain input."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(n - 1), 0)
    mean = F.sum(money(value)).over(w).cast("double") / F.count(value).over(w)
    return df.withColumn(name, mean)


def densify(df: DataFrame, date: str, value: str, fill: float = 0.0) -> DataFrame:
    """One row per calendar day between the first and the last; absent days get ``fill``."""
    bounds = df.agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    days = bounds.select(F.explode(F.sequence("_lo", "_hi")).alias(date))
    return days.join(df, date, "left").withColumn(value, F.coalesce(value, F.lit(fill)))


def lags(df: DataFrame, part: list[str], order: list[str], value: str, steps: list[int]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumns({f"lag_{n}": F.lag(value, n).over(w) for n in steps})


def trailing_zscore(df: DataFrame, part: list[str], order: list[str], value: str, n: int) -> DataFrame:
    """Distance of each period from the mean of the n periods before it, in their standard deviations."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-n, -1)
    return df.withColumns(
        {"trail_mean": F.avg(value).over(w), "trail_std": F.stddev(value).over(w), "trail_n": F.count(value).over(w)}
    ).withColumn("zscore", F.try_divide(F.col(value) - F.col("trail_mean"), F.col("trail_std")))


def revenue_anomalies(
    df: DataFrame, part: list[str], order: list[str], value: str, n: int = 6, threshold: float = 3.0
) -> DataFrame:
    """Spikes and drops: periods at least ``threshold`` deviations off their n predecessors (all n must exist)."""
    scored = trailing_zscore(df, part, order, value, n)
    hit = scored.filter((F.col("trail_n") == n) & (F.abs("zscore") >= threshold))
    return hit.withColumn("kind", F.when(F.col("zscore") > 0, "spike").otherwise("drop"))


# --- time series: input has one row per period -------------------------------------------------------------------


def seasonal_index(df: DataFrame, season: Column, value: str) -> DataFrame:
    """Mean per season ÷ overall mean."""
    per = df.groupBy(season.alias("season")).agg(
        F.sum(money(value)).alias("_s"), F.count(value).alias("periods")
    )
    overall = per.agg(F.sum("_s").cast("double") / F.sum("periods")).scalar()
    mean = F.col("_s").cast("double") / F.col("periods")
    return per.select(
        "season", "periods", mean.alias("season_mean"), F.try_divide(mean, overall).alias("seasonal_index")
    )


def linear_trend(df: DataFrame, x: Column, value: str) -> DataFrame:
    """Least-squares slope, intercept and R² of the value over x."""
    return df.agg(
        F.regr_slope(F.col(value), x).alias("slope"),
        F.regr_intercept(F.col(value), x).alias("intercept"),
        F.regr_r2(F.col(value), x).alias("r2"),
    )


def decompose(df: DataFrame, order: str, value: str, period: int) -> DataFrame:
    """Additive decomposition of an evenly spaced series.

    trend = centred moving average over one period (the two end points of an even period get half weight);
    seasonal = mean of value − trend per position in the period, centred to sum to 0; residual = the rest. Trend and
    residual are null where the frame is incomplete.
    """
    half = period // 2
    w = Window.orderBy(order)
    framed = w.rowsBetween(-half, half)
    if period % 2:
        mean = F.sum(value).over(framed) / period
    else:
        ends = F.lag(value, half).over(w) + F.lead(value, half).over(w)
        mean = (F.sum(value).over(framed) - ends / 2) / period
    complete = F.count(value).over(framed) == 2 * half + 1
    base = df.withColumn("trend", F.when(complete, mean)).withColumn(
        "position", ((F.row_number().over(w) - 1) % period).cast("int")
    )
    raw = base.groupBy("position").agg(F.avg(F.col(value) - F.col("trend")).alias("_raw"))
    centre = raw.agg(F.avg("_raw")).scalar()
    seasonal = raw.select("position", (F.col("_raw") - centre).alias("seasonal"))
    # at most ``period`` rows
    return base.join(F.broadcast(seasonal), "position").withColumn(
        "residual", F.col(value) - F.col("trend") - F.col("seasonal")
    )
