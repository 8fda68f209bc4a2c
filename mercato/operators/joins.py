"""Joins: dimension lookups, fact chains, orphans, stream enrichment, view merging, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators.skew import BROADCAST_BYTES, fits, skew_join

def dim_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Join a dimension: broadcast when it is known to be under ``max_bytes``, else the salted shuffle join."""
    return skew_join(facts, dim, keys, how, max_bytes=max_bytes, spread_by=spread_by)


def merge_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Sort-merge join. The planner adds the shuffle and sort of each side; AQE splits skewed partitions."""
    return left.hint("merge").join(right, keys, how)


def items_enriched(items: DataFrame, products: DataFrame, translations: DataFrame, how: str = "inner") -> DataFrame:
    """items ⋈ products ⋈ translations. With ``inner`` a product without a translated category drops out, and its
    revenue with it; ``left`` keeps it with a null name."""
    named = dim_join(items, products, ["product_id"], how, spread_by=["order_id"])
    return dim_join(named, translations, ["category"], how, spread_by=["order_id"])


def star(
    orders: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame, customers: DataFrame
) -> DataFrame:
    """orders ⋈ items ⋈ products ⋈ sellers ⋈ customers, one row per item.

    Dimensions join the item side first, so the one big shuffle (on order_id) happens once.
    """
    lines = dim_join(items, products, ["product_id"], spread_by=["order_id"])
    lines = dim_join(lines, sellers, ["seller_id"], spread_by=["order_id"])
    buyers = dim_join(orders, customers, ["customer_id"], spread_by=["order_id"])
    return skew_join(lines, buyers, ["order_id"], spread_by=["product_id"])


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return skew_join(child.filter(F.col(child_key).isNotNull()), keys, [child_key], "left_anti")


def zip_centroids(geo: DataFrame, zip_col: str, lat: str, lng: str, city: str, state: str) -> DataFrame:
    """One row per zip prefix: mean position, alphabetically first city and state."""
    return geo.groupBy(F.col(zip_col).alias("zip")).agg(
        F.avg(lat).alias("lat"), F.avg(lng).alias("lng"), F.min(city).alias("city"), F.min(state).alias("state")
    )


def with_geo(df: DataFrame, centroids: DataFrame, zip_col: str) -> DataFrame:
    """Left lookup by zip prefix; ``centroids`` has one row per zip, so rows never multiply."""
    return dim_join(df, centroids.withColumnRenamed("zip", zip_col), [zip_col], "left")


def enrich(stream: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of a stream (or a batch) with static reference data, one dimension row per key."""
    if stream.isStreaming:
        dim = F.broadcast(dim) if fits(dim) else dim
        return stream.join(dim, keys, "left")
    return dim_join(stream, dim, keys, "left")


def serve(batch: DataFrame, speed: DataFrame, keys: list[str]) -> DataFrame:
    """One view from a batch and a real-time view: batch values win, keys known only to the speed view are added."""
    metrics = [c for c in batch.columns if c not in keys]
    fresh = speed.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in metrics], F.lit(True).alias("_in_speed"))
    known = batch.withColumn("_in_batch", F.lit(True))
    return known.join(fresh, keys, "full_outer").select(
        *keys, *[F.when(F.col("_in_batch"), F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c) for c in metrics]
    )


def serve_by_cutoff(batch: DataFrame, speed: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    """Batch rows before the cutoff and real-time rows from it on: a union, no join."""
    return batch.filter(F.col(ts) < cutoff).unionByName(speed.filter(F.col(ts) >= cutoff))


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], metrics: list[str], tolerance: float = 0.0
) -> DataFrame:
    """Compare two results with one row per key.

    ``status``: matched, missing_left, missing_right or differs. Nulls equal each other; numbers may differ by the
    tolerance.
    """
    a = left.select(*keys, *[F.col(m).alias(f"left_{m}") for m in metrics], F.lit(1).alias("_l"))
    b = right.select(*keys, *[F.col(m).alias(f"right_{m}") for m in metrics], F.lit(1).alias("_r"))

    def same(m: str) -> Column:
        x, y = F.col(f"left_{m}"), F.col(f"right_{m}")
        return x.eqNullSafe(y) | F.coalesce(F.abs(x - y) <= F.lit(tolerance), F.lit(False))

    agree = reduce(lambda p, q: p & q, [same(m) for m in metrics])
    status = (
        F.when(F.col("_l").isNull(), "missing_left")
        .when(F.col("_r").isNull(), "missing_right")
        .when(agree, "matched")
        .otherwise("differs")
    )
    return a.join(b, keys, "full_outer").withColumn("status", status).drop("_l", "_r")
