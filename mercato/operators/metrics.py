"""Gold aggregates. Money is summed as exact decimals, so results do not depend on row order or partitioning."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.aggregates import geo_mean, share, weighted_avg
from mercato.functions.scalar import days_late, delay_days, delivery_status, money, rfm_segment
from mercato.operators.joins import skew_join
from mercato.operators.skew import dense_ids
from mercato.session import pin


def total(c: Column | str) -> Column:
    """Exact sum returned as a double."""
    return F.sum(money(c)).cast("double")


def revenue_by(df: DataFrame, keys: list[str], price: str = "price") -> DataFrame:
    """Sum of prices per key; null prices are skipped."""
    return df.groupBy(*keys).agg(total(price).alias("revenue"))


def revenue_via(facts: DataFrame, dim: DataFrame, key: str, group: str, price: str = "price") -> DataFrame:
    """Revenue per dimension attribute, summing per join key before the join.

    The join then sees one row per key: a key that holds a third of the facts costs no more than any other.
    """
    per_key = facts.groupBy(key).agg(F.sum(money(price)).alias("_revenue"))
    return per_key.join(dim.select(key, group), key).groupBy(group).agg(F.sum("_revenue").cast("double").alias("revenue"))


def _grouping_sets(keys: list[str], cube: bool) -> list[tuple[str, ...]]:
    """All subsets of the keys, or their prefixes, the finest first."""
    if not cube:
        return [tuple(keys[:i]) for i in range(len(keys), -1, -1)]
    return [chosen for i in range(len(keys), -1, -1) for chosen in combinations(keys, i)]


def revenue_totals(
    df: DataFrame, keys: list[str], price: str = "price", cube: bool = False, distinct: str | None = None
) -> DataFrame:
    """Revenue per key combination with subtotals; ``level`` is the grouping id (0 = all keys present).

    The facts are aggregated once, to the finest grain. Every coarser set is then added up from the smallest set that
    holds its keys, so no fact is repeated per level. ``distinct`` names a column whose different values are counted
    exactly on every level, as ``distinct_<name>``: values are numbers (integers as they are, others numbered in order),
    64 to a word of bits, and words of parents merge with OR; null is no value. An empty table has no rows.
    """
    number = None
    if distinct is not None:
        if not isinstance(df.schema[distinct].dataType, T.IntegralType):
            df = skew_join(df, dense_ids(df, distinct, "_number"), [distinct], "left")
            number = F.col("_number").cast("bigint")
        else:
            number = F.col(distinct).cast("bigint")
    zero = F.lit(0).cast("bigint")
    facts = df.select(
        *keys,
        money(price).alias("_amount"),
        (zero if number is None else F.coalesce(F.shiftright(number, 6), zero)).alias("_word"),
        (zero if number is None else F.coalesce(F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63).cast("int")), zero)).alias("_bits"),
    )

    def added_up(rows: DataFrame, chosen: tuple[str, ...]) -> DataFrame:
        return rows.groupBy(*chosen, "_word").agg(F.sum("_amount").alias("_amount"), F.bit_or("_bits").alias("_bits"))

    done: dict[tuple[str, ...], tuple[int, DataFrame]] = {}
    levels = []
    for chosen in _grouping_sets(keys, cube):
        above = [found for wider, found in done.items() if set(chosen) < set(wider)]
        rows = pin(added_up(min(above, key=lambda x: x[0])[1] if above else facts, chosen))
        done[chosen] = (rows.count(), rows)
        level = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in chosen)
        outputs = [F.sum("_amount").cast("double").alias("revenue")]
        if distinct is not None:
            outputs.append(F.sum(F.bit_count("_bits")).cast("bigint").alias(f"distinct_{distinct}"))
        # without keys there is one group, and none in an empty table
        total_of = rows.groupBy(*chosen) if chosen else rows.groupBy(F.lit(0).alias("_all"))
        named = [F.col(k) if k in chosen else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
        found = total_of.agg(*outputs)
        levels.append(found.select(*named, *found.columns[len(chosen) or 1 :], F.lit(level).cast("bigint").alias("level")))
    return reduce(DataFrame.unionAll, levels)


def revenue_metrics(df: DataFrame, keys: list[str], price: str, order: str, customer: str) -> DataFrame:
    """Revenue, item-row count, mean price per item row (named order value) and exact distinct customers per key."""
    return (
        df.groupBy(*keys)
        .agg(
            F.sum(money(price)).alias("_sum"),
            F.count(order).alias("order_count"),
            F.count(price).alias("_priced"),
            F.countDistinct(customer).alias("unique_customers"),
        )
        .select(
            *keys,
            F.col("_sum").cast("double").alias("total_revenue"),
            "order_count",
            F.try_divide(F.col("_sum").cast("double"), "_priced").alias("avg_order_value"),
            "unique_customers",
        )
    )


def rfm(df: DataFrame, customer: str, date: str, amount: str, as_of: Column) -> DataFrame:
    """Recency in days, frequency and monetary value per customer, in one grouping.

    ``customer`` names the key: the per-order id of the source data would give everyone frequency 1.
    """
    return df.groupBy(customer).agg(
        F.datediff(as_of, F.max(date)).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        total(amount).alias("monetary"),
    )


def with_segment(scores: DataFrame) -> DataFrame:
    return scores.withColumn("segment", rfm_segment("recency", "frequency", "monetary"))


def product_performance(
    items: DataFrame, reviews: DataFrame, views: DataFrame | None = None, product: str = "product_id"
) -> DataFrame:
    """Revenue, units, mean review score and conversion (orders ÷ views) per product.

    Item rows shrink to (product, order) before they meet the reviews, and to products before they meet the views.
    """
    lines = items.groupBy(product, "order_id").agg(F.sum(money("price")).alias("_rev"), F.count(F.lit(1)).alias("_n"))
    scored = skew_join(lines, reviews.select("order_id", "score"), ["order_id"], "left")
    result = scored.groupBy(product).agg(
        F.sum("_rev").cast("double").alias("revenue"),
        F.sum("_n").alias("units"),
        F.count(F.lit(1)).alias("orders"),
        F.avg("score").alias("avg_score"),
    )
    if views is None:
        return result
    seen = views.groupBy(product).agg(F.count(F.lit(1)).alias("views"))
    return result.join(seen, product, "left").withColumn("conversion", F.try_divide("orders", "views"))


def deliveries(orders: DataFrame, items: DataFrame, grace_days: int = 30) -> DataFrame:
    """Per order: estimated and actual delivery where the source has none (order date + grace, last ship date)."""
    last = items.groupBy("order_id").agg(F.max("ship_date").alias("actual"))
    estimated = F.timestamp_add("DAY", F.lit(grace_days), F.col("order_date"))
    return orders.join(last, "order_id", "left").withColumn("estimated", estimated)


def delivery_metrics(df: DataFrame, keys: list[str], ordered: str, estimated: str, actual: str) -> DataFrame:
    """Mean lead time and delay in days, on-time share and delivered count over delivered rows."""
    done = df.filter(F.col(actual).isNotNull())
    return done.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("delivered"),
        F.avg(F.datediff(actual, ordered)).alias("avg_lead_days"),
        F.avg(delay_days(estimated, actual)).alias("avg_delay_days"),
        share(days_late(estimated, actual) <= 0).alias("on_time_rate"),
    )


def status_counts(df: DataFrame, keys: list[str], estimated: str, actual: str) -> DataFrame:
    return df.groupBy(*keys, delivery_status(estimated, actual).alias("delivery_status")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def seller_performance(items: DataFrame, sellers: DataFrame, reviews: DataFrame, delivered: DataFrame) -> DataFrame:
    """Per seller: orders, revenue, units, mean review score and on-time share of its orders; sellers without sales
    keep zeros.

    Items are reduced to one row per (seller, order) first. Scores and on-time flags are per order, so an order
    counts once per seller however many lines it has.
    """
    per_order = items.groupBy("seller_id", "order_id").agg(
        F.sum(money("price")).alias("_rev"), F.count(F.lit(1)).alias("_units")
    )
    facts = reviews.select("order_id", "score").join(
        delivered.select("order_id", (days_late("estimated", "actual") <= 0).alias("_on_time")), "order_id", "full_outer"
    )
    joined = skew_join(per_order, facts, ["order_id"], "left")
    sums = joined.groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("_rev").cast("double").alias("total_revenue"),
        F.avg("score").alias("avg_review_score"),
        F.sum("_units").alias("total_products_sold"),
        F.avg(F.col("_on_time").cast("int")).alias("on_time_delivery_rate"),
    )
    return sellers.join(sums, "seller_id", "left").fillna(
        0, subset=["total_orders", "total_revenue", "total_products_sold"]
    )


def pivot_sum(df: DataFrame, rows: list[str], column: str, values: list[str], amount: str) -> DataFrame:
    """Wide sums for a fixed list of values. Other values of the column are dropped; an absent cell is null."""
    cells = [F.sum(F.when(F.col(column) == v, money(amount))).cast("double").alias(v) for v in values]
    return df.groupBy(*rows).agg(*cells)


def pivot_any(df: DataFrame, rows: list[str], column: str, values: list, agg: Column) -> DataFrame:
    """Pivot with any aggregate; the value list is required, as finding it would cost a job."""
    return df.groupBy(*rows).pivot(column, values).agg(agg)


def unpivot(df: DataFrame, ids: list[str], columns: list[str], key: str, value: str) -> DataFrame:
    """Wide to long; null cells stay."""
    return df.unpivot(ids, columns, key, value)


def weighted_rating(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    return df.groupBy(*keys).agg(weighted_avg(value, weight).alias("weighted_rating"))


def mean_growth(df: DataFrame, keys: list[str], growth: str) -> DataFrame:
    """Geometric mean of growth rates given as fractions."""
    return df.groupBy(*keys).agg(geo_mean(growth).alias("mean_growth"))


def monthly(df: DataFrame, ts: str, amount: str, keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        total(amount).alias("monthly_revenue")
    )


def daily(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(total(amount).alias("revenue"))


def distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key and their share of the whole; the total comes from the grouped counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def clv_trend(df: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    """Per month: spend so far ÷ customers seen so far.

    A customer counts from the month of the first purchase; the windows run over months only.
    """
    per = df.groupBy(F.col(customer).alias("_c"), F.date_format(ts, "yyyy-MM").alias("year_month")).agg(
        F.sum(money(amount)).alias("_spend")
    )
    first = per.groupBy("_c").agg(F.min("year_month").alias("year_month"))
    joined_in = first.groupBy("year_month").agg(F.count(F.lit(1)).alias("_new"))
    spend = per.groupBy("year_month").agg(F.sum("_spend").alias("_spend"))
    so_far = Window.orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return (
        spend.join(joined_in, "year_month", "left")
        .select(
            "year_month",
            F.sum("_spend").over(so_far).cast("double").alias("cumulative_spend"),
            F.sum(F.coalesce("_new", F.lit(0))).over(so_far).alias("customers"),
        )
        .withColumn("clv", F.try_divide("cumulative_spend", "customers"))
    )


def customer_segments(scores: DataFrame, churn: DataFrame | None = None, recs: DataFrame | None = None) -> DataFrame:
    """Segment documents: RFM, segment, churn probability and recommended products (both null when not given).

    ``churn``: (customer_id, churn_probability); ``recs``: (customer_id, recommended_products), one row each.
    """
    docs = with_segment(scores)
    docs = docs.join(churn, "customer_id", "left") if churn is not None else docs.withColumn(
        "churn_probability", F.lit(None).cast("double")
    )
    docs = docs.join(recs, "customer_id", "left") if recs is not None else docs.withColumn(
        "recommended_products", F.lit(None).cast("array<string>")
    )
    return docs.select(
        F.col("customer_id").cast("string").alias("_id"),
        F.col("recency").alias("recency_days"),
        "frequency",
        "monetary",
        F.col("segment").alias("rfm_segment"),
        "churn_probability",
        "recommended_products",
    )


def geo_distribution(df: DataFrame, region: list[str], counted: dict[str, str]) -> DataFrame:
    """Distinct entities per region: output name → column."""
    return df.groupBy(*region).agg(*[F.countDistinct(c).alias(name) for name, c in counted.items()])


def top_k(df: DataFrame, by: str, k: int, tie: list[str]) -> DataFrame:
    """The k largest; ties follow the given columns. Runs as per-task top-k and a merge, not a full sort."""
    return df.orderBy(F.desc(by), *tie).limit(k)


def alerts(metrics: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per (metric row, broken rule): columns of ``metrics`` and ``rule``."""
    fired = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return metrics.withColumn("rule", F.explode(fired))


# Alert thresholds (revenue −20 %, errors 5 %, lag 1000).
REVENUE_DROP_PCT = -20.0
ERROR_RATE = 0.05
MAX_LAG = 1000


def standard_rules(
    growth: str | None = None, error_rate: str | None = None, lag: str | None = None
) -> dict[str, Column]:
    rules: dict[str, Column] = {}
    if growth:
        rules["revenue_drop"] = F.col(growth) < REVENUE_DROP_PCT
    if error_rate:
        rules["error_rate"] = F.col(error_rate) > ERROR_RATE
    if lag:
        rules["lag"] = F.col(lag) > MAX_LAG
    return rules


def consistency(a: DataFrame, b: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Compare whole-table metrics of two tables: one row per metric with both values and whether they agree."""

    def side(df: DataFrame, name: str) -> DataFrame:
        one = df.agg(*[m.cast("double").alias(k) for k, m in metrics.items()])
        return one.unpivot([], list(metrics), "metric", name)

    joined = side(a, "left_value").join(side(b, "right_value"), "metric")
    return joined.withColumn("agrees", F.col("left_value").eqNullSafe(F.col("right_value")))
