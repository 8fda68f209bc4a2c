"""Building blocks that keep hot keys from landing in one task.

``skew_join`` salts only the keys that need it. ``running`` computes prefix aggregates over an order without a window
that holds a whole key, and ``exact_quantiles`` and ``dense_ids`` follow from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import pin

ROWS_PER_TASK = 1_000_000
BROADCAST_BYTES = 10 * 1024 * 1024


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every key with more rows than one task should take, and into how many parts each must be split.

    There are at most rows / ``rows_per_task`` of them, so the planner chooses how to join the list. The count combines
    map-side.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(*keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_parts"))
    )


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame (for a file scan: bytes on disk, scaled to the columns read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a frame is small enough to broadcast.

    The optimizer multiplies the sizes of joined tables, so a small dimension made of two tables looks big. When the
    files below are small as well, its rows are counted, stopping at the bound.
    """
    if plan_bytes(df) <= max_bytes:
        return True
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    scanned = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if scanned > max_bytes:
        return False
    most = max_bytes // max(1, df._jdf.schema().defaultSize())
    return df.limit(most + 1).count() <= most


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows_per_task: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Equi-join that stays balanced when one key holds a large share of ``left``.

    A right side whose estimated size is at most ``max_bytes`` is broadcast, and nothing is shuffled. Otherwise each side
    is planned and shuffled once, and adaptive execution splits the partitions that turn out skewed.

    Where that cannot help (another operator needs the join's partitioning, or the left side is joined again and again in
    a loop), give the ``hot`` keys of ``left`` from ``hot_keys``, pinned, or ``rows_per_task`` to have them found here:
    their rows are cut into parts by a hash of the row and the number of the partition it was read from, so even
    identical copies spread and a retried task makes the same choice, and ``right`` rows of those keys are repeated once
    per part. ``how``: inner, left, left_semi or left_anti. Rows without a key are dropped before the shuffle where they
    cannot be in the result, and else spread like a hot key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot repeat the right side of a {how} join")
    if fits(right, max_bytes):
        return left.join(F.broadcast(right), keys, how)
    if hot is None and rows_per_task is None:
        return left.join(right, keys, how)
    hot = hot_keys(left, keys, rows_per_task) if hot is None else hot
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    if how in ("inner", "left_semi"):
        left = left.filter(~no_key)
    partitions = F.lit(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = F.pmod(F.xxhash64(*(spread_by or left.columns)) + F.col("_spread"), F.coalesce(F.col("_parts"), partitions))
    salted_left = (
        left.withColumn("_spread", F.spark_partition_id())
        .join(hot, keys, "left")
        .withColumn("_part", F.when(no_key | F.col("_parts").isNotNull(), spread).otherwise(0).cast("int"))
        .drop("_parts", "_spread")
    )
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))))
        .drop("_parts")
    )
    return salted_left.join(salted_right, [*keys, "_part"], how).drop("_part")


def chunked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Range-partition by key and order and pin the result; adds ``_chunk`` and the tie-break ``_tie``.

    A hot key, even one made of identical copies, is spread over several chunks. A key continues from an earlier chunk
    in at most one place per chunk, which bounds the carry table of ``running`` by the number of chunks.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*[F.col(k) for k in keys], *order, F.col("_tie"))
    return pin(ranged.withColumn("_chunk", F.spark_partition_id()))


_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def _combine(kind: str, carry: Column, inside: Column) -> Column:
    if kind == "max":
        return F.greatest(carry, inside)
    if kind == "min":
        return F.least(carry, inside)
    return F.coalesce(carry + inside, inside, carry)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    outputs: dict[str, tuple[str, Column]],
    include_current: bool = True,
) -> DataFrame:
    """Prefix aggregates (sum, count, max, min) per key in the given order, over rows unbounded preceding to current.

    Three steps: aggregate inside each chunk, carry chunk totals forward, add the carry. No task ever sees more than
    one chunk. ``include_current=False`` ends the frame at the previous row. Rows that tie on ``order`` follow the
    pinned input order, so give a total order where the result must be reproducible.
    """
    base = chunked(df, keys, order)
    for name, (_, value) in outputs.items():
        base = base.withColumn(f"_v_{name}", value)
    totals = base.groupBy(*keys, "_chunk").agg(
        *[_FOLDS[kind](f"_v_{name}").alias(f"_c_{name}") for name, (kind, _) in outputs.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_chunk").alias("_k_chunk"),
        F.row_number().over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_nth"),
        *[
            (F.sum if kind in ("sum", "count") else _FOLDS[kind])(f"_c_{name}").over(before).alias(f"_b_{name}")
            for name, (kind, _) in outputs.items()
        ],
    ).filter("_nth > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_chunk") == F.col("_k_chunk")]
    end = 0 if include_current else -1
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, end)
    # at most one continued key per chunk: the broadcast side has no more rows than there are chunks
    joined = base.join(F.broadcast(carried), reduce(lambda a, b: a & b, same), "left")
    return joined.select(
        *df.columns,
        *[
            _combine(kind, F.col(f"_b_{name}"), _FOLDS[kind](f"_v_{name}").over(inside)).alias(name)
            for name, (kind, _) in outputs.items()
        ],
    )


def dense_ids(df: DataFrame, column: str, id_name: str) -> DataFrame:
    """Number the distinct non-null values of ``column`` 0, 1, 2, … in order, without collecting them anywhere."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    numbered = running(values, [], [F.col(column)], {"_rank": ("count", F.lit(1))})
    return numbered.select(column, (F.col("_rank") - 1).cast("int").alias(id_name))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


QUANTILE_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of many columns: one row per (column_name, probability).

    A mergeable sketch first brackets each quantile between two values; its rank error is known, so the bracket is sure
    to hold the answer. A second pass counts what lies below the bracket, and only the values inside it, a few in ten
    thousand, are counted, ranked over their range-partitioned order and picked. Memory does not grow with the number of
    distinct values, as it does for a single-buffer percentile.
    """
    cells = [(c, float(p)) for c in columns for p in probabilities]
    margin = 2.0 / QUANTILE_ACCURACY

    def number(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    def edge(c: str, p: float) -> Column:
        if p <= 0 or p >= 1:
            return F.min(number(c)) if p <= 0 else F.max(number(c))
        return F.percentile_approx(number(c), p, QUANTILE_ACCURACY)

    # both rows have one field per column and probability: bounded by the schema
    found = df.agg(
        *[F.count(number(c)).alias(f"n{i}") for i, (c, _) in enumerate(cells)],
        *[edge(c, p - margin).alias(f"lo{i}") for i, (c, p) in enumerate(cells)],
        *[edge(c, p + margin).alias(f"hi{i}") for i, (c, p) in enumerate(cells)],
    ).first()
    live = [i for i in range(len(cells)) if found[f"n{i}"]]
    schema = "column_name string, probability double, quantile double"
    if not live:
        return df.sparkSession.createDataFrame([], schema)
    below = df.agg(*[F.count_if(number(cells[i][0]) < F.lit(found[f"lo{i}"])).alias(f"b{i}") for i in live]).first()
    inside = F.array_compact(
        F.array(
            *[
                F.when(
                    number(c).between(F.lit(found[f"lo{i}"]), F.lit(found[f"hi{i}"])),
                    F.struct(F.lit(i).alias("cell"), number(c).alias("value")),
                )
                for i, (c, _) in enumerate(cells)
                if i in live
            ]
        )
    )
    counted = df.select(F.explode(inside).alias("x")).select("x.*").groupBy("cell", "value").count()
    ranked = running(counted, ["cell"], [F.col("value")], {"upto": ("sum", F.col("count"))})
    targets = df.sparkSession.createDataFrame(
        [(i, *cells[i], (found[f"n{i}"] - 1) * cells[i][1] - below[f"b{i}"]) for i in live],
        "cell int, column_name string, probability double, position double",
    )
    # one row per column and probability
    hits = ranked.join(F.broadcast(targets), "cell").filter(
        (F.col("upto") - F.col("count") <= F.ceil("position")) & (F.col("upto") > F.floor("position"))
    )
    fraction = F.first("position") - F.floor(F.first("position"))
    low, high = F.min("value"), F.max("value")
    return hits.groupBy("column_name", "probability").agg((low + (high - low) * fraction).alias("quantile"))
