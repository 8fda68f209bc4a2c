"""Row-wise shaping: casts, projections, predicates, retention, replication."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.scalar import hashed_days, parse_timestamp, shift_days


def to_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast several text columns in one projection."""
    return df.withColumns({c: parse_timestamp(c) for c in columns})


def columns_like(df: DataFrame, parts: tuple[str, ...] = ("timestamp", "date")) -> list[str]:
    """Names that contain any of ``parts``. With the defaults ``order_approved_at`` is not among them."""
    return [c for c in df.columns if any(p in c for p in parts)]


def preview(df: DataFrame, columns: list[str], n: int = 5) -> DataFrame:
    return df.select(*columns).limit(n)


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Add year, month and year_month."""
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "year_month": F.date_format(ts, "yyyy-MM")}
    )


def metric_id(window_start: Column | str, category: Column | str) -> Column:
    """``<window start>_<category>``."""
    start = F.col(window_start) if isinstance(window_start, str) else window_start
    category = F.col(category) if isinstance(category, str) else category
    return F.concat_ws("_", F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss"), category)


def product_doc(products: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename product columns (new name → old name) and nest length, height and width as ``dimensions``."""
    sides = ("length_cm", "height_cm", "width_cm")
    flat = [F.col(old).alias(new) for new, old in names.items() if new not in sides]
    return products.select(*flat, F.struct(*[F.col(names[s]).alias(s) for s in sides]).alias("dimensions"))


def find(df: DataFrame, predicate: Column, limit: int = 0) -> DataFrame:
    """Rows that satisfy the predicate; limit 0 means all."""
    found = df.filter(predicate)
    return found.limit(limit) if limit > 0 else found


def find_one(df: DataFrame, predicate: Column, order_by: list[str]) -> DataFrame:
    """The first match in an explicit order, or no row."""
    return df.filter(predicate).orderBy(*order_by).limit(1)


def find_by_id(df: DataFrame, key: str, value: object) -> DataFrame:
    """Point lookup; an absent key gives no row. The equality reaches the scan."""
    return df.filter(F.col(key) == F.lit(value))


def matching(**fields: object) -> Column:
    """Equality conjunction over fields; None matches null."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in fields.items()], F.lit(True))


def outside(df: DataFrame, column: str, lo: object, hi: object) -> DataFrame:
    """Rows strictly below lo or above hi; null never matches."""
    return df.filter((F.col(column) < F.lit(lo)) | (F.col(column) > F.lit(hi)))


def expire(df: DataFrame, ts: str, seconds: int, now: Column | None = None) -> DataFrame:
    """Drop rows older than ``seconds``; rows without a timestamp never expire."""
    now = F.current_timestamp() if now is None else now
    return df.filter(F.col(ts).isNull() | (F.col(ts) > now - F.make_dt_interval(secs=F.lit(seconds))))


def impute(df: DataFrame, strategy: str, columns: list[str], value: object = None) -> DataFrame:
    """Missing values: ``drop`` rows, fill a ``value``, or fill the column's ``mean`` or (approximate) ``median``."""
    if strategy == "drop":
        return df.dropna(subset=columns)
    if strategy == "value":
        return df.fillna(value, subset=columns)
    return Imputer(strategy=strategy, inputCols=columns, outputCols=columns).fit(df).transform(df)


def inflate(
    df: DataFrame, n: int, id_col: str, ts_cols: list[str], step_days: int = 30, truncate: bool = False
) -> DataFrame:
    """``n`` copies of every row from one scan and no shuffle.

    Copy i has ``_i`` appended to its id and its timestamps moved by ``i * step_days``; the unsuffixed original is not
    kept. ``truncate=True`` drops the time of day, as adding days to a date does.
    """
    return _copies(df, F.sequence(F.lit(0), F.lit(n - 1))).select(
        *[
            F.concat(F.col(c).cast("string"), F.lit("_"), F.col("_copy").cast("string")).alias(c)
            if c == id_col
            else shift_days(c, F.col("_copy") * step_days, truncate).alias(c)
            if c in ts_cols
            else F.col(c)
            for c in df.columns
        ]
    )


def augment(
    df: DataFrame, n: int, id_col: str, ts_col: str, seed: int = 0, per_row: bool = True, truncate: bool = False
) -> DataFrame:
    """The original rows plus ``n`` jittered copies, (n + 1) × the input, from one scan.

    Copy i appends ``_gen{i}`` to the id and moves the timestamp by 0–364 days, drawn per row, or one 0–365 day shift
    per copy with ``per_row=False``. Shifts are hashed, so a rerun gives the same rows.
    """
    copy = F.col("_copy")
    days = hashed_days(id_col, copy, 365, seed) if per_row else hashed_days(F.lit("copy"), copy, 366, seed)
    moved = shift_days(ts_col, F.when(copy < 0, 0).otherwise(days), truncate)
    return _copies(df, F.sequence(F.lit(-1), F.lit(n - 1))).select(
        *[
            F.when(copy < 0, F.col(c).cast("string"))
            .otherwise(F.concat(F.col(c).cast("string"), F.lit("_gen"), copy.cast("string")))
            .alias(c)
            if c == id_col
            else moved.alias(c)
            if c == ts_col
            else F.col(c)
            for c in df.columns
        ]
    )


def _copies(df: DataFrame, numbers: Column) -> DataFrame:
    return df.withColumn("_copy", F.explode(numbers))


def union_all(*tables: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order.

    A struct maximum combines map-side, so a hot key shrinks before the shuffle (a row-number window would move all its
    rows into one task). Rows that tie on ``order`` are decided by the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*df.columns)
    )


def sorted_layout(df: DataFrame, order: list[Column], n: int | None = None) -> DataFrame:
    """Range-partition and sort inside partitions: the layout a compound sort key gives, without one global sort."""
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)
