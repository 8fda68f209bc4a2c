"""Column expressions. All are built-in expressions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: Column | str) -> Column:
    """Text to timestamp; text that is no timestamp gives null instead of an ANSI error."""
    return F.try_to_timestamp(_col(c).cast("string"))


def shift_days(c: Column | str, days: Column | int, truncate: bool = False) -> Column:
    """Move a timestamp by whole days, keeping the time of day; ``truncate=True`` gives a DATE as ``date_add`` does."""
    days = F.lit(days) if isinstance(days, int) else days
    if truncate:
        return F.date_add(_col(c), days)
    return F.timestamp_add("DAY", days, _col(c))


def hashed_days(id_column: Column | str, copy: Column, span: int = 365, seed: int = 0) -> Column:
    """A day shift in [0, span) that looks random but depends only on the row, so reruns and retries agree."""
    return F.pmod(F.xxhash64(_col(id_column), copy, F.lit(seed)), F.lit(span)).cast("int")


def pct_change(value: Column | str, base: Column | str) -> Column:
    """(value − base) / base × 100; null when base is null or 0."""
    return F.try_divide(_col(value) - _col(base), _col(base)) * 100


def discount_pct(price: Column | str, original: Column | str) -> Column:
    """Discount in percent as a 32-bit float: 0.0 when the original price is 0, null when either input is null."""
    price, original = _col(price), _col(original)
    known = price.isNotNull() & original.isNotNull()
    pct = F.when(original == 0, F.lit(0.0)).otherwise(F.try_divide(original - price, original) * 100)
    return F.when(known, pct).cast("float")


def days_late(estimated: Column | str, actual: Column | str) -> Column:
    """Whole elapsed days from estimate to delivery, floored (so −12 h is −1 and +5 h is 0)."""

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    return F.floor((micros(_col(actual)) - micros(_col(estimated))) / F.lit(DAY_MICROS)).cast("int")


def delivery_status(estimated: Column | str, actual: Column | str) -> Column:
    """pending while undelivered; on_time up to 0 whole days late, slight_delay up to 3, late beyond."""
    late = days_late(estimated, actual)
    return (
        F.when(_col(actual).isNull(), "pending")
        .when(late <= 0, "on_time")
        .when(late <= 3, "slight_delay")
        .otherwise("late")
    )


def delay_days(estimated: Column | str, actual: Column | str) -> Column:
    """Calendar days between the estimated and the actual date (negative when early)."""
    return F.datediff(_col(actual), _col(estimated))


def rfm_segment(recency: Column | str, frequency: Column | str, monetary: Column | str) -> Column:
    """Champion, Loyal or At Risk; the first rule that holds wins."""
    recency, frequency, monetary = _col(recency), _col(frequency), _col(monetary)
    return (
        F.when((recency < 30) & (frequency > 10) & (monetary > 1000), "Champion")
        .when((recency < 60) & (frequency > 5), "Loyal")
        .otherwise("At Risk")
    )


def micros_to_timestamp(c: Column | str) -> Column:
    """Epoch microseconds to a timestamp truncated to milliseconds, in the session zone (UTC)."""
    return F.timestamp_millis(F.floor(_col(c).cast("bigint") / F.lit(1000)).cast("bigint"))


def image_field(image: Column | str, name: str, kind: str = "string") -> Column:
    """One field of a row image (map of strings) as ``kind``; absent or unreadable values give null."""
    return F.try_element_at(_col(image), F.lit(name)).try_cast(kind)


# Opinion words for rule-based review scores.
POSITIVE_WORDS = ["good", "great", "excellent", "best", "love", "fast", "happy", "perfect", "nice", "easy"]
NEGATIVE_WORDS = ["bad", "poor", "worst", "hate", "slow", "broken", "late", "wrong", "hard", "problem"]


def sentiment_score(text: Column | str) -> Column:
    """Positive minus negative opinion words in the whole text; null text gives null."""
    words = F.split(F.lower(_col(text)), "[^a-z]+")

    def hits(vocabulary: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(vocabulary)))

    return F.when(_col(text).isNotNull(), hits(POSITIVE_WORDS) - hits(NEGATIVE_WORDS))


def sentiment_label(score: Column | str) -> Column:
    score = _col(score)
    return F.when(score > 0, "positive").when(score < 0, "negative").when(score == 0, "neutral")


MONEY_SCALE = 6


def money(c: Column | str, scale: int = MONEY_SCALE) -> Column:
    """An amount as an exact number of ``scale`` decimals; sums of it do not depend on the order of rows.

    Eighteen digits stand before the point. An amount that is not a number is refused: it would silently vanish from sums.
    """
    c = _col(c)
    refuse = F.raise_error(F.lit("an amount is not a number")).cast(f"decimal({18 + scale},{scale})")
    return F.when(F.isnan(c.cast("double")), refuse).otherwise(c.cast(f"decimal({18 + scale},{scale})"))
