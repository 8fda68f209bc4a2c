"""Row rules: each row either passes or is set aside with the reasons."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.schemas import KEYS, MAX_LENGTHS, ORDER_STATUSES, PAYMENT_TYPES


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a bad row; unknown (null) counts as fine, so absent values need their own rule."""

    name: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column}:null", F.col(column).isNull())


def one_of(column: str, values: list) -> Rule:
    return Rule(f"{column}:domain", ~F.col(column).isin(values))


def between(column: str, lo: object, hi: object) -> Rule:
    return Rule(f"{column}:range", (F.col(column) < F.lit(lo)) | (F.col(column) > F.lit(hi)))


def max_length(column: str, n: int) -> Rule:
    return Rule(f"{column}:length", F.length(column) > n)


def table_rules(table: str) -> list[Rule]:
    """The rules that the source schema implies for a table."""
    rules = [not_null(k) for k in KEYS.get(table, [])]
    rules += [max_length(c, n) for c, n in MAX_LENGTHS.get(table, {}).items()]
    if table == "customers":
        rules.append(not_null("customer_unique_id"))
    if table == "orders":
        rules += [not_null("customer_id"), one_of("order_status", ORDER_STATUSES)]
    if table == "order_payments":
        rules.append(one_of("payment_type", PAYMENT_TYPES))
    if table == "order_reviews":
        rules.append(between("review_score", 1, 5))
    return rules


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``reasons``: the names of the broken rules."""
    return df.withColumn("reasons", F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules])))


def validate(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons). Both read the same one-pass projection."""
    checked = with_reasons(df, rules)
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)
