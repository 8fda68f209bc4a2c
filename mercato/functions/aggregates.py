"""Aggregate expressions that Spark does not name, and their grouped-UDF surface."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weighted_avg(value: Column | str, weight: Column | str) -> Column:
    """Weighted mean over rows whose value is known; null when their weights sum to 0."""
    value, weight = _col(value), _col(weight)
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def geo_mean(growth: Column | str) -> Column:
    """Geometric mean of growth rates (0.1 = +10 %); any rate of −100 % or less makes it null."""
    growth = _col(growth)
    valid = growth > -1
    mean = F.exp(F.avg(F.log1p(F.when(valid, growth)))) - 1
    return F.when(F.count(F.when(~valid, 1)) == 0, mean)


def share(part: Column | str) -> Column:
    """Fraction of rows for which a condition holds (unknown counts as not holding)."""
    return F.avg(F.when(_col(part), 1.0).otherwise(0.0))


# The two below are for SQL callers that want a registered UDAF; a Python aggregate sees a whole group at once, so
# batch code uses the expressions above, which combine map-side.


def weighted_avg_group(value: pd.Series, weight: pd.Series) -> float:
    known = value.notna()
    total = float(weight[known].sum())
    return float((value[known] * weight[known]).sum()) / total if total else math.nan


def geo_mean_group(growth: pd.Series) -> float:
    known = growth.dropna()
    if known.empty or (known <= -1).any():
        return math.nan
    return math.exp(float(known.map(math.log1p).mean())) - 1
