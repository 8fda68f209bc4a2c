"""The n best items of every user by inner product of factors, without scoring every user against every item."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.skew import running
from mercato.session import pin

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 16 * 1024 * 1024  # item factors that are broadcast at once
STRIP = 256  # items scored before the bound is looked at again
SLACK = 1e-9  # relative rounding that a bound may be off by

_STATE = "user bigint, factors array<float>, items array<bigint>, scores array<double>, scored bigint, done boolean"


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n highest of every row, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=1)[:, :n]
    return np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)


def _walk(
    users: np.ndarray, top: np.ndarray, ids: np.ndarray, factors: np.ndarray, names: np.ndarray, rest: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Go through one chunk of items, longest first: (scores, ids, items scored, finished) for every user.

    No later item is longer than the next strip's first one (``rest`` after the last strip), so by Cauchy-Schwarz none can
    score more than that length times the user's; a user whose n-th score lies above it is finished. A list is sorted
    again only where a strip holds a score that is no lower than its n-th: with longest items first, few do.
    """
    n, size = top.shape[1], np.linalg.norm(users, axis=1)
    lengths = np.linalg.norm(factors, axis=1)
    scored, active = np.zeros(len(users), dtype=np.int64), np.arange(len(users))
    for at in range(0, len(factors), STRIP):
        strip, own = factors[at : at + STRIP], names[at : at + STRIP]
        found = users[active] @ strip.T
        scored[active] += len(strip)
        better = found.max(axis=1) >= top[active, -1]
        found, moved = found[better], active[better]
        top[moved], ids[moved] = _best(
            np.hstack([top[moved], found]), np.hstack([ids[moved], np.broadcast_to(own, found.shape)]), n
        )
        longest = lengths[at + STRIP] if at + STRIP < len(factors) else rest
        active = active[top[active, -1] <= size[active] * longest * (1 + SLACK)]
        if not len(active):
            break
    finished = np.ones(len(users), dtype=bool)
    finished[active] = rest < 0
    return top, ids, scored, finished


def _round(chunk, n: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors, names, rest = chunk.value
        for pdf in batches:
            if not len(pdf):
                continue
            users = np.array(pdf["factors"].tolist(), dtype=np.float64)
            top = np.full((len(pdf), n), -np.inf)
            ids = np.full((len(pdf), n), np.iinfo(np.int64).max)
            for i, (s, x) in enumerate(zip(pdf["scores"], pdf["items"], strict=True)):
                top[i, : len(s)], ids[i, : len(x)] = s, x
            top, ids, scored, finished = _walk(users, top, ids, factors, names, rest)
            real = np.isfinite(top)
            yield pdf.assign(
                items=[list(row[keep]) for row, keep in zip(ids, real, strict=True)],
                scores=[list(row[keep]) for row, keep in zip(top, real, strict=True)],
                scored=pdf["scored"].to_numpy() + scored,
                done=finished,
            )

    return run


def top_by_product(users: DataFrame, items: DataFrame, n: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(user, items, scores, scored): the n highest inner products of every user, best first, ties to the smaller item.

    ``users`` and ``items`` are (id, features) with arrays of finite numbers. Items are numbered by descending length and
    met in chunks of at most ``chunk_bytes``, which is all that is ever broadcast. A user drops out as soon as no item
    left can be among its n best; the others go on to the next chunk, so later rounds see few of them. The lists are
    exact. ``scored`` counts the items a user was really compared with. With fewer than n items all are returned.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    spark = users.sparkSession
    sized = items.select(
        F.col("id").cast("bigint").alias("item"),
        "features",
        F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("length"),
    )
    placed = pin(running(sized.withColumn("short", -F.col("length")), [], [F.col("short"), F.col("item")], {"place": ("count", F.lit(1))}))
    found = placed.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("rank")).first()
    left = pin(
        users.select(
            F.col("id").cast("bigint").alias("user"),
            F.col("features").cast("array<float>").alias("factors"),
            F.array().cast("array<bigint>").alias("items"),
            F.array().cast("array<double>").alias("scores"),
            F.lit(0).cast("bigint").alias("scored"),
            F.lit(not found["n"]).alias("done"),
        ).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    )
    rounds = [left.filter("done")]
    if found["n"]:
        step = max(1, chunk_bytes // (8 * (found["rank"] + 2)))
        for first in range(1, found["n"] + 1, step):
            # one chunk and the length of the item after it: bounded by ``chunk_bytes``
            rows = placed.filter(F.col("place").between(first, first + step)).orderBy("place").toPandas()
            own, after = rows[:step], rows[step:]
            factors = np.array(own["features"].tolist(), dtype=np.float64)
            chunk = spark.sparkContext.broadcast((factors, own["item"].to_numpy(), float(after["length"].iloc[0]) if len(after) else -1.0))
            met = pin(left.filter("not done").mapInPandas(_round(chunk, n), _STATE))
            rounds.append(met.filter("done"))
            left = met
            if left.filter("not done").isEmpty():
                break
    return reduce(DataFrame.unionAll, rounds).select("user", "items", "scores", "scored")
