"""Exact top-k inner products over vectors in descending length, pruned by SVD-rotated partial sums.

Vectors are rotated into the eigenbasis of their second moments, so that the leading coordinates hold most of every
length. Per block of vectors, longest first, |q| |v| bounds all scores to come; for the rest the leading coordinates
give a partial sum, and Cauchy-Schwarz bounds what the others can add. What survives is scored in exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import rank_within, store
from mercato.session import scratch_path

QUERY_BLOCK = 4096  # queries sent to all tasks at once; the bound of what is broadcast, with the vector's length
ROWS = 1024  # vectors scored at once
SLACK = 1e-9  # relative error allowed to floating-point bounds; scores themselves are integers
EXACT = float(1 << 62)  # products of lengths below it are scored in 64 bits, others in Python's integers
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantised(vectors: DataFrame, *, scale: int = 1024, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, v array<double>, norm): every component x as floor(scale * x), a whole number however large.

    Null vectors and those that hold null or non-finite components are left out, as are rows without id.
    """
    x = F.col(column).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda e: e * F.lit(float(scale)))
    # doubles from 2^53 on are whole
    v = F.transform(scaled, lambda e: F.when(F.abs(e) < F.lit(float(1 << 53)), F.floor(e).cast("double")).otherwise(e))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.when(fine, v).alias("v")).where("id is not null and v is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e))
    return rows.withColumn("norm", norm)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of one width; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _products(vectors: np.ndarray, query: np.ndarray, bound: float) -> list[int] | np.ndarray:
    """Exact inner products with a query; ``bound`` is no less than any of them."""
    if bound < EXACT:
        return vectors.astype(np.int64) @ query.astype(np.int64)
    asked = [int(c) for c in query]
    return [sum(int(c) * q for c, q in zip(v, asked, strict=True) if q and c) for v in vectors]


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Eigenvectors of the summed outer products of all vectors, largest first; the driver gets width^2 numbers a task.

    Any rotation gives the same result, so vectors whose squares are beyond a double's range may be left out of it.
    """

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for pdf in batches:
            m = _matrix(pdf["v"], width)
            m = m[np.abs(m).max(axis=1, initial=0) < 1e100]
            total += m.T @ m
        yield pd.DataFrame({"i": np.arange(width), "row": list(total)})

    parts = rows.select("v").mapInPandas(moments, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros((width, width))
    for i, j, x in cells:
        gram[i, j] = x
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


class _Best:
    """The k best (score, id) of every query so far; smaller ids win ties. ``lost`` counts scores below 64 bits."""

    def __init__(self, floor: np.ndarray, known: np.ndarray, k: int):
        n = len(floor)
        self.k = k
        self.floor = floor  # scores below it cannot be among the k best
        self.bound = np.where(known, floor.astype(np.float64), -np.inf)
        self.score = np.full((n, k), LEAST)
        self.id = np.full((n, k), MOST)
        self.empty = np.ones((n, k), dtype=bool)
        self.lost = np.zeros(n, dtype=bool)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.score[q], scores]), np.concatenate([self.id[q], ids])
        e = np.concatenate([self.empty[q], np.zeros(len(ids), dtype=bool)])
        order = np.lexsort((i, ~s, e))[: self.k]  # ~s falls as s rises and, unlike -s, always fits
        self.score[q], self.id[q], self.empty[q] = s[order], i[order], e[order]
        if not self.empty[q][-1]:
            self.floor[q] = max(self.floor[q], self.score[q][-1])
            self.bound[q] = float(self.floor[q])


def _scan(queries: np.ndarray, ids: np.ndarray, floor: np.ndarray, known: np.ndarray, basis: np.ndarray, lead: int, k: int, batches: Iterator[pd.DataFrame]) -> _Best:
    width = queries.shape[1]
    best = _Best(floor.copy(), known, k)
    rotated = queries @ basis
    head, rest = rotated[:, :lead], np.linalg.norm(rotated[:, lead:], axis=1)
    lengths = np.linalg.norm(rotated, axis=1)
    for pdf in batches:
        for at in range(0, len(pdf), ROWS):
            part = pdf.iloc[at : at + ROWS]
            exact = _matrix(part["v"], width)
            turned = exact @ basis
            sizes = np.linalg.norm(turned, axis=1)
            longest = sizes.max()
            # beyond a double's range bounds are infinite or no number; either prunes nothing
            with np.errstate(over="ignore", invalid="ignore"):
                reach = lengths * longest
                slack = SLACK * (1 + reach)
                active = np.flatnonzero(~(reach + slack < best.bound))
                if not len(active):
                    continue
                bound = head[active] @ turned[:, :lead].T + np.outer(rest[active], np.linalg.norm(turned[:, lead:], axis=1)) + slack[active, None]
                vec = part["id"].to_numpy(np.int64)
                alive = ~(bound < best.bound[active, None]) & (ids[active, None] != vec[None, :])
            for row in np.flatnonzero(alive.any(axis=1)):
                q, cols = active[row], np.flatnonzero(alive[row])
                scores = _products(exact[cols], queries[q], reach[q] if reach[q] == reach[q] else np.inf)
                if isinstance(scores, list):
                    if max(scores) > MOST:
                        raise OverflowError(f"the score of query {ids[q]} and vector {vec[cols[scores.index(max(scores))]]} does not fit into 64 bits")
                    fits = np.array([s >= LEAST for s in scores])
                    best.lost[q] |= not fits.all()
                    scores, cols = np.array([s for s in scores if s >= LEAST], dtype=np.int64), cols[fits]
                near = scores >= best.floor[q]
                if near.any():
                    best.add(q, scores[near], vec[cols[near]])
    return best


def top_k(
    vectors: DataFrame, *, every: int = 100, k: int = 10, scale: int = 1024, id_column: str = "vec_id", column: str = "embedding", lead: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of every query with all other rows.

    Queries are the rows whose id is divisible by ``every``; a row never meets an id equal to its own. Ties go to the
    smaller id. Null vectors and vectors that hold null or non-finite components take no part, nor do rows without id;
    shorter vectors end in zeros, so an empty one scores 0. Components of any size are scored exactly; a score among the
    best that does not fit into 64 bits is an error. An empty table gives no rows; repeated rows with the same id are each
    a candidate, and a query is asked once per distinct vector. ``lead`` is the number of rotated coordinates in the
    partial sums (default: a quarter).

    Queries go out in blocks of bounded size, each against all rows, and a block's best are stored before the next: rows
    lie in ranges of descending length, the longest range is searched first, and its k-th scores are where all other
    ranges start.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale=scale, id_column=id_column, column=column)
    ordered = store(rows.repartitionByRange(F.col("norm").desc(), "id").sortWithinPartitions(F.col("norm").desc(), "id").withColumn("part", F.spark_partition_id()), "top-vectors")
    facts = ordered.agg(F.max(F.size("v")), F.min("part")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if facts[0] is None:
        return spark.createDataFrame([], schema)
    width, longest = facts
    basis = rotation(ordered, width) if width else np.zeros((0, 0))
    lead = lead or max(1, width // 4)
    asked = store(ordered.where(F.col("id") % every == 0).select("id", "v").distinct().withColumn("part", F.spark_partition_id()), "top-queries")
    numbered = store(rank_within(asked, [], ["id", "v"], "number").withColumn("block", F.expr(f"number div {QUERY_BLOCK}")), "top-blocks")
    path, blocks = scratch_path(spark, "top-found"), numbered.agg(F.max("block")).first()[0]
    if blocks is None:
        return spark.createDataFrame([], schema)
    for block in range(blocks + 1):
        got = numbered.where(F.col("block") == block).select("id", "v").toPandas()
        part = _one_block(ordered, got["id"].to_numpy(np.int64), _matrix(got["v"], width), basis, lead, k, longest)
        part.write.parquet(f"{path}/block={block}")
    found = spark.read.schema(FOUND).parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    message = F.concat(F.lit("a score of query "), "query_id", F.lit(" does not fit into 64 bits"))
    whole = F.when(F.col("score").isNull(), F.raise_error(message).cast("long")).otherwise(F.col("score"))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", whole.alias("score"))


FOUND = "query_id long, vec_id long, score long"  # a null score is one below 64 bits


def _one_block(ordered: DataFrame, ids: np.ndarray, queries: np.ndarray, basis: np.ndarray, lead: int, k: int, longest: int) -> DataFrame:
    spark = ordered.sparkSession
    nothing = np.full(len(ids), LEAST), np.zeros(len(ids), dtype=bool)

    def search(floor: np.ndarray, known: np.ndarray):
        sent = spark.sparkContext.broadcast((ids, queries, floor, known, basis))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            i, q, f, some, r = sent.value
            best = _scan(q, i, f, some, r, lead, k, batches)
            hit = ~best.empty
            yield pd.DataFrame({"query_id": np.repeat(i, hit.sum(axis=1)), "vec_id": best.id[hit], "score": pd.array(best.score[hit], dtype="Int64")})
            if best.lost.any():
                low = i[best.lost]
                yield pd.DataFrame({"query_id": low, "vec_id": low, "score": pd.array([None] * len(low), dtype="Int64")})

        return scan

    first = ordered.where(F.col("part") == longest).orderBy(F.col("norm").desc(), "id")
    firsts = first.select("id", "v").coalesce(1).mapInPandas(search(*nothing), FOUND)
    floors = firsts.where("score is not null").groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
    reached = {r["query_id"]: r["floor"] for r in floors.collect()}  # a row per query of the block
    floor = np.array([reached.get(int(i), LEAST) for i in ids], dtype=np.int64)
    return ordered.select("id", "v").mapInPandas(search(floor, np.array([int(i) in reached for i in ids])), FOUND)
