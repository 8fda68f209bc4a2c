"""K-d tree sharding: split at distributed weighted medians along the widest metadata dimension.

The tree is grown breadth first over a narrow table of (size, coordinates). Every level finds all its medians at once:
bytes are summed per node and key interval, the interval holding the median is cut again, and the driver sees one row
per node and pass. What the driver holds is bounded by the number of leaves, total bytes / target bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import discard, only, rank_within, small_table, store, text_of

STRING_BYTES = 6  # leading bytes of a string that make its coordinate
BINS = 1 << 16  # intervals a node's key range is cut into per pass
COORD_BITS = 31
TIE_BITS = 32


def _coordinate(df: DataFrame, column: str) -> Column:
    """A number that orders the column: numbers as they are, dates as days, text by its leading bytes."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("string", "char", "varchar"):
        head = F.substring(F.hex(F.encode(F.col(column), "UTF-8")), 1, 2 * STRING_BYTES)
        return F.conv(F.rpad(head, 2 * STRING_BYTES, "0"), 16, 10).cast("double")
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.unix_timestamp(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _metadata(docs: DataFrame, id_column: str, dimensions: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    text = text_of()
    kept = [id_column, "text", *[d for d in dimensions if d not in (id_column, "text")]]
    narrow = only(docs, *kept)
    raw = narrow.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("uid"),
        *[_coordinate(narrow, d).alias(f"c{i}") for i, d in enumerate(dimensions)],
    )
    meta = store(raw, "shard-meta")
    finite = [F.when(~F.isnan(f"c{i}"), F.col(f"c{i}")) for i in range(len(dimensions))]
    ends = meta.agg(
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(finite)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(finite)]
    ).first()
    top = float(2**COORD_BITS - 1)
    scaled = []
    for i, c in enumerate(finite):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        # nulls and NaN sit at the low end; a dimension of one value has no width
        share = (c - F.lit(lo)) / F.lit(hi - lo) if lo is not None and hi > lo else F.lit(0.0)
        scaled.append(F.coalesce(F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top), F.lit(0)).cast("long").alias(f"q{i}"))
    tie = F.pmod(F.xxhash64("id", "uid"), F.lit(2**TIE_BITS)).alias("tie")
    return meta.select("id", "size", "crc", "part", "uid", tie, *scaled), meta


def kd_shards(
    docs: DataFrame,
    *,
    target_bytes: int | None = None,
    shards: int | None = None,
    id_column: str = "doc_id",
    dimensions: Sequence[str] = ("source", "lang", "n_chars", "doc_id"),
) -> DataFrame:
    """Put every row into a leaf of about ``target_bytes`` (or into exactly ``shards`` leaves of equal bytes).

    Size is the text's UTF-8 bytes plus one (null text: one). A node of k leaves is cut where its bytes divide as
    floor(k/2) to ceil(k/2), along the dimension whose values in the node span the largest share of the whole table's
    range (ties: the earlier dimension). Rows equal in that dimension are told apart by a hash, so one hot value, or a
    group of copies, spreads over leaves. Returns id, size, crc, shard (int, leaf number from the left) and slot (long,
    gapless from 0 within the shard). An empty table gives no rows; repeated rows are each kept.
    """
    if (target_bytes is None) == (shards is None):
        raise ValueError("give target_bytes or shards")
    spark = docs.sparkSession
    meta, raw = _metadata(docs, id_column, dimensions)
    total = meta.agg(F.sum("size")).first()[0] or 0
    leaves = shards if shards is not None else max(1, round(total / target_bytes))
    placed = store(meta.withColumn("node", F.lit(0).cast("int")), "shard-level")
    discard(raw)
    nodes = {0: leaves}
    while any(k > 1 for k in nodes.values()):
        cuts = _cuts(placed, {n: k for n, k in nodes.items() if k > 1}, len(dimensions))
        moves = [(n, c[0], c[1], nodes[n] // 2) for n, c in cuts.items()]
        table = small_table(spark, moves, "node int, dim int, cut long, first int")
        right = F.coalesce(_key(len(dimensions)) > F.col("cut"), F.lit(False))
        node = F.when(right, F.col("node") + F.col("first")).otherwise(F.col("node"))
        moved = placed.join(table, "node", "left").withColumn("node", node).drop("dim", "cut", "first")
        moved, last = store(moved, "shard-level"), placed
        discard(last)
        placed = moved
        grown = {}
        for n, k in nodes.items():
            if k == 1:
                grown[n] = 1
            elif n in cuts:
                grown |= {n: k // 2, n + k // 2: k - k // 2}
        nodes = grown  # a node without rows has no cut and is not grown further
    final = placed.select("id", "size", "crc", "part", "uid", F.col("node").alias("shard"))
    return rank_within(final, ["shard"], ["uid"], "slot").select("id", "size", "crc", "shard", "slot")


def _key(dimensions: int) -> Column:
    """The value a row is cut by, once its node's dimension is joined: coordinate first, hash last."""
    coord = F.element_at(F.array(*[F.col(f"q{i}") for i in range(dimensions)]), F.col("dim") + 1)
    return coord * F.lit(2**TIE_BITS) + F.col("tie")


def _cuts(placed: DataFrame, nodes: dict[int, int], dimensions: int) -> dict[int, tuple[int, int]]:
    """For every node: the dimension and the largest key of its left half."""
    spark = placed.sparkSession
    wanted = small_table(spark, [(n,) for n in nodes], "node int")
    spans = (
        placed.join(wanted, "node", "left_semi")
        .groupBy("node")
        .agg(F.sum("size").alias("size"), *[F.min(f"q{i}").alias(f"lo{i}") for i in range(dimensions)], *[F.max(f"q{i}").alias(f"hi{i}") for i in range(dimensions)])
        .collect()
    )
    open_nodes: dict[int, dict] = {}
    for r in spans:
        dim = max(range(dimensions), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        k = nodes[r["node"]]
        need = r["size"] * (k // 2) / k
        open_nodes[r["node"]] = {
            "dim": dim, "lo": r[f"lo{dim}"] << TIE_BITS, "hi": (r[f"hi{dim}"] << TIE_BITS) + 2**TIE_BITS - 1,
            "need": need, "slack": r["size"] / k / 10_000,
        }
    found: dict[int, tuple[int, int]] = {}
    while open_nodes:
        rows = [(n, s["dim"], s["lo"], s["hi"], (s["hi"] - s["lo"]) // BINS + 1, float(s["need"])) for n, s in open_nodes.items()]
        table = small_table(spark, rows, "node int, dim int, lo long, hi long, width long, need double")
        keyed = placed.join(table, "node").withColumn("key", _key(dimensions)).where(F.col("key").between(F.col("lo"), F.col("hi")))
        bins = keyed.groupBy("node", "need", F.expr("(key - lo) div width").alias("bin")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
        )
        upto = Window.partitionBy("node").orderBy("bin")
        reached = bins.withColumn("upto", F.sum("size").over(upto)).where("upto >= need")
        first = reached.groupBy("node").agg(F.min(F.struct("bin", "size", "n", "upto")).alias("b"))
        at = {r["node"]: r["b"] for r in first.collect()}
        for n, _, lo, hi, width, need in rows:
            b = at[n]
            before = b["upto"] - b["size"]
            left, right = lo + b["bin"] * width, min(hi, lo + (b["bin"] + 1) * width - 1)
            if width == 1 or b["n"] == 1 or b["size"] <= open_nodes[n]["slack"]:
                nearer_after = b["upto"] - need <= need - before
                found[n] = (open_nodes[n]["dim"], right if nearer_after else left - 1)
                del open_nodes[n]
            else:
                open_nodes[n] |= {"lo": left, "hi": right, "need": need - before}
    return found
