"""Run registered queries against DuckDB and compare exactly."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mercato.plans.tables import NAMES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def _rows(columns: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


# DuckDB type → Spark type
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "float"}


def type_difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    theirs = {r[0]: _TYPES.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (k, theirs[c]) for c, k in df.dtypes if theirs.get(c) != k}


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both engines agree on names, types and values; else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    theirs = _rows(names, found.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(wrong)} of {len(ours)} rows, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from mercato.session import build_session

    sf = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            problem = difference(df, con, oracles[name]) if name in oracles else None
            n = "" if name in oracles else f"rows-only {df.count()}"
            if name in oracles and (odd := type_difference(df, con, oracles[name])):
                n += f"TYPES {odd}"
        except Exception as e:  # noqa: BLE001
            causes = [line.strip() for line in str(e).splitlines() if line.startswith("Caused by")]
            problem, n = f"{type(e).__name__}: {str(e)[:400]} {causes}", ""
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s {n} {problem or ''}", flush=True)
    print("bad:", bad)
