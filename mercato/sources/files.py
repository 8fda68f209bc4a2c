"""Batch scans: CSV, Parquet, ORC, JSON, catalog tables; schema checks; incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system that owns the path, so object stores and globs work too."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which costs a second pass: profiling only.

    With a schema, values that do not parse become null.
    """
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_if_exists(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None
) -> DataFrame | None:
    """The table at ``path``, or None (with a message) when nothing is there."""
    if not _path_exists(spark, path):
        print(f"no input at {path}, skipped")
        return None
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def load_tables(
    spark: SparkSession, root: str, names: dict[str, str], schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Lazily open several files under one root: logical name → DataFrame. The suffix picks the format."""
    tables = {}
    for name, file in names.items():
        path = f"{root.rstrip('/')}/{file}"
        schema = (schemas or {}).get(name)
        if file.endswith(".csv"):
            tables[name] = read_csv(spark, path, schema)
        else:
            reader = spark.read.format(file.rsplit(".", 1)[-1])
            tables[name] = (reader.schema(schema) if schema is not None else reader).load(path)
    return tables


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of all tables in one job instead of one job per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def read_table(spark: SparkSession, layer: str, name: str, root: str, fmt: str = "parquet") -> DataFrame:
    """A table of the bronze, silver or gold layer."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{layer}/{name}")


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose files were written with different column sets; absent columns read as null."""
    return spark.read.option("mergeSchema", True).parquet(path)


def project_table(spark: SparkSession, name: str, columns: dict[str, str]) -> DataFrame:
    """Catalog table or view → renamed projection (new name → SQL expression)."""
    return spark.table(name).select(*[F.expr(e).alias(n) for n, e in columns.items()])


def describe_schema(df: DataFrame) -> DataFrame:
    """The schema as a table, one row per column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def validate_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Differences to an expected schema: missing, extra or type-changed columns; empty when they agree."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    rows = [(c, "missing", t, None) for c, t in wanted.items() if c not in actual]
    rows += [(c, "extra", None, t) for c, t in actual.items() if c not in wanted]
    rows += [(c, "type_changed", t, actual[c]) for c, t in wanted.items() if c in actual and actual[c] != t]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, problem string, expected_type string, actual_type string"
    )


def incremental_append(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, one per key; append the result.

    Deduplication combines map-side and runs first, so a key repeated many times reaches the join once.
    """
    return new.dropDuplicates(keys).join(existing.select(*keys).distinct(), keys, "left_anti")
