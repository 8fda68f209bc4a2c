"""Scans of systems outside the lake: relational tables over JDBC and message topics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class JdbcConfig:
    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000


def jdbc_options(
    cfg: JdbcConfig, table: str, part_col: str | None = None, lo: str = "", hi: str = "", n: int = 1
) -> dict[str, str]:
    """Reader options; with a partition column the table is read by ``n`` parallel range queries."""
    options = {
        "url": cfg.url,
        "dbtable": table,
        "driver": cfg.driver,
        "fetchsize": str(cfg.fetch_size),
        "user": cfg.user,
        "password": cfg.password,
    }
    if part_col:
        options |= {"partitionColumn": part_col, "lowerBound": lo, "upperBound": hi, "numPartitions": str(n)}
    return options


def read_jdbc(
    spark: SparkSession, cfg: JdbcConfig, table: str, part_col: str | None = None, lo: str = "", hi: str = "", n: int = 1
) -> DataFrame:
    """Relational table scan. Needs the database's driver jar on the classpath. Filters are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(cfg, table, part_col, lo, hi, n)).load()


@dataclass
class StreamConfig:
    """Where events come from. ``kafka`` needs its connector jar; file formats take the same code path."""

    fmt: str = "kafka"
    servers: str = "localhost:9092"
    topics: list[str] = field(default_factory=list)
    starting_offsets: str = "earliest"
    path: str = ""
    glob: str | None = None
    schema: T.StructType | None = None
    max_per_trigger: int | None = None
    consumer: dict[str, str] = field(default_factory=dict)


def stream_options(cfg: StreamConfig) -> dict[str, str]:
    """Source options: subscription, start position, rate limit and consumer pass-through."""
    if cfg.fmt == "kafka":
        options = {
            "kafka.bootstrap.servers": cfg.servers,
            "subscribe": ",".join(cfg.topics),
            "startingOffsets": cfg.starting_offsets,
        }
        options |= {f"kafka.{k}": v for k, v in cfg.consumer.items()}
        if cfg.max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(cfg.max_per_trigger)
        return options
    options = {}
    if cfg.glob:
        options["pathGlobFilter"] = cfg.glob
    if cfg.max_per_trigger:
        options["maxFilesPerTrigger"] = str(cfg.max_per_trigger)
    return options


def read_events(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Streaming scan of topics or of a folder that files arrive in."""
    reader = spark.readStream.format(cfg.fmt).options(**stream_options(cfg))
    if cfg.fmt == "kafka":
        return reader.load()
    return reader.schema(cfg.schema).load(cfg.path)


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON messages to columns. Text that does not parse keeps its raw form in ``_corrupt_record``."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(F.col(column).cast("string"), with_corrupt, options)
    # generated columns: a later filter on them is not pushed below, where it would parse the text a second time
    return df.select(*[c for c in df.columns if c != column], F.inline(F.array(parsed)))


def route(df: DataFrame, topic: str) -> DataFrame:
    """The messages of one topic of a multi-topic subscription."""
    return df.filter(F.col("topic") == topic)
