"""A training corpus from documents: language, near-duplicates, personal data, source mix, packed sequences.

Every stage works on all rows the one before it kept, and is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import langid, mixing, neardup, packing, pii
from mercato.session import configure, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language, which their text names. Null texts and texts without any letter go."""
    configure(spark)
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked at 0.8 over shingles of five words: the one with the smallest doc_id."""
    configure(spark)
    return neardup.without_near_duplicates(docs, width=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; matches are replaced by their kind, terms that disclose them generalised or removed."""
    configure(spark)
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, as often as it takes them; a source's last one is cut where its target ends."""
    configure(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence, its place there and the language of its document."""
    configure(spark)
    packed = packing.pack(docs.select(F.struct("doc_id", "lang").alias("doc_id"), "text"))
    return packed.select("doc_id.doc_id", *[c for c in packed.columns if c != "doc_id"], "doc_id.lang")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("pack", pack),
]

# A network, hashed signatures and a tokenizer are no SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
