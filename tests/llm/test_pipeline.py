"""The pipeline's stages one by one, each on its own input, and the whole run."""

from __future__ import annotations

import sys
from pathlib import Path

import brute
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from mercato.llm import langid  # noqa: E402


def test_queries_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mix", "pack"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        old, new = before.collect(), out.collect()
        if name != "pack":
            assert out.dtypes == columns
        if name == "language":
            assert {r["doc_id"] for r in new} == {r["doc_id"] for r in old if any(c.isalpha() for c in r["text"] or "")}
        elif name == "near_duplicates":
            root = brute.components([(r["doc_id"], r["text"]) for r in old], 5)
            assert sorted(r["doc_id"] for r in new) == sorted({i for i in root if root[i] == i})
        elif name == "personal_data":
            assert sorted(r["doc_id"] for r in new) == sorted(r["doc_id"] for r in old)
            assert not any(brute.personal(r["text"]) for r in new)
        elif name == "mix":
            words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
            assert abs(words(new) - 1.5 * words(old)) < 0.01 * words(old)
        else:
            assert sum(r["piece"] == 0 for r in new) == len(old)
        before = out
    assert corpus_pipeline.run(spark, sf).count() == before.count()


def test_the_network_names_the_language_of_every_piece(spark, sf, tmp_path):
    """A missing or wrong label of a held-out document does not reach the corpus."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("text rlike '[A-Za-z]{3}'")
    spoilt = docs.withColumn("lang", F.when(~langid.held_out(), F.col("lang")))
    spoilt.write.parquet(str(tmp_path / "documents.parquet"))
    spoilt = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert spoilt.filter("lang is null").count() > 0
    want = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spoilt, langid.fit(spoilt)).collect()}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert packed and all(r["lang"] == want[r["doc_id"]] for r in packed)
