"""Models in a session that other queries have used."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from mercato.operators import ml


def test_forest_scores_after_an_observation(spark):
    df = spark.range(400).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 7 > 3 as int) label")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 400}
    model = ml.fit_forest(df, ["a"], trees=3)
    assert not model.stages[-1].hasSummary
    scores = ml.score(model, df, ["a"], "id", "p").join(df, "id")
    wrong = scores.filter((F.col("p") > 0.5).cast("int") != F.col("label"))
    assert scores.count() == 400 and wrong.count() == 0


def test_a_forest_trains_on_partitions_of_bounded_size(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 7 > 3 AS INT) AS label", "id").coalesce(1)
    monkeypatch.setattr(ml, "BAG_ROWS", 100)
    seen = []
    fit = ml.Pipeline.fit
    monkeypatch.setattr(ml.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    model = ml.fit_forest(rows, ["x"], trees=3)
    sizes = seen[0].groupBy(F.spark_partition_id()).count().collect()
    assert sum(n for _, n in sizes) == 4000 and max(n for _, n in sizes) <= 130
    scored = ml.score(model, rows, ["x"], "id", "p").join(rows, "id")
    assert scored.filter("(p > 0.5) <> (label = 1)").isEmpty()


def test_blocks_of_the_recommender_are_bounded(spark, monkeypatch):
    ratings = spark.range(3000).selectExpr("id % 60 AS user", "(id * 7) % 53 AS item", "1.0D AS rating").distinct()
    seen, als = [], ml.ALS
    monkeypatch.setattr(ml, "ALS", lambda **settings: seen.append(settings) or als(**settings))
    few, many = ml.Recommender.fit(ratings, max_iter=2), ml.Recommender.fit(ratings, max_iter=2, ratings_per_block=100)
    count = ratings.count()
    assert seen[0]["numUserBlocks"] == seen[0]["numItemBlocks"] == 10 < count / 100 <= seen[1]["numUserBlocks"] == seen[1]["numItemBlocks"]
    assert all(x["checkpointInterval"] == 1 and x["intermediateStorageLevel"] == "DISK_ONLY" for x in seen)
    assert few.top(5).count() == many.top(5).count() == 5 * 60
