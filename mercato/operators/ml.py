"""Models on MLlib: recommendations, churn, revenue forecast, baskets, late deliveries; features and their store."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.functions.scalar import days_late, money
from mercato.operators.documents import as_read_model
from mercato.operators.joins import dim_join
from mercato.operators.metrics import customer_segments
from mercato.operators.skew import dense_ids, skew_join
from mercato.operators.topn import top_by_product
from mercato.session import pin, unpin

# --- splits and features -----------------------------------------------------------------------------------------


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """Seeded random parts, for example 0.8 / 0.2."""
    return df.randomSplit(weights, seed)


def hashed_split(df: DataFrame, key: str, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same row lands on the same side in every run and retry."""
    bucket = F.pmod(F.xxhash64(key), F.lit(1000))
    return df.filter(bucket < int(train * 1000)), df.filter(bucket >= int(train * 1000))


def split_by_date(df: DataFrame, date: str, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train on, later rows to test on; for series with one row per period."""
    placed = df.withColumn("_r", F.percent_rank().over(Window.orderBy(date)))
    return placed.filter(F.col("_r") < train).drop("_r"), placed.filter(F.col("_r") >= train).drop("_r")


def feature_pipeline(categorical: list[str], numeric: list[str]) -> Pipeline:
    """Impute means, index and one-hot encode categories, assemble, scale to unit deviation and zero mean.

    Categories are indexed on the driver, so only columns with few values belong in ``categorical``.
    """
    stages = [
        Imputer(inputCols=numeric, outputCols=[f"{c}_filled" for c in numeric]),
        StringIndexer(
            inputCols=categorical, outputCols=[f"{c}_index" for c in categorical], stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_hot" for c in categorical]),
        VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *[f"{c}_hot" for c in categorical]], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def write_features(df: DataFrame, root: str, name: str, version: str, note: str = "") -> str:
    """Store a feature table under ``version=…`` and append a row to the metadata table."""
    path = f"{root.rstrip('/')}/features/{name}"
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    meta = [(name, version, ",".join(df.columns), note)]
    df.sparkSession.createDataFrame(meta, "name string, version string, columns string, note string").withColumn(
        "created_at", F.current_timestamp()
    ).write.mode("append").parquet(f"{root.rstrip('/')}/feature_metadata")
    return path


def read_features(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    """One version of a feature table; other versions are pruned at the directory level."""
    table = spark.read.parquet(f"{root.rstrip('/')}/features/{name}")
    return table.filter(F.col("version") == version).drop("version")


# --- recommendations ---------------------------------------------------------------------------------------------


def interactions(lines: DataFrame, user: str, item: str) -> DataFrame:
    """(user, item, rating 1.0) once per pair: repeated purchases combine map-side into ``times``."""
    return (
        lines.groupBy(F.col(user).alias("user"), F.col(item).alias("item"))
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("rating", F.lit(1.0))
    )


RATINGS_PER_BLOCK = 8_000_000  # ratings that one task of ALS holds: some 45 bytes each while blocks are built


class Recommender:
    """Implicit-feedback ALS over arbitrary ids. Constant ratings carry no signal in explicit mode.

    Users and items lie in ten blocks each, and in more where a block would have more than ``ratings_per_block`` ratings. Blocks
    wait on disk, not in the heap that tasks need, and a checkpoint per iteration lets the shuffles before it go.
    """

    def __init__(self, model: ALSModel, users: DataFrame, items: DataFrame):
        self.model, self.users, self.items = model, users, items

    @classmethod
    def fit(
        cls,
        ratings: DataFrame,
        rank: int = 10,
        max_iter: int = 10,
        reg: float = 0.1,
        seed: int = 42,
        ratings_per_block: int = RATINGS_PER_BLOCK,
    ) -> Recommender:
        users = pin(dense_ids(ratings, "user", "user_ix"))
        items = pin(dense_ids(ratings, "item", "item_ix"))
        placed = pin(cls._placed(ratings, users, items).select("user_ix", "item_ix", "rating"))
        blocks = max(10, math.ceil(placed.count() / ratings_per_block))
        als = ALS(
            rank=rank,
            maxIter=max_iter,
            regParam=reg,
            implicitPrefs=True,
            coldStartStrategy="drop",
            userCol="user_ix",
            itemCol="item_ix",
            ratingCol="rating",
            seed=seed,
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            intermediateStorageLevel="DISK_ONLY",
            checkpointInterval=1,
        )
        model = als.fit(placed)
        unpin(placed)
        return cls(model, users, items)

    @staticmethod
    def _placed(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
        return skew_join(skew_join(ratings, users, ["user"]), items, ["item"])

    def rmse(self, ratings: DataFrame) -> float:
        scored = self.model.transform(self._placed(ratings, self.users, self.items))
        return RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(scored)

    def best(self, n: int = 10) -> DataFrame:
        """(user, items, scores, scored) by number: the n best of every user and how many items were compared for them."""
        return top_by_product(self.model.userFactors, self.model.itemFactors, n)

    def top(self, n: int = 10, best: DataFrame | None = None) -> DataFrame:
        """(user, rank, item, score): the n best items of every user, those of ``best(n)`` where it is at hand."""
        found = self.best(n) if best is None else best
        flat = found.select(F.col("user").alias("user_ix"), F.posexplode(F.arrays_zip("items", "scores")).alias("pos", "r")).select(
            "user_ix", (F.col("pos") + 1).alias("rank"), F.col("r.items").alias("item_ix"), F.col("r.scores").cast("float").alias("score")
        )
        named = dim_join(flat, self.items, ["item_ix"])
        return dim_join(named, self.users, ["user_ix"]).select("user", "rank", "item", "score")


def segment_documents(
    scores: DataFrame, now: DataFrame, churn: PipelineModel, features: list[str], recommender: Recommender, n: int = 10
) -> DataFrame:
    """Customer segments as the read model stores them, with the churn model's probability and the recommender's items.

    ``scores``: recency, frequency and monetary value; ``now``: churn features as of the same day. A customer whom a model
    does not know has a null in its field.
    """
    risk = score(churn, now, features, "customer_id", "churn_probability").drop("prediction")
    docs = customer_segments(scores, risk, recommended_lists(recommender.top(n)))
    return as_read_model(docs, "customer_segments")


def recommended_lists(top: DataFrame) -> DataFrame:
    """(customer_id, recommended_products): the n items of each user as one array, best first."""
    ordered = F.sort_array(F.collect_list(F.struct("rank", F.col("item").cast("string").alias("item"))))
    return top.groupBy(F.col("user").alias("customer_id")).agg(
        F.transform(ordered, lambda x: x["item"]).alias("recommended_products")
    )


# --- churn -------------------------------------------------------------------------------------------------------

# Features of the churn model. days_since_last_order repeats recency; the list names both.
CHURN_FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "avg_order_value",
    "days_since_last_order",
    "avg_review_score",
]


def churn_features(
    orders: DataFrame,
    reviews: DataFrame,
    as_of: Column,
    horizon_days: int = 90,
    label: str = "future",
) -> DataFrame:
    """One row per customer with an order up to ``as_of``: features from that past, and a churn label.

    ``label="future"``: 1 when no order follows within the horizon, so the label comes from a later period than the
    features. ``label="threshold"``: 1 when the last order is more than ``horizon_days`` old, which restates a feature.
    """
    scored = orders.join(reviews.select("order_id", "score"), "order_id", "left")
    past = F.col("order_date") <= as_of
    later = (F.col("order_date") > as_of) & (F.col("order_date") <= F.date_add(as_of, horizon_days))
    cents = F.sum(F.when(past, money("total"))).cast("double")
    last = F.datediff(as_of, F.max(F.when(past, F.col("order_date"))))
    churned = F.max(later.cast("int")) == 0 if label == "future" else last > horizon_days
    return (
        scored.groupBy("customer_id")
        .agg(
            last.alias("recency"),
            F.count_if(past).alias("frequency"),
            cents.alias("monetary"),
            F.try_divide(cents, F.count_if(past)).alias("avg_order_value"),
            last.alias("days_since_last_order"),
            F.avg(F.when(past, F.col("score"))).alias("avg_review_score"),
            churned.cast("int").alias("label"),
        )
        .filter("frequency > 0")
    )


BAG_ROWS = 200_000  # training rows that one task keeps: some 500 bytes each with 100 trees


def dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in partitions of at most about ``rows`` rows; fewer rows in all stay where they are.

    A forest keeps every training row with its weight in every tree, many times the size of the stored row.
    """
    rows = rows or BAG_ROWS
    parts = math.ceil(df.count() / rows)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else df


def fit_forest(df: DataFrame, features: list[str], trees: int = 100, seed: int = 42) -> PipelineModel:
    """Random forest on numeric features; unknown values are replaced by the column mean.

    The copy has no training summary. A summary holds the session, which every scoring task would carry, and which can no
    longer be sent once anything in the session has been observed.
    """
    filled = [f"{c}_in" for c in features]
    fitted = Pipeline(
        stages=[
            Imputer(inputCols=features, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features"),
            RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, seed=seed),
        ]
    ).fit(dealt(df.select("label", *[F.col(c).cast("double") for c in features])))
    return fitted.copy()


def score(model: PipelineModel, df: DataFrame, features: list[str], id_col: str, name: str) -> DataFrame:
    """Batch scoring: (id, probability of class 1, predicted class)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df.withColumns({c: F.col(c).cast("double") for c in features}))
    return out.select(id_col, vector_to_array("probability")[1].alias(name), F.col("prediction").cast("int"))


def classifier_metrics(model: PipelineModel, df: DataFrame, features: list[str]) -> dict[str, float]:
    """AUC, precision, recall and F1 (weighted over classes)."""
    out = model.transform(df.withColumns({c: F.col(c).cast("double") for c in features})).persist()
    found = {"auc": BinaryClassificationEvaluator(labelCol="label").evaluate(out)}
    for name, metric in [("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")]:
        found[name] = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(out)
    out.unpersist()
    return found


def log_loss(label: Column, p: Column) -> Column:
    """Mean negative log likelihood of 0/1 labels; probabilities are kept a billionth away from 0 and 1."""
    safe = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return -F.avg(F.when(label == 1, F.log(safe)).otherwise(F.log(1 - safe)))


def against_chance(train: DataFrame, scored: DataFrame, p: str = "p") -> dict[str, float]:
    """Scores (``p``, ``label``) held against always saying the training share of class 1.

    ``auc``; ``chance_error``, the standard error of the AUC of scores that know nothing; ``loss`` and ``base_loss``, the
    mean log losses of the scores and of that share.
    """
    share = train.agg(F.avg("label")).first()[0]
    label = F.col("label")
    one = scored.agg(
        F.count_if(label == 1).alias("ones"), F.count_if(label == 0).alias("zeros"),
        log_loss(label, F.col(p)).alias("loss"), log_loss(label, F.lit(share)).alias("base_loss"),
    ).first()
    auc = BinaryClassificationEvaluator(rawPredictionCol=p, labelCol="label").evaluate(scored)
    error = ((one["ones"] + one["zeros"] + 1) / (12 * max(1, one["ones"]) * max(1, one["zeros"]))) ** 0.5
    return {"auc": auc, "chance_error": error, "loss": one["loss"], "base_loss": one["base_loss"]}


def importances(model: PipelineModel, features: list[str]) -> dict[str, float]:
    return dict(zip(features, model.stages[-1].featureImportances.toArray().tolist(), strict=True))


# --- forecast ----------------------------------------------------------------------------------------------------

# Features of the forecast.
FORECAST_FEATURES = ["day_of_week", "month", "lag_1", "lag_7"]


def forecast_features(daily: DataFrame, date: str = "date", value: str = "revenue") -> DataFrame:
    """Calendar and lag features of a daily series; the warm-up rows without lags are dropped."""
    w = Window.orderBy(date)
    return daily.select(
        date,
        value,
        F.dayofweek(date).alias("day_of_week"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        F.lag(value, 1).over(w).alias("lag_1"),
        F.lag(value, 7).over(w).alias("lag_7"),
    ).dropna(subset=["lag_1", "lag_7"])


def fit_forecast(df: DataFrame, value: str = "revenue", kind: str = "linear", seed: int = 42) -> PipelineModel:
    """Linear regression, or gradient-boosted trees with ``kind="gbt"``."""
    common = {"featuresCol": "features", "labelCol": value}
    learner = LinearRegression(**common) if kind == "linear" else GBTRegressor(**common, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=FORECAST_FEATURES, outputCol="features"), learner]).fit(df)


def regression_metrics(predictions: DataFrame, value: str = "revenue") -> dict[str, float]:
    def one(metric: str) -> float:
        return RegressionEvaluator(labelCol=value, predictionCol="prediction", metricName=metric).evaluate(predictions)

    return {"rmse": one("rmse"), "r2": one("r2")}


def accuracy_over_time(predictions: DataFrame, date: str, value: str, predicted: str = "prediction") -> DataFrame:
    """Mean absolute percentage error and row count per month."""
    error = F.abs(F.try_divide(F.col(predicted) - F.col(value), F.col(value)))
    return predictions.groupBy(F.date_format(date, "yyyy-MM").alias("year_month")).agg(
        F.avg(error).alias("mape"), F.count(F.lit(1)).alias("n")
    )


# --- baskets and deliveries --------------------------------------------------------------------------------------


def baskets(lines: DataFrame, order: str, item: str) -> DataFrame:
    """(order, items): distinct items per order. Duplicates go map-side first, so an array has at most as many entries
    as there are items."""
    return lines.select(order, item).dropna().distinct().groupBy(order).agg(F.collect_list(item).alias("items"))


def market_basket(transactions: DataFrame, min_support: float = 0.01, min_confidence: float = 0.1) -> FPGrowthModel:
    """Frequent itemsets (``freqItemsets``) and rules (``associationRules``)."""
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(transactions)


# Features of the late-delivery model.
LATE_FEATURES = ["items", "value", "sellers", "month", "day_of_week"]


def late_features(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Per delivered order: what is known when it is placed, and whether it arrived late.

    ``orders`` has order_id, order_date, estimated, actual.
    """
    per_seller = lines.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(money("price")).alias("_value")
    )
    per = per_seller.groupBy("order_id").agg(
        F.sum("_n").alias("items"), F.sum("_value").cast("double").alias("value"), F.count("seller_id").alias("sellers")
    )
    return (
        orders.filter(F.col("actual").isNotNull())
        .join(per, "order_id")
        .select(
            "order_id",
            "items",
            "value",
            "sellers",
            F.month("order_date").alias("month"),
            F.dayofweek("order_date").alias("day_of_week"),
            (days_late("estimated", "actual") > 0).cast("int").alias("label"),
        )
    )
