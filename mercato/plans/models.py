"""Model queries. Feature tables and labels have SQL; fitted models are compared by rows only."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import metrics, ml
from mercato.operators.joins import skew_join
from mercato.plans import tables as t
from mercato.plans.registry import query, total
from mercato.session import pin, scratch_path

AS_OF = "2001-04-01"


def _bought(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.items(spark, sf).select("order_id", "product_id")
    return skew_join(lines, t.orders(spark, sf).select("order_id", "customer_id"), ["order_id"])


@query(
    """
    SELECT o_custkey AS "user", l_partkey AS item, count(*) AS times, 1.0::DOUBLE AS rating
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2
    """
)
def ml1_interactions(spark: SparkSession, sf: str) -> DataFrame:
    return ml.interactions(_bought(spark, sf), "customer_id", "product_id")


@query(
    """
    SELECT o_custkey AS customer_id, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS ix FROM (SELECT DISTINCT o_custkey FROM orders)
    """
)
def ml1_dense_user_ids(spark: SparkSession, sf: str) -> DataFrame:
    from mercato.operators.skew import dense_ids

    return dense_ids(t.orders(spark, sf), "customer_id", "ix")


@query()
def ml2_recommendations(spark: SparkSession, sf: str) -> DataFrame:
    ratings = pin(ml.interactions(_bought(spark, sf), "customer_id", "product_id"))
    return ml.Recommender.fit(ratings).top(10)


@query(
    """
    SELECT count(DISTINCT o_custkey) AS users, least(10, (SELECT count(DISTINCT l_partkey) FROM lineitem)) * count(DISTINCT o_custkey) AS rows,
      true AS ranks_complete, true AS compared_once, true AS better_than_popularity FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    """
)
def ml2_recommendation_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Ten distinct ranked items for every user, none compared with more items than there are, and more of the purchases
    among them than among the ten items that most users bought."""
    ratings = pin(ml.interactions(_bought(spark, sf), "customer_id", "product_id"))
    model = ml.Recommender.fit(ratings)
    best = pin(model.best(10))
    top = pin(model.top(10, best))
    once = best.agg(F.bool_and(F.col("scored").between(F.size("items"), model.model.itemFactors.count()))).scalar()
    popular = ratings.groupBy("item").agg(F.count(F.lit(1)).alias("buyers")).orderBy(F.desc("buyers"), "item").limit(10)
    hits = top.join(ratings, ["user", "item"], "left_semi").agg(F.count(F.lit(1))).scalar()
    per = top.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("item").alias("items"), F.count_distinct("rank").alias("ranks"), F.max("rank").alias("last")
    )
    complete = F.bool_and((F.col("n") == F.col("items")) & (F.col("n") == F.col("ranks")) & (F.col("n") == F.col("last")))
    return per.agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("n").alias("rows"),
        complete.alias("ranks_complete"),
        once.alias("compared_once"),
        (hits > popular.agg(F.sum("buyers")).scalar()).alias("better_than_popularity"),
    )


_CHURN = f"""
    WITH {t.SQL_REVIEWS}, f AS (SELECT o_custkey AS customer_id, max(o_orderdate) FILTER (WHERE past) AS last, count(*) FILTER (WHERE past) AS frequency,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE past) AS DOUBLE) AS monetary, avg(score) FILTER (WHERE past) AS avg_review_score,
      count(*) FILTER (WHERE o_orderdate > DATE '{AS_OF}' AND o_orderdate <= DATE '{AS_OF}' + 90) AS later
      FROM (SELECT *, o_orderdate <= DATE '{AS_OF}' AS past FROM orders LEFT JOIN reviews ON order_id = o_orderkey) GROUP BY 1)
    SELECT customer_id, CAST(date_diff('day', CAST(last AS DATE), DATE '{AS_OF}') AS INTEGER) AS recency, frequency, monetary,
      monetary / frequency AS avg_order_value, CAST(date_diff('day', CAST(last AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order,
      avg_review_score, CAST({{label}} AS INTEGER) AS label FROM f WHERE frequency > 0
"""


def _churn(spark: SparkSession, sf: str, label: str = "future") -> DataFrame:
    return ml.churn_features(t.orders(spark, sf), t.reviews(spark, sf), F.lit(AS_OF).cast("date"), 90, label)


@query(_CHURN.format(label="later = 0"))
def ml3_churn_features(spark: SparkSession, sf: str) -> DataFrame:
    return _churn(spark, sf)


@query(_CHURN.format(label=f"date_diff('day', CAST(last AS DATE), DATE '{AS_OF}') > 90"))
def ml3_churn_threshold_label(spark: SparkSession, sf: str) -> DataFrame:
    return _churn(spark, sf, "threshold")


@query()
def ml4_churn_scores(spark: SparkSession, sf: str) -> DataFrame:
    data = pin(_churn(spark, sf))
    names = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"]
    train, test = ml.hashed_split(data, "customer_id")
    model = ml.fit_forest(train, names)
    return ml.score(model, test, names, "customer_id", "churn_probability")


@query(
    f"""
    WITH o AS (SELECT o_custkey AS customer_id FROM orders WHERE o_orderdate <= DATE '{AS_OF}' GROUP BY 1)
    SELECT count(*) AS customers, true AS parts_disjoint, true AS in_range, true AS scores_differ FROM o
    """
)
def ml4_churn_score_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer is in one part; scores of the test part are probabilities and not all alike."""
    data = pin(_churn(spark, sf))
    names = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"]
    train, test = ml.hashed_split(data, "customer_id")
    scores = pin(ml.score(ml.fit_forest(train, names), test, names, "customer_id", "p"))
    seen = train.select("customer_id", F.lit(0).alias("p")).unionByName(scores.select("customer_id", F.lit(1).alias("p")))
    per = seen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("times"))
    joined = data.select("customer_id").join(per, "customer_id", "left").join(scores.select("customer_id", F.col("p").alias("score")), "customer_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("customers"), F.bool_and(F.coalesce(F.col("times") == 1, F.lit(False))).alias("parts_disjoint"),
        F.bool_and(F.col("score").between(0, 1)).alias("in_range"), (F.max("score") > F.min("score")).alias("scores_differ"),
    )


@query(
    f"""
    SELECT (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderdate <= DATE '{AS_OF}') AS customers,
      true AS threshold_label_found, true AS threshold_beats_base_rate, true AS future_not_below_chance
    """
)
def ml4_churn_quality(spark: SparkSession, sf: str) -> DataFrame:
    """AUC and log loss on the test part, held against the base rate.

    The threshold label follows from a feature, so the forest must find it. Orders of these tables do not depend on
    earlier ones, so no model can foresee the future label: its AUC only has to be within four standard errors of chance.
    """
    names, found = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"], {}
    for label in ("threshold", "future"):
        data = pin(_churn(spark, sf, label))
        train, test = ml.hashed_split(data, "customer_id")
        scored = ml.score(ml.fit_forest(train, names), test, names, "customer_id", "p")
        found[label] = ml.against_chance(train, pin(scored.join(test.select("customer_id", "label"), "customer_id")))
    rule, future = found["threshold"], found["future"]
    return data.agg(
        F.count(F.lit(1)).alias("customers"),
        F.lit(rule["auc"] > 0.9).alias("threshold_label_found"),
        F.lit(rule["loss"] < 0.5 * rule["base_loss"]).alias("threshold_beats_base_rate"),
        F.lit(future["auc"] > 0.5 - 4 * future["chance_error"]).alias("future_not_below_chance"),
    )


@query()
def ml4_churn_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics and feature importances as rows: a handful."""
    data = pin(_churn(spark, sf))
    names = [c for c in ml.CHURN_FEATURES if c != "days_since_last_order"]
    train, test = ml.hashed_split(data, "customer_id")
    model = ml.fit_forest(train, names)
    rows = list(ml.classifier_metrics(model, test, names).items()) + list(ml.importances(model, names).items())
    return spark.createDataFrame(rows, "name string, value double")


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily(t.orders(spark, sf), "order_date", "total")


_FORECAST = f"""
    WITH {t.SQL_DAILY}, l AS (SELECT d, revenue, lag(revenue, 1) OVER (ORDER BY d) AS lag_1, lag(revenue, 7) OVER (ORDER BY d) AS lag_7 FROM daily),
    f AS (SELECT strftime(d, '%Y-%m-%d') AS date, revenue, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(month(d) AS INTEGER) AS month,
      CAST(year(d) AS INTEGER) AS year, lag_1, lag_7 FROM l WHERE lag_7 IS NOT NULL)
"""


@query(f"{_FORECAST} SELECT * FROM f")
def ml5_forecast_features(spark: SparkSession, sf: str) -> DataFrame:
    return ml.forecast_features(_daily(spark, sf)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query()
def ml5_linear_forecast(spark: SparkSession, sf: str) -> DataFrame:
    train, test = ml.split_by_date(pin(ml.forecast_features(_daily(spark, sf))), "date")
    return ml.fit_forecast(train).transform(test).select("date", "revenue", "prediction")


@query()
def ml5_tree_forecast(spark: SparkSession, sf: str) -> DataFrame:
    train, test = ml.split_by_date(pin(ml.forecast_features(_daily(spark, sf))), "date")
    return ml.fit_forecast(train, kind="gbt").transform(test).select("date", "revenue", "prediction")


@query(
    f"""
    {_FORECAST}, r AS (SELECT *, percent_rank() OVER (ORDER BY date) AS p FROM f)
    SELECT count(*) FILTER (WHERE p >= 0.8) AS n, true AS beats_the_day_before, true AS beats_the_week_before, true AS near_the_mean, true AS r2_follows FROM r
    """
)
def ml5_forecast_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The linear forecast over all test days against three naive ones: the day before, the week before, the training mean.

    It must beat both repetitions. Days of these tables do not depend on each other, so the mean is the best forecast
    there is, and the model only has to come within 5 percent of its error.
    """
    train, test = ml.split_by_date(pin(ml.forecast_features(_daily(spark, sf))), "date")
    scored = pin(ml.fit_forecast(train).transform(test).select("revenue", "prediction"))
    found = ml.regression_metrics(scored)
    mean = train.agg(F.avg("revenue")).first()[0]
    naive = {
        name: ml.regression_metrics(test.select("revenue", said.cast("double").alias("prediction")))["rmse"]
        for name, said in {"day": F.col("lag_1"), "week": F.col("lag_7"), "mean": F.lit(mean)}.items()
    }
    spread = scored.agg(F.var_pop("revenue")).first()[0]
    follows = abs(found["r2"] - (1 - found["rmse"] ** 2 / spread)) < 1e-6
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(found["rmse"] < naive["day"]).alias("beats_the_day_before"),
        F.lit(found["rmse"] < naive["week"]).alias("beats_the_week_before"),
        F.lit(found["rmse"] < 1.05 * naive["mean"]).alias("near_the_mean"),
        F.lit(follows).alias("r2_follows"),
    )


@query(f"{_FORECAST}, r AS (SELECT *, percent_rank() OVER (ORDER BY date) AS p FROM f) SELECT date, revenue FROM r WHERE p >= 0.8")
def ml6_split_by_date(spark: SparkSession, sf: str) -> DataFrame:
    _, test = ml.split_by_date(ml.forecast_features(_daily(spark, sf)), "date")
    return test.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "revenue")


@query("SELECT count(*) AS n, true AS disjoint, true AS shares_near, true AS rows_kept FROM orders")
def ml6_random_split_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The three parts share no order, hold all of them unchanged, and are near their shares."""
    weights = [0.6, 0.2, 0.2]
    orders = t.orders(spark, sf).select("order_id", "total")
    parts = ml.random_split(orders, weights)
    both = parts[0].withColumn("part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        both = both.unionByName(p.withColumn("part", F.lit(i)))
    per = both.groupBy("order_id").agg(F.count(F.lit(1)).alias("times"), F.max("total").alias("found"), F.max("part").alias("part"))
    held = orders.join(per, "order_id", "left")
    near = [F.abs(F.count_if(F.col("part") == i) / F.count(F.lit(1)) - w) < 0.1 for i, w in enumerate(weights)]
    return held.agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("times") == 1, F.lit(False))).alias("disjoint"),
        (near[0] & near[1] & near[2]).alias("shares_near"), F.bool_and(F.coalesce(F.col("found") == F.col("total"), F.lit(False))).alias("rows_kept"),
    )


@query()
def ml6_random_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = ml.random_split(t.orders(spark, sf).select("order_id", "total"), [0.6, 0.2, 0.2])
    counts = [p.agg(F.lit(i).alias("part"), F.count(F.lit(1)).alias("n")) for i, p in enumerate(parts)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    """
    WITH f AS (SELECT o_orderkey AS order_id, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END,
      (SELECT avg(o_totalprice) FROM orders WHERE o_orderstatus <> 'P')) AS v, o_orderpriority AS p FROM orders),
    s AS (SELECT avg(v) AS m, stddev_samp(v) AS d FROM f)
    SELECT order_id, round((v - m) / d, 6) AS scaled, CASE WHEN p = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS urgent FROM f, s
    """
)
def ml7_feature_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    df = t.orders(spark, sf).withColumn("total", F.when(F.col("status") != "P", F.col("total")))
    out = ml.feature_pipeline(["priority"], ["total"]).fit(df).transform(df)
    features = vector_to_array("features")
    return out.select("order_id", F.round(features[0], 6).alias("scaled"), features[1].alias("urgent"))


@query(f"SELECT o_custkey AS customer_id, {total('o_totalprice')} AS spend FROM orders GROUP BY 1")
def ml8_versioned_features(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "store")
    spend = t.orders(spark, sf).groupBy("customer_id").agg(metrics.total("total").alias("spend"))
    ml.write_features(spend.withColumn("spend", F.lit(0.0)), root, "spend", "v1", "zeros")
    ml.write_features(spend, root, "spend", "v2", "exact sums")
    return ml.read_features(spark, root, "spend", "v2")


@query("SELECT count(*) AS n, 0::BIGINT AS differing FROM (SELECT o_custkey FROM orders WHERE o_orderdate <= DATE '2001-04-01' GROUP BY 1)")
def ml9_saved_model_scores_alike(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml import PipelineModel

    data = pin(_churn(spark, sf))
    names = ml.CHURN_FEATURES
    model = ml.fit_forest(data, names)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    fresh = ml.score(model, data, names, "customer_id", "a").drop("prediction")
    loaded = ml.score(PipelineModel.load(path), data, names, "customer_id", "b").drop("prediction")
    both = fresh.join(loaded, "customer_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("a") != F.col("b")).alias("differing"))


@query()
def ml10_accuracy_over_time(spark: SparkSession, sf: str) -> DataFrame:
    train, test = ml.split_by_date(pin(ml.forecast_features(_daily(spark, sf))), "date")
    return ml.accuracy_over_time(ml.fit_forecast(train).transform(test), "date", "revenue")


@query(
    f"""
    {_FORECAST}, r AS (SELECT *, percent_rank() OVER (ORDER BY date) AS p FROM f), m AS (SELECT * FROM r WHERE p >= 0.8)
    SELECT date[:7] AS year_month, count(*) AS n, round(avg(abs((lag_7 - revenue) / revenue)), 6) AS week_before, true AS better_overall FROM m GROUP BY 1
    """
)
def ml10_accuracy_against_week_before(spark: SparkSession, sf: str) -> DataFrame:
    """Days and error of repeating the week before, per month of the test part; over all days the model's error is less."""
    train, test = ml.split_by_date(pin(ml.forecast_features(_daily(spark, sf))), "date")
    scored = pin(ml.fit_forecast(train).transform(test).select("date", "revenue", "lag_7", "prediction"))
    naive = ml.accuracy_over_time(scored, "date", "revenue", "lag_7")
    found = ml.accuracy_over_time(scored, "date", "revenue")
    both = pin(naive.withColumnRenamed("mape", "week_before").join(found.drop("n"), "year_month"))
    less = both.agg((F.sum(F.col("mape") * F.col("n")) < F.sum(F.col("week_before") * F.col("n"))).alias("x")).first()[0]
    return both.select("year_month", "n", F.round("week_before", 6).alias("week_before"), F.lit(less).alias("better_overall"))


@query(
    """
    WITH k AS (SELECT l_orderkey AS o, bit_or(CAST(1 << list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) - 1 AS BIGINT)) AS m
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), s AS (SELECT i AS mask FROM range(1, 64) r(i)),
    c AS (SELECT mask, count(*) AS freq FROM k JOIN s ON (m & mask) = mask GROUP BY 1)
    SELECT array_to_string(list_filter(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], lambda x, i: ((mask >> (i - 1)) & 1) = 1), '+') AS itemset, freq
    FROM c WHERE freq >= 0.1 * (SELECT count(*) FROM k)
    """
)
def ml11_frequent_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    lines = skew_join(t.items(spark, sf).select("order_id", "product_id"), t.products(spark, sf).select("product_id", "kind"), ["product_id"])
    model = ml.market_basket(ml.baskets(lines, "order_id", "kind"), min_support=0.1)
    return model.freqItemsets.select(F.array_join(F.sort_array("items"), "+").alias("itemset"), "freq")


_KINDS = "['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD']"


def _kinds_of(mask: str) -> str:
    return f"array_to_string(list_filter({_KINDS}, lambda x, i: (({mask} >> (i - 1)) & 1) = 1), '+')"


@query(
    f"""
    WITH k AS (SELECT l_orderkey AS o, bit_or(CAST(1 << list_position({_KINDS}, p_type) - 1 AS BIGINT)) AS m
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1), n AS (SELECT count(*) AS n FROM k), s AS (SELECT i AS mask FROM range(1, 64) r(i)),
    c AS (SELECT mask, count(*) AS freq FROM k JOIN s ON (m & mask) = mask GROUP BY 1 HAVING count(*) >= 0.1 * (SELECT n FROM n)),
    b AS (SELECT CAST(1 << j AS BIGINT) AS bit FROM range(6) r(j))
    SELECT {_kinds_of('a.mask')} AS antecedent, {_kinds_of('x.mask')} AS consequent, round(u.freq / a.freq, 9) AS confidence,
      round(u.freq / a.freq / (x.freq / n), 9) AS lift, round(u.freq / n, 9) AS support
    FROM c u JOIN b ON (u.mask & bit) = bit AND u.mask <> bit JOIN c a ON a.mask = u.mask - bit JOIN c x ON x.mask = bit, n
    WHERE u.freq / a.freq >= 0.4
    """
)
def ml11_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    lines = skew_join(t.items(spark, sf).select("order_id", "product_id"), t.products(spark, sf).select("product_id", "kind"), ["product_id"])
    rules = ml.market_basket(ml.baskets(lines, "order_id", "kind"), min_support=0.1, min_confidence=0.4).associationRules
    joined = {c: F.array_join(F.sort_array(c), "+") for c in ("antecedent", "consequent")}
    rounded = {c: F.round(c, 9) for c in ("confidence", "lift", "support")}
    return rules.withColumns(joined | rounded).select("antecedent", "consequent", "confidence", "lift", "support")


@query(
    f"""
    WITH {t.SQL_DELIVERED}, p AS (SELECT l_orderkey, count(*) AS items, {total('l_extendedprice')} AS value, count(DISTINCT l_suppkey) AS sellers FROM lineitem GROUP BY 1)
    SELECT order_id, items, value, sellers, CAST(month(order_date) AS INTEGER) AS month, CAST(dayofweek(order_date) + 1 AS INTEGER) AS day_of_week,
      CASE WHEN actual >= estimated + INTERVAL 1 DAY THEN 1 ELSE 0 END AS label FROM delivered JOIN p ON l_orderkey = order_id
    """
)
def ml12_late_features(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.items(spark, sf)
    return ml.late_features(metrics.deliveries(t.orders(spark, sf), lines), lines)


@query()
def ml12_late_scores(spark: SparkSession, sf: str) -> DataFrame:
    lines = t.items(spark, sf)
    data = pin(ml.late_features(metrics.deliveries(t.orders(spark, sf), lines), lines))
    train, test = ml.hashed_split(data, "order_id")
    model = ml.fit_forest(train, ml.LATE_FEATURES)
    return ml.score(model, test, ml.LATE_FEATURES, "order_id", "late_probability")


@query(
    f"""
    WITH {t.SQL_DELIVERED} SELECT count(*) AS orders, true AS parts_disjoint, true AS in_range, true AS better_than_chance,
      true AS better_than_base_rate FROM delivered WHERE actual IS NOT NULL
    """
)
def ml12_late_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every delivered order is in one part; on the test part the AUC lies four standard errors above chance, and the log
    loss below that of always saying the training share of late orders."""
    lines = t.items(spark, sf)
    data = pin(ml.late_features(metrics.deliveries(t.orders(spark, sf), lines), lines))
    train, test = ml.hashed_split(data, "order_id")
    scored = ml.score(ml.fit_forest(train, ml.LATE_FEATURES), test, ml.LATE_FEATURES, "order_id", "p")
    scored = pin(scored.join(test.select("order_id", "label"), "order_id"))
    found = ml.against_chance(train, scored)
    both = train.select("order_id", F.lit(None).cast("double").alias("p")).unionByName(scored.select("order_id", "p"))
    per = both.groupBy("order_id").agg(F.count(F.lit(1)).alias("times"), F.max("p").alias("p"))
    held = data.select("order_id").join(per, "order_id", "left")
    return held.agg(
        F.count(F.lit(1)).alias("orders"),
        F.bool_and(F.coalesce(F.col("times") == 1, F.lit(False))).alias("parts_disjoint"),
        F.bool_and(F.col("p").between(0, 1)).alias("in_range"),
        F.lit(found["auc"] > 0.5 + 4 * found["chance_error"]).alias("better_than_chance"),
        F.lit(found["loss"] < found["base_loss"]).alias("better_than_base_rate"),
    )
