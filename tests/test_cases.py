"""Hand-checked cases: null paths, boundaries, sequences."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import scalar
from mercato.functions.aggregates import geo_mean, weighted_avg
from mercato.functions.register import register_all
from mercato.operators import cdc, documents, joins, metrics, quality, shaping, validation, windows
from mercato.plans import feeds
from mercato.schemas import KEYS, TABLES
from mercato.sources import external, files, sinks


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_quality_example(spark, tmp_path):
    df = spark.createDataFrame(
        [("A", 20, 1000.0), ("B", 21, 2000.0), ("C", 22, None), ("C", 22, 2000.0), (None, 1000, 3000.0)],
        "name string, age int, salary double",
    )
    nulls = {r[0]: (r[1], r[2]) for r in rows(quality.null_report(df))}
    assert nulls == {"name": (1, 20.0), "age": (0, 0.0), "salary": (1, 20.0)}
    assert rows(quality.duplicate_report(df)) == [(5, 5, 0)]
    out = {r["column_name"]: r for r in quality.outlier_report(df).collect()}
    assert (out["age"]["q1"], out["age"]["q3"]) == (21, 22)
    assert (out["age"]["lower_bound"], out["age"]["upper_bound"], out["age"]["outliers"]) == (19.5, 23.5, 1)
    assert (out["salary"]["lower_bound"], out["salary"]["upper_bound"], out["salary"]["outliers"]) == (1000, 3000, 0)
    page = tmp_path / "report.html"
    quality.html_report({"nulls <b>": quality.null_report(df)}, str(page))
    assert "nulls &lt;b&gt;" in page.read_text() and "salary" in page.read_text()


def test_null_report_of_nothing(spark):
    df = spark.createDataFrame([], "a int, b double")
    assert rows(quality.null_report(df)) == [("a", 0, None), ("b", 0, None)]
    assert rows(quality.duplicate_report(df)) == [(0, 0, 0)]


def test_duplicate_sample_keeps_input_order(spark):
    df = spark.createDataFrame([(i, "x" if i % 2 else "y") for i in range(30)], "i int, v string")
    assert [r[0] for r in rows(quality.duplicate_sample(df, ["i"], 10))] == list(range(2, 12))


@pytest.mark.parametrize(
    ("actual", "floor", "status"),
    [
        (None, None, "pending"),
        ("2018-01-09 12:00:00", -1, "on_time"),
        ("2018-01-10 23:59:59", 0, "on_time"),
        ("2018-01-11 00:00:00", 1, "slight_delay"),
        ("2018-01-13 23:59:59", 3, "slight_delay"),
        ("2018-01-14 00:00:00", 4, "late"),
    ],
)
def test_delivery_status(spark, actual, floor, status):
    register_all(spark)
    df = spark.createDataFrame([("2018-01-10 00:00:00", actual)], "e string, a string").selectExpr(
        "cast(e as timestamp_ntz) e", "cast(a as timestamp_ntz) a"
    )
    found = df.select(
        scalar.days_late("e", "a"),
        scalar.delivery_status("e", "a"),
        F.expr("delivery_status(cast(e as timestamp), cast(a as timestamp))"),
    )
    assert rows(found) == [(floor, status, status)]


def test_under_a_day_late_is_on_time(spark):
    df = spark.sql("SELECT timestamp_ntz'2018-01-10 20:00:00' e, timestamp_ntz'2018-01-11 01:00:00' a")
    assert rows(df.select(scalar.delivery_status("e", "a"), scalar.delay_days("e", "a"))) == [("on_time", 1)]


def test_discount(spark):
    df = spark.createDataFrame(
        [(80.0, 100.0), (5.0, 0.0), (120.0, 100.0), (None, 100.0), (5.0, None)], "p double, o double"
    )
    assert [r[0] for r in rows(df.select(scalar.discount_pct("p", "o")))] == [20.0, 0.0, -20.0, None, None]
    assert df.select(scalar.discount_pct("p", "o").alias("d")).schema["d"].dataType == T.FloatType()


def test_segments(spark):
    cases = [
        ((29, 11, 1001), "Champion"),
        ((30, 11, 1001), "Loyal"),
        ((29, 11, 1000), "Loyal"),
        ((59, 6, 0), "Loyal"),
        ((60, 6, 5000), "At Risk"),
        ((10, 5, 5000), "At Risk"),
    ]
    df = spark.createDataFrame([c[0] for c in cases], "r int, f int, m int")
    assert [r[0] for r in rows(df.select(scalar.rfm_segment("r", "f", "m")))] == [c[1] for c in cases]


def test_weighted_and_geometric_means(spark):
    df = spark.createDataFrame([(5.0, 2.0), (3.0, 1.0), (None, 4.0)], "v double, w double")
    assert rows(df.agg(F.round(weighted_avg("v", "w"), 4))) == [(4.3333,)]
    growth = spark.createDataFrame([(0.1,), (0.2,), (-0.05,), (None,)], "g double")
    assert rows(growth.agg(F.round(geo_mean("g"), 6))) == [(0.078365,)]
    ruined = growth.unionByName(spark.createDataFrame([(-1.0,)], "g double"))
    assert rows(ruined.agg(geo_mean("g"))) == [(None,)]
    register_all(spark)
    df.createOrReplaceTempView("vw")
    assert rows(spark.sql("SELECT round(weighted_avg(v, w), 4) FROM vw")) == [(4.3333,)]


def _messages(spark, *texts):
    return spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "kafka_offset long, value string")


def _event(op, after, ts=1, before="null"):
    return f'{{"schema": {{}}, "payload": {{"before": {before}, "after": {after}, "op": "{op}", "ts_ms": {ts}}}}}'


def test_change_sequence(spark):
    feed = _messages(
        spark,
        _event("c", '{"order_id": "o1", "customer_id": "c1", "order_status": "created", "order_purchase_timestamp": 1514764800123456}'),
        _event("u", '{"order_id": "o1", "customer_id": "c1", "order_status": "approved", "order_purchase_timestamp": null}', 2),
        _event("u", '{"order_id": "o1", "customer_id": null, "order_status": "shipped"}', 3),
        _event("d", "null", 4, '{"order_id": "o1"}'),
        "junk",
        '{"order_id": "o1"}',
        _event("u", '{"customer_id": "c9"}', 5),
        _event("u", "{}", 6),
    )
    ok, bad = cdc.split_bad(cdc.decode_cdc(feed))
    assert sorted(rows(bad.select("kafka_offset", "reason"))) == [(4, "malformed"), (6, "missing_key")]
    typed = cdc.order_changes(ok.withColumn("ts_ms", F.col("payload.ts_ms")), ["ts_ms", "kafka_offset"])
    empty = spark.createDataFrame([], cdc.ORDER_STATE)
    kept = cdc.apply_cdc(empty, typed)
    assert rows(kept) == [("o1", None, "shipped", datetime(2018, 1, 1, 0, 0, 0, 123000))]
    assert rows(cdc.apply_cdc(kept, typed)) == rows(kept)
    assert cdc.apply_cdc(empty, typed, deletes="apply").count() == 0


def test_change_after_delete_starts_anew(spark):
    feed = _messages(
        spark,
        _event("c", '{"order_id": "o1", "customer_id": "c1", "order_purchase_timestamp": 1000000}', 1),
        _event("d", "null", 2, '{"order_id": "o1"}'),
        _event("c", '{"order_id": "o1", "customer_id": "c2"}', 3),
    )
    ok, _ = cdc.split_bad(cdc.decode_cdc(feed))
    typed = cdc.order_changes(ok.withColumn("ts_ms", F.col("payload.ts_ms")), ["ts_ms", "kafka_offset"])
    empty = spark.createDataFrame([], cdc.ORDER_STATE)
    assert rows(cdc.apply_cdc(empty, typed, "apply")) == [("o1", "c2", None, None)]


def test_upsert_merges_and_repeats(spark):
    stored = spark.createDataFrame([(1, 1, 2)], "k int, a int, b int")
    new = spark.createDataFrame([(1, 9), (2, 5)], "k int, a int")
    table, stats = documents.upsert(stored, new, ["k"])
    assert sorted(rows(table)) == [(1, 9, 2), (2, 5, None)]
    assert rows(stats) == [(1, 1, 1, 0)]
    again, stats = documents.upsert(table, new, ["k"])
    assert sorted(rows(again)) == sorted(rows(table)) and rows(stats) == [(2, 0, 0, 0)]
    cleared, _ = documents.upsert(stored, spark.createDataFrame([(1, None)], "k int, b int"), ["k"])
    assert rows(cleared) == [(1, 1, None)]
    assert documents.upsert(stored, new.limit(0), ["k"]) is None


def test_upsert_rejects_rows_without_key(spark):
    stored = spark.createDataFrame([(1, 1)], "k int, a int")
    table, stats = documents.upsert(stored, spark.createDataFrame([(None, 7)], "k int, a int"), ["k"])
    assert rows(table) == [(1, 1)] and rows(stats) == [(0, 0, 0, 1)]


def test_insert_refuses_second_key(spark):
    df = spark.createDataFrame([(1, 1)], "k int, a int")
    with pytest.raises(ValueError, match="duplicate key"):
        documents.insert(df, df, ["k"])


def test_embed_parts_follow_the_item_number(spark):
    df = spark.range(25_000).select(F.lit(1).alias("k"), (F.col("id") + 1).alias("no"), (F.col("id") * 2).alias("x"))
    wanted = [(0, 10_000), (1, 10_000), (2, 5_000)]
    for partitions in (1, 7):
        docs = documents.embed(df.repartition(partitions), "k", F.col("x"), ["no"], "xs", "no", total=F.sum("x"))
        found = sorted((r["part"], len(r["xs"]), r["xs"], r["total"]) for r in docs.collect())
        assert [(p, n) for p, n, *_ in found] == wanted
        assert [x for _, _, xs, _ in found for x in xs] == list(range(0, 50_000, 2))
        assert sum(t for *_, t in found) == sum(range(0, 50_000, 2))


def test_order_totals_stand_once(spark):
    n = 25_000
    lines = spark.range(n).select(
        F.lit(1).alias("order_id"), (F.col("id") + 1).alias("item_no"), F.col("id").alias("product_id"), F.lit("c").alias("category"),
        F.lit(2).alias("seller_id"), F.lit(0.5).alias("price"), F.lit(0.1).alias("freight"),
    )
    orders = spark.createDataFrame([(1, 9, "P", None, None, None), (2, 9, "P", None, None, None)], "order_id int, customer_id int, status string, order_date timestamp, estimated timestamp, actual timestamp")
    customers = spark.createDataFrame([(9, "s", "t")], "customer_id int, customer_state string, customer_city string")
    payments = spark.createDataFrame([(1, "card", 7.0), (2, "card", 3.0)], "order_id int, payment_type string, payment_value double")
    reviews = spark.createDataFrame([], "order_id int, score int")
    docs = documents.order_analytics(orders, customers, lines, payments, reviews)
    assert docs.count() == 4
    sums = docs.agg(F.sum("totalItemValue"), F.sum("itemCount"), F.sum("totalPaymentValue")).first()
    assert tuple(sums) == (n * 0.5, n, 10.0)


def test_seller_documents_have_the_read_model(spark, sf):
    from mercato.plans import tables as t
    from mercato.schemas import READ_MODELS

    items = t.items(spark, sf)
    found = metrics.seller_performance(items, t.sellers(spark, sf), t.reviews(spark, sf), metrics.deliveries(t.orders(spark, sf), items))
    docs = documents.as_read_model(found, "seller_performance", documents.SELLER_NAMES, lastUpdated=F.lit("2001-08-02 00:00:00"))
    assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in READ_MODELS["seller_performance"]]
    assert docs.where("lastUpdated is null or sellerId is null").count() == 0


def _model_fields(name):
    from mercato.schemas import READ_MODELS

    return [(f.name, f.dataType) for f in READ_MODELS[name].fields]


def test_order_documents_have_the_read_model(spark):
    from decimal import Decimal

    n = documents.PART_ITEMS + 5
    lines = spark.range(n).select(
        F.lit(1).alias("order_id"), (F.col("id") + 1).alias("item_no"), F.col("id").alias("product_id"), F.lit("c").alias("category"),
        F.lit(2).alias("seller_id"), F.lit(0.1).alias("price"), F.lit(0.1).alias("freight"),
    )
    orders = spark.createDataFrame(
        [(1, 9, "P", None, None, None), (2, None, None, None, None, None)],
        "order_id int, customer_id int, status string, order_date timestamp, estimated timestamp, actual timestamp",
    )
    customers = spark.createDataFrame([(9, "s", "t")], "customer_id int, customer_state string, customer_city string")
    payments = spark.createDataFrame([(1, "card", 7.0), (2, "card", 1e9)], "order_id int, payment_type string, payment_value double")
    reviews = spark.createDataFrame([], "order_id int, score int")
    docs = documents.order_documents(documents.order_analytics(orders, customers, lines, payments, reviews))
    assert [(f.name, f.dataType) for f in docs.schema] == _model_fields("order_analytics")
    found = {r["orderId"]: r for r in docs.collect()}
    assert sorted(found) == ["1", "1#1", "2"]
    assert found["1"]["totalItemValue"] == Decimal(n) / 10 and found["1"]["totalPaymentValue"] == 7
    assert len(found["1"]["items"]) == documents.PART_ITEMS and len(found["1#1"]["items"]) == 5
    assert found["1#1"]["totalItemValue"] is None and found["1"]["items"][0]["price"] == Decimal("0.10")
    assert found["2"]["totalPaymentValue"] is None  # a billion does not fit ten digits


def test_segment_documents_take_the_models(spark, sf):
    """Probabilities are the forest's and products the recommender's, under the fields and types of the read model."""
    from mercato.operators import ml
    from mercato.plans import tables as t

    orders, reviews = t.orders(spark, sf), t.reviews(spark, sf)
    names = ["recency", "frequency", "monetary"]
    churn = ml.fit_forest(ml.churn_features(orders, reviews, F.lit("2001-04-01").cast("date")), names, trees=5)
    now = ml.churn_features(orders, reviews, F.lit("2001-08-02").cast("date")).filter("customer_id % 2 = 0")
    ratings = ml.interactions(orders.select("customer_id", (F.col("order_id") % 7).alias("item")), "customer_id", "item")
    recommender = ml.Recommender.fit(ratings)
    scores = metrics.rfm(orders, "customer_id", "order_date", "total", F.lit("2001-08-02").cast("date"))
    docs = ml.segment_documents(scores, now, churn, names, recommender, 2)
    assert [(f.name, f.dataType) for f in docs.schema] == _model_fields("customer_segments")
    want = {str(r[0]): r[1] for r in ml.score(churn, now, names, "customer_id", "p").collect()}
    items = {}
    for r in recommender.top(2).orderBy("rank").collect():
        items.setdefault(str(r["user"]), []).append(str(r["item"]))
    for r in docs.collect():
        assert r["churn_probability"] == want.get(r["_id"]) and r["recommended_products"] == items.get(r["_id"])


def test_scores_against_chance(spark):
    from mercato.operators import ml

    train = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    scored = spark.createDataFrame([(1, 1.0), (0, 0.0), (0, 0.5), (1, 0.5)], "label int, p double")
    found = ml.against_chance(train, scored)
    assert found["auc"] == pytest.approx(0.875) and found["chance_error"] == pytest.approx((5 / 48) ** 0.5)
    assert found["loss"] == pytest.approx(0.5 * math.log(2), abs=1e-6)
    assert found["base_loss"] == pytest.approx(-(math.log(0.25) + math.log(0.75)) / 2)


def test_found_documents_are_whole(spark):
    lines = spark.createDataFrame([(1, 1, 5, "a"), (1, 2, 6, "b"), (2, 1, 6, "c"), (3, 1, None, "d")], "k int, no int, s int, p string")
    docs = documents.find_embedded(lines, "k", F.col("s") == 5, F.struct("p", "s"), ["no"], "items", "no")
    assert [(r["k"], [i["p"] for i in r["items"]]) for r in docs.collect()] == [(1, ["a", "b"])]


def test_upsert_without_order_takes_whole_rows(spark):
    """Two rows of one key: their fields are never mixed."""
    stored = spark.createDataFrame([], "k int, s string, n string")
    new = spark.createDataFrame([(1, "z", "a"), (1, "b", "c")], "k int, s string, n string")
    for rows_in in (new, new.orderBy("s")):
        table, _ = documents.upsert(stored, rows_in, ["k"])
        assert rows(table) in ([(1, "z", "a")], [(1, "b", "c")])
        again, _ = documents.upsert(stored, rows_in.repartition(3), ["k"])
        assert rows(again) == rows(table)


def test_sums_keep_small_amounts_and_refuse_what_is_no_number(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert df.agg(F.sum(scalar.money("x")).cast("double")).first()[0] == 4.0
    with pytest.raises(Exception, match="not a number"):
        df.union(spark.sql("SELECT double('NaN')")).agg(F.sum(scalar.money("x"))).collect()


def test_anomalies_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    assert quality.iqr_anomalies(df, "x").count() == 0


def test_update_and_delete_treat_unknown_as_no_match(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, a int")
    assert sorted(rows(documents.delete(df, F.col("a") == 5))) == [(1, None)]
    assert sorted(rows(documents.update(df, F.col("a") > 1, {"a": F.lit(0)}))) == [(1, None), (2, 0)]


def test_inflate_and_augment(spark):
    df = spark.createDataFrame([("a", "2018-01-31 10:30:00")], "id string, d string").withColumn(
        "d", F.col("d").cast("timestamp_ntz")
    )
    copies = shaping.inflate(df, 3, "id", ["d"])
    assert sorted(rows(copies))[1] == ("a_1", datetime(2018, 3, 2, 10, 30))
    assert sorted(rows(copies))[0] == ("a_0", datetime(2018, 1, 31, 10, 30))
    assert str(sorted(rows(shaping.inflate(df, 2, "id", ["d"], truncate=True)))[1][1]) == "2018-03-02"
    first, again = (sorted(rows(shaping.augment(df, 4, "id", "d", seed=s))) for s in (1, 1))
    assert first == again and len(first) == 5 and first[0] == ("a", datetime(2018, 1, 31, 10, 30))
    shared = shaping.augment(df.unionByName(df.withColumn("id", F.lit("b"))), 1, "id", "d", per_row=False)
    moved = {r[1] for r in rows(shared) if "_gen" in r[0]}
    assert len(moved) == 1


def test_validation_of_source_tables(spark):
    df = spark.createDataFrame(
        [("p1", 1, "credit_card"), ("p2", 1, "gold"), (None, 1, "boleto"), ("p3", 1, None)],
        "order_id string, payment_sequential int, payment_type string",
    )
    ok, bad = validation.validate(df, validation.table_rules("order_payments"))
    assert sorted(r[0] for r in rows(ok)) == ["p1", "p3"]
    assert {r["order_id"]: r["reasons"] for r in bad.collect()} == {"p2": ["payment_type:domain"], None: ["order_id:null"]}
    assert set(KEYS) < set(TABLES)


def test_reconcile_statuses(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None), (4, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.001), (3, None), (4, 9.0), (5, 1.0)], "k int, v double")
    found = dict(rows(joins.reconcile(a, b, ["k"], ["v"], 0.01).select("k", "status")))
    assert found == {1: "matched", 2: "missing_right", 3: "matched", 4: "differs", 5: "missing_left"}


def test_growth_after_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "m int, v double")
    found = windows.growth(df, [], ["m"], "v").orderBy("m")
    assert [r["growth_pct"] for r in found.collect()] == [None, None, 100.0]


def test_unpivot_undoes_pivot(spark):
    df = spark.createDataFrame([("x", "a", 1.0), ("x", "b", 2.0), ("y", "a", 3.0)], "s string, t string, v double")
    long = metrics.unpivot(metrics.pivot_sum(df, ["s"], "t", ["a", "b"], "v"), ["s"], ["a", "b"], "t", "v")
    assert sorted(rows(long.dropna())) == sorted(rows(df)) and long.count() == 4


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    assert rows(quality.histogram(df, "v", 4).select("bin", "n")) == [(0, 2)]


def test_csv_with_bom_and_absent_file(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_bytes("﻿product_category_name,product_category_name_english\nmoveis,furniture\n".encode())
    schema = TABLES["product_category_name_translation"]
    assert rows(files.read_csv(spark, str(path), schema)) == [("moveis", "furniture")]
    assert files.read_csv(spark, str(path)).columns == schema.fieldNames()
    assert files.read_if_exists(spark, str(tmp_path / "none.csv")) is None


def test_source_options():
    cfg = external.JdbcConfig("jdbc:postgresql://db/shop", "u", "secret")
    opts = external.jdbc_options(cfg, "orders", "order_no", "0", "100", 8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "order_no" and opts["dbtable"] == "orders"
    assert "secret" not in repr(cfg)
    kafka = external.stream_options(
        external.StreamConfig(topics=["a", "b"], max_per_trigger=100, consumer={"max.poll.records": "500"})
    )
    assert kafka["subscribe"] == "a,b" and kafka["startingOffsets"] == "earliest"
    assert kafka["maxOffsetsPerTrigger"] == "100" and kafka["kafka.max.poll.records"] == "500"


def test_corrupt_json_is_kept(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("oops",)], "value string")
    found = external.parse_json(df, T.StructType([T.StructField("a", T.IntegerType())]))
    assert sorted(rows(found), key=str) == [(1, None), (None, "oops")]


def test_json_messages_keep_nulls(spark):
    df = spark.createDataFrame([("o1", None)], "order_id string, status string")
    assert rows(sinks.json_messages(df, "order_id")) == [("o1", '{"order_id":"o1","status":null}')]


def test_tiers_keep_undated_rows_hot(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2024-01-01",), (None,)], "d string").select(F.col("d").cast("date"))
    hot, cold = sinks.tier_split(df, "d", F.lit("2023-01-01").cast("date"))
    assert hot.count() == 2 and cold.count() == 1


def test_models_still_work_after_bulk_insert(spark, tmp_path):
    """Observing rows must not leave anything in the session that a model cannot ship to its tasks."""
    from mercato.operators import ml

    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(60)], "id int, a double, label int")
    assert sinks.bulk_insert(df, str(tmp_path / "bulk")) == 60
    assert sinks.bulk_insert(df, str(tmp_path / "bulk")) == 60
    assert spark.read.parquet(str(tmp_path / "bulk")).count() == 120
    model = ml.fit_forest(df, ["a"], trees=3)
    assert ml.score(model, df, ["a"], "id", "p").count() == 60
    assert 0 <= ml.classifier_metrics(model, df, ["a"])["auc"] <= 1


def test_stored_changes_of_a_batch_are_small_and_spread(spark, monkeypatch):
    feed = feeds.order_feed(spark, "/root/testdata/sf0.001").coalesce(1)
    monkeypatch.setattr(cdc, "MESSAGES_PER_TASK", 100)
    found = cdc.tagged_changes(feed)
    count = feed.count()
    sizes = [n for _, n in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 130 and len(sizes) >= count / 130
    assert "payload" not in found.columns and found.filter("reason IS NULL AND value IS NOT NULL").isEmpty()
    ok, bad = cdc.split_bad(cdc.decode_cdc(feed))
    typed = cdc.order_changes(ok.withColumn("ts_ms", F.col("payload.ts_ms")), ["ts_ms", "kafka_offset"])
    assert typed.exceptAll(found.filter("reason IS NULL").drop("reason", "value")).isEmpty()
    assert typed.count() == found.filter("reason IS NULL").count()
    letters = found.filter("reason IS NOT NULL").select("value", "reason")
    assert not bad.isEmpty() and bad.select("value", "reason").exceptAll(letters).isEmpty() and letters.count() == bad.count()
