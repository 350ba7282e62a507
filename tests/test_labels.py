import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymill.operators import labels as lb


@pytest.fixture(scope="module")
def entries(spark):
    rnd = random.Random(1)
    data = []
    for i in range(200):
        n = rnd.randrange(1, 100)
        bought = rnd.randrange(0, n + 1)
        data.append((f"e{i}", n, n // 2, bought, bought / n, float(n) / 3, f"P{i % 4}", f"page{i % 7}"))
    return spark.createDataFrame(
        data,
        "entry_id string, visitor_count long, new_visitor_count long, order_buyer_count long, "
        "order_conversion_rate double, avg_stay_duration double, time_period string, entry_page_name string",
    ).cache()


def test_labels_and_missing_columns(entries):
    out = lb.entry_labels(entries)
    counts = [r["visitor_count"] for r in entries.collect()]
    assert out.agg(F.sum("high_visitor")).first()[0] == sum(c >= np.quantile(counts, 0.75) for c in counts)
    assert "high_duration" not in lb.entry_labels(entries.drop("avg_stay_duration")).columns
    with pytest.raises(ValueError):
        lb.entry_labels(entries.select("entry_id"))


def test_scaling_uses_the_population_deviation(entries):
    out = lb.entry_features(entries)
    got = [r["visitor_count_scaled"] for r in out.orderBy("entry_id").collect()]
    raw = np.array([r["visitor_count"] for r in entries.orderBy("entry_id").collect()], dtype=float)
    assert np.allclose(got, (raw - raw.mean()) / raw.std())
    constant = lb.scaled_numerics(entries.withColumn("visitor_count", F.lit(5)))
    assert constant.agg(F.max(F.abs("visitor_count_scaled"))).first()[0] == 0


def test_train_and_score(spark, entries):
    rows = lb.entry_features(lb.entry_labels(entries)).withColumn("all_one", F.lit(1))
    fitted = lb.train_label_models(rows, ["high_visitor", "all_one"], "entry_id", trees=5, depth=4)
    assert list(fitted.models) == ["high_visitor"] and fitted.constants == {"all_one": 1}
    scored = lb.score_labels(fitted, rows.withColumn("time_period", F.lit("never seen"))).cache()
    assert scored.where("all_one_prob = 1.0 and all_one_pred = 1").count() == 200
    assert lb.area_under_roc(scored, "high_visitor", "high_visitor_prob") > 0.95
    report = lb.evaluate_labels(scored, [("high_visitor", "high_visitor_pred")]).first()
    assert report["accuracy"] > 0.9 and report["rows"] == 200
    assert sum(lb.mean_importance(fitted)) == pytest.approx(1.0)


def test_split_is_stable_and_complete(entries):
    train, test = lb.split_rows(entries, "entry_id")
    assert train.count() + test.count() == 200 and train.join(test, "entry_id").count() == 0
    assert 0.2 < test.count() / 200 < 0.4


def test_every_category_is_kept_apart(spark):
    rows = spark.range(20_001).selectExpr("id AS entry_id", "string(id) AS time_period", "double(id % 7) AS visitor_count_scaled")
    categories = lb.category_dictionary(rows, ["time_period"])
    vectors = lb.feature_model(rows, categories).transform(lb.with_slots(rows, categories))
    assert vectors.first()["features"].size == 1 + 20_001
    assert vectors.select("time_period_slot").distinct().count() == 20_001 and categories.shared == {"time_period": 0}


def test_slots_of_frequent_rare_unseen_and_null(spark, monkeypatch):
    monkeypatch.setattr(lb, "REST_SLOTS", 4)
    values = ["a"] * 5 + ["b"] * 3 + ["c", "d", None]
    rows = spark.createDataFrame([(v, 1.0) for v in values], "time_period string, x_scaled double")
    two = lb.category_dictionary(rows, ["time_period"], dictionary=2)
    assert two.own == {"time_period": 2} and two.shared == {"time_period": 4}
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("new",), (None,)], "time_period string").withColumn("x_scaled", F.lit(2.0))
    slots = {r.time_period: r.time_period_slot for r in lb.with_slots(asked, two).collect()}
    assert slots["a"] == 0 and slots["b"] == 1 and 2 <= slots["c"] < 6 and 2 <= slots["new"] < 6 and slots[None] == 6
    vectors = {r.time_period: r.features for r in lb.feature_model(asked, two).transform(lb.with_slots(asked, two)).collect()}
    assert vectors["a"].toArray().tolist() == [2, 1, 0, 0, 0, 0, 0] and vectors[None].toArray().tolist() == [2, 0, 0, 0, 0, 0, 0]
    every = lb.category_dictionary(rows, ["time_period"])
    assert every.own == {"time_period": 4} and {r.time_period: r.time_period_slot for r in lb.with_slots(asked, every).collect()}["new"] == 4


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
def test_saved_models_score_the_same_in_another_session(spark, entries, tmp_path, kind):
    rows = lb.entry_features(lb.entry_labels(entries)).withColumn("all_one", F.lit(1))
    fitted = lb.train_label_models(rows, ["high_visitor", "all_one"], "entry_id", kind, trees=3, depth=3)
    lb.save_label_models(fitted, str(tmp_path / "m"))
    other = spark.newSession()
    loaded = lb.load_label_models(other, str(tmp_path / "m"))
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    names = ["entry_id", "high_visitor_pred", "high_visitor_prob", "all_one_pred", "all_one_prob"]
    before, after = (sorted(map(tuple, lb.score_labels(m, s.read.parquet(path)).select(*names).collect())) for m, s in ((fitted, spark), (loaded, other)))
    assert before == after and len(before) == 200
    assert loaded.constants == {"all_one": 1} and list(loaded.models) == ["high_visitor"]


def test_class_report_without_hits(spark, rows):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "y int, p int")
    got = {r["class"]: r for r in lb.class_report(df, "y", "p").collect()}
    assert got[1]["precision"] == 1.0 and got[1]["recall"] == 0.0 and got[1]["f1"] == 0.0
    assert got[0]["precision"] == pytest.approx(0.3333) and got[0]["support"] == 1
