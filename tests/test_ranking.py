"""Skew-safe operators against plain windows and brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daymill.operators import ranking


def brute_steps(data):
    out = []
    by_session = {}
    for s, t, i, p in data:
        by_session.setdefault(s, []).append((t, i, p))
    for s, views in by_session.items():
        views.sort()
        for n, (_, _, p) in enumerate(views):
            out.append((s, p, n + 1, views[n + 1][2] if n + 1 < len(views) else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", [1, 60, 86400])
def test_steps_with_a_hot_session(spark, rows, chunk):
    rnd = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        session = "hot" if i % 3 == 0 else f"s{rnd.randrange(40)}"
        if i % 50 == 0:
            session = None  # views without a session stay together
        at = start + dt.timedelta(seconds=rnd.randrange(3000))
        data.append((session, at, i, rnd.choice(["home", "cart", None, "pay"])))
    df = spark.createDataFrame(data, "s string, t timestamp, i long, p string")
    assert rows(ranking.steps_in_session(df, "s", "t", "i", "p", chunk)) == brute_steps(data)


def test_empty_session_text_is_not_the_missing_session(spark, rows):
    at = dt.datetime(2024, 1, 1)
    data = [("", at, 1, "a"), (None, at, 2, "b")]
    df = spark.createDataFrame(data, "s string, t timestamp, i long, p string")
    assert rows(ranking.steps_in_session(df, "s", "t", "i", "p")) == brute_steps(data)


def test_rank_in_group_equals_window_rank(spark, rows):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, 0, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(data, "g string, score long, id long")
    want = df.withColumn("rank", F.rank().over(Window.partitionBy("g").orderBy(F.col("score").desc())))
    got = ranking.rank_in_group(df, ["g"], "score")
    assert rows(got, "id", "rank") == rows(want, "id", "rank")


def test_top_keeps_ties_and_limits_before_the_shuffle(spark, rows):
    data = [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 4, 4), ("a", 1, 5), ("b", 1, 6)]
    df = spark.createDataFrame(data, "g string, score int, id int")
    out = ranking.top_in_group(df, ["g"], "score", 3)
    assert rows(out, "id", "rk") == [(1, 1), (2, 1), (3, 3), (4, 3), (6, 1)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


QS = [0.0, 0.25, 0.33, 0.7, 0.75, 1.0]


@pytest.mark.parametrize("few", [0, 3, 1 << 16])
@pytest.mark.parametrize("size", [1, 2, 10, 5000])
def test_exact_quantiles(spark, monkeypatch, size, few):
    monkeypatch.setattr(ranking, "FEW_ROWS", few)
    monkeypatch.setattr(ranking, "PARTS", 16)
    rnd = random.Random(size)
    values = [(round(rnd.gauss(0, 10), 1), rnd.gauss(0, 1) * 10.0 ** rnd.randrange(-300, 300)) for _ in range(size)]
    df = spark.createDataFrame([*values, (None, float("nan"))], "v double, `w x` double")
    got = ranking.exact_quantiles(df, {"v": QS, "w x": QS})
    assert got["v"] == pytest.approx(np.quantile([v for v, _ in values], QS))
    assert got["w x"] == pytest.approx(np.quantile([w for _, w in values], QS), rel=1e-9)


def test_quantiles_of_odd_columns(spark):
    inf = float("inf")
    df = spark.createDataFrame([(None, -inf, 0.0, 5), (None, inf, -0.0, 5), (None, inf, 5e-324, 5)], "a double, b double, c double, d int")
    got = ranking.exact_quantiles(df, {"a": [0.5], "b": [0.0, 0.5, 1.0], "c": [0.0, 0.5, 1.0], "d": [0.5]})
    assert got == {"a": [None], "b": [-inf, inf, inf], "c": [0.0, 0.0, 5e-324], "d": [5.0]}
    assert ranking.exact_quantiles(df.limit(0), {"b": [0.5]}) == {"b": [None]}


def test_a_value_that_most_rows_share(spark):
    df = spark.range(20_000).selectExpr("double(id) AS v").union(spark.range(90_000).selectExpr("500.0D"))
    values = [*range(20_000), *[500] * 90_000]
    assert ranking.exact_quantiles(df, {"v": QS})["v"] == pytest.approx(np.quantile(values, QS))


def test_more_quantiles_take_no_more_passes(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(300_000).selectExpr("double(hash(id)) AS v", "double(id % 7) AS w")

    def jobs(wanted):
        spark.sparkContext.setJobGroup("quantiles", "")
        before = len(tracker.getJobIdsForGroup("quantiles"))
        ranking.exact_quantiles(df, wanted)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup("quantiles")) - before

    assert jobs({"v": [0.1]}) == jobs({"v": [i / 20 for i in range(21)], "w": [0.3, 0.9]}) <= 8
