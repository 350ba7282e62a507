import numpy as np
import pytest

from daymill.llm import common, queries, severity

LABELLED = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    model = severity.fit(docs, labels.where("doc_id % 2 = 0"))
    graded = severity.grade(docs.join(labels.withColumnRenamed("toxic", "label").where("doc_id % 2 = 1"), "doc_id"), model)
    found = {(r.label, r.toxic): r["count"] for r in graded.groupBy("label", "toxic").count().collect()}
    # About four in a hundred labels say toxic of texts without any sign of it.
    assert found[1, True] / (found[1, True] + found.get((1, False), 0)) > 0.85
    assert found.get((0, True), 0) / (found[0, False] + found.get((0, True), 0)) < 0.02


def features_by_hand(token):
    """Runs of letters in lower case, and their first 4, 5 and 6 letters if they are longer."""
    words, word = [], ""
    for c in token.lower() + " ":
        if c == "_" or not c.isalnum() or c.isdecimal():
            words, word = words + [word], ""
        else:
            word += c
    words = [w for w in words if w]
    return words + [w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n]


@pytest.mark.parametrize("token", ["Hello", "you_are-an IDIOT!!", "it's", "x1y22", "éàßss", "", "123", "abcdefgh-ij"])
def test_features(token):
    assert sorted(severity.features_of(token)) == sorted(features_by_hand(token))


def test_query_against_one_text_at_a_time(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = severity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.QUERIES["op8_severity"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        tokens = texts[r.doc_id].split()
        score = sum(model.weights.get(f, 0.0) for t in tokens for f in features_by_hand(t)) / len(tokens) ** 0.5
        above = model.above(np.array([score]))[0]
        assert r.expected_severity == pytest.approx(above.sum()) and r.toxic == (above[0] >= model.reject_from)


def test_grades_are_ordered():
    draw = np.random.default_rng(1)
    grades = draw.integers(0, 3, 600)
    rows = [(np.array([0, 1]), np.array([g + draw.normal(0, 0.2), draw.normal()])) for g in grades]
    weights, (low, high) = severity.fit_grades(rows, grades, 2)
    scores = np.array([v @ weights[i] for i, v in rows])
    chosen = (scores > low).astype(int) + (scores > high)
    assert low < high and abs(weights[1]) < 0.2 * weights[0] and (chosen == grades).mean() > 0.95


def test_cut():
    assert severity.best_cut(np.array([0.1, 0.2, 0.6, 0.8]), np.array([0, 0, 1, 1])) == pytest.approx(0.4)
    assert severity.best_cut(np.array([0.5, 0.5]), np.array([0, 1])) > 1


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (99, 0)], "doc_id long, toxic int")
    model = severity.fit(odd, labels)
    assert model.weights == {}  # only toxic rows have a text
    found = severity.grade(odd, model)
    assert found.count() == odd.count() and not found.where("toxic").count()
    assert severity.keep_clean(odd, model).columns == odd.columns and severity.keep_clean(odd, model).count() == odd.count()
    assert severity.fit(none, labels.limit(0)).score("idiot") == 0
    loud = severity.Severity({"idiot": 50.0}, (1.0, 2.0))
    kept = severity.keep_clean(spark.createDataFrame([(1, "you idiot"), (2, "hello"), (3, None)], "doc_id long, text string"), loud)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_every_telling_feature_counts(spark, frames):
    """No number of features is set: all that part the two kinds of text are used."""
    bad = [f"bad{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(400)]
    docs = frames([" ".join(bad) if i % 2 else "fine words here" for i in range(60)])
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    weights = severity.fit(docs, labels).weights
    assert set(bad) <= set(weights)
    assert not severity.fit(docs, labels, least_ratio=1e9).weights


def test_a_repeated_key_is_one_labelled_row(spark, frames):
    docs = frames(["clean text"] * 6 + ["bad text"] * 6)
    many = docs.unionByName(spark.range(200).selectExpr("7L AS doc_id", "'zz other' AS text", "'en' AS lang", "'s' AS source", "8L AS n_chars"))
    labels = docs.selectExpr("doc_id", "int(doc_id >= 6) AS toxic")
    one, two = severity.fit(docs, labels), severity.fit(many, labels)
    assert one.weights and one.weights == two.weights


def test_a_text_goes_to_the_workers_once(spark, odd, monkeypatch):
    sent, plain = [], severity.map_arrow
    monkeypatch.setattr(severity, "map_arrow", lambda df, run, schema: sent.append(df.columns) or plain(df, run, schema))
    loud = severity.Severity({"mail": 50.0}, (1.0, 2.0))
    kept, graded = severity.keep_clean(odd, loud), severity.grade(odd.drop("toxic"), loud)
    assert [len(c) for c in sent] == [len(odd.columns), len(odd.columns) - 1]
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert [r.doc_id for r in graded.where("toxic").collect()] == [7]
    other = severity.keep_clean(odd, loud, "TEXT")  # a name in other letters, as Spark takes it
    assert sorted(map(repr, other.collect())) == sorted(map(repr, kept.collect()))


def test_a_stage_that_takes_over_a_worker_gives_its_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    monkeypatch.delitem(common.sys.modules, "daymill_worker_shelf", raising=False)
    assert [common.per_process(k, lambda k=k: [k]) for k in "aab"] == [["a"], ["a"], ["b"]]
    assert len(given) == 1
    monkeypatch.undo()
    common.give_back()
