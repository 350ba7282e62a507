from collections import Counter

import pytest
from pyspark.sql import functions as F

from daymill.llm import mixing, queries

SMALL = "/root/testdata/sf0.001"


def targets(sizes, weights=(3, 1, 2)):
    """By handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest, open_ = total - sum(2 * sizes[n] for n in full), sum(weight[n] for n in names if n not in full)
        out = {n: 2 * sizes[n] if n in full else rest * weight[n] / open_ for n in names}
        over = {n for n in names if n not in full and out[n] > 2 * sizes[n] + 1e-9}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 5, None: 70}, {"x": 7}, {"z": 3, "é": 900, "Z": 2, "😀": 50, None: 1}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    assert got == pytest.approx(targets(sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 1000])
def test_permutation(spark, n):
    moved = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(1))).collect()]
    assert sorted(moved) == list(range(n))
    if n == 1000:
        assert sum(a == i for i, a in enumerate(moved)) < 20
        other = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(2))).collect()]
        assert moved != other


def test_query_against_brute_force(spark):
    rows = queries.QUERIES["op10_mixing"](spark, SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    size = {k: len(r.text.encode().split()) for k, r in docs.items()}
    by_source = Counter()
    for k, r in docs.items():
        by_source[r.source] += size[k]
    want, taken = targets(by_source), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        source = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], by_source[source]) and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS for s in want)
    assert {r.doc_id: r.taken for r in queries.QUERIES["op10_mixing"](spark, SMALL).collect()} == {r.doc_id: r.taken for r in rows}


def test_slots_and_blocks_by_hand(spark, frames):
    docs = frames([" ".join(f"w{i}x{j}" for j in range(10 + 37 * i % 90)) for i in range(60)], source=[f"s{i % 4}" for i in range(60)])
    mixed = mixing.mix(docs, block_words=16)
    slots = mixed.slots.collect()
    assert sorted(s.place for s in slots) == list(range(len(slots)))
    drawn = Counter((s.source, s.block) for s in slots)
    assert max(drawn.values()) <= 2
    got = {r.key: r.taken for r in mixing.taken(mixed).collect()}
    for r in mixed.documents.collect():
        words = range(r.first_word, r.first_word + r.size)
        assert got[r.key] == sum(drawn[r.source, w // 16] for w in words)
    texts = Counter()
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in mixing.mixed_documents(docs, block_words=16).collect():
        texts[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set(whole[r.doc_id].split()) and r.n_chars == len(r.text)
    assert {k: n for k, n in got.items() if n} == dict(texts)


@pytest.mark.parametrize("words", [{"a": 31, "b": 4000, "c": 4000}, {"a": 150, "b": 9000}, {"a": 1, "b": 130, "c": 257, "d": 3}, {"a": 3000, "b": 3001, "c": 50}])
def test_each_source_comes_near_its_target(spark, frames, words):
    texts = [(s, n - i if n - i < 40 else 40) for s, n in words.items() for i in range(0, n, 40)]
    rows = mixing.taken(mixing.mix(frames([" ".join(["w"] * n) for _, n in texts], source=[s for s, _ in texts]))).collect()
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
    want = targets(words)
    for source, size in words.items():
        full = want[source] == 2 * size
        block = min(mixing.BLOCK_WORDS, -(-min(want[source], size) // mixing.LEAST_BLOCKS))
        assert taken[source] == 2 * size if full else abs(taken[source] - want[source]) <= block / 2


def test_hot_source_is_spread(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'a b c' AS text", "if(id % 3 = 0, 'hot', string(id % 50)) AS source")
    mixed = mixing.mix(docs)
    assert mixed.documents.where("source = 'hot'").agg(F.max("first_word")).first()[0] == 3 * (20_000 // 3 + 1) - 3
    assert mixed.documents.select("source", "first_word").distinct().count() == 20_000


def test_odd_rows(odd, none):
    rows = mixing.taken(mixing.mix(odd)).collect()
    assert len(rows) == odd.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0) and sum(r["size"] == 0 for r in rows) == 3
    made = mixing.mixed_documents(odd)
    assert made.columns == odd.columns and all(r.text for r in made.collect())
    assert mixing.mixed_documents(none).count() == 0 and mixing.taken(mixing.mix(none)).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
