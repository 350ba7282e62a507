import hashlib

import numpy as np

from daymill.llm import queries, sketch

SMALL = "/root/testdata/sf0.001"


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op2_sketch"](spark, SMALL).collect()}
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert len(got) == len(texts)
    for (key, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r, own, mine = got[key], sketch.sketch(text), sketch.sketch(changed)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (sketch.packed(own), sketch.packed(mine))
        assert (r.near_edited, r.near_next) == (sketch.likeness(own, mine), sketch.likeness(own, sketch.sketch(after)))


def test_estimates_and_merging():
    words = [f"w{i}" for i in range(40_000)]
    whole, part = sketch.sketch(" ".join(words)), sketch.sketch(" ".join(words[:4000]))
    assert sketch.containment(part, whole) == 1
    assert abs(sketch.containment(whole, part) - 0.1) < 0.02
    assert abs(sketch.likeness(whole, part) - 0.1) < 0.02
    halves = sketch.merge(sketch.sketch(" ".join(words[:20_004])), sketch.sketch(" ".join(words[20_000:])))
    assert np.array_equal(halves, whole)
    assert np.array_equal(sketch.unpacked(sketch.packed(whole)), whole)
    empty = np.zeros(0, np.uint64)
    assert (sketch.likeness(empty, empty), sketch.containment(empty, part), sketch.merge().size) == (1.0, 0.0, 0)


def test_odd_rows(odd, none, frames):
    made = sketch.sketches(odd).select("doc_id", "fingerprint").collect()
    prints = {r.doc_id: r.fingerprint for r in made}
    assert len(made) == odd.count() and prints[2] == prints[3] == prints[4] and prints[1] == prints[6]
    found = sketch.compare_with_edits(odd).collect()
    assert len(found) == odd.count() and all(0 <= r.near_next <= 1 for r in found)
    assert sketch.compare_with_edits(none).count() == 0
    (alone,) = sketch.compare_with_edits(frames(["one two three four five six"])).collect()
    assert alone.near_next == 1


def test_every_row_meets_its_successor(frames):
    docs = frames([f"text {i}" for i in range(300)])
    for parts in (1, 7, 64):
        rows = sketch.with_next(docs, "doc_id", ["text"], parts)
        seen = [(a.key, b.key) for p in rows.rdd.glom().collect() for a, b in zip(p, p[1:]) if a.part == b.part and not a["last"]]
        assert sorted(seen) == [(i, (i + 1) % 300) for i in range(300)]


def test_likeness_is_the_true_similarity(spark):
    def shingles(text):
        words = text.lower().encode().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    got = {r.doc_id: r for r in queries.QUERIES["op2_sketch"](spark, SMALL).collect()}
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    for (key, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        own, mine, other = map(shingles, (text, sketch.edited(text, after), after))
        assert got[key].near_edited == len(own & mine) / len(own | mine) and got[key].near_next == len(own & other) / len(own | other)
        assert got[key].kept_in_edited == len(own & mine) / len(own) and got[key].kept_in_next == len(own & other) / len(own)


def test_short_texts_have_hashes(frames):
    texts = [f"w{i} a b c d e f g" for i in range(40)]
    assert len({r.fingerprint for r in sketch.sketches(frames(texts)).collect()}) == 40
    assert max(r.near_next for r in sketch.compare_with_edits(frames(texts)).collect()) < 1


def shingles(text):
    words = text.lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_estimates_of_a_quarter_of_the_hashes(spark):
    """Every document with its edit and its successor, against the true similarity."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in sketch.compare_with_edits(docs, fraction=0.25).collect()}
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    off = {"near_edited": [], "kept_in_edited": [], "near_next": []}
    for (key, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        own, mine, other = map(shingles, (text, sketch.edited(text, after), after))
        off["near_edited"].append(abs(got[key].near_edited - len(own & mine) / len(own | mine)))
        off["kept_in_edited"].append(abs(got[key].kept_in_edited - len(own & mine) / len(own)))
        off["near_next"].append(abs(got[key].near_next - len(own & other) / len(own | other)))
    assert np.mean(off["near_edited"]) < 0.05 and np.mean(off["kept_in_edited"]) < 0.06 and np.mean(off["near_next"]) < 0.002


def test_very_unequal_documents():
    """A short text inside a long one: containment is estimated both ways from a quarter of the hashes."""
    words = [f"w{i}" for i in range(60_000)]
    long = sketch.sketch(" ".join(words), 0.25)
    assert abs(len(long) / 60_000 - 0.25) < 0.01
    for n in (100, 1000, 10_000):
        short = sketch.sketch(" ".join(words[500 : 500 + n]), 0.25)
        assert sketch.containment(short, long) == 1 and abs(sketch.containment(long, short) - n / 60_000) < 0.01
        half = sketch.sketch(" ".join([*words[500 : 500 + n // 2], *[f"x{i}" for i in range(n // 2)]]), 0.25)
        assert abs(sketch.containment(half, long) - 0.5) < 3 * 0.5 / (n * 0.25) ** 0.5 + 5 / n


def test_the_smallest_hash_is_always_kept():
    made = [sketch.sketch(f"only w{i}", 0.25) for i in range(200)]
    assert all(len(m) == 1 for m in made) and len({sketch.packed(m) for m in made}) == 200
    # A smallest hash above the threshold gives way when texts are merged.
    last = sketch._last(0.25)
    above, below = next(m for m in made if m[0] > last), next(m for m in made if m[0] <= last)
    assert np.array_equal(sketch.merge(above, below, fraction=0.25), below) and np.array_equal(sketch.merge(above, fraction=0.25), above)
    both = sorted((m for m in made if m[0] > last), key=lambda m: m[0])[:2]
    assert np.array_equal(sketch.merge(*both, fraction=0.25), both[0])


def test_many_ranges_cost_no_literals(frames):
    """What opens a range is joined, not written into the plan: its text doesn't grow with the ranges."""
    docs = frames([f"text {i}" for i in range(300)])
    plan = lambda n: len(sketch.with_next(docs, "doc_id", ["text"], n)._jdf.queryExecution().optimizedPlan().toString())
    assert plan(250) < 2 * plan(4)
