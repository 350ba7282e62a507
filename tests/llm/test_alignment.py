import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from daymill.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def two():
    return alignment.TwoTokenizers(*PATHS)


def brute(two, text):
    """Ids by the libraries on the whole text, groups as text, and all links, pair by pair."""
    if not text:
        return None
    a, b = two.a.encode(" " + text, add_special_tokens=False).ids, two.b.encode(text)
    spelled = (" " + text).encode()
    if b"".join(two.a_bytes[i] for i in a) != spelled or b"".join(two.b_bytes[i] for i in b) != spelled:
        return None
    ends_a, ends_b = (np.cumsum([len(side[i]) for i in ids]) for side, ids in ((two.a_bytes, a), (two.b_bytes, b)))
    groups, i, j = [], 0, 0
    for end in sorted({*ends_a.tolist()} & {*ends_b.tolist()}):
        x, y = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    over = (np.r_[0, ends_a[:-1]][:, None] < ends_b[None, :]) & (np.r_[0, ends_b[:-1]][None, :] < ends_a[:, None])
    return len(a), len(b), ";".join(groups), [(a[x], b[y]) for x, y in zip(*np.nonzero(over))]


def check(two, text):
    want, found = brute(two, text), alignment._aligned(two, text)
    if want is None:
        assert found[:4] == (0, 0, 0, "") and not len(found[4])
        return
    n_a, n_b, groups, pairs = want
    assert found[:3] == (n_a, n_b, groups.count(";") + 1) and found[3] == hashlib.sha256(groups.encode()).hexdigest()
    assert sorted(zip(found[4].tolist(), found[5].tolist())) == sorted(pairs)


@pytest.mark.parametrize("signs", ["abcdefgh  ", "ETA oin \n\t", "'s've 're", "日本語 テキ ", "😀👍🏽éé ñü‍́", "012 .,;!?<s>", " \x1c\x85\xa0　ab\x00", "▁ab ", "<0x41> </s>", "ﬁ１² ｱ"])
def test_any_text_as_the_libraries_do(two, signs):
    draw = random.Random(signs)
    for i in range(300):
        check(two, "".join(draw.choice(signs) for _ in range(draw.choice([1, 3, 10, 60]))) + "<|endoftext|>" * (i % 20 == 0))


def test_long_texts(two):
    check(two, "x" * 3000)
    check(two, "the same words again and again " * 100)
    check(two, " " * 2000 + "end")


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_any_ends(seed):
    """Any two cuts of the same bytes, long equal stretches included."""
    draw = random.Random(seed)
    shared, ends = draw.random(), range(1, 400)
    sides = [{400}, {400}]
    for end in ends:
        if draw.random() < 0.5:
            for side in sides if draw.random() < shared else [draw.choice(sides)]:
                side.add(end)
    a, b = map(sorted, sides)
    cut = [np.diff(side, prepend=0) for side in (a, b)]
    wide = [c.astype(np.uint8 if seed % 2 and c.max() < 256 else np.int64) for c in cut]
    ends_a, ends_b, at_a, at_b = alignment.groups_and_links(*alignment.align(*map(alignment.steps, wide)))
    common = sorted({*a} & {*b})
    assert [a[i - 1] for i in ends_a] == common == [b[i - 1] for i in ends_b]
    starts = {0: [0, *a], 1: [0, *b]}
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]}
    assert len(at_a) == len(want) and set(zip(at_a.tolist(), at_b.tolist())) == want


@pytest.mark.parametrize("head", [3, 1 << 16])
def test_counts_against_brute_force(spark, two, head):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = {d: brute(two, t) for d, t in texts.items() if len(t or "") < 5000}
    short = docs.where(docs.doc_id.isin(list(made)))
    counts = Counter(p for m in made.values() if m for p in m[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for r in alignment.with_counts(alignment.align_texts(short, *PATHS), head).collect():
        pairs = made[r.doc_id][3] if made[r.doc_id] else []
        assert (r.n_links, r.count_sum, r.n_best) == (len(pairs), sum(counts[p] for p in pairs), sum(counts[p] == most[p[1]] for p in pairs))


def test_query_has_a_row_for_each_document(spark):
    rows = queries.QUERIES["op13_alignment"](spark, SMALL)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert rows.where("n_best > n_links OR n_links < greatest(n_a, n_b) OR n_groups > least(n_a, n_b)").count() == 0


def test_odd_rows(spark, odd, none):
    rows = alignment.with_counts(alignment.align_texts(odd.withColumnRenamed("fingerprint", "row"), *PATHS)).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[d][0].n_a == by[d][0].count_sum == 0 and by[d][0].groups_sha256 == "" for d in (2, 3))
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and by[1][0].n_a > 0 and by[4][0].n_b > 0
    assert alignment.with_counts(alignment.align_texts(none, *PATHS)).count() == 0


def test_ids_of_more_than_seven_digits_are_refused():
    assert alignment.decimal(0)[0].shape == (1,)
    with pytest.raises(ValueError):
        alignment.decimal(10**7 + 1)
