import random

import numpy as np
import pandas as pd
import pytest
import xxhash

from daymill.llm import queries, simhash

SMALL = "/root/testdata/sf0.001"


def by_hand(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(keys, prints, radius=4):
    up = {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in keys}


@pytest.mark.parametrize("text", ["", " \t", "One", "one two three", "A b C d", "a b c d e f g h " * 500, "é ü x y z w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == by_hand(text)
    assert simhash.fingerprint(None) == 0


def test_query_against_all_pairs(spark):
    got = queries.QUERIES["op1_simhash"](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {k: by_hand(t) for k, t in texts.items()}
    want = groups(sorted(texts), prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {k: (f"{prints[k]:016x}", want[k]) for k in texts}


@pytest.mark.parametrize("slice_rows", [4, 2048])
def test_hot_shards_lose_no_link(spark, slice_rows):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    values = {draw.getrandbits(64) for _ in range(200)} | {centre}
    for _ in range(150):  # a chain of near values in the same shards
        centre ^= 1 << draw.randrange(64) | 1 << draw.randrange(64)
        values.add(centre)
    values = sorted(values)
    frame = spark.createDataFrame([(i, simhash.signed(v)) for i, v in enumerate(values)], "id long, print long")
    links = simhash.near_links(frame, slice_rows=slice_rows)
    got = {r.id: r.component for r in simhash.components(links).collect()}
    want = groups(list(range(len(values))), dict(enumerate(values)))
    assert {i: got.get(i, i) for i in want} == want
    assert links.count() < 5 * 16 * len(values)


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**12])
def test_block_sets_cover_every_change(n):
    masks = simhash.block_sets(n)
    for _ in range(300):
        change = sum(1 << b for b in random.sample(range(64), 4))
        assert any(not change & m for m in masks)


def test_forest_follows_the_edges():
    values = np.array([random.getrandbits(64) for _ in range(300)], np.uint64)
    tree = np.repeat(np.arange(3), 100)
    forest = simhash.Forest(values, tree)
    found = {(int(q), int(n)) for qs, ns in forest.search(values, tree, 26) for q, n in zip(qs, ns)}
    want = {(i, j) for i in range(300) for j in range(300) if tree[i] == tree[j] and (int(values[i]) ^ int(values[j])).bit_count() <= 26}
    assert found == want
    assert not simhash._shard_links(pd.DataFrame({"shard": [], "side": [], "id": [], "print": []}), 4).size


def test_odd_rows(odd, none):
    found = simhash.near_duplicates(odd).select("doc_id", "simhash", "component_id", "key").collect()
    assert len(found) == odd.count()
    empty = [r for r in found if r.doc_id in (2, 3, 4)]
    assert {r.simhash for r in empty} == {0} and {r.component_id for r in empty} == {2}
    assert {r.component_id for r in found if r.doc_id in (1, 6)} == {1}
    assert simhash.near_duplicates(none).count() == 0


def test_one_stays(odd, none, frames):
    stay = simhash.one_of_each_group(odd)
    assert stay.columns == odd.columns
    ids = [r.doc_id for r in stay.collect()]
    assert ids.count(1) == 1 and 6 not in ids and 2 in ids and 3 not in ids and 5 in ids and 7 in ids
    assert simhash.one_of_each_group(none).count() == 0
    copies = frames(["a text of some length here"] * 40 + ["quite another one with other words"])
    assert sorted(r.doc_id for r in simhash.one_of_each_group(copies).collect()) == [0, 40]
