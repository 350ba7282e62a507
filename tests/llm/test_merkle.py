import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from daymill.llm import merkle, queries

SMALL = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, **other):
    values = [other.get(f, row[f]) for f in FIELDS]
    return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """Root, and for each leaf its siblings from the bottom up, joined level by level."""
    proofs, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, held = [], []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for j in range(len(run)):
                for at in below[i + j]:
                    proofs[at].append("".join(run[:j] + run[j + 1 :]))
            parents.append(hashed("".join(run)))
            held.append(sum(below[i : i + fanout], []))
        nodes, below = parents, held
    return nodes[0], ["".join(p) for p in proofs]


def expected(rows, fanout=2):
    """(doc_id, leaf, subroot, root, hash of the siblings) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(r), r.doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
    low = {g: tree([x[2] for x in groups[g]], fanout) for g in order}
    root, tops = tree([low[g][0] for g in order], fanout)
    return sorted(
        ((x[3], x[2], low[g][0], root, hashed(low[g][1][i] + tops[n])) for n, g in enumerate(order) for i, x in enumerate(groups[g])), key=repr
    )


def got(docs, fanout=2):
    rows = merkle.manifest(docs, FIELDS, "lang", "doc_id", fanout).rows
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("proof")))).collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = queries.QUERIES["op11_merkle"](spark, SMALL).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == expected(docs)
    changed = {r.doc_id for r in docs if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None}
    assert changed and {r.doc_id for r in rows if not r.verified} == changed
    assert all((r.folded_root == r.root) == r.verified for r in rows)


@pytest.mark.parametrize("fanout", [2, 3])
def test_several_rounds(spark, frames, monkeypatch, fanout):
    monkeypatch.setattr(merkle, "BLOCK_NODES", 9)
    docs = frames([f"text {i}" for i in range(90)]).withColumn("lang", F.when(F.col("doc_id") < 70, "en").when(F.col("doc_id") < 89, "dé"))
    assert got(docs, fanout) == expected(docs.collect(), fanout)


def test_odd_rows(odd, none):
    assert got(odd.select(*FIELDS)) == got(odd) == expected(odd.collect())
    assert got(none) == []


def test_one_row_is_its_own_root(frames):
    ((_, leaf, subroot, root, proof),) = got(frames(["alone"]))
    assert leaf == subroot == root and proof == hashed("")


@pytest.mark.parametrize("wanted", [1, 4])
def test_a_key_and_a_row_that_many_share(spark, frames, monkeypatch, wanted):
    monkeypatch.setattr(merkle, "AT_ONCE", 3)
    monkeypatch.setattr(merkle, "partitions", lambda df: wanted * 4)
    docs = frames([f"t{i}" for i in range(12)]).unionByName(frames([f"u{i % 7}" for i in range(50)]).withColumn("doc_id", F.lit(5).cast("long")))
    docs = docs.unionByName(frames(["null"] * 20).withColumn("doc_id", F.lit(None).cast("long")))
    assert got(docs) == expected(docs.collect())


def test_order_of_input_rows_does_not_matter(odd):
    assert got(odd.orderBy(F.desc("text"))) == got(odd.repartition(3))


def test_a_fold_needs_the_right_leaf(frames):
    rows = merkle.manifest(frames(["a", "b", "c"]), FIELDS, "lang", "doc_id", also={"other": F.lit("0" * 64)}).rows
    folded = rows.select(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root"), merkle.fold(F.col("other"), F.col("proof")) == F.col("root"))
    assert [tuple(r) for r in folded.collect()] == [(True, False)] * 3
    with pytest.raises(ValueError):
        merkle.manifest(frames(["a"]), FIELDS, "lang", "doc_id", fanout=1)
