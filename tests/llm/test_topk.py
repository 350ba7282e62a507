import duckdb
import numpy as np
import pytest

from daymill.llm import queries, topk

SMALL = "/root/testdata/sf0.001"


def by_hand(queries_, data, k):
    out = []
    for q, v in queries_.items():
        scores = sorted((-int(np.dot(v, w)), i) for i, w in data.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def by_rows(data, k):
    """Every row with an id divisible by 20 against every other row, also those of its id."""
    out = []
    for n, (q, v) in enumerate(data):
        if q % 20 == 0:
            scores = sorted((-int(np.dot(v, w)), i) for m, (i, w) in enumerate(data) if m != n)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    got = sorted(map(tuple, queries.QUERIES["op5_topk"](spark, SMALL).collect()))
    assert got == sorted(con.execute(queries.ORACLES["op5_topk"]).fetchall()) and got


@pytest.mark.parametrize("kind", ["clusters", "same", "line"])
def test_small_blocks(spark, kind):
    draw = np.random.default_rng(2)
    if kind == "clusters":
        points = (draw.integers(-40, 40, (6, 8))[draw.integers(0, 6, 400)] + draw.integers(-2, 3, (400, 8))).tolist()
    else:
        points = [[3, 4]] * 300 if kind == "same" else [[i, -i] for i in range(300)]
    data = dict(enumerate(points))
    frame = spark.createDataFrame(list(data.items()), "id long, vector array<long>")
    got = topk.top_k(frame.where("id % 20 = 0"), frame, 7, data_rows=64, query_rows=8)
    assert sorted(map(tuple, got.collect())) == by_hand({i: v for i, v in data.items() if i % 20 == 0}, data, 7)


def test_trees_cover(spark):
    points = np.random.default_rng(3).integers(-9, 9, (500, 2)).astype(float)
    tree = topk.cover_tree(points, np.arange(500), np.arange(500), leaf=8)
    assert sorted(tree.ids.tolist()) == list(range(500)) and np.array_equal(tree.points, points[tree.ids])
    assert tree.kids.any()
    for i in range(len(tree.kids)):
        kids = tree.children(i)
        held = tree.points[tree.first[i] : tree.last[i]]
        assert np.sqrt(((held - tree.centre[i]) ** 2).sum(axis=1)).max() <= tree.radius[i] + 1e-9
        if len(kids):
            apart = np.sqrt(((tree.centre[kids][:, None] - tree.centre[kids][None]) ** 2).sum(axis=2))
            assert (apart[~np.eye(len(kids), dtype=bool)] > tree.radius[i] / 2 - 1e-9).all() and (tree.radius[kids] <= tree.radius[i] / 2 + 1e-9).all()
            assert tree.first[kids[0]] == tree.first[i] and tree.last[kids[-1]] == tree.last[i]


def test_pairs_are_pruned(monkeypatch):
    draw = np.random.default_rng(4)
    far = np.concatenate([draw.integers(90, 100, (500, 3)), draw.integers(-100, -90, (500, 3))]).astype(float)
    offered = []
    monkeypatch.setattr(topk.Best, "offer", (lambda real: lambda self, rows, scores, ids: (offered.append(scores.size), real(self, rows, scores, ids)))(topk.Best.offer))
    asked = topk.cover_tree(far[:20], np.arange(1000, 1020), np.arange(1000, 1020))
    topk.search(asked, topk.cover_tree(far, np.arange(1000), np.arange(1000)), topk.Best(20, 5))
    assert sum(offered) <= 20 * 500


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.5]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]), (5, [0.25]), (6, []), (0, [1.0, 0.5]), (None, [1.0, 1.0]), (20, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, id string")
    vectors = topk.quantised(frame)
    got = sorted(map(tuple, topk.top_k(vectors.where("id % 20 = 0"), vectors, 20).collect()))
    data = [(0, [64, 32]), (0, [64, 32]), (5, [16, 0]), (6, [0, 0]), (20, [0, 0])]
    assert got == by_rows(data, 20)
    assert topk.top_k(vectors.limit(0), vectors).count() == 0 and topk.top_k(vectors, vectors.limit(0)).count() == 0


def test_rows_of_one_id(spark):
    rows = [(20, [1, 0]), (1, [3, 0]), (1, [2, 0]), (2, [1, 0])]
    frame = spark.createDataFrame(rows, "id long, vector array<long>")
    assert sorted(map(tuple, topk.top_k(frame.where("id = 20"), frame).collect())) == [(20, 1, 1, 3), (20, 2, 1, 2), (20, 3, 2, 1)]
    draw = np.random.default_rng(8)
    rows = [(int(draw.integers(0, 45)), draw.integers(-2, 3, 2).tolist()) for _ in range(300)] + [(40, [1, 1])] * 30
    frame = spark.createDataFrame(rows, "id long, vector array<long>")
    got = topk.top_k(frame.where("id % 20 = 0"), frame, 7, data_rows=50, query_rows=8)
    assert sorted(map(tuple, got.collect())) == by_rows(rows, 7)
