import random

import pytest

from daymill.operators import dimensions as dims
from daymill.operators import trees

NODES = "id long, name string, parent_id long"


def brute(nodes):
    """(id, ancestor, least distance), walking up from every node."""
    parents, out = {}, set()
    for i, _, p in nodes:
        if i is not None:
            parents.setdefault(i, set()).add(p)
    for i in parents:
        seen, front, far = {i: 0}, {i}, 0
        while front:
            far += 1
            front = {p for x in front for p in parents[x] if p in parents and p not in seen}
            seen |= {p: far for p in front}
        out |= {(i, a, d) for a, d in seen.items()}
    return sorted(out, key=repr)


def frame(spark, nodes):
    return spark.createDataFrame(nodes, NODES)


FOREST = [(1, "a", None), (2, "b", 1), (3, "c", 2), (4, "d", 3), (5, "e", 4), (6, "f", 5), (7, "g", 1), (8, "lost", 99), (None, "no id", 1), (7, "g", 1)]


def test_depth_five(spark, rows):
    pairs = trees.closure(frame(spark, FOREST))
    assert rows(pairs, "id", "ancestor", "distance") == brute(FOREST)
    assert rows(pairs.where("id = 6"), "ancestor", "distance") == [(1, 5), (2, 4), (3, 3), (4, 2), (5, 1), (6, 0)]
    assert rows(trees.cycles(frame(spark, FOREST), pairs)) == []


@pytest.mark.parametrize("loop", [[(1, "a", 1)], [(1, "a", 2), (2, "b", 1)], [(1, "a", 2), (2, "b", 3), (3, "c", 4), (4, "d", 5), (5, "e", 1)]])
def test_cycles_end_and_are_reported(spark, rows, loop):
    nodes = [*loop, (50, "below", 1), (51, "further below", 50), (60, "root", None), (61, "child", 60)]
    pairs = trees.closure(frame(spark, nodes))
    assert rows(pairs, "id", "ancestor", "distance") == brute(nodes)
    assert rows(trees.cycles(frame(spark, nodes), pairs)) == [(i,) for i, _, _ in loop]


@pytest.mark.parametrize("seed", range(2))
def test_any_graph(spark, rows, seed):
    rnd = random.Random(seed)
    nodes = [(i, f"n{i}", rnd.choice([None, rnd.randrange(40), rnd.randrange(max(1, i))])) for i in range(35)] + [(3, "n3", 20)]
    assert rows(trees.closure(frame(spark, nodes)), "id", "ancestor", "distance") == brute(nodes)


def test_rounds_are_few(spark, rows):
    path = [(i, f"n{i}", i - 1 if i else None) for i in range(40)]
    pairs = trees.closure(frame(spark, path))
    assert pairs.count() == 40 * 41 // 2 and pairs.agg({"distance": "max"}).first()[0] == 39
    empty = trees.closure(frame(spark, []))
    assert empty.count() == 0


def test_climbing_with_chains_and_without(spark, rows):
    tree = frame(spark, [(1, "province", None), (10, "city", 1), (100, "district", 10), (2, "lone", None), (20, "lone city", 2)])
    hubs = spark.createDataFrame([(1, 10, 1), (2, 100, 2), (3, 20, 1), (4, 20, None), (5, 999, 2), (6, None, 1), (7, 2, 2)], "hub long, at long, level int")
    want = sorted(
        [
            (1, 10, "city", 1, "province"), (2, 10, "city", 1, "province"), (3, 20, "lone city", 2, "lone"), (4, 2, "lone", None, None),
            (5, None, None, None, None), (6, None, None, None, None), (7, None, None, None, None),
        ],
        key=repr,
    )
    chained = dims.region_chains(tree)
    for regions in (tree, chained):
        out = dims.climb_regions(hubs, regions, "at", hubs.level)
        assert rows(out, "hub", "city_id", "city_name", "province_id", "province_name") == want
    assert rows(chained.selectExpr("id", "chain.id AS up"))[1] == (10, [10, 1])
