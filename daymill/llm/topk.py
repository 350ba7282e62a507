"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are packed into blocks of a few thousand, each with its cover tree: a node is a point with a covering radius,
its children are points of its cover more than half that radius apart that cover it within half the radius, and so on.
A node that a few children cannot cover so is a leaf, as are small ones; in many dimensions that may be a whole block.
Queries are packed the same way.  For a pair of nodes no score can exceed

    q.x + |q| r_x + |x| r_q + r_q r_x        (centres q and x, covering radii r_q and r_x),

so a pair whose bound is below the worst k-th score of the query group is dropped with all below it; at the leaves the
scores are one matrix product.  A search task holds one query block and reads the data blocks of its share one after
the other, so the k-th scores found so far prune what follows.  Its memory is two blocks.

The best of each share are merged per query.  Results are exact: a bound equal to the k-th score is still searched,
because ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daymill.llm.common import col, partitions, stored

#: Vectors in a data block, in a query block, and in a leaf that is not split.
DATA_ROWS, QUERY_ROWS, LEAF_ROWS = 4096, 1024, 128
#: Children that may cover a node; one that needs more is a leaf.
CHILDREN = 32
NO_ID = np.iinfo(np.int64).max


@dataclass
class CoverTree:
    """Points in tree order, with the id and the identity of their rows.

    Node i: points[first[i]:last[i]], centre, covering radius, children kid[i] to kid[i] + kids[i] - 1.
    """

    points: np.ndarray
    ids: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    last: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    kid: np.ndarray
    kids: np.ndarray

    def children(self, node: int) -> np.ndarray:
        return np.arange(self.kid[node], self.kid[node] + self.kids[node])


def cover_tree(points: np.ndarray, ids: np.ndarray, keys: np.ndarray, leaf: int = LEAF_ROWS) -> CoverTree:
    """Tree of whole-number vectors; repeated points share a leaf, however many they are."""
    points, ids, keys = points.copy(), ids.copy(), keys.copy()
    first, last, centre, radius, kid, kids = [0], [len(points)], [points[0].copy()], [0.0], [0], [0]
    todo = [0]
    while todo:
        node = todo.pop()
        a, b = first[node], last[node]
        apart = np.sqrt(((points[a:b] - centre[node]) ** 2).sum(axis=1))
        radius[node] = float(apart.max())
        if b - a <= leaf or radius[node] == 0:
            continue
        # Children: the centre, then always the point farthest from those chosen, until all are within half the radius.
        nearest, owner, chosen = apart.copy(), np.zeros(b - a, int), [centre[node]]
        while len(chosen) < CHILDREN and nearest.max() > radius[node] / 2:
            point = points[a + int(nearest.argmax())].copy()
            d = np.sqrt(((points[a:b] - point) ** 2).sum(axis=1))
            owner[d < nearest] = len(chosen)
            nearest = np.minimum(nearest, d)
            chosen.append(point)
        if nearest.max() > radius[node] / 2:
            continue
        order = np.argsort(owner, kind="stable")
        points[a:b], ids[a:b], keys[a:b], owner = points[a:b][order], ids[a:b][order], keys[a:b][order], owner[order]
        edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True])
        kid[node], kids[node] = len(first), len(edges) - 1
        for i, j in zip(edges, edges[1:]):
            todo.append(len(first))
            first.append(a + i)
            last.append(a + j)
            centre.append(chosen[owner[i]])
            radius.append(0.0)
            kid.append(0)
            kids.append(0)
    return CoverTree(points, ids, keys, *map(np.array, (first, last)), np.array(centre, float), np.array(radius), *map(np.array, (kid, kids)))


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), NO_ID)

    def offer(self, rows: slice, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (query, candidate) of the candidates ``ids``; -inf is none."""
        worst = self.score[rows, -1]
        if scores.shape[1] > 4 * self.k:  # only a row's own k best, ties included, can be among the k best of all
            worst = np.maximum(worst, np.partition(scores, -self.k, axis=1)[:, -self.k])
        at, c = np.nonzero((scores >= worst[:, None]) & (scores > -np.inf))
        if not len(at):
            return
        hit = np.unique(at)
        held = rows.start + hit
        row = np.r_[np.repeat(held, self.k), rows.start + at]
        score, found = np.r_[self.score[held].ravel(), scores[at, c]], np.r_[self.id[held].ravel(), ids[c]]
        order = np.lexsort((found, -score, row))
        row, score, found = row[order], score[order], found[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.k
        self.score[row[kept], place[kept]], self.id[row[kept], place[kept]] = score[kept], found[kept]


def search(queries: CoverTree, data: CoverTree, best: Best) -> None:
    """Offers every candidate that can still be among the k best; a query's own row is no candidate."""
    size_q, size_x = np.sqrt((queries.centre**2).sum(axis=1)), np.sqrt((data.centre**2).sum(axis=1))

    def worst(q: int) -> float:
        return best.score[queries.first[q] : queries.last[q], -1].min()

    def bound(q: int, x: np.ndarray) -> np.ndarray:
        r = queries.radius[q]
        # The slack covers rounding in the roots; scores themselves are whole numbers and exact.
        return data.centre[x] @ queries.centre[q] + size_q[q] * data.radius[x] + size_x[x] * r + r * data.radius[x] + 1e-6 * (1 + size_q[q] * size_x[x])

    def visit(q: int, nodes: np.ndarray) -> None:
        while len(nodes):
            limits = bound(q, nodes)
            nodes = nodes[np.argsort(-limits)][np.sort(-limits) <= -worst(q)]
            split = [x for x in nodes if data.kids[x]]
            if queries.kids[q]:
                # Split the wider side; a query group is split once the data nodes are no wider.
                if split and max(data.radius[x] for x in split) > queries.radius[q]:
                    wide = [x for x in split if data.radius[x] > queries.radius[q]]
                    keep = np.setdiff1d(nodes, wide)
                    nodes = np.concatenate([keep, *[data.children(x) for x in wide]])
                    continue
                for child in queries.children(q):
                    visit(child, nodes)
                return
            rows = slice(queries.first[q], queries.last[q])
            for x in nodes:  # leaves, best bound first
                if not data.kids[x] and bound(q, np.array([x]))[0] >= worst(q):
                    a, b = data.first[x], data.last[x]
                    scores = queries.points[rows] @ data.points[a:b].T
                    scores[queries.keys[rows][:, None] == data.keys[a:b][None, :]] = -np.inf
                    best.offer(rows, scores, data.ids[a:b])
            nodes = np.concatenate([data.children(x) for x in split]) if split else np.zeros(0, int)

    visit(0, np.zeros(1, int))


def usable(vector: Column) -> Column:
    """Not null, and neither a null nor a non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


#: The arrays of a block, as bytes.
ARRAYS = {"ids": "<i8", "keys": "<i8", "first": "<i8", "last": "<i8", "radius": "<f8", "kid": "<i8", "kids": "<i8", "centre": "<f8", "points": "<f8"}
BLOCK = "block int, width int, " + ", ".join(f"{name} binary" for name in ARRAYS)


def _blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of about ``rows`` vectors, dealt out by a hash of the row, each packed into its tree once."""
    count = max(1, -(-vectors.count() // rows))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("key", "copy"), F.lit(count)).cast("int"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, group["vector"]))
        points = np.zeros((len(group), max(width, 1)))
        for i, v in enumerate(group["vector"]):  # a shorter vector is filled up with zeros
            points[i, : len(v)] = v
        ids, keys, copy = (group[c].to_numpy(np.int64) for c in ("id", "key", "copy"))
        order = np.lexsort((copy, keys, ids))
        # Only one copy of a row is the row itself; the others are candidates of its query like any other.
        keys = np.where(copy == 0, keys, 0)
        tree = cover_tree(points[order], ids[order], keys[order])
        held = {name: [np.ascontiguousarray(getattr(tree, name), kind).tobytes()] for name, kind in ARRAYS.items()}
        return pd.DataFrame({"block": group["block"].iloc[:1], "width": [points.shape[1]], **held})

    return stored(dealt.repartition(count, "block").groupBy("block").applyInPandas(pack, BLOCK), "blocks")


def _tree(row, wide: int) -> CoverTree:
    """The tree of a stored block, its vectors filled up to ``wide`` components."""
    held = {name: np.frombuffer(getattr(row, name), kind) for name, kind in ARRAYS.items()}
    for name in ("centre", "points"):
        held[name] = np.pad(held[name].reshape(-1, int(row.width)), ((0, 0), (0, wide - int(row.width))))
    return CoverTree(**{name: held[name] for name in CoverTree.__dataclass_fields__})


def top_k(queries: DataFrame, data: DataFrame, k: int = 20, data_rows: int = DATA_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` data vectors of the highest inner product.

    Both sides have ``id`` (long) and ``vector`` (array of whole numbers, below 2**53 in every product).  Every row is a
    candidate of its own, rows of one id too; a query's own row, one of the data with its id and vector, is none.  Ties
    go to the smaller id.  Shorter vectors count as filled up with zeros.  Rows with a null id are left out.  Rows alike
    are searched once: a query that is there several times has its rows as often, each with ranks from 1.  Empty inputs
    give no rows; fewer than ``k`` candidates give all.
    """

    def rows(df: DataFrame) -> DataFrame:
        """Rows alike folded to one, with their number."""
        held = df.where("id IS NOT NULL").groupBy("id", "vector").agg(F.count(F.lit(1)).alias("copies"))
        return held.withColumn("key", F.xxhash64("id", "vector"))

    # Of rows alike a query can take k at most, besides its own.
    candidates = rows(data).withColumn("copy", F.explode(F.sequence(F.lit(0), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))))
    searched = stored(rows(queries), "queries")
    asked, held = _blocks(searched.withColumn("copy", F.lit(0)).drop("copies"), query_rows), _blocks(candidates.drop("copies"), data_rows)
    blocks, others = asked.count(), held.count()
    shares = max(1, min(others, partitions(data) // max(1, blocks)))
    columns = ["block", "width", *ARRAYS]
    # Each query block meets each data block once: blocks, not rows, are paired, one data block per row and share.
    meet = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.col("block").alias("q"), F.lit(False).alias("is_data"), *columns)
    spread = held.select(F.pmod("block", F.lit(shares)).alias("share"), F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1)))).alias("n"), F.lit(True).alias("is_data"), *columns)
    numbers = asked.select(F.col("block").alias("q")).orderBy("q").collect() if blocks else []  # one number per block
    names = F.array(*[F.lit(r.q) for r in numbers]) if numbers else F.array().cast("array<int>")
    spread = spread.withColumn("q", F.get(names, F.col("n")))
    # Both sides of a share come together in one task; the rows stream through, query blocks one after the other.
    sides = meet.unionByName(spread.drop("n"))
    placed = sides.repartition(max(1, shares * blocks), "share", "q").sortWithinPartitions("share", "q", "is_data", "block")
    found = placed.mapInPandas(lambda batches: _search(batches, k), "key long, vec_id long, score long")
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    owners = searched.select("key", F.col("id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return owners.join(ranked, "key").select("query_id", "rank", "vec_id", "score")


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    at, given, tree, best = None, None, None, None

    def done() -> pd.DataFrame:
        real = best.id < NO_ID
        rows = np.repeat(tree.keys, real.sum(axis=1))
        return pd.DataFrame({"key": rows, "vec_id": best.id[real], "score": best.score[real].astype(np.int64)})

    for batch in batches:
        for row in batch.itertuples(index=False):
            if not row.is_data:
                if best is not None:
                    yield done()
                at, given, tree, best = (row.share, row.q), row, None, None
            elif at == (row.share, row.q):
                wide = max(int(given.width), int(row.width))
                if tree is None or tree.points.shape[1] < wide:
                    tree, best = _tree(given, wide), best if best is not None else Best(len(given.ids) // 8, k)
                search(tree, _tree(row, tree.points.shape[1]), best)
    if best is not None:
        yield done()


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, vector) with each component x turned into floor(scale * x); unusable vectors are left out."""
    return vectors.where(usable(col(vector))).select(col(key).cast("long").alias("id"), F.transform(col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("vector"))
