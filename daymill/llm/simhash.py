"""SimHash near-duplicates: 64-bit fingerprints, linked through BK-trees.

1. A fingerprint per document (:func:`fingerprints`): Python over Arrow batches, one document at a time.
2. Distinct fingerprints only, each with the smallest row id that has it: a group of exact copies is one row from here.
3. Shards.  With ``radius + keep`` blocks of bits, two fingerprints that differ in at most ``radius`` bits agree on at
   least ``keep`` whole blocks, so every link is found inside a shard of fingerprints that agree on ``keep`` given
   blocks.  ``keep`` grows with the number of fingerprints, so that a shard of unrelated ones stays small at any size.
4. Shards that hold many fingerprints all the same (clusters of near copies) are cut into slices; each pair of slices
   is a task of its own, so no task holds more than two slices.
5. In a task, each slice is a BK-tree.  The trees of a task are built and searched together, level by level with numpy:
   a node's children are keyed by their Hamming distance to it, and a query at distance d follows the edges from
   d - radius to d + radius only.
6. A search keeps a link to a fingerprint only if the two are not yet joined inside the task (union-find), so a task
   passes on fewer links than it has fingerprints, not all pairs, and no connection is lost.
7. Components by rounds of large and small stars over the links.

The trees are sent to the tasks by the shuffle on the shard, not as one broadcast, since together they grow with the
data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import fresh, map_arrow, partitions, replace, stored

SEED = 42
SHINGLE_WORDS = 4
RADIUS = 4
BITS = 64
#: Unrelated fingerprints aimed at in a shard.
SHARD_ROWS = 64
#: Fingerprints in a slice of a shard; a task compares two slices at a time.
SLICE_ROWS = 2048
#: Shingle hashes held at once while the bits of one text are counted.
HASHES_AT_ONCE = 1 << 14
#: Pairs of query and node held at once in a search.
FRONTIER = 1 << 20


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the lower-cased words of ``text``, shingles of ``size`` words, repeats included.

    Fewer words than ``size`` make one shingle.  No words (or null): zero.
    """
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, HASHES_AT_ONCE):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + HASHES_AT_ONCE], stops[at : at + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "simhash") -> DataFrame:
    """``docs`` without ``text``, with the fingerprint ``out`` (a signed long with the same 64 bits)."""
    kept = [c for c in docs.columns if c not in (text, out)]
    given = fresh(docs, "given_text")
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(given))
    schema = source.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            prints = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints)], names=[*kept, out])

    return map_arrow(source, run, schema)


# ---- BK-trees, many at once ----------------------------------------------------------------------------------------


def bit_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees over ``values``, one for each value of ``tree`` (sorted ascending).

    ``first`` and ``edge``: the children of node i are ``child[first[i]:first[i + 1]]``, ascending by the distance to
    i that ``edge`` holds; no two children of a node have the same distance.  Equal values must not share a tree.
    """

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        n = len(values)
        self.values = values
        roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.zeros(0, np.int64)
        self.root_of = dict(zip(tree[roots].tolist(), roots.tolist()))
        at = np.repeat(roots, np.diff(np.r_[roots, n])) if n else np.zeros(0, np.int64)
        parent, distance = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        left = np.setdiff1d(np.arange(n), roots, assume_unique=True)
        while len(left):  # a level: each node left goes to the child of its node at its distance; the first becomes it
            d = bit_distance(values[left], values[at[left]])
            order = np.lexsort((left, d, at[left]))
            left, d = left[order], d[order]
            new = np.r_[True, (at[left][1:] != at[left][:-1]) | (d[1:] != d[:-1])]
            parent[left[new]], distance[left[new]] = at[left[new]], d[new]
            at[left] = left[new][np.cumsum(new) - 1]
            left = np.sort(left[~new])
        inner = np.flatnonzero(parent >= 0)
        order = inner[np.lexsort((distance[inner], parent[inner]))]
        self.child, self.edge, self.owner = order, distance[order], parent[order]
        self.key = self.owner * (BITS + 1) + self.edge  # ascending, so that a run of edges is found by bisection

    def search(self, queries: np.ndarray, trees: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (index of the query, index of the node within ``radius``), in pieces of bounded size."""
        roots = np.array([self.root_of.get(t, -1) for t in trees.tolist()], np.int64)
        there = np.flatnonzero(roots >= 0)
        work = [(there[i : i + FRONTIER // 64], roots[there[i : i + FRONTIER // 64]]) for i in range(0, len(there), FRONTIER // 64)]
        while work:  # depth first over pieces, so that what waits stays small
            q, node = work.pop()
            if not len(q):
                continue
            d = bit_distance(queries[q], self.values[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            low = np.searchsorted(self.key, node * (BITS + 1) + np.maximum(d - radius, 0))
            high = np.searchsorted(self.key, node * (BITS + 1) + np.minimum(d + radius, BITS), side="right")
            width = high - low
            total = np.cumsum(width)
            for a, b in _pieces(total, FRONTIER):
                w = width[a:b]
                if not w.sum():
                    continue
                reach = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(low[a:b], w)
                work.append((np.repeat(q[a:b], w), self.child[reach]))


def _pieces(total: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts of a running total into runs of about ``most``."""
    at, done = 0, 0
    while at < len(total):
        to = max(int(np.searchsorted(total, done + most, side="right")), at + 1)
        yield at, to
        at, done = to, int(total[to - 1])


class Joined:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _shard_links(members: pd.DataFrame, radius: int) -> np.ndarray:
    """Rows (id, id) that join what is within ``radius`` inside each shard; fewer than there are members.

    ``members``: shard, side (0: in the tree, 1: query of another slice, 2: both), id, print.
    """
    values, ids = members["print"].to_numpy(np.int64).view(np.uint64), members["id"].to_numpy(np.int64)
    shard, side = members["shard"].to_numpy(np.int64), members["side"].to_numpy()
    inside = np.flatnonzero(side != 1)
    asking = np.flatnonzero(side != 0)
    forest = Forest(values[inside], shard[inside])
    known, kept = Joined(len(values)), []
    for q, node in forest.search(values[asking], shard[asking], radius):
        a, b = asking[q], inside[node]
        new = a != b
        for i, j in zip(a[new].tolist(), b[new].tolist()):
            if known.join(i, j):
                kept.append((i, j))
    found = np.array(kept, np.int64).reshape(-1, 2)
    return np.stack([ids[found[:, 0]], ids[found[:, 1]]], axis=1)


def _links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Streams members sorted by shard; handles whole shards, about SLICE_ROWS * 4 members at a time."""
    waiting: list[pd.DataFrame] = []
    held = 0

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        found = _shard_links(rows, radius)
        return pd.DataFrame({"a": found.max(axis=1), "b": found.min(axis=1)})

    for batch in batches:
        if not len(batch):
            continue
        waiting.append(batch)
        held += len(batch)
        if held >= 4 * SLICE_ROWS:
            rows = pd.concat(waiting, ignore_index=True)
            last = rows["shard"].to_numpy() == rows["shard"].iloc[-1]
            if not last.all():
                yield done(rows[~last].reset_index(drop=True))
                rows = rows[last].reset_index(drop=True)
            waiting, held = [rows], len(rows)
    if held:
        yield done(pd.concat(waiting, ignore_index=True))


# ---- shards ---------------------------------------------------------------------------------------------------------


def block_sets(n: int, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> list[int]:
    """Bit masks; two fingerprints within ``radius`` agree on all bits of at least one.

    The fewest blocks that leave about ``shard_rows`` of ``n`` unrelated fingerprints in a shard.
    """
    for keep in range(1, BITS - radius + 1):
        blocks = radius + keep
        edges = [BITS * i // blocks for i in range(blocks + 1)]
        masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
        if n / 2 ** (BITS * keep // blocks) <= shard_rows or keep == 4:
            return [sum(chosen) for chosen in combinations(masks, keep)]
    raise AssertionError


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_links(prints: DataFrame, radius: int = RADIUS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Links (a, b), a above b, that connect all of ``prints`` (id, print; prints distinct) within ``radius``."""
    masks = block_sets(prints.count(), radius)
    wide = prints.select(
        F.col("id"),
        F.col("print"),
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("set"), F.col("print").bitwiseAND(F.lit(signed(m))).alias("value")) for i, m in enumerate(masks)])
        ).alias("block"),
    ).select("id", "print", "block.set", "block.value")
    # Slices: shards above slice_rows are cut by a hash of the fingerprint.
    hot = wide.groupBy("set", "value").agg(F.count("*").alias("n")).where(F.col("n") > slice_rows)
    members = wide.join(hot, ["set", "value"], "left").withColumn("slices", F.coalesce(F.ceil(F.col("n") / slice_rows), F.lit(1)))
    mine = members.withColumn("slice", F.pmod(F.xxhash64("print", F.lit(7)), F.col("slices")).cast("int"))
    # The pair of slices (i, j), i <= j: slice i is the tree, slice j asks; (i, i) does both.
    own = F.array(F.struct(F.col("slice").alias("i"), F.col("slice").alias("j"), F.lit(2).alias("side")))
    after = F.filter(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int")), lambda j: j > F.col("slice"))
    before = F.filter(F.sequence(F.lit(0), (F.col("slices") - 1).cast("int")), lambda j: j < F.col("slice"))
    tasks = mine.select(
        "id",
        "print",
        "set",
        "value",
        F.explode(
            F.concat(
                own,
                F.transform(after, lambda j: F.struct(F.col("slice").alias("i"), j.alias("j"), F.lit(0).alias("side"))),
                F.transform(before, lambda i: F.struct(i.alias("i"), F.col("slice").alias("j"), F.lit(1).alias("side"))),
            )
        ).alias("task"),
    ).select(F.xxhash64("set", "value", "task.i", "task.j").alias("shard"), "task.side", "id", "print")
    # Two shards with the same hash are searched as one: more is compared, nothing is missed.
    sorted_ = tasks.repartition(partitions(prints), "shard").sortWithinPartitions("shard", "print", "side")
    return sorted_.mapInPandas(lambda batches: _links(batches, radius), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id it is connected to.

    Large star, small star: each round hangs all neighbours of an id on the smallest of them, until nothing changes.
    Each round's links are written to the shared folder.
    """
    now = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while seen != (0, None):
        both = now.union(now.select("b", "a")).toDF("at", "to")
        least = both.groupBy("at").agg(F.min("to").alias("m")).withColumn("m", F.least("at", "m"))
        large = both.where("to > at").join(least, "at").select(F.col("to").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(smallest, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", F.col("m").alias("b")))
        now = stored(small.where("a != b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` without ``text``, with ``simhash`` (long) and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest
    ``key`` (a whole number) that links lead to, the document's own included.  Null and empty texts have the
    fingerprint zero and are linked like any other; rows with the same key are rows of their own; a null key counts as
    none when the smallest is taken, so a component of null keys only has a null id.  Long texts are read whole.  An
    empty table gives an empty table.  Other columns are kept; one called ``simhash`` or ``component_id`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("simhash", "component_id")]
    prints = stored(fingerprints(docs.select(*[F.col(f"`{c}`") for c in kept]), text), "simhash")
    distinct = stored(prints.groupBy("simhash").agg(F.min(f"`{key}`").alias("least")), "prints")
    # Nodes are the fingerprints themselves: distinct also where keys are null or repeat.
    links = near_links(distinct.select(F.col("simhash").alias("id"), F.col("simhash").alias("print")), radius)
    groups = components(links).select(F.col("id").alias("simhash"), F.col("component").alias("node"))
    named = distinct.join(groups, "simhash", "left").withColumn("node", F.coalesce("node", "simhash"))
    least = named.groupBy("node").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "node").select("simhash", "component_id")
    return prints.join(ids, "simhash").select(*[F.col(f"`{c}`") for c in prints.columns], "component_id")


def hex_digits(simhash: str = "simhash"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(simhash)), 16, "0")


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the one with the smallest key, nulls last.

    Rows that share that key are told apart by a hash of their text; a row that is there twice stays once.
    """
    number, mark = fresh(docs, "row_number"), fresh(docs, "row_mark")
    marked = docs.withColumn(number, F.coalesce(F.col(f"`{key}`"), F.lit(0))).withColumn(mark, F.xxhash64(f"`{key}`", f"`{text}`"))
    plain = marked.select(F.col(f"`{key}`").alias("key"), F.col(number).alias("number"), F.col(mark).alias("mark"), F.col(f"`{text}`").alias("text"))
    found = near_duplicates(plain, "key", "text")
    lone = F.when(F.col("component_id").isNull(), F.col("simhash"))  # groups of null keys only
    stays = (
        found.groupBy("component_id", lone.alias("lone"))
        .agg(F.min(F.struct(F.col("key").isNull().alias("none"), "number", "mark")).alias("kept"))
        .select(F.col("kept.number").alias(number), F.col("kept.mark").alias(mark))
    )
    return marked.join(stays, [number, mark]).dropDuplicates([number, mark]).select(*[F.col(f"`{c}`") for c in docs.columns])
