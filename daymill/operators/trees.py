"""Trees given by a parent column: all ancestors of every node, of any depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymill.session import scratch_table


def _written(df: DataFrame) -> DataFrame:
    path = scratch_table(df.sparkSession, "closure")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _edges(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """Distinct (id, ancestor) of nodes and their parents; parents that are no nodes are left out."""
    known = nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("ancestor")).distinct()
    return nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(parent).alias("ancestor")).distinct().join(known, "ancestor", "left_semi").select("id", "ancestor")


def closure(nodes: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """(id, ancestor, distance): every node with itself (distance 0) and all its ancestors.

    Pointer doubling: after a round the pairs reach twice as far up, so a tree of depth d takes about log2(d) rounds,
    each written and read back.  A node with several parents has the ancestors of all, each at its least distance.  A
    cycle ends the rounds as well, since then no pair is new; :func:`cycles` names its nodes.
    """
    step = _edges(nodes, key, parent)
    own = nodes.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(key).alias("ancestor"), F.lit(0).cast("bigint").alias("distance")).distinct()
    pairs, jump, reach, known = own, _written(step), 1, -1
    while True:
        far = jump.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("further"))
        longer = pairs.join(far, "ancestor").select("id", F.col("further").alias("ancestor"), (F.col("distance") + reach).alias("distance"))
        pairs = _written(pairs.unionByName(longer).groupBy("id", "ancestor").agg(F.min("distance").alias("distance")))
        held = pairs.count()
        if held == known or jump.isEmpty():
            return pairs
        known, reach = held, 2 * reach
        jump = _written(jump.join(far, "ancestor").select("id", F.col("further").alias("ancestor")).distinct())


def cycles(nodes: DataFrame, pairs: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """(id) of the nodes that are their own ancestors; ``pairs`` is the closure."""
    back = pairs.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("id"))
    return _edges(nodes, key, parent).join(back, ["id", "ancestor"], "left_semi").select("id").distinct()


def chains(nodes: DataFrame, carry: Sequence[str], key: str = "id", parent: str = "parent_id", pairs: DataFrame | None = None) -> DataFrame:
    """``nodes`` with ``chain``: the node, its parent and so on up, each with its key and the columns ``carry``.

    A chain is as long as the tree is deep.  Written once; a report that climbs several times reads one table.
    """
    pairs = closure(nodes, key, parent) if pairs is None else pairs
    named = pairs.join(nodes.select(F.col(key).alias("ancestor"), *[F.col(c).alias(f"__{c}") for c in carry]), "ancestor")
    link = F.struct("distance", F.col("ancestor").alias(key), *[F.col(f"__{c}").alias(c) for c in carry])
    listed = named.groupBy(F.col("id").alias("__id")).agg(F.array_sort(F.collect_list(link)).alias("chain"))
    return _written(nodes.join(listed, F.col(key) == F.col("__id"), "left").drop("__id"))
