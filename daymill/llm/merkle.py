"""Merkle manifest of a dataset: one tree per group, and one over the groups' roots, with a proof for every row.

A row's leaf is a hash of its columns.  The leaves of a group stand in the order of a key; every ``fanout`` consecutive
nodes become their hash until one is left, the group's root.

**Slot pivot.**  A level is a set of conditional aggregates over the children of a parent: one column for each slot of
the fanout, holding the digest of the child in that slot.  The slot columns joined are what the parent hashes; joined
without a child's own slot they are that child's siblings.  The aggregates run as windows over blocks of about a thousand
consecutive nodes: a block's rows are shuffled and sorted once for all its levels, since the parents' numbers are sort
columns from the top of the block down.  The blocks' roots are the nodes of the next round, a thousandth as many, and a
node's proof is that inside its block followed by that of its block.

Positions are found without sorting a group in one task: rows are cut into ranges of the key, the rows of a range are
numbered and the rows before it are a sum over the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymill.llm.common import col, partitions, ranges, stored, with_range

#: Nodes that come together in a window at most.
BLOCK_NODES = 1024
#: Stretches that the rows of one hot key are cut into, by their digest.
STRETCHES = 4096
#: Numbers in one step when a folded row is told apart again.
AT_ONCE = 4096
SMALLEST = -(1 << 63)
#: Siblings to the left and to the right of a node on each level, as joined hex digests.
PROOF = T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(text, 256)


def written(value: Column, kind: T.DataType) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value if isinstance(kind, T.StringType) else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, fields: Sequence[str], instead: dict[str, Column] | None = None) -> Column:
    """The leaf of a row; ``instead`` gives other values for some of the ``fields``."""
    values = {f: (instead or {}).get(f, col(f)) for f in fields}
    return digest(F.concat(*[written(values[f], docs.select(values[f].alias("v")).schema["v"].dataType) for f in fields]))


def positions(nodes: DataFrame, group: str = "group", key: str = "key", tie: str = "leaf") -> DataFrame:
    """``nodes`` with ``at``, the place (from 0) of a row in its group by ``key`` (whole number, null first) and ``tie``.

    Equal rows follow each other.  A key that many rows share is cut by the first hex digits of ``tie``, and its equal
    rows are folded to one with a count before they are numbered, so no range grows with the copies of a key or row.
    """
    columns = nodes.columns
    given = stored(nodes.withColumn("number", F.coalesce(col(key), F.lit(SMALLEST))), "leaves")
    wanted = partitions(nodes)
    cuts = ranges(given, "number", wanted)
    placed = with_range(given, "number", cuts, "part")
    held = placed.groupBy("part").count()
    # A range that holds far more than its share does so because of one key, its cut.
    bulky = {r.part for r in held.where(F.col("count") > F.lit(4) * (F.lit(given.count()) / F.lit(wanted)) + F.lit(AT_ONCE)).collect()}
    lower = F.element_at(F.array(*[F.lit(c) for c in [SMALLEST, *cuts]]), F.col("part") + 1)
    hot = (F.col("number") == lower) & (F.col("part").isin(sorted(bulky)) if bulky else F.lit(False))
    stretch = F.conv(F.substring(col(tie), 1, 3), 16, 10).cast("int")
    placed = placed.withColumn("hot", hot).withColumn("fine", F.when(F.col("hot"), stretch).when(F.col("number") < lower, -1).otherwise(STRETCHES))
    if bulky:
        same = placed.where("hot").groupBy(*map(col, columns), "number", "part", "fine").agg(F.count(F.lit(1)).alias("copies"))
        placed = placed.where("NOT hot").withColumn("copies", F.lit(1).cast("long")).drop("hot").unionByName(same)
    else:
        placed = placed.withColumn("copies", F.lit(1).cast("long")).drop("hot")

    before = Window.partitionBy(group).orderBy("part", "fine").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(group, "part", "fine").agg(F.sum("copies").alias("size"))
        .select(group, "part", "fine", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy(group, "part", "fine").orderBy("number", tie).rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("first", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, [group, "part", "fine"])
    first = F.col("start") + F.col("first")
    if not bulky:
        return numbered.select(*map(col, columns), first.cast("long").alias("at"))
    # Copies are told apart again in steps, spread over the tasks between the two.
    steps = numbered.withColumn("first", first).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(AT_ONCE))))
    each = F.explode(F.sequence(F.col("step"), F.least(F.col("step") + AT_ONCE, "copies") - 1))
    spread = steps.repartition(F.col(group), F.col("first"), F.col("step"))
    return spread.withColumn("copy", each).select(*map(col, columns), (F.col("first") + F.col("copy")).cast("long").alias("at"))


def _round(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``nodes`` (group, at, height, node) with ``proof`` inside their block and ``node`` the block's root.

    A tree with fewer than ``levels`` left to climb stops at its root.
    """
    block = fanout**levels
    climbed = nodes.withColumn("block", F.floor(F.col("at") / F.lit(block)))
    parents = [f"p{k}" for k in range(1, levels + 1)]
    for k, parent in enumerate(parents, 1):
        climbed = climbed.withColumn(parent, F.expr(f"at div {fanout**k}L"))
    down = ["group", "block", *parents[::-1]]
    climbed = climbed.repartition("group", "block").sortWithinPartitions(*down, "at").withColumn("proof", F.array().cast(PROOF))
    for k in range(1, levels + 1):
        same_parent = Window.partitionBy("group", "block", *parents[: k - 1 : -1], f"p{k}")
        slot = F.expr(f"(at div {fanout ** (k - 1)}L) % {fanout}")
        for s in range(fanout):
            climbed = climbed.withColumn(f"slot{s}", F.max(F.when(slot == s, F.col("node"))).over(same_parent))
        slots = [F.coalesce(F.col(f"slot{s}"), F.lit("")) for s in range(fanout)]
        sibling = F.struct(
            F.concat(*[F.when(F.lit(s) < slot, x).otherwise("") for s, x in enumerate(slots)]).alias("left"),
            F.concat(*[F.when(F.lit(s) > slot, x).otherwise("") for s, x in enumerate(slots)]).alias("right"),
        )
        climbs = F.lit(k) <= F.col("height")
        climbed = climbed.select(
            *[c for c in climbed.columns if c not in ("node", "proof") and not c.startswith("slot")],
            F.when(climbs, F.concat("proof", F.array(sibling))).otherwise(F.col("proof")).alias("proof"),
            F.when(climbs, digest(F.concat(*slots))).otherwise(F.col("node")).alias("node"),
        )
    return climbed.drop(*parents)


def trees(nodes: DataFrame, fanout: int = 2) -> DataFrame:
    """``nodes`` (``group``, ``at``, ``leaf``, others) with ``proof`` and ``root`` of the group's tree.

    ``at`` counts from 0 in each group without gaps.  A lone leaf is its own root and has an empty proof.
    """
    sizes = stored(nodes.groupBy("group").agg(F.max("at").alias("last")), "sizes")
    last = sizes.agg(F.max("last")).first()[0] or 0
    height, reach, tallest = F.lit(0), 1, 0
    while reach <= last:
        height, reach, tallest = height + (F.col("last") >= F.lit(reach)).cast("int"), reach * fanout, tallest + 1
    levels = 1
    while levels < tallest and fanout ** (levels + 1) <= BLOCK_NODES:
        levels += 1
    block = fanout**levels
    current = nodes.join(sizes.select("group", height.alias("height")), "group").withColumn("node", F.col("leaf"))
    rounds = []
    while True:
        rounds.append(stored(_round(current, fanout, levels), "climbed"))
        if last < block:
            break
        last //= block
        whole = rounds[-1].where(F.col("at") % block == 0)
        current = whole.select("group", F.col("block").alias("at"), F.greatest(F.col("height") - levels, F.lit(0)).alias("height"), "node")

    def onto(above: DataFrame, below: DataFrame) -> DataFrame:
        """The proofs of a round's nodes carried on by those of their blocks."""
        tops = above.select("group", F.col("at").alias("block"), F.col("proof").alias("above"), F.col("root"))
        kept = [c for c in below.columns if c not in ("block", "height", "node", "proof", "root")]
        return below.join(tops, ["group", "block"]).select(*map(col, kept), F.concat("proof", "above").alias("proof"), tops["root"])

    out = rounds[-1].withColumnRenamed("node", "root")
    for below in rounds[-2::-1]:
        out = onto(out, below)
    return out.select(*map(col, nodes.columns), "proof", "root")


@dataclass
class Manifest:
    """``rows``: key columns, ``leaf``, ``proof`` (array of left, right from the leaf up), ``subroot`` and ``root``;
    ``groups``: a group's value, its ``subroot`` and ``root``."""

    rows: DataFrame
    groups: DataFrame


def _value() -> Column:
    """What a group stands for."""
    return F.when(F.col("group") != "", F.substring("group", 2, 1 << 30))


def manifest(docs: DataFrame, fields: Sequence[str], by: str, key: str, fanout: int = 2, also: dict[str, Column] | None = None) -> Manifest:
    """Trees over the rows of ``docs``: a tree for each value of ``by``, its leaves in ascending order of ``key``.

    A leaf hashes ``fields``, each written as ``-`` if null, else as its UTF-8 byte count, ``:`` and value.  ``also``
    names further columns to carry.  Null keys come first; rows of one key stand in the order of their leaves, equal
    rows are leaves of their own.  The roots of the values of ``by``, null first, then by their bytes, form the last
    tree.  Texts are hashed in the scan and not carried.  An empty table has no rows and no root.
    """
    if fanout < 2:
        raise ValueError("a tree needs a fanout of at least 2")
    value = col(by).cast("string")
    extra = also or {}
    leaves = docs.select(
        F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value)).alias("group"),  # null before all, '' after it
        col(key).cast("long").alias("key"),
        leaf(docs, fields).alias("leaf"),
        *[c.alias(n) for n, c in extra.items()],
    )
    low = trees(positions(leaves), fanout)

    # The same again over the subroots; a group's place comes from the first bytes of its name, then the name.
    subroots = stored(low.where(F.col("at") == 0).select("group", F.col("root").alias("leaf")), "subroots")
    first_bytes = F.conv(F.rpad(F.substring(F.hex(F.encode("group", "utf-8")), 1, 12), 12, "0"), 16, 10).cast("long")
    named = subroots.select(F.lit("").alias("group"), first_bytes.alias("key"), F.col("group").alias("name"), "leaf")
    # Few rows share their first six bytes; they are told apart by the name.
    tops = trees(positions(named, tie="name"), fanout)
    above = stored(tops.select(F.col("name").alias("group"), F.col("leaf").alias("subroot"), F.col("proof").alias("above"), "root"), "roots")
    joined = low.drop("root").join(above, "group")
    rows = joined.select(
        F.col("key").alias(key),
        _value().alias(by),
        "leaf",
        *map(col, extra),
        F.concat("proof", "above").alias("proof"),
        "subroot",
        "root",
    )
    groups = above.select(_value().alias(by), "subroot", "root")
    return Manifest(rows, groups)


def siblings(proof: Column) -> Column:
    """All digests of a proof joined, from the leaf up, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, node, lambda below, s: digest(F.concat(s["left"], below, s["right"])))
