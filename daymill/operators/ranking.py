"""Ranks, paths and quantiles that do not gather a large group in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_in_group(df: DataFrame, groups: Sequence[str], score: str, name: str = "rank") -> DataFrame:
    """Rank by ``score`` downwards inside each group, ties share a rank.

    The rank of a row is one more than the rows with a higher score.  Rows
    are counted per group and score first, the window runs over the distinct
    scores only, and the rank is joined back.  So a group of any size is fine
    as long as its scores are counts with few distinct values.
    """
    counted = df.groupBy(*groups, score).agg(F.count(F.lit(1)).alias("__n"))
    higher = Window.partitionBy(*groups).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.col(score).alias("__score"),
        (F.coalesce(F.sum("__n").over(higher), F.lit(0)) + 1).cast("int").alias(name),
    )
    same = F.col(score).eqNullSafe(F.col("__score"))
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return df.join(ranked, same, "left").drop("__score", *[f"__g{i}" for i in range(len(groups))])


def top_in_group(df: DataFrame, groups: Sequence[str], score: str, n: int, name: str = "rk") -> DataFrame:
    """Rows of the ``n`` highest ranks per group, ties kept.

    Spark applies the limit in every task before the rows of a group meet,
    so a large group sends only its candidates.
    """
    order = Window.partitionBy(*groups).orderBy(F.col(score).desc())
    return df.withColumn(name, F.rank().over(order)).where(F.col(name) <= n)


def steps_in_session(
    views: DataFrame, session: str, time: str, tie: str, page: str, chunk_seconds: int = 60
) -> DataFrame:
    """Each view with its step number in the session and the page after it.

    A session may hold a large share of all views, so it is never ordered in
    one task.  Views are numbered inside short stretches of time; a table with
    one row per session and stretch carries the number of views before it and
    the first page after it.
    """
    # Keys without nulls: views without a session or time stay together, and no
    # null filter is inferred that would make the two uses below differ.
    stretch = F.coalesce(F.floor(F.unix_seconds(F.col(time)) / F.lit(chunk_seconds)).cast("bigint"), F.lit(-(1 << 62)))
    key = ["__session", "__none"]
    cut = views.select(
        F.coalesce(F.col(session).cast("string"), F.lit("")).alias("__session"),
        F.col(session).isNull().alias("__none"),
        F.col(session),
        F.col(time).alias("__t"),
        F.col(tie).alias("__tie"),
        F.col(page).alias("page_id"),
        stretch.alias("__chunk"),
    )
    local = Window.partitionBy(*key, "__chunk").orderBy("__t", "__tie")
    numbered = cut.select(
        *key,
        "__chunk",
        session,
        "page_id",
        F.row_number().over(local).alias("__rn"),
        F.lead("page_id").over(local).alias("__next"),
        F.lead(F.lit(1)).over(local).isNull().alias("__last"),
    )
    # Taken from the numbered rows, so both sides use one scan and one shuffle.
    across = Window.partitionBy(*key).orderBy("__chunk")
    stretches = (
        numbered.groupBy(*key, "__chunk")
        .agg(F.max("__rn").alias("__n"), F.max(F.when(F.col("__rn") == 1, F.col("page_id"))).alias("__first"))
        .select(
            *key,
            "__chunk",
            F.coalesce(F.sum("__n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
            F.lead("__first").over(across).alias("__following"),
        )
    )
    # Short sessions have as many stretches as views, which the estimate before the run does not see: never broadcast.
    return numbered.join(stretches.hint("merge"), [*key, "__chunk"]).select(
        session,
        "page_id",
        (F.col("__before") + F.col("__rn")).alias("step"),
        F.when(F.col("__last"), F.col("__following")).otherwise(F.col("__next")).alias("next_page_id"),
    )


#: Parts that a stretch of values is cut into by one pass, and rows few enough to be counted value by value.
PARTS, FEW_ROWS = 1 << 16, 1 << 16


@dataclass
class Stretch:
    """Values of a column from ``low`` to ``high``; ``first`` rows of the column lie below it, ``rows`` in it."""

    column: str
    low: float
    high: float
    first: int
    rows: int


def _magnitude(v: Column) -> Column:
    """A whole number that grows with a double: its sign and binary logarithm, in steps of a fifteenth."""
    size = F.log2(F.abs(v)) + 1100  # 26 or more, down to the smallest double
    return F.floor(F.when(v == 0, 0.0).when(v > 0, size).otherwise(-size) * 15).cast("bigint")


def _counted(df: DataFrame, parts: list[tuple[str, int, Column, Column]]) -> dict[tuple[str, int], list[tuple[float, float, int]]]:
    """One pass: for each (column, number, test, part) the parts of the rows that pass the test, in ascending order,
    as smallest value, largest value and rows."""
    rows = [
        F.when(test, F.struct(F.lit(c).alias("c"), F.lit(i).alias("i"), part.cast("double").alias("part"), F.col(f"`{c}`").cast("double").alias("v")))
        for c, i, test, part in parts
    ]
    used = df.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r")).select("r.*")
    held = used.groupBy("c", "i", "part").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    out: dict[tuple[str, int], list[tuple[float, float, int]]] = {(c, i): [] for c, i, _, _ in parts}
    for r in held.collect():  # PARTS or FEW_ROWS rows for a stretch
        out[r.c, r.i].append((r.low, r.high, r.n))
    return {k: sorted(v) for k, v in out.items()}


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Interpolated quantiles of several columns, all found in the same few passes over ``df``.

    Radix selection.  The first pass counts the rows of each order of magnitude.  The part that holds a wanted
    position is a stretch, whose parts the next pass counts, and so on: with 65,536 parts four passes settle any
    double.  A stretch of ``FEW_ROWS`` rows or less is counted value by value at once.  The driver sees counts of
    parts, never rows; their number depends on the quantiles, not on the data.  Nulls and NaN are left out; a column
    without a number has none.  Runs the passes when called.
    """
    number = {c: F.col(f"`{c}`").cast("double") for c in wanted}
    usable = {c: v.isNotNull() & ~F.isnan(v) for c, v in number.items()}
    first = _counted(df, [(c, 0, usable[c], _magnitude(number[c])) for c in wanted])
    totals = {c: sum(n for _, _, n in first[c, 0]) for c in wanted}
    places = {(c, p) for c, qs in wanted.items() if totals[c] for q in qs for p in _neighbours(q, totals[c])}
    value: dict[tuple[str, int], float] = {}

    def settle(parts: list[tuple[float, float, int]], column: str, before: int) -> list[Stretch]:
        """Values of the places whose part holds one value only; the stretches of the others."""
        open_parts = []
        for low, high, n in parts:
            inside = [p for c, p in places if c == column and before <= p < before + n]
            if inside and low == high:
                value.update({(column, p): low for p in inside})
            elif inside:
                open_parts.append(Stretch(column, low, high, before, n))
            before += n
        return open_parts

    stretches = [s for c in wanted for s in settle(first[c, 0], c, 0)]
    while stretches:
        tests = []
        for i, s in enumerate(stretches):
            v = number[s.column]
            share = (v - F.lit(s.low)) / F.lit(s.high - s.low)
            part = v if s.rows <= FEW_ROWS else F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
            tests.append((s.column, i, usable[s.column] & v.between(s.low, s.high), part))
        found = _counted(df, tests)
        stretches = [left for i, s in enumerate(stretches) for left in settle(found[s.column, i], s.column, s.first)]

    def quantile(c: str, q: float) -> float | None:
        if not totals[c]:
            return None
        low, high = (value[c, p] for p in _neighbours(q, totals[c]))
        return low if low == high else low + (high - low) * ((totals[c] - 1) * q - _neighbours(q, totals[c])[0])

    return {c: [quantile(c, q) for q in qs] for c, qs in wanted.items()}


def _neighbours(q: float, rows: int) -> tuple[int, int]:
    """Places (from 0, in ascending order) of the values that a quantile lies between."""
    at = (rows - 1) * q
    return math.floor(at), math.ceil(at)
