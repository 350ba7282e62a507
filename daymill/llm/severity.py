"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Grades are 0 (clean), 1 (mild) and 2 (severe).  The labels only tell toxic from clean, so the grades of the labelled
rows come from how dense a toxic text is with features that tell the two apart: up to the median of the toxic rows is
mild, above it severe.  The model has one weight per feature, shared by both thresholds:

    P(grade <= k) = sigmoid(threshold[k] - weights . x)

Features are words and their beginnings, so that forms not seen in training still count; x is a feature's occurrences
over the square root of the number of words.  The score of a text is then a sum over its words, each looked up once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.llm.common import Remembered, col, fresh, map_arrow, per_process, stored

#: Labelled rows the model is fitted on at most: those with the smallest hash of their id.
SAMPLE_ROWS = 10_000
#: The least likelihood ratio and number of documents of a feature that is kept.
MIN_RATIO, MIN_DOCS = 12.0, 5
BEGINNINGS = (4, 5, 6)
#: Weight of clean rows over toxic ones when the cut is chosen.
CLEAN_COUNTS = 3
STEPS, RATE, RIDGE = 400, 0.3, 1e-4
WORDS = re.compile(r"[^\W\d_]+")
REMEMBERED = 200_000


def features_of(token: str) -> list[str]:
    """The words in a stretch of text without white space, and their beginnings (``abcd*``)."""
    out = []
    for word in WORDS.findall(token.lower()):
        out.append(word)
        out += [word[:n] + "*" for n in BEGINNINGS if len(word) > n]
    return out


@dataclass
class Severity:
    """A fitted model: ``expected`` is the sum of grade times probability."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, float] = (1e9, 1e9)
    #: P(grade >= 1) from which a text is rejected, where toxic and clean labelled rows part best.
    reject_from: float = 0.5

    def score(self, text: str | None, known: Remembered | None = None) -> float:
        tokens = (text or "").split()
        if not tokens:
            return 0.0
        known = known if known is not None else self.lookup()
        return sum(map(known.__getitem__, tokens)) / len(tokens) ** 0.5

    def name(self) -> str:
        """The same for equal weights."""
        return hashlib.sha256(repr(sorted(self.weights.items())).encode()).hexdigest()

    def lookup(self) -> Remembered:
        weights = self.weights
        return Remembered(lambda token: sum(weights.get(f, 0.0) for f in features_of(token)), REMEMBERED)

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1) and P(grade >= 2), a row for each score."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - scores[:, None], -700, 700)))


def fit_grades(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, features: int) -> tuple[np.ndarray, tuple[float, float]]:
    """Weights and thresholds of highest penalised likelihood; ``rows`` are (feature numbers, values)."""
    sizes = [len(i) for i, _ in rows]
    index = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, int)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    row = np.repeat(np.arange(len(rows)), sizes)
    weights, low, gap = np.zeros(features), 0.0, 0.0  # the second threshold is low + exp(gap)
    state = [np.zeros(features + 2), np.zeros(features + 2)]
    # Toxic rows are few; each class weighs the same in all.
    share = np.bincount(grades, minlength=3) / len(grades)
    weight = (1 / np.maximum(share, 1e-9))[grades]
    weight /= weight.sum()
    for step in range(1, STEPS + 1):
        score = np.bincount(row, value * weights[index], minlength=len(rows))
        high = low + np.exp(gap)
        below0, below1 = 1 / (1 + np.exp(np.clip(score - low, -60, 60))), 1 / (1 + np.exp(np.clip(score - high, -60, 60)))
        chance = np.maximum(np.choose(grades, [below0, below1 - below0, 1 - below1]), 1e-12)
        slope0, slope1 = below0 * (1 - below0), below1 * (1 - below1)
        by_low = np.choose(grades, [slope0, -slope0, 0 * slope0]) / chance * weight
        by_high = np.choose(grades, [0 * slope1, slope1, -slope1]) / chance * weight
        by_weight = np.bincount(index, value * -(by_low + by_high)[row], minlength=features) - RIDGE * weights
        gradient = np.r_[by_weight, (by_low + by_high).sum(), by_high.sum() * np.exp(gap)]
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        weights, low, gap = weights + move[:-2], low + move[-2], min(gap + move[-1], 5.0)
    return weights, (float(low), float(low + np.exp(gap)))


def likelihood_ratio(t: Column, c: Column, toxic: int, clean: int) -> Column:
    """G-squared of a feature found in ``t`` of ``toxic`` and ``c`` of ``clean`` documents."""
    n = toxic + clean
    cells = [(t, (t + c) * toxic / n), (c, (t + c) * clean / n), (toxic - t, toxic * (n - t - c) / n), (clean - c, clean * (n - t - c) / n)]
    return 2 * sum((F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells), F.lit(0.0))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic", sample_rows: int = SAMPLE_ROWS, least_ratio: float = MIN_RATIO
) -> Severity:
    """A model of the labelled rows of ``docs``; at most ``sample_rows`` of them are used.

    Labels without key or value are left out; of several labels for a key the largest counts, of several rows of
    ``docs`` with a key the one whose text is smallest.  Every feature whose likelihood ratio is ``least_ratio`` or more
    is used.  Without both toxic and clean rows the model finds nothing toxic.
    """
    chosen = (
        labels.where(col(key).isNotNull() & col(toxic).isNotNull())
        .groupBy(col(key).alias("key"))
        .agg((F.max(col(toxic)) > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample_rows)
    )
    chosen = stored(chosen, "labelled")
    given = docs.where(col(text).isNotNull()).select(col(key).alias("key"), col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("features", T.MapType(T.StringType(), T.IntegerType()))])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process("severity features", dict)  # what another stage left in this worker goes before the counting
        for batch in batches:
            toxics, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(texts), 64):
                made = []
                for i in range(at, min(at + 64, len(texts))):
                    tokens = texts[i].as_py().split()
                    made.append((len(tokens), list(Counter(f for t in tokens for f in features_of(t)).items())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(toxics[at : at + 64], pa.int32()), pa.array([n for n, _ in made], pa.int32()), pa.array([f for _, f in made], pa.map_(pa.string(), pa.int32()))],
                    names=["toxic", "words", "features"],
                )

    # Repeated keys are folded in the tasks that read them, so the sample stays within its bound.
    sample = given.join(chosen, "key").groupBy("key").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    counted = stored(sample.select("toxic", "text").mapInArrow(count, schema), "features")
    totals = {r.toxic: r["n"] for r in counted.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Severity()
    seen = counted.select("toxic", F.explode(F.map_keys("features")).alias("feature")).groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    best = (
        seen.where(F.col("t") + F.col("c") >= MIN_DOCS)
        .withColumn("g", likelihood_ratio(F.col("t"), F.col("c"), totals[1], totals[0]))
        .where(F.col("g") >= least_ratio)
        .orderBy(F.col("g").desc(), "feature")
        .withColumn("telling", F.col("t") * totals[0] > F.col("c") * totals[1])
    )
    number = {r.feature: (i, r.telling) for i, r in enumerate(best.select("feature", "telling").collect())}
    pairs = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.IntegerType()))])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted((number[f][0], n) for f, n in (row or ()) if f in number) for row in batch.column(2).to_pylist()]
            lists = [pa.array([[x[k] for x in row] for row in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["toxic", "words", "at", "n"])

    telling = np.array([t for _, t in number.values()], bool)
    rows, toxics, density = [], [], []
    for r in counted.mapInArrow(pick, pairs).collect():  # at most sample_rows rows, the kept features of each
        at, n, words = np.array(r["at"], int), np.array(r["n"], float), max(r.words, 1)
        rows.append((at, n / words**0.5))
        toxics.append(r.toxic)
        density.append(n[telling[at]].sum() / words)
    toxics, density = np.array(toxics), np.array(density)
    grades = np.where(toxics == 0, 0, np.where(density > np.median(density[toxics == 1]), 2, 1))
    weights, thresholds = fit_grades(rows, grades, len(number))
    model = Severity({f: float(weights[i]) for f, (i, _) in number.items() if weights[i]}, thresholds)
    scores = np.array([float(v @ weights[i]) for i, v in rows])
    model.reject_from = best_cut(model.above(scores)[:, 0], toxics)
    return model


def best_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The value that parts toxic from clean rows best by the shares of each on the right side, a wrongly rejected
    share counting CLEAN_COUNTS times; halfway between the two rows it lies between."""
    order = np.argsort(chance, kind="stable")
    chance, toxic = chance[order], toxic[order] == 1
    gain = CLEAN_COUNTS * np.cumsum(~toxic) / max(1, (~toxic).sum()) - np.cumsum(toxic) / max(1, toxic.sum())
    gain = np.where(np.r_[chance[1:] > chance[:-1], True], gain, -1.0)  # rows alike stay together
    at = int(np.argmax(gain))
    return float((chance[at] + chance[at + 1]) / 2) if at + 1 < len(chance) else 1.1


def grade(docs: DataFrame, model: Severity, text: str = "text", reject_from: float | None = None) -> DataFrame:
    """``docs`` with ``expected_severity`` (0 to 2), ``p_toxic`` (of grade 1 or 2), ``severity`` (the likeliest grade)
    and ``toxic`` (``p_toxic`` of at least ``reject_from``, by default the model's), from the whole ``text``.

    Null and empty texts have score 0 like a text without any known feature.  Rows are handled one by one; input
    columns of these names are replaced.
    """
    cut = model.reject_from if reject_from is None else reject_from
    new = ("expected_severity", "p_toxic", "severity", "toxic")
    kept = [c for c in docs.columns if c.lower() not in new]
    if text in kept and isinstance(docs.schema[text].dataType, T.StringType):  # the text goes to the workers once
        source, at = docs.select(*map(col, kept)), kept.index(text)
    else:
        source, at = docs.select(*map(col, kept), col(text).cast("string").alias(fresh(docs, "given_text"))), len(kept)
    kinds = (T.DoubleType(), T.DoubleType(), T.IntegerType(), T.BooleanType())
    schema = T.StructType([*[source.schema[c] for c in kept], *[T.StructField(n, k) for n, k in zip(new, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_process(("severity", model.name()), model.lookup)
        for batch in batches:
            scores = np.array([model.score(t.as_py(), known) for t in batch.column(at)], float)
            above = model.above(scores)
            chance = np.stack([1 - above[:, 0], above[:, 0] - above[:, 1], above[:, 1]], axis=1)
            made = [above.sum(axis=1), above[:, 0], chance.argmax(axis=1).astype(np.int32), above[:, 0] >= cut]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], *map(pa.array, made)], names=[*kept, *new])

    return map_arrow(source, run, schema)


def keep_clean(docs: DataFrame, model: Severity, text: str = "text", reject_from: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with their columns."""
    names = {c: fresh(docs, f"kept_{i}") for i, c in enumerate(docs.columns)}  # out of the way of the new columns
    read = names.get(text, fresh(docs, "graded_text"))
    copy = [] if text in names else [col(text).cast("string").alias(read)]
    marked = docs.select(*[col(c).alias(n) for c, n in names.items()], *copy)
    clean = grade(marked, model, read, reject_from).where(~F.col("toxic"))
    return clean.select(*[F.col(n).alias(c) for c, n in names.items()])
