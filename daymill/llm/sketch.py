"""Document fingerprints: every shingle hash below a fixed fraction of the hash range is retained, by default all.

The size of such a sketch follows the size of the text, so sketches of very unequal documents can be compared: the
share of one's hashes found in the other estimates containment.  The smallest hash of a text is retained in any case, so
no text is without one.  Sketches of parts merge to the sketch of the whole, as far as shingles do not cross the cut.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymill.llm.common import col, fresh, map_arrow, partitions, ranges, with_range

SHINGLE_WORDS = 5
SEED = 42
#: Retained share of the hash range.  All of it: likeness and containment are exact.  A smaller share gives estimates
#: from as much smaller sketches; texts of few shingles then may have equal sketches though they differ.
FRACTION = 1.0
#: Shingle hashes held at once.
HASHES_AT_ONCE = 1 << 16


def shingle_hashes(text: str, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``size`` lower-cased words, in pieces; a text with fewer words is one shingle.

    A text without words is one empty shingle, so it equals other such texts only.
    """
    words = text.lower().encode("utf-8", "replace").split()
    joined = b" ".join(words)
    if len(words) <= size:
        yield np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = (ends - lengths)[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        until = at + HASHES_AT_ONCE
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:until], stops[at:until])], np.uint64)


def sketch(text: str | None, fraction: float = FRACTION, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingle hashes below ``fraction`` of the hash range, or else the smallest one, ascending.  Null is
    read as empty."""
    last, kept, least = _last(fraction), [], None
    for h in shingle_hashes(text or "", size):
        kept.append(h[h <= last])
        least = h.min() if least is None else min(least, h.min())
    found = np.unique(np.concatenate(kept))
    return found if len(found) else np.array([least], np.uint64)


def _last(fraction: float) -> np.uint64:
    """The largest hash that is retained."""
    return np.uint64(min(int(fraction * 2.0**64), 2**64) - 1)


def merge(*sketches: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of all the texts together: a smallest hash kept above the threshold gives way to any below it."""
    every = np.unique(np.concatenate(sketches)) if sketches else np.zeros(0, np.uint64)
    below = every[every <= _last(fraction)]
    return below if len(below) else every[:1]


def shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that are in b: 1 for the same sketch, two empty ones included; 0 where only
    ``a`` is empty."""
    return shared(a, b) / len(a) if len(a) else float(not len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches."""
    both = shared(a, b)
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def packed(hashes: np.ndarray) -> str:
    """A sketch as text: base64 of its hashes as ascending little-endian 64-bit numbers."""
    return base64.b64encode(hashes.astype("<u8").tobytes()).decode()


def unpacked(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


def sketches(docs: DataFrame, text: str = "text", out: str = "fingerprint", fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the sketch of the whole ``text`` as text in ``out``.

    Null is read as empty.  A text none of whose hashes is small enough has its smallest one; likely only below about
    1 / ``fraction`` shingles.  Rows are handled one by one, so repeated rows and other columns stay as they are; an input
    column called ``out`` is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    given = fresh(docs, "given_text")
    source = docs.select(*map(col, kept), col(text).cast("string").alias(given))
    schema = T.StructType([*[source.schema[c] for c in kept], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array((packed(sketch(t.as_py(), fraction)) for t in batch.column(len(kept))), pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], made], names=[*kept, out])

    return map_arrow(source, run, schema)


def with_next(docs: DataFrame, key: str, columns: list[str], parts: int | None = None) -> DataFrame:
    """Rows (part, last, key, columns) laid out so that each row's successor by ``key`` follows it in its partition.

    ``docs`` is cut into ranges of ``key`` (a whole number).  Each range, sorted, ends with a copy of the row that
    opens the next one (``last`` true), and the last range with a copy of the very first row.  Null keys come first;
    equal keys follow in the order of the columns' hash.
    """
    given = docs.select(col(key).cast("long").alias("key"), *map(col, columns))
    cuts = ranges(given, "key", parts or partitions(docs))
    placed = with_range(given, "key", cuts, "part").withColumn("tie", F.xxhash64(*map(col, columns)))
    # One row per range, as many as there are cuts: what opens it, and the range before it, whose end it also is.
    first = F.min(F.struct(F.col("key").isNotNull().alias("is"), "key", "tie")).alias("head")
    heads = placed.groupBy("part").agg(first)
    around = Window.orderBy("part")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", "head", F.coalesce(F.lag("part").over(around), F.last("part").over(whole)).alias("before"))
    # Bounded by the number of ranges; the documents are not shuffled for it.
    placed = placed.join(F.broadcast(heads), "part")
    is_head = F.col("key").eqNullSafe(F.col("head.key")) & (F.col("tie") == F.col("head.tie"))
    ends = F.when(is_head, F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("last")), F.struct(F.col("before").alias("to"), F.lit(True).alias("last"))))
    spread = placed.withColumn("place", F.explode(F.coalesce(ends, F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("last")))))).select(
        F.col("place.to").alias("part"), F.col("place.last").alias("last"), "key", "tie", *map(col, columns)
    )
    return spread.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "last", "key", "tie")


def edited(text: str, after: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as many code points of ``after``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION) -> DataFrame:
    """Each document's sketch beside that of its edited text and of the next document.

    Gives ``key``, ``n_chars``, ``edited_text``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (:func:`likeness`), ``kept_in_edited`` and ``kept_in_next`` (:func:`containment`).  The next document
    has the next larger key; after the last comes the first.  Null texts are read as empty.  A single document is its
    own next one.  Rows with equal keys follow each other in the order of their text's hash; a row that is there
    twice follows itself.
    """
    rows = with_next(docs.select(col(key).alias(key), F.coalesce(col(text).cast("string"), F.lit("")).alias("given_text")), key, ["given_text"])
    rows = rows.select("part", "last", "key", "given_text")
    schema = f"`{key}` long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_in_edited double, kept_in_next double"

    def compare(row: tuple, following: tuple) -> tuple:
        (_, number, given, own), (_, _, after, other) = row, following
        changed = edited(given, after)
        mine = own if changed == given else sketch(changed, fraction)
        return number, len(given), changed, packed(own), packed(mine), likeness(own, mine), likeness(own, other), containment(own, mine), containment(own, other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous, names = None, [f.split()[0].strip("`") for f in schema.split(", ")]
        for batch in batches:
            out = []
            for part, last, number, given in zip(*[c.to_pylist() for c in batch.columns]):
                row = (part, number, given, sketch(given, fraction))
                if previous is not None and previous[0] == part:
                    out.append(compare(previous, row))
                previous = None if last else row
                if len(out) >= 256:
                    yield _batch(out, names)
                    out = []
            if out:
                yield _batch(out, names)

    return rows.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
