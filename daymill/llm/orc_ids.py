"""Token ids in ORC files, in ascending document order.

A table of token ids is a folder of ORC files, one range of document ids after the other.  Each row holds a document:
``part`` (number of its range), ``doc_id``, ``start_in_part`` (ids of the part's documents before it), ``n`` (its own) and
``ids``.
ORC writes whole-number columns as run lengths in stripes, with an index entry every few thousand rows and a Bloom
filter on ``doc_id``, so readers take stripes in parallel and skip those that cannot hold a document.  A second small
folder, ``parts``, holds for each part the number of ids before it.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymill.llm.bpe import SPACE
from daymill.llm.common import Remembered, col, map_arrow, packed_lists, partitions, per_process, ranges, with_range

#: Encoded words remembered by a Python worker; beyond that they are encoded anew.
REMEMBERED = 1_000_000
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1000
#: Chance that the Bloom filter passes a document that a stripe does not hold.
FALSE_POSITIVES = 0.01

#: Below this code point, text is its own normal form NFC and lower-cases letter by letter.
SIMPLE = 0x130
_KINDS = {chr(c): unicodedata.category(chr(c))[0] for c in range(SIMPLE)}
_LETTERS, _NUMBERS, _SPACES = ("".join(c for c, kind in _KINDS.items() if kind == k) for k in "LNZ")
#: The tokenizer's own pattern for such text, whatever follows it.
SIMPLE_MATCH = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\t-\\r\x85{_SPACES}{_LETTERS}{_NUMBERS}]+")
NOT_SIMPLE = re.compile(f"[^\x00-{chr(SIMPLE - 1)}]")


def byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write a byte as a printable sign: itself if it is one, else the next free one from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


SIGNS = byte_signs()
#: Simple characters whose UTF-8 bytes are written otherwise.
WRITTEN = {c: "".join(SIGNS[b] for b in chr(c).encode()) for c in range(SIMPLE) if "".join(SIGNS[b] for b in chr(c).encode()) != chr(c)}


#: Python's split() takes these for white space, the tokenizer doesn't.
NO_SPACE = re.compile("[\x1c-\x1f]")
WORD = re.compile(f"[^{SPACE}]+")


class WordEncoder:
    """A tokenizer of the ``tokenizers`` library that drops white space, run once per distinct word.

    Text between white spaces is encoded apart from the rest.  Words of simple characters are normalised and split
    here and only the merging is left to the library's model.  That gives the ids of the whole text
    (``tests/llm/test_orc_ids.py`` compares them).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Remembered(self._word, REMEMBERED)
        self.matches = Remembered(self._match, REMEMBERED // 4)

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _match(self, match: str) -> bytes:
        written = match if match.isascii() and match.isalnum() else match.translate(WRITTEN)
        return _packed([t.id for t in self.model.tokenize(written)])

    def _word(self, word: str) -> bytes:
        if not word.isascii() and NOT_SIMPLE.search(word):
            return self._library(word)
        word = word.lower()
        return self._match(word) if word.isalpha() else b"".join(map(self.matches.__getitem__, SIMPLE_MATCH.findall(word)))

    def packed(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if any(t in text for t in self.special):
            return self._library(text)
        words = WORD.findall(text) if NO_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist()


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<i4").tobytes()


def _ids(batches: Iterator[pa.RecordBatch], path: str, end: int | None) -> Iterator[pa.RecordBatch]:
    """doc_id and ids."""
    encoder = None
    for batch in batches:
        encoder = encoder or per_process(("word encoder", path), lambda: WordEncoder(path))
        last = b"" if end is None else _packed([end])
        packed = [encoder.packed(t.as_py() or "") + last for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), packed_lists(packed)], names=["doc_id", "ids"])


def write_ids(
    docs: DataFrame, folder: str, tokenizer: str, end: int | None = 2, key: str = "doc_id", text: str = "text", parts: int | None = None
) -> None:
    """Encodes ``text`` and writes the table of token ids to ``folder``.

    ``docs`` is cut into ``parts`` ranges of ``key`` (a whole number), each sorted and written by one task; a null or
    empty text has the end id only.  Null keys come first; rows with equal keys follow each other in the order of
    their text's hash.
    """
    given = docs.select(col(key).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    cuts = ranges(given, "doc_id", parts or partitions(docs))
    spread = with_range(given, "doc_id", cuts, "part").repartitionById(len(cuts) + 1, F.col("part"))
    ordered = spread.sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text", "part")
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("start_in_part", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = None, 0
        for batch in batches:
            for made in _ids(iter([batch.select(["doc_id", "text"])]), tokenizer, end):
                numbers = batch.column(2).to_numpy(zero_copy_only=False)
                sizes = np.diff(made.column(1).offsets.to_numpy()).astype(np.int64)
                starts = np.empty(len(sizes), np.int64)
                for at in np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else ():
                    same = slice(at, at + int(np.argmin(np.r_[numbers[at:] == numbers[at], False])))
                    before = before if numbers[at] == part else 0
                    part = numbers[at]
                    starts[same] = before + np.cumsum(sizes[same]) - sizes[same]
                    before += int(sizes[same].sum())
                yield pa.RecordBatch.from_arrays([batch.column(2), made.column(0), pa.array(starts), pa.array(sizes.astype(np.int32)), made.column(1)], schema=_arrow(schema))

    (
        ordered.mapInArrow(run, schema)
        .write.option("orc.compress", "ZSTD")
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", FALSE_POSITIVES)
        .orc(f"{folder}/ids")
    )
    spark = docs.sparkSession
    totals = spark.read.schema("part int, n int").orc(f"{folder}/ids").groupBy("part").agg(F.sum("n").alias("held"))
    # One row per part, as many as the cuts above.
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("before")).coalesce(1).write.orc(f"{folder}/parts")


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of a table of token ids.

    A filter on ``doc_id`` reaches the stripes' Bloom filters and row indexes.
    """
    ids = spark.read.schema("part int, doc_id long, start_in_part long, ids array<int>").orc(f"{folder}/ids")
    parts = spark.read.schema("part int, before long").orc(f"{folder}/parts")
    return ids.join(parts, "part").select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "ids")


def checksums(tokens: DataFrame, ids: str = "ids") -> DataFrame:
    """``tokens`` with the list ``ids`` replaced by its length ``n_tokens`` and ``ids_crc32``, the unsigned CRC-32 of
    the ids as little-endian 32-bit numbers."""
    kept = [c for c in tokens.columns if c.lower() not in (ids.lower(), "n_tokens", "ids_crc32")]
    source = tokens.select(*map(col, kept), col(ids))
    schema = T.StructType([*[source.schema[c] for c in kept], T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4")
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], schema=_arrow(schema))

    return map_arrow(source, run, schema)
