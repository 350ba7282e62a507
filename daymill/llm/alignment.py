"""Alignment of two tokenizers over the same bytes.

Both cut a space and the text into tokens; what counts is where tokens end, as byte offsets.  Offsets at which a token
ends on both sides cut the tokens into groups.  Texts on which the two agree for long stretches have equal ends at a
constant shift between the two index counts, a diagonal.

**Diagonal run skipping.**  At the current shift, 1, 2, 4, ... ends of the one side are compared with those of the other
at once, and the whole stretch is jumped while they are equal; after a miss the width is halved down to one.  What is
left is an irregular group: its ends are merged one by one until the sides meet again, which also gives the new shift.

A link is a pair of tokens, one of each side, that share a byte.  How often two ids are linked in the corpus is a count
over all documents.  The most frequent pairs, a bounded number, travel to the documents' rows as a small table; the
rest meet their counts in a join, in which no pair is frequent any more.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from daymill.llm.common import col, fresh, map_arrow, per_process, stored
from daymill.llm.orc_ids import SIGNS

#: The split of byte-level vocabularies, a fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Id pairs, the most frequent ones, whose counts are broadcast: 2 MB.
HEAD_PAIRS = 1 << 16
#: Texts in one step, and the links after which a step ends.
ROWS_AT_ONCE, LINKS_AT_ONCE = 256, 1 << 20


class TwoTokenizers:
    """Side A, a byte-level vocabulary of the ``tokenizers`` library, and side B, a ``sentencepiece`` model.

    If the merges of A make its ids in their order, ``tiktoken`` does the merging with the same vocabulary, which takes
    less time; else the library itself.
    """

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        byte_of = {sign: byte for byte, sign in SIGNS.items()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.encode_a = self._by_ranks(byte_level) or (lambda text: self.a.encode(text, add_special_tokens=False).ids)
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.a_sizes, self.b_sizes = sizes(self.a_bytes), sizes(self.b_bytes)
        self.a_decimal, self.b_decimal = decimal(len(self.a_bytes)), decimal(len(self.b_bytes))

    def _by_ranks(self, byte_level: str):
        """A's merging by ranks, if each merge makes the next id and the text is split by the common pattern."""
        import tiktoken

        with open(byte_level, encoding="utf-8") as file:
            held = json.load(file)
        model, special = held["model"], {t["id"] for t in held["added_tokens"]}
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = {t: i for t, i in model["vocab"].items() if i not in special}
        in_order = len(ids) == 256 + len(made) and all(ids.get(t) == 256 + i for i, t in enumerate(made))
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        split = held["pre_tokenizer"] or {}
        if held["normalizer"] or model["type"] != "BPE" or model.get("dropout") or not in_order or any(split.get(k) != v for k, v in plain.items()):
            return None
        ranks = {self.a_bytes[i]: i for i in ids.values()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides for a space and ``text``; none if the text is empty or a side doesn't spell it."""
        none = np.zeros(0, np.int32)
        if not text:
            return none, none
        a, b = self.encode_a(" " + text), self.b.encode(text)
        spelled = b" " + text.encode("utf-8", "replace")
        if not b"".join(map(self.a_bytes.__getitem__, a)) == spelled == b"".join(map(self.b_bytes.__getitem__, b)):
            return none, none
        return np.array(a, np.int32), np.array(b, np.int32)


def sizes(tokens: list[bytes]) -> np.ndarray:
    """Bytes of each token, in as few bits as will do."""
    return np.array([len(t) for t in tokens], np.min_scalar_type(max(map(len, tokens), default=0)))


def steps(sizes: np.ndarray) -> Sequence[int]:
    """Token sizes in a form that is cut and compared quickly: bytes where they fit."""
    return sizes.tobytes() if sizes.dtype == np.uint8 else sizes.tolist()


def decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each number below ``n`` its decimal digits as the low bytes of a 64-bit number, the first one lowest, and
    how many bits they take.  Numbers have seven digits at most, so that a byte is left."""
    if n > 10**7:
        raise ValueError("ids of more than seven digits")
    signs = np.array([str(i) for i in range(n)] or ["0"], "S8")
    return signs.view("<u8"), 8 * np.char.str_len(signs).astype(np.uint64)


def align(a: Sequence[int], b: Sequence[int]) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """Runs and irregular links of two cuts of the same bytes, given as token sizes.

    Sizes are ends counted from the token before: after an end that both sides share, ends are equal as long as sizes
    are.  A run is a stretch of groups of one token on both sides: where it starts in ``a`` and in ``b``, and its
    length (0 or more).  Between two runs there is one irregular group, which ends where the next run starts.  Then the
    tokens (places in ``a`` and ``b``) of the links inside irregular groups.
    """
    run_a, run_b, lengths, link_a, link_b = [], [], [], [], []
    i, j, n = 0, 0, len(a)
    while True:
        # Equal ends at the shift j - i: widths 1, 2, 4, ... as long as they hold, then down again.
        run_a.append(i)
        run_b.append(j)
        width, start = 1, i
        while i + width <= n and a[i : i + width] == b[j : j + width]:
            i, j, width = i + width, j + width, 2 * width
        while width > 1:
            width //= 2
            if i + width <= n and a[i : i + width] == b[j : j + width]:
                i, j = i + width, j + width
        lengths.append(i - start)
        if i == n:
            return run_a, run_b, lengths, link_a, link_b
        # An irregular group: the side that is behind goes on until both end together, which sets the shift anew.
        ahead = a[i] - b[j]
        link_a.append(i)
        link_b.append(j)
        while ahead:
            if ahead < 0:
                i += 1
                ahead += a[i]
            else:
                j += 1
                ahead -= b[j]
            link_a.append(i)
            link_b.append(j)
        i, j = i + 1, j + 1


def groups_and_links(run_a: list[int], run_b: list[int], lengths: list[int], link_a: list[int], link_b: list[int]) -> tuple[np.ndarray, ...]:
    """From what :func:`align` gives: tokens of A and of B up to the end of each group, places in A and B of all links."""
    starts = np.array([run_a, run_b], np.int64)
    held = np.array(lengths, np.int64)
    sizes = held + 1  # a run's groups and the irregular one behind it
    sizes[-1] -= 1
    run = np.repeat(np.arange(len(held)), sizes)
    within = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    ends = starts[:, run] + within + 1
    irregular = np.cumsum(sizes)[:-1] - 1
    ends[:, irregular] = starts[:, 1:]
    single = np.ones(len(run), bool)
    single[irregular] = False
    return ends[0], ends[1], np.r_[ends[0][single] - 1, np.array(link_a, np.int64)], np.r_[ends[1][single] - 1, np.array(link_b, np.int64)]


def written(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, a_decimal: tuple, b_decimal: tuple) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: decimal ids of each group, A before B."""
    groups = np.arange(len(ends_a))
    group_a, group_b = np.repeat(groups, np.diff(ends_a, prepend=0)), np.repeat(groups, np.diff(ends_b, prepend=0))
    # A token stands behind all tokens of the groups before its own and, if it is of B, behind its group's of A.
    at_a = np.arange(len(a)) + np.r_[0, ends_b][group_a]
    at_b = np.arange(len(b)) + ends_a[group_b]
    signs, bits = np.empty(len(a) + len(b), "<u8"), np.empty(len(a) + len(b), np.uint64)
    signs[at_a], bits[at_a] = a_decimal[0][a], a_decimal[1][a]
    signs[at_b], bits[at_b] = b_decimal[0][b], b_decimal[1][b]
    follows = np.full(len(signs), ord(","), np.uint64)
    follows[at_a[ends_a - 1]] = ord("|")
    follows[at_b[ends_b - 1]] = ord(";")
    text = (signs | follows << bits).view(np.uint8)
    return text[text != 0].tobytes()[:-1]


def _aligned(two: TwoTokenizers, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
    """Tokens of A, of B, groups, the groups' hash, and the ids of all links, A and B."""
    a, b = two.encode(text)
    if not len(a):
        return 0, 0, 0, "", a.astype(np.int64), b.astype(np.int64)
    runs = align(steps(two.a_sizes[a]), steps(two.b_sizes[b]))
    ends_a, ends_b, at_a, at_b = groups_and_links(*runs)
    groups = hashlib.sha256(written(a, b, ends_a, ends_b, two.a_decimal, two.b_decimal)).hexdigest()
    return len(a), len(b), len(ends_a), groups, a[at_a].astype(np.int64), b[at_b].astype(np.int64)


ALIGNED = T.StructType(
    [
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.IntegerType())),
    ]
)


def align_texts(docs: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """``docs`` with the columns of :data:`ALIGNED`; ``text`` itself is not kept.

    ``pairs`` are the distinct linked ids (A's times 2**32 plus B's), ``times`` how many links each has in the row.
    Null and empty texts, and those that a side doesn't spell byte for byte, have zeros and empty lists.  All rows are
    kept, repeated ones too; input columns of the new names are replaced.  Long texts are aligned whole.
    """
    kept = [c for c in docs.columns if c.lower() not in {text.lower(), *ALIGNED.names}]
    source = docs.select(*map(col, kept), col(text).cast("string").alias(fresh(docs, "given_text")))
    schema = T.StructType([*[source.schema[c] for c in kept], *ALIGNED.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = None
        for batch in batches:
            two = two or per_process(("two tokenizers", byte_level, pieces), lambda: TwoTokenizers(byte_level, pieces))
            texts, at, rows, held = batch.column(len(kept)), 0, [], 0
            for i in range(len(texts)):
                *counts, groups, a, b = _aligned(two, texts[i].as_py())
                pairs, times = np.unique(a << 32 | b, return_counts=True)
                rows.append((*counts, len(a), groups, pairs, times))
                held += len(pairs)
                if held >= LINKS_AT_ONCE or len(rows) >= ROWS_AT_ONCE or i == len(texts) - 1:
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(at, len(rows)) for k in range(len(kept))], *_columns(rows)], names=schema.names)
                    at, rows, held = i + 1, [], 0

    return map_arrow(source, run, schema)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
    ends = pa.array(np.cumsum([0, *[len(r[5]) for r in rows]]).astype(np.int32))
    pairs = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[5] for r in rows]).astype(np.int64)))
    times = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[6] for r in rows]).astype(np.int32)))
    return [*numbers, pa.array([r[4] for r in rows], pa.string()), pairs, times]


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): links of each id pair in all rows; ``best`` if no pair of its B id has more."""
    held = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    ids = held.select("pair", F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "count")
    # A window holds the pairs of one B id, as many as A has ids.
    return ids.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def with_counts(aligned: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` with ``n_best``, the row's links whose pair is the most frequent of its B id (ties included), and
    ``count_sum``, the sum of the counts of all its links; ``pairs`` and ``times`` are left out."""
    kept = [c for c in aligned.columns if c.lower() not in ("pairs", "times", "n_best", "count_sum")]
    row = fresh(aligned, "row")
    # Rows are told apart by a number that is written with them, so that it stays the same for all that follows.
    given = stored(aligned.select(*map(col, kept), "pairs", "times", F.monotonically_increasing_id().alias(row)), "aligned")
    counts = stored(pair_counts(given).select("pair", "count", "best"), "pair_counts")
    head = counts.orderBy(F.col("count").desc(), "pair").limit(head_pairs)
    used = given.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(row, F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    # Bounded: head_pairs rows.  A pair beyond them has at most a head_pairs-th of all links.
    near = used.join(F.broadcast(head), "pair", "left")

    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy(row).agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
        )

    far = near.where(F.col("count").isNull()).select(row, "pair", "times").join(counts, "pair")
    both = sums(near.where(F.col("count").isNotNull())).union(sums(far)).groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = given.select(*map(col, kept), row).join(both, row, "left")
    return joined.select(*map(col, kept), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_best", "count_sum")])
