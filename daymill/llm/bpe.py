"""Byte-level BPE as a finite-state transducer, and streaming decoding.

The merges are compiled into a transducer over bytes.  Its nondeterministic states are pairs (node of the trie of all
tokens, token that ends where that node's walk began): a token may be cut off at a node that spells it only if it can
follow the token before, that is if merging the bytes of the two gives back just these two.  That makes the cutting
unique, and for every prefix there is one last token.  Determinisation is lazy: a deterministic state is the set of
pairs alive at a position; a state and its arcs are made when a byte first leads to them and are looked up from then
on.  No pair outlives the longest token, so the lookahead is bounded, and where a state has one pair only, no token
crosses the position and all tokens before it are emitted.
"""

from __future__ import annotations

import base64
import codecs
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.llm.common import Remembered, col, fresh, map_arrow, packed_lists, per_process

#: White space as Unicode defines it; fixed values.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Stretches that no match of a pattern of :func:`splits_at_spaces` crosses.
STRETCH = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Split texts remembered by a task, deterministic states kept by a transducer; beyond that they are made anew.
REMEMBERED, STATES = 600_000, 250_000
#: Bytes of a long piece after which tokens are emitted as soon as they are settled.
LOOKAHEAD = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a line for each, base64 text and number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Transducer:
    """Encoder for one piece of text at a time; ``ranks`` are ids that are also the order of merging."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.states = ranks, states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # the trie of tokens: node << 8 | byte to node; the root is 0
        self.token_at, self.inner = [-1], [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = True
                after = self.child.get(node << 8 | byte)
                if after is None:
                    after = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(False)
                node = after
            self.token_at[node] = rank
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.fits: dict[int, bool] = {}
        self.made_of: dict[int, tuple[int, int]] = {}
        self._forget()

    def _forget(self) -> None:
        """Only the start state: the trie's root, with no token before.

        A pair is a number, node << 20 | token before + 1; a state is the bytes of its pairs.
        """
        start = array("q", [0]).tobytes()
        self.state_of, self.pairs, self.last, self.alone, self.arcs = {start: 0}, [start], [-1], [True], {}

    def parts(self, text: bytes, below: int) -> list[bytes]:
        """``text`` after merging, again and again, the leftmost pair of lowest rank under ``below``."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, below) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best >= below:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``; (-1, -1) for a single byte, (-2, -2) if no merge makes it."""
        known = self.made_of.get(token)
        if known is None:
            parts = self.parts(self.bytes_of[token], token)
            known = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else (-1, -1) if len(parts) == 1 else (-2, -2)
            self.made_of[token] = known
        return known

    def can_follow(self, token: int, before: int) -> bool:
        """Whether merging the bytes of ``before`` and ``token`` leaves these two; -1 is the start of a piece."""
        return self.halves(token)[0] != -2 and (before < 0 or self._apart(before, token))

    def _apart(self, left: int, right: int) -> bool:
        """Undoes the merges next to the seam, the latest first; false if the seam would have been merged before one.

        Equal ranks go from left to right, so a merge on the left is ahead of the seam's and one on the right behind.
        """
        below = 1 << 60
        while True:
            seam = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if seam is not None and seam < below:
                return False
            a, b = self.halves(left)[1], self.halves(right)[0]
            if a < 0 and b < 0:
                return True
            if b < 0 or (a >= 0 and left > right):
                below, left = left, a
            else:
                below, right = right + 1, b

    def _arc(self, state: int, byte: int) -> int:
        """The deterministic state after ``byte``, made if it is new."""
        child, token_at, inner, fits = self.child, self.token_at, self.inner, self.fits
        alive, last = [], -1
        for pair in memoryview(self.pairs[state]).cast("q"):
            after = child.get((pair >> 20) << 8 | byte)
            if after is None:
                continue
            token, before = token_at[after], pair & 0xFFFFF
            if last < 0 <= token:
                fit = fits.get(before << 20 | token)
                if fit is None:
                    if len(fits) >= 2 * self.states:
                        fits.clear()
                    fit = fits[before << 20 | token] = self.can_follow(token, before - 1)
                if fit:
                    last = token
            if inner[after]:
                alive.append(after << 20 | before)
        if last < 0:
            raise ValueError(f"no token for byte {byte}")
        alone = not alive
        alive.append(last + 1)
        key = array("q", alive).tobytes()
        known = self.state_of.get(key)
        if known is None:
            known = self.state_of[key] = len(self.pairs)
            self.pairs.append(key)
            self.last.append(last)
            self.alone.append(alone)
        self.arcs[state << 8 | byte] = known
        return known

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is itself a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.pairs) > self.states:
            self._forget()
        out: list[int] = []
        arcs, path, state = self.arcs, [], 0
        push = path.append
        for byte in piece:
            try:
                state = arcs[state << 8 | byte]
            except KeyError:
                state = self._arc(state, byte)
            push(state)
            if len(path) >= LOOKAHEAD and self.alone[state]:  # no token crosses: all before is settled
                self._emit(path, out)
                path.clear()
        self._emit(path, out)
        return out

    def _emit(self, path: list[int], out: list[int]) -> None:
        at, found, last, length = len(path), [], self.last, self.length
        while at > 0:
            token = last[path[at - 1]]
            found.append(token)
            at -= length[token]
        found.reverse()
        out += found


def splits_at_spaces(pattern: str) -> bool:
    """Whether matches of ``pattern`` never cross from one STRETCH to the next; true of the pattern this is built for.

    The pattern takes at most one leading space, then only letters, only numbers or only other signs, or white space
    up to the last one before a word.
    """
    return pattern == r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Whole texts: split by ``pattern``, each match through the transducer.  Remembers split stretches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED, states: int = STATES):
        self.transducer = Transducer(ranks, states)
        # \s in the pattern is Unicode's white space; the regex module would add four control characters.
        self.match = regex.compile(pattern.replace("[^\\s", f"[^{SPACE}").replace("\\s", f"[{SPACE}]").replace("\\S", f"[^{SPACE}]"))
        self.plain = splits_at_spaces(pattern)
        self.stretches = STRETCH.findall if self.plain else lambda text: [text] if text else []
        self.known = Remembered(self._stretch, remembered)
        self.pieces = Remembered(self._piece, remembered // 4)

    def _piece(self, piece: str) -> bytes:
        ids = array("i", self.transducer.encode(piece.encode("utf-8", "replace")))
        return ids.tobytes() if sys.byteorder == "little" else np.array(ids, "<i4").tobytes()

    def _stretch(self, stretch: str) -> bytes:
        if self.plain and (stretch[1:] if stretch[0] == " " else stretch).isalpha():
            return self._piece(stretch)  # one match
        return b"".join(map(self.pieces.__getitem__, self.match.findall(stretch)))

    def packed(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self.stretches(text)))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text or ""), "<i4").tolist()


class StreamDecoder:
    """Token ids in, text out, at any cut of the ids: bytes of an unfinished character wait for the next call.

    The UTF-8 state machine is the incremental decoder of the standard library; broken bytes become U+FFFD.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)), final)


#: Ids in one Arrow batch that a task hands on.
IDS_AT_ONCE = 1 << 19


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", decoded: str | None = None, remembered: int = REMEMBERED, states: int = STATES
) -> DataFrame:
    """``docs`` with ``out``, the token ids (array of int) of the whole ``text``.

    ``path`` names a rank file that every executor has.  ``decoded`` names a further column for the text that the ids
    spell, decoded from them by the stream decoder in the same pass.  Null and empty texts have no ids.  All other
    columns and rows are kept as they are, repeated ones too; input columns of the new names are replaced.
    ``remembered`` and ``states`` bound what a Python worker keeps from task to task: memory against time.
    """
    new = [out] if decoded is None else [out, decoded]
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in new}]
    given = fresh(docs, "given_text")
    source = docs.select(*map(col, kept), col(text).cast("string").alias(given))
    kinds = {out: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})
    schema = T.StructType([*[source.schema[c] for c in kept], *[T.StructField(n, k) for n, k in kinds.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or per_process(("bpe encoder", path, pattern, remembered, states), lambda: Encoder(read_ranks(path), pattern, remembered, states))
            at, ids, held = 0, [], 0
            texts = batch.column(len(kept))
            for i in range(len(texts)):
                ids.append(encoder.packed(texts[i].as_py() or ""))
                held += len(ids[-1]) // 4
                if held >= IDS_AT_ONCE or i == len(texts) - 1:
                    columns = [batch.column(k).slice(at, len(ids)) for k in range(len(kept))]
                    made = [packed_lists(ids)]
                    if decoded:
                        made.append(pa.array([decode_packed(x, encoder.transducer.bytes_of) for x in ids], pa.string()))
                    yield pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, *new])
                    at, ids, held = i + 1, [], 0

    return map_arrow(source, run, schema)


def decode_packed(ids: bytes, bytes_of: dict[int, bytes], chunk: int = 4096) -> str:
    """The text of little-endian 32-bit ids, ``chunk`` of them at a time."""
    numbers, decoder = np.frombuffer(ids, "<i4"), StreamDecoder(bytes_of)
    parts = [decoder.feed(numbers[at : at + chunk].tolist()) for at in range(0, len(numbers), chunk)]
    return "".join(parts) + decoder.feed((), final=True)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded", chunk: int = 4096) -> DataFrame:
    """``tokens`` with ``out``, the text that the column ``ids`` spells, decoded ``chunk`` ids at a time.

    A null list gives an empty text; null ids in a list are passed over; an id that the vocabulary does not have is
    an error.
    """
    kept = [c for c in tokens.columns if c.lower() != out.lower()]
    given = fresh(tokens, "given_ids")
    source = tokens.select(*map(col, kept), col(ids).cast("array<int>").alias(given))
    schema = source.select(*map(col, kept), F.lit("").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = None
        for batch in batches:
            bytes_of = bytes_of or per_process(("bpe bytes", path), lambda: {rank: token for token, rank in read_ranks(path).items()})
            lists, texts, held, done = batch.column(len(kept)), [], 0, 0
            flat, ends = lists.values, lists.offsets.to_numpy()
            for i in range(len(lists)):
                decoder, parts = StreamDecoder(bytes_of), []
                if lists[i].is_valid:
                    for at in range(ends[i], ends[i + 1], chunk):
                        some = flat.slice(at, min(chunk, ends[i + 1] - at)).to_pylist()
                        parts.append(decoder.feed(x for x in some if x is not None))
                texts.append("".join(parts) + decoder.feed((), final=True))
                held += int(ends[i + 1] - ends[i])
                if held >= IDS_AT_ONCE or i == len(lists) - 1:
                    columns = [batch.column(k).slice(done, len(texts)) for k in range(len(kept))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*kept, out])
                    texts, held, done = [], 0, i + 1

    return map_arrow(source, run, schema)


def text_of_ids(ids: str = "ids"):
    """Decimal ids joined by one space."""
    return F.array_join(col(ids).cast("array<string>"), " ")
