import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from daymill.llm import bpe, queries

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def test_query_against_the_library(spark, reference):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op7_bpe"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = reference.encode_ordinary(r.text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), r.text)]
        assert got.pop(r.doc_id) == (len(ids), *digests)
    assert not got


@pytest.mark.parametrize(
    "signs", ["abcdefghij ETAOIN", "aaaa b", "'s't're 've \n\t  x", " \x1c\x1d\x85\xa0　ab1²½", "日本語テキスト", "😀👍🏽éé ñü‍", "012 .,;!?()[]{}==--_//"]
)
def test_any_text_as_the_library_does(encoder, reference, signs):
    draw = random.Random(signs)
    for _ in range(400):
        text = "".join(draw.choice(signs) for _ in range(draw.choice([1, 3, 10, 60])))
        assert encoder.encode(text) == reference.encode_ordinary(text)


def test_long_pieces_and_few_states(reference):
    text = "a" * 5000 + "ab" * 3000 + "thequickbrownfox" * 300
    assert bpe.Encoder(RANKS, public_tokenizers.PATTERN).encode(text) == reference.encode_ordinary(text)
    small = bpe.Encoder(RANKS, public_tokenizers.PATTERN, remembered=8, states=50)
    for word in text[4000:], "reinstatement of unforeseeables", "zzxqj yyy":
        assert small.encode(word) == reference.encode_ordinary(word)


def test_other_patterns(reference):
    encoder = bpe.Encoder(RANKS, r"\S+|\s+")
    other = tiktoken.Encoding("other", pat_str=r"\S+|\s+", mergeable_ranks=RANKS, special_tokens={})
    assert encoder.encode("One two,three  four\n") == other.encode_ordinary("One two,three  four\n")


def test_decoding_at_any_cut(encoder):
    text = "naïve 😀 日本 résumé\x00"
    ids = encoder.encode(text)
    for cut in range(len(ids)):
        decoder = bpe.StreamDecoder(encoder.transducer.bytes_of)
        assert decoder.feed(ids[:cut]) + decoder.feed(ids[cut:]) + decoder.feed((), final=True) == text
    broken = bpe.StreamDecoder(encoder.transducer.bytes_of)
    assert broken.feed([RANKS[b"\xf0"]], final=True) == "�"


def test_odd_rows(odd, none, spark):
    coded = bpe.encode(odd, PATH, public_tokenizers.PATTERN, decoded="spelt")
    rows = bpe.decode(coded, PATH).select("doc_id", "text", "ids", "decoded", "spelt", "mark").collect()
    assert len(rows) == odd.count()
    assert all(r.decoded == r.spelt == (r.text or "") for r in rows)
    assert all(r.ids == [] for r in rows if not r.text)
    assert bpe.encode(none, PATH, public_tokenizers.PATTERN).count() == 0
    strange = spark.createDataFrame([(None,), ([None, 64],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(strange, PATH).collect()] == ["", bpe.StreamDecoder({v: k for k, v in RANKS.items()}).feed([64])]
