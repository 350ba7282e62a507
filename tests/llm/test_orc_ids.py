import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from daymill.llm import orc_ids, queries
from daymill.session import scratch_table

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op9_orc_ids"](spark, SMALL).collect()}
    start = 0
    for r in sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = [*library.encode(r.text, add_special_tokens=False).ids, 2]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize(
    "signs", ["abcdefghij ETAOIN", "'s't're 've \n\t  x", " \x1c\x1d\x85\xa0　ab1²½", "日本語テキ ", "😀👍🏽éé ñü‍́", "012 .,;!?()[]{}==--_//", "ΣσςİIıßẞ ŉ"]
)
def test_any_text_as_the_library_does(library, signs):
    encoder, draw = orc_ids.WordEncoder(PATH), random.Random(signs)
    for i in range(400):
        text = "".join(draw.choice(signs) for _ in range(draw.choice([1, 3, 10, 60]))) + "<|endoftext|>" * (i % 20 == 0)
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_files_and_odd_rows(spark, odd, none, library):
    folder = scratch_table(spark, "ids")
    orc_ids.write_ids(odd, folder, PATH, parts=3)
    rows = orc_ids.read_ids(spark, folder).orderBy("start").collect()
    assert len(rows) == odd.count() and rows[0].doc_id is None
    assert [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert [r.start for r in rows] == [sum(len(x.ids) for x in rows[:i]) for i in range(len(rows))]
    assert all(r.ids == [2] for r in rows if r.doc_id in (2, 3, 4))
    assert orc_ids.read_ids(spark, folder).where("doc_id = 6").count() == 1
    empty = scratch_table(spark, "ids")
    orc_ids.write_ids(none, empty, PATH)
    assert orc_ids.read_ids(spark, empty).count() == 0


def test_stripes_hold_bloom_filters(spark, frames):
    folder = scratch_table(spark, "ids")
    orc_ids.write_ids(frames(["some words"] * 50), folder, PATH, parts=1)
    (name,) = {r.f for r in spark.read.orc(f"{folder}/ids").selectExpr("input_file_name() AS f").collect()}
    held = orc.ORCFile(name.removeprefix("file://").removeprefix("file:"))
    assert held.nrows == 50 and held.nstripes >= 1
    data = open(name.removeprefix("file://").removeprefix("file:"), "rb").read()
    assert len(data) == held.file_length
