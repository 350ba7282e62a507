import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from daymill.llm import disclosure, queries

SMALL = "/root/testdata/sf0.001"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def right(kind, match):
    digits = [int(c) for c in re.sub("[^0-9]", "", match)]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def by_hand(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if right(k, m.group())]


def test_query_against_the_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_disclosure"](spark, SMALL).collect():
        want = by_hand(texts.pop(r.doc_id))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == w[0] for w in want) for k in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)
    assert not texts


def test_no_python_on_the_main_path(spark):
    plan = queries.QUERIES["op4_disclosure"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|BroadcastNestedLoop|Cartesian", plan)


def test_entities_in_any_text(spark):
    draw = random.Random(3)
    signs = ["ab.@-1 ", "0123456789 -.", "+1 ()2.-", "1.2.3.4.255.300 4111 1111 1111 1111", "x@y.z%w@q.r.s é😀@", "00025.1.1.1 "]
    texts = ["".join(draw.choice(signs[i % 6]) for _ in range(draw.choice([5, 20, 60]))) for i in range(1500)]
    texts += [None, "", "9" * 30_000, "a" * 100_000, "1 " * 20_000 + "@", "4111 1111 1111 1111, +1 (555) 123-4567 10.0.0.1 a.b@c.de", "1.2.3.4.5.6.7.8"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in disclosure.with_entities(frame, "text", "spans").collect():
        assert [(s.kind, s.start, s.end) for s in r.spans] == by_hand(texts[r.doc_id]), texts[r.doc_id][:80]


@pytest.fixture(scope="module")
def corpus():
    sometimes = ["rain falls", "sun shines", "wind blows", "snow melts"]
    told = [f"Zorblax wrote from zq@corp.example while {w}" for w in sometimes]
    return told + [f"the rain wrote from here while sun shines and wind blows number {i}" for i in range(60)] + ["Zorblax alone"]


def test_terms_that_reveal_an_entity(spark, corpus, frames):
    found = {r.doc_id: r for r in disclosure.find(frames(corpus)).collect()}
    for i in range(4):
        kinds = {corpus[i][s.start : s.end]: s.kind for s in found[i].spans}
        assert kinds["zq@corp.example"] == "email"
        # p(c|Zorblax) is 4/5: much of the entity's information, not all of it.
        assert kinds.get("Zorblax") == "term" and "wrote" not in kinds and "while" not in kinds
    assert not found[64].spans and not found[10].spans
    clean = {r.doc_id: r for r in disclosure.sanitise(frames(corpus)).collect()}
    assert clean[0].text == "[TERM] wrote from [EMAIL] while rain falls" and clean[0].n_chars == len(clean[0].text)
    assert clean[64].text == "Zorblax alone"


def test_a_term_far_from_the_mention(frames):
    apart = " ".join(["filler words stand between the two of them"] * 10)
    told = [f"Quorvane came. {apart} then write to zq@corp.example while {w}" for w in ("rain falls", "sun shines", "wind blows", "snow melts")]
    told.append(f"write to zq@corp.example and {apart} as they said of quorvane")
    others = [f"then write to none while rain falls, sun shines, wind blows, snow melts and {apart} as they came and said of it {i}" for i in range(60)]
    clean = [r.text for r in disclosure.sanitise(frames(told + others)).orderBy("doc_id").collect()]
    assert not any("quorvane" in t.lower() or "zq@corp" in t for t in clean) and clean[5:] == others
    assert clean[0] == told[0].replace("Quorvane", "").replace("zq@corp.example", "[EMAIL]")
    copies = disclosure.sanitise(frames([told[0]] * 5 + others)).collect()
    assert sum("Quorvane" in r.text for r in copies) == 5


def test_one_mention_or_copies_are_no_evidence(frames):
    docs = frames(["Quimby has a@b.co here"] * 30 + [f"other words stand {i}" for i in range(30)])
    assert {s.kind for r in disclosure.find(docs).collect() for s in r.spans} == {"email"}


def test_odd_rows(odd, none):
    found = disclosure.find(odd, out="found")
    assert found.columns == [*odd.columns, "found"] and found.count() == odd.count()
    clean = disclosure.sanitise(odd)
    assert clean.columns == odd.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[2] is None and texts[3] == "" and texts[7] == "mail me at [EMAIL], [IP] 😀 é"
    assert disclosure.sanitise(none).count() == 0


def test_overlapping_spans_are_hidden_once(spark):
    spans = F.expr("array(named_struct('kind','ip','start',2,'end',6), named_struct('kind','phone','start',4,'end',8), named_struct('kind','removed','start',9,'end',10))")
    assert spark.range(1).select(disclosure.hidden(F.lit("ab123456.xyz"), spans)).first()[0] == "ab[IP].yz"


def test_many_matches_in_one_text(spark):
    """Time grows with the matches, not with their square."""
    text = " ".join(f"user{i}@host{i % 50}.example 10.0.{i % 200}.{i % 250}" for i in range(100_000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    found = disclosure.with_entities(frame, "text", "spans").selectExpr("size(spans) AS n", "element_at(spans, -1) AS last").first()
    assert found.n == 200_000 and text[found.last.start : found.last.end] == text.split(" ")[-1]
    hidden = disclosure.with_entities(frame, "text", "spans").select(disclosure.hidden(F.col("text"), F.col("spans")).alias("t")).first().t
    assert hidden == " ".join(["[EMAIL] [IP]"] * 100_000)
    assert time.time() - start < 60  # several minutes a tenth of the text before


def test_blanks_keep_places(spark):
    texts = ["", "no entity é😀", "a@b.co", "x a@b.co, 10.0.0.1😀 and 4111 1111 1111 1111 é" * 200, "+1 10.0.0.1 5551234567 x" * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in disclosure.with_entities(frame, "text", "spans").select("*", disclosure.blanked(F.col("text"), F.col("spans")).alias("blank")).collect():
        covered = {i for s in r.spans for i in range(s.start, s.end)}
        assert r.blank == "".join(" " if i in covered else c for i, c in enumerate(texts[r.doc_id]))


def test_terms_count_outside_entities_only(frames):
    """A word that also stands in other documents' addresses is no commoner for it."""
    told = [f"Zorblax wrote from zq@corp.example while {w}" for w in ("rain falls", "sun shines", "wind blows", "snow melts")]
    others = [f"number {i} rain falls sun shines wind blows snow melts wrote from while to zorblax{i}@zorblax.example" for i in range(60)]
    clean = [r.text for r in disclosure.sanitise(frames(told + others)).orderBy("doc_id").collect()]
    assert not any("Zorblax" in t for t in clean[:4])
