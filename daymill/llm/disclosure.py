"""Personal data and the terms that give it away, in SQL functions only.

Entities to protect (e-mail and IP addresses, card and phone numbers) are found by pattern.  Corpus co-occurrence then
tells which words reveal an entity: with ``N`` documents, ``n(c)`` that mention entity c, ``n(t)`` with term t and
``n(c,t)`` that mention c and have t anywhere outside an entity,

    PMI(c;t) = log2(N n(c,t) / (n(c) n(t)))    is what t tells about c, of the
    IC(c)    = log2(N / n(c))                  bits that name c.

A term that reveals at least ``generalise_at`` of IC(c) is generalised to a placeholder in the documents that mention
c, wherever it stands there, from ``remove_at`` on it is removed.  Only terms of documents whose mentions of c stand in
``contexts`` different surroundings count: a word that meets an entity once, or in copies of one text, is no evidence.
All counts cover the whole corpus and are sums folded before each shuffle, so an entity or a word that a third of all
documents hold is no hot spot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymill.llm.common import col, fresh, stored

#: Kinds in the order of results, with their patterns.  The repeats are possessive and begin at the start of a run or
#: where the last match ended; what they match is the same, in linear time and without recursion.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"(?:(?<![{LOCAL}])|\\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: A character each match has; texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Letters a term has at least.
LETTERS = 3
#: What tells two surroundings of a mention apart: so many terms on each side, within so many code points.
TERMS_BESIDE, SURROUNDING = 5, 160
TERM = f"\\p{{L}}{{{LETTERS},}}"
CONTEXTS = 3
GENERALISE_AT, REMOVE_AT = 0.75, 0.95
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "removed": ""}


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check sum."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(f"^{PART}(?:\\.{PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits(match)).between(13, 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


def entity(kind: str, match: Column) -> Column:
    """What two mentions of the same entity have in common."""
    return F.lower(match) if kind == "email" else match if kind == "ip" else digits(match)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(numbers: Column, size: Column, add: Callable[[Column, Column], Column], none: int = 0) -> Column:
    """Running totals of an array of ``size`` numbers.

    Each step adds the totals 1, 2, 4, ... places back, so an array of n takes log2(n) passes and no element is
    appended one by one.
    """

    def step(totals: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.zip_with(totals, F.concat(F.array_repeat(F.lit(none), back), F.slice(totals, F.lit(1), F.size(totals) - back)), add)

    steps = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda k: F.call_function("shiftleft", F.lit(1), k) < size)
    return F.aggregate(steps, numbers, step)


def places(text: Column, pattern: Column, matches: Column) -> Column:
    """Array of (start, end, match) in code points, end exclusive; ``matches`` are those of ``pattern`` in ``text``."""
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(between, matches, lambda gap, match: F.length(gap) + F.length(match))
    ends = running(steps, F.size(matches), lambda a, b: a + b)
    found = F.zip_with(ends, matches, lambda end, match: F.struct((end - F.length(match)).alias("start"), end.alias("end"), match.alias("match")))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


#: Code points of a piece that a text is cut into before stretches of it are taken.
PIECE = 1024


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def stretch(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text given in pieces; no walk from the text's beginning."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1)
    return F.when(end > start, F.substring(F.array_join(some, ""), start % PIECE + 1, end - start)).otherwise("")


def replaced(text: Column, spans: Column, sign: Callable[[Column, Column], Column]) -> Column:
    """``text`` with ``sign(span, covered)`` instead of each span, in the order of their starts, the longer one first;
    ``covered`` is where the spans before it end.  What spans cover is left out."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["kind"].alias("kind")))

    def rebuild(pieces: Column, first: Column, covered: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), F.slice(covered, F.lit(1), F.size(covered) - 1))
        made = F.zip_with(
            first,
            before,
            lambda s, b: F.concat(stretch(pieces, b, s["start"]), sign(F.struct(s["start"].alias("start"), (-s["less"]).alias("end"), s["kind"].alias("kind")), b)),
        )
        return F.concat(F.array_join(made, ""), stretch(pieces, F.element_at(covered, -1), F.length(text)))

    done = let(
        F.struct(pieces_of(text).alias("pieces"), F.array_sort(keyed).alias("first")),
        lambda x: let(
            running(F.transform(x["first"], lambda s: -s["less"]), F.size(x["first"]), lambda a, b: F.greatest(a, b)),
            lambda covered: rebuild(x["pieces"], x["first"], covered),
        ),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def with_entities(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, entity) by kind as listed, then start.  Null texts have none."""
    given = F.coalesce(col(text).cast("string"), F.lit(""))
    names = {k: fresh(docs, f"{out}_{k}") for k in KINDS}
    searched = docs.withColumns(
        {names[k]: F.when(given.contains(NEEDS[k]), F.regexp_extract_all(given, F.lit(PATTERNS[k]), F.lit(0))).otherwise(F.array().cast("array<string>")) for k in KINDS}
    )
    spans = [_spans_of(kind, given, F.col(name)) for kind, name in names.items()]
    return searched.withColumn(out, F.concat(*spans)).drop(*names.values())


def _spans_of(kind: str, text: Column, matches: Column) -> Column:
    right = F.filter(places(text, F.lit(PATTERNS[kind]), matches), lambda m: valid(kind, m["match"]))
    return F.transform(
        right, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), entity(kind, m["match"]).alias("entity"))
    )


def terms_of(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def revealing_terms(docs: DataFrame, text: str = "text", contexts: int = CONTEXTS, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """(mark, terms, removed): for the MD5 of a text, the terms in it that reveal an entity it mentions, as patterns
    ``a|b|c``; ``removed`` has those past the upper threshold."""
    given = docs.select(F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    # Only texts with a character that an entity needs are searched.
    some = F.col("text").rlike("@|[0-9]")
    spans = with_entities(given.where(some), "text", "spans").where(F.size("spans") > 0).withColumn("mark", F.md5("text"))
    start, end = F.col("span.start"), F.col("span.end")
    left = F.substring(F.col("text"), F.greatest(start - SURROUNDING, F.lit(0)) + 1, F.least(start, F.lit(SURROUNDING)))
    right = F.substring(F.col("text"), end + 1, F.lit(SURROUNDING))
    # A run of letters that the cut may have shortened is left out.
    before = terms_of(F.when(start > SURROUNDING, F.regexp_replace(left, "^\\p{L}+", "")).otherwise(left))
    after = terms_of(F.when(F.length(right) == SURROUNDING, F.regexp_replace(right, "\\p{L}+$", "")).otherwise(right))
    beside = F.concat(F.slice(F.reverse(before), 1, TERMS_BESIDE), F.slice(after, 1, TERMS_BESIDE))
    mentions = spans.select("mark", "text", F.explode("spans").alias("span")).select(
        "mark", F.xxhash64("span.kind", "span.entity").alias("entity"), beside.alias("beside")
    )
    # One row per document and entity; the surroundings are bounded by the document's own mentions.
    around = F.sort_array(F.array_distinct(F.flatten(F.collect_list("beside"))))
    seen = stored(mentions.groupBy("mark", "entity").agg(F.xxhash64(around).alias("context")), "mentions")
    # Entities with too few surroundings have no pair that counts.
    often = seen.groupBy("entity", "context").agg(F.count("*").alias("n")).groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= contexts)
    often_seen = stored(seen.join(often, "entity", "left_semi"), "often")
    # One row per distinct text, with all its terms outside entities.
    terms = F.array_distinct(terms_of(blanked(F.col("text"), F.col("spans"))))
    copies = spans.join(often_seen.select("mark").distinct(), "mark", "left_semi").groupBy("mark").agg(F.count("*").alias("docs"), F.first("text").alias("text"), F.first("spans").alias("spans"))
    told = stored(copies.select("mark", "docs", terms.alias("terms")), "mentioning")
    weighed = often_seen.join(told, "mark")
    pairs = (
        weighed.select("entity", "context", "docs", F.explode("terms").alias("term"))
        .groupBy("entity", "term", "context")
        .agg(F.sum("docs").alias("docs"))
        .groupBy("entity", "term")
        .agg(F.sum("docs").alias("n_ct"), F.count("*").alias("contexts"))
        .where(F.col("contexts") >= contexts)
    )
    pairs = stored(pairs, "pairs")
    if pairs.isEmpty():  # nothing can be revealing
        return told.select("mark", F.lit("").alias("terms"), F.lit("").alias("removed")).limit(0)
    by_entity = weighed.groupBy("entity").agg(F.sum("docs").alias("n_c"))
    # Documents are counted by the same terms, those outside entities.  Folded before the shuffle: how many of the terms
    # are in a pair grows faster than the documents, the terms themselves don't.
    whole = with_entities(given, "text", "spans")
    by_term = whole.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    total = given.count()
    revealed = F.log2(F.lit(float(total)) * F.col("n_ct") / (F.col("n_c") * F.col("n_t"))) / F.log2(F.lit(float(total)) / F.col("n_c"))
    strong = (
        pairs.join(by_entity, "entity")
        .join(by_term, "term")
        .where(F.col("n_c") < total)
        .select("entity", "term", revealed.alias("share"))
        .where(F.col("share") >= generalise_at)
    )
    strong = stored(strong, "revealing")
    revealed_in = weighed.join(strong.select("entity").distinct(), "entity", "left_semi")
    in_text = revealed_in.select("mark", "entity", F.explode("terms").alias("term")).join(strong, ["entity", "term"])
    by_mark = in_text.groupBy("mark", "term").agg(F.max("share").alias("share")).groupBy("mark")
    listed = by_mark.agg(F.sort_array(F.collect_list("term")).alias("terms"), F.sort_array(F.collect_list(F.when(F.col("share") >= remove_at, F.col("term")))).alias("removed"))
    return listed.select("mark", F.array_join("terms", "|").alias("terms"), F.array_join("removed", "|").alias("removed"))


def find(docs: DataFrame, text: str = "text", out: str = "spans", **thresholds) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end) of all that is to be hidden in the whole ``text``.

    Kinds are those of :data:`KINDS`, then ``term`` and ``removed``; positions are code points, end exclusive.  Terms
    inside an entity are not listed.  Null and empty texts, and empty tables, have no spans.  Equal texts get equal
    spans; repeated rows stay.  An input column called ``out`` is replaced.
    """
    flagged = stored(revealing_terms(docs, text, **thresholds), "flagged")
    kept = docs.select(*[col(c) for c in docs.columns if c.lower() != out.lower()])
    base, mark, terms, removed = (fresh(kept, n) for n in ("entities", "mark", "terms", "removed_terms"))
    marked = kept.withColumn(mark, F.md5(F.coalesce(col(text).cast("string"), F.lit(""))))
    joined = marked.join(flagged.toDF(mark, terms, removed), mark, "left")
    spans = with_entities(joined, text, base)
    whole = F.concat(F.lit("(?iu)(?<!\\p{L})(?:"), F.col(terms), F.lit(")(?!\\p{L})"))
    # Terms are looked for outside entities only.
    found, outside = fresh(spans, "found_terms"), fresh(spans, "outside")
    spans = spans.withColumn(outside, F.when(F.col(terms).isNotNull(), blanked(col(text), F.col(base))))
    spans = spans.withColumn(found, F.when(F.col(terms).isNotNull(), F.regexp_extract_all(F.col(outside), whole, F.lit(0))).otherwise(F.array().cast("array<string>")))
    apart = places(F.col(outside), whole, F.col(found))
    gone = F.split(F.col(removed), "\\|")
    kinds = F.transform(
        apart, lambda m: F.struct(F.when(F.array_contains(gone, F.lower(m["match"])), "removed").otherwise("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"))
    )
    listed = F.concat(
        F.transform(F.col(base), lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))),
        F.when(F.size(found) > 0, F.concat(F.filter(kinds, lambda k: k["kind"] == "term"), F.filter(kinds, lambda k: k["kind"] == "removed"))).otherwise(
            F.array().cast("array<struct<kind:string,start:int,end:int>>")
        ),
    )
    return spans.select(*map(col, kept.columns), listed.alias(out))


def hidden(text: Column, spans: Column, placeholders: dict[str, str] = PLACEHOLDERS) -> Column:
    """``text`` with each span replaced by its placeholder; spans that overlap are hidden as one, under the first's."""
    signs = F.create_map(*[F.lit(x) for pair in placeholders.items() for x in pair])
    return replaced(text, spans, lambda s, covered: F.when(s["start"] >= covered, F.element_at(signs, s["kind"])).otherwise(""))


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with spaces instead of all that the spans cover, so that places stay."""
    return replaced(text, spans, lambda s, covered: F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], covered), F.lit(0))))


def sanitise(docs: DataFrame, text: str = "text", **thresholds) -> DataFrame:
    """``docs`` with entities and revealing terms hidden in ``text``; ``n_chars``, if there, is set anew."""
    spans = fresh(docs, "spans")
    found = find(docs, text, spans, **thresholds)
    new = F.when(col(text).isNull(), None).otherwise(hidden(col(text), F.col(spans)))
    made = found.select(*[new.alias(c) if c == text else col(c) for c in docs.columns])
    return made.withColumn("n_chars", F.coalesce(F.length(col(text)).cast("long"), col("n_chars"))) if "n_chars" in docs.columns else made


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def written(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
