"""The registered queries of the operators, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymill.llm import alignment, bpe, disclosure, merkle, mixing, orc_ids, preference, severity, simhash, sketch, style_tree, topk, url_filter
from daymill.session import apply_runtime_options, scratch_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(apply_runtime_options(spark), folder)

    QUERIES[build.__name__] = run
    return run


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


@query
def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.text_of_ids(), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_orc_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    table = scratch_table(spark, "ids")
    orc_ids.write_ids(docs, table, public_tokenizers.path("word_bpe_49k.json"), end=2)
    return orc_ids.checksums(orc_ids.read_ids(spark, table))


@query
def op2_sketch(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return sketch.compare_with_edits(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "kept_in_edited",
        "kept_in_next",
    )


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return mixing.taken(mixing.mix(docs)).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op4_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = disclosure.find(docs).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*disclosure.KINDS))
    counts = [F.size(disclosure.of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in disclosure.KINDS]
    return found.select("doc_id", *counts, F.sha2(disclosure.written(base), 256).alias("base_sha256"), disclosure.written(F.col("spans")).alias("spans"))


@query
def op8_severity(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    model = severity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return severity.grade(docs, model).select("doc_id", "expected_severity", "p_toxic", "severity", "toxic")


@query
def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"))
    return topk.top_k(vectors.where(F.col("id") % 20 == 0), vectors)


ORACLES["op5_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.n, q.vec_id AS query_id, x.vec_id, CAST(list_dot_product(q.e, x.e) AS BIGINT) AS score
  FROM v q JOIN v x ON q.n <> x.n WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op6_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return style_tree.main_text(pages).select("page_id", "url", "text", "n_chars")


@query
def op3_preference(spark: SparkSession, folder: str) -> DataFrame:
    turns = preference.numbered(spark.read.parquet(f"{folder}/conversations.parquet"), "conv_id")
    pairs = preference.preference_pairs(*preference.with_other_reply(turns))

    def spans(mask: str):
        return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(mask)

    return pairs.select(F.col("pair").alias("conv_id"), "prompt_turns", "prompt", "chosen", "rejected", spans("chosen_mask"), spans("rejected_mask"))


ORACLES["op3_preference"] = """
WITH t AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 WHEN 'assistant' THEN 3 ELSE 99 END, coalesce(role, ''), coalesce(text, '')) - 1 AS INTEGER) AS place,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), l AS (
  SELECT conv_id, max(place) AS place, arg_max(text, place) AS reply FROM t WHERE role = 'assistant' GROUP BY conv_id
), n AS (
  SELECT *, coalesce(lead(reply) OVER (ORDER BY conv_id), first_value(reply) OVER (ORDER BY conv_id)) AS other FROM l
), r AS (
  SELECT t.conv_id, t.place, n.place AS last, t.role, t.text, n.reply, n.other,
    '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS shown
  FROM t JOIN n USING (conv_id) WHERE t.place <= n.place
)
SELECT conv_id, CAST(count(*) FILTER (place < last OR reply = other) AS INTEGER) AS prompt_turns,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (place < last OR reply = other), '') AS prompt,
  CASE WHEN any_value(reply) = any_value(other) THEN '' ELSE '<|assistant|>' || chr(10) || any_value(reply) || '<|end|>' || chr(10) END AS chosen,
  CASE WHEN any_value(reply) = any_value(other) THEN '' ELSE '<|assistant|>' || chr(10) || any_value(other) || '<|end|>' || chr(10) END AS rejected,
  CASE WHEN any_value(reply) = any_value(other) THEN '' ELSE '14:' || CAST(14 + length(any_value(reply)) AS VARCHAR) END AS chosen_mask,
  CASE WHEN any_value(reply) = any_value(other) THEN '' ELSE '14:' || CAST(14 + length(any_value(other)) AS VARCHAR) END AS rejected_mask
FROM r GROUP BY conv_id
"""


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(*LEAF_FIELDS)
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    tampered = F.when(chosen, merkle.leaf(docs, LEAF_FIELDS, {"n_chars": F.col("n_chars") + 1}))
    rows = merkle.manifest(docs, LEAF_FIELDS, "lang", "doc_id", also={"tampered": tampered}).rows
    shown = rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


_WRITTEN = {f: f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in ("source", "lang", "text")}
_NUMBER = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join([_NUMBER.format("doc_id"), _WRITTEN["source"], _WRITTEN["lang"], "{n_chars}", _WRITTEN["text"]]) + ")"

ORACLES["op11_merkle"] = f"""
WITH RECURSIVE t AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM range(256) r(i))
), d AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format(n_chars=_NUMBER.format("n_chars"))} AS leaf,
      {_LEAF.format(n_chars=_NUMBER.format("n_chars + 1"))} AS changed,
      xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS chosen
    FROM documents, t)
), n AS (
  SELECT 0 AS lvl, g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS c FROM d
  UNION ALL
  SELECT lvl + 1, g, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(c) + 1) // 2 FROM n WHERE c > 1 GROUP BY lvl, g, i // 2
), s AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS c FROM n WHERE c = 1
), m AS (
  SELECT 0 AS lvl, i, h, c FROM s
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(c) + 1) // 2 FROM m WHERE c > 1 GROUP BY lvl, i // 2
), low AS (
  SELECT d.g, d.i, list(CASE WHEN p.i & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(o.h, '') ORDER BY p.lvl) AS path
  FROM d JOIN n p ON p.g = d.g AND p.i = d.i >> p.lvl AND p.c > 1 LEFT JOIN n o ON o.g = p.g AND o.lvl = p.lvl AND o.i = xor(p.i, 1) GROUP BY d.g, d.i
), top AS (
  SELECT s.g, list(CASE WHEN p.i & 1 = 1 THEN 'L' ELSE 'R' END || coalesce(o.h, '') ORDER BY p.lvl) AS path
  FROM s JOIN m p ON p.i = s.i >> p.lvl AND p.c > 1 LEFT JOIN m o ON o.lvl = p.lvl AND o.i = xor(p.i, 1) GROUP BY s.g
), f AS (
  SELECT d.*, s.h AS subroot, (SELECT h FROM m WHERE c = 1) AS root, list_concat(coalesce(low.path, []), coalesce(top.path, [])) AS path
  FROM d JOIN s USING (g) LEFT JOIN low ON low.g = d.g AND low.i = d.i LEFT JOIN top ON top.g = d.g
), r AS (
  SELECT *, list_reduce(list_prepend(CASE WHEN chosen THEN changed ELSE leaf END, path),
    lambda h, x: sha256(CASE WHEN x[1] = 'L' THEN x[2:] || h ELSE h || x[2:] END)) AS folded_root FROM f
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM r
"""


#: The rules of the query's contract: host, path, verdict.
URL_RULES = "SELECT * FROM VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block') AS t(host, path, verdict)"


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return url_filter.judge(pages, spark.sql(URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op12_url_filter"] = f"""
WITH r AS ({URL_RULES.replace("VALUES (", "(VALUES (").replace(" AS t(", ") AS t(")}
), u AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), b AS (
  SELECT n, arg_max(r.host || r.path, length(r.host) + length(r.path)) AS rule, arg_max(r.verdict, length(r.host) + length(r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (n)
"""


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = alignment.align_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.with_counts(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder).withColumn("ids", bpe.text_of_ids())


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
