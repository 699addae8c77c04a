"""The registered queries of this subpackage and their SQL: `name -> (spark, folder) -> DataFrame`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import chat, divergence, html_main, language, line_templates, minhash, packing, quality, repeats, segmentation, token_counts, topk, whitening
from tidewire.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, folder, "documents")))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), work_dir(spark, "token-cache"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    return chat.digests(chat.windows(turns.unionByName(added)))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return segmentation.sample(table(spark, folder, "documents"))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_main.extract(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.apply_policy(quality.ledger(table(spark, folder, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    predicted = language.predict(docs, language.fit(docs))
    return predicted.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.drop_recurring(table(spark, folder, "documents"))


def op11_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
        (F.octet_length("text") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_top_k, op3_packing, op4_token_counts, op5_chat_format, op6_sentencepiece,
        op7_main_text, op8_quality_rules, op9_language_id, op10_line_dedup, op11_repeated_passages,
        op12_whitening, op13_source_divergence,
    )
}

_OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
      FROM d),
p AS (SELECT r, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS win
      FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM p) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT j) AS n
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r),
m AS (SELECT d.doc_id, d.text, len(w.words) AS n_words,
        length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(w.lines) - len(list_distinct(w.lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
        len(w.lines) AS n_lines, length(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS n_upper,
        length(regexp_replace(d.text, '[^a-z]', '', 'g')) AS n_lower
      FROM d JOIN w USING (r) LEFT JOIN covered c USING (r))
SELECT doc_id, cast(n_words AS bigint) AS n_words, cast(word_chars AS bigint) AS word_chars,
  cast(n_symbols AS bigint) AS n_symbols, cast(n_dup_lines AS bigint) AS n_dup_lines,
  cast(n_repeat_words AS bigint) AS n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (@rules) AS kept
FROM m
""".replace("@rules", " OR ".join(rule for _, rule in quality.RULES))

_OP2 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS bigint) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, cast(rank AS int) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# What SQL can say of op5: the windows, and so formatted_chars, depend on token counts.
OP5_READ_BACK = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  cast(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256
FROM turns GROUP BY conv_id
"""

_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
o AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
n AS (SELECT lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_total FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(l.lang_total, 0) AS lang_total, coalesce(s.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM n GROUP BY ALL) s USING (lang, source)
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN n USING (lang, source, term)
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, cast(coalesce(s.value, 0) AS bigint) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, cast(((p - q) * (p - q)) // (p + q) AS bigint) FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS int) AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

SQL: dict[str, str] = {"op2_top_k": _OP2, "op8_quality_rules": _OP8, "op13_source_divergence": _OP13}
