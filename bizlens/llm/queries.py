"""The registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bizlens.llm import bagminhash, chat, counts, decontam, hmm, huffman, lines, merkle, packing, rules, spelling, toxicity, warc


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines of each document go."""
    return lines.removed_lines(given(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and verdict of each document."""
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rules.judged(given(spark, folder, "documents")).select(*columns)


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scores(given(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that stand in documents."""
    found = decontam.contained(given(spark, folder, "documents"), given(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = given(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], conversations.schema)
    return chat.digests(chat.formatted(conversations.unionByName(extra)))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return huffman.round_trip(given(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(given(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(given(spark, folder, "documents"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of each document."""
    return bagminhash.classes(given(spark, folder, "documents"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of each document, and whether the proof holds after the tampering."""
    return merkle.verified(given(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.grouped(given(spark, folder, "documents"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.counted(given(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_quality_rules, op3_toxicity, op4_lm_scoring, op5_decontamination,
        op6_chat_format, op7_token_files, op8_warc, op9_packing, op10_near_dedup,
        op11_merkle_manifest, op12_spelling_variants, op13_token_counts,
    )
}

ORACLE_SQL = {
    "op2_quality_rules": rules.SQL,
    "op5_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, doc_id, list_slice(w, i, i + 4) AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5),
b AS (SELECT row_number() OVER () AS bid, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark),
q AS (SELECT DISTINCT bid, item_id, list_slice(w, i, i + 4) AS g FROM b, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5),
n AS (SELECT bid, count(*) AS n_item FROM q GROUP BY bid),
h AS (SELECT rid, doc_id, bid, item_id, count(*) AS n_shared FROM s JOIN q USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item FROM h JOIN n USING (bid) WHERE n_shared >= 0.8 * n_item
""",
    "op6_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l') AS etext,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '<', '\l'), ':', '\c') AS erole,
         role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS opens
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       cast(sum(length(etext) + CASE WHEN opens THEN 4 + length(erole) + 2 + 8 ELSE 6 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op8_warc": r"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, first_value(rid) OVER w AS first_rid, first_value(page_id) OVER w AS first_id
      FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, rid)),
x AS (SELECT *, unhex(sha1(h)) AS s FROM f),
bits AS (
  SELECT rid, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(v AS INT), 1), '' ORDER BY k) AS b32 FROM (
    SELECT rid, k, list_reduce(list_transform(range(5), lambda j: cast(substr(bin, cast(5 * k + j + 1 AS BIGINT), 1) AS INT)), lambda a, b: 2 * a + b) AS v
    FROM (SELECT rid, array_to_string(list_transform(range(40), lambda i: lpad(bin(cast('0x' || substr(sha1(h), cast(i + 1 AS BIGINT), 1) AS INT)), 4, '0')), '') AS bin FROM f),
         unnest(range(32)) AS u(k)) GROUP BY rid)
SELECT page_id, octet_length(encode(h)) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN rid = first_rid THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rid = first_rid THEN NULL ELSE first_id END AS refers_to
FROM x JOIN bits USING (rid)
""",
}
