"""Quality rules as a short-circuit cascade, ordered by what they reject for what they cost. Built-in functions only."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import WORD, text_of
from bizlens.session import materialize

SAMPLE_ROWS = 2_000
WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"

#: Rules over the columns of ``measured``: true rejects. All in whole numbers, so that any engine decides alike.
RULES: dict[str, str] = {
    "symbols": "100 * n_symbols > 10 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 20 * n_words",
    "few_letters": r"2 * length(regexp_replace(_text, '[^\\p{L}]+', '')) < word_chars",
    "one_word_over_and_over": "50 * size(array_distinct(_words)) < n_words and n_words < 2000",
    "endless_word": "array_max(transform(_words, w -> length(w))) > 1000",
}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated(words: Column) -> Column:
    """How many words lie in windows of eight words that occur twice or more in the text."""
    zero = F.lit(0).cast("long")

    def covered(places: Column) -> Column:
        step = lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
        return F.aggregate(F.transform(places, step), zero, lambda a, x: a + x)

    def again(ranked: Column) -> Column:
        twice = F.filter(ranked, lambda e, j: (F.get(ranked, j - 1)["x"] == e["x"]) | (F.get(ranked, j + 1)["x"] == e["x"]))
        return _let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    def within(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(ranked, again)).otherwise(zero)

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= WINDOW, _let(windows, within)).otherwise(zero)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``n_lines``, ``base_failed``, and ``_text`` and ``_words`` for the rules, for every whole text."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("_text"))
    text = F.col("_text")
    counts = _let(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda words: F.struct(
            words.alias("_words"), F.size(words).cast("long").alias("n_words"), _repeated(words).alias("n_repeat_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        ),
    )
    lines = _let(
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)),
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.size(x).cast("long").alias("n_lines")
        ),
    )
    n_symbols = (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols")
    out = out.select("doc_id", "_text", counts.alias("_counts"), lines.alias("_of_lines"), n_symbols)
    out = out.select("doc_id", "_text", "_counts.*", "_of_lines.*", "n_symbols")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def ordered(sample: DataFrame, rules: dict[str, str]) -> list[dict]:
    """The rules with rejected share, seconds and rank, most rejections per second first, measured on a stored sample."""
    found = []
    sample.agg(F.count(F.lit(1))).first()  # files and code are warm before anything is timed
    for name, rule in rules.items():
        started = time.perf_counter()
        n, rejected = sample.agg(F.count(F.lit(1)), F.count(F.when(F.expr(rule), 1))).first()
        seconds = time.perf_counter() - started
        share = rejected / n if n else 0.0
        found.append({"rule": name, "share": share, "seconds": seconds, "rank": share / max(seconds, 1e-6)})
    return sorted(found, key=lambda r: (-r["rank"], r["seconds"], r["rule"]))


def cascade(frame: DataFrame, rules: dict[str, str], order: list[str]) -> DataFrame:
    """Add ``rejected_by``: the first rule in ``order`` that holds, else null. Later rules aren't evaluated once one holds."""
    case = None
    for name in order:
        case = (F if case is None else case).when(F.expr(rules[name]), F.lit(name))
    return frame.withColumn("rejected_by", case if case is not None else F.lit(None).cast("string"))


def judged(docs: DataFrame, rules: dict[str, str] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts and verdict for every row of ``docs(doc_id, text)``.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, rejected_by,
    kept``. A row that fails the base is not kept and meets no rule. The others pass a cascade of ``rules`` whose order is
    found on a stored sample of at most ``sample_rows`` rows: rejected share by seconds spent. The order decides only which rule is
    named first and how much work is done; ``kept`` is the same for any order.

    A null or empty text has no words and fails the base. Repeated rows are judged each. Other columns are ignored; an empty
    table gives no rows.
    """
    rules = RULES if rules is None else rules
    sample = measured(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(5)) == 0).limit(sample_rows))
    order = [r["rule"] for r in ordered(materialize(sample.filter("not base_failed"), "sample"), rules)]
    frame = measured(docs)
    guarded = {name: f"not base_failed and ({rule})" for name, rule in rules.items()}
    out = cascade(frame, guarded, order)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed", "rejected_by",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"),
    )


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (SELECT rid, i, list_slice(ws, i, i + 7) AS g FROM d, unnest(range(1, len(ws) - 6)) AS u(i) WHERE len(ws) >= 8),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, sum(s) AS n FROM (
    SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS s FROM rep) GROUP BY rid),
b AS (
  SELECT doc_id, t, ws, len(ws) AS n_words, coalesce(cast(n AS BIGINT), 0) AS n_repeat_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines
  FROM d LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 2 * length(regexp_replace(t, '[^\p{L}]+', '', 'g')) < word_chars
    OR (50 * len(list_distinct(ws)) < n_words AND n_words < 2000)
    OR coalesce(list_max(list_transform(ws, lambda w: length(w))), 0) > 1000) AS kept
FROM f
"""
