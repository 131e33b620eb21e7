"""The registered queries as DuckDB SQL over the given tables, stated independently of the Spark plans.

``CTES`` holds one building block per feed, lookup and table; ``query`` puts the needed ones in
front of a final SELECT.
"""

from __future__ import annotations

import re

from bizlens.functions.text import STOP_WORDS, TOKEN_PATTERN
from bizlens.schemas import TABLES
from checks.standins import BUSINESS, RULE_WORDS, STANDIN_RULES

_TS = "'%Y-%m-%d %H:%M:%S'"
_BLANKS = r"[^ \t\n\r\f\x0B\p{Z}]+"
_EDGES = r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(column: str, values) -> str:
    values = list(values)
    return f"{column} IN ({', '.join(_text(v) for v in values)})" if values else "FALSE"


def _hash_id(*parts: str) -> str:
    marked = ", ".join(f"coalesce('v' || CAST({p} AS VARCHAR), 'n')" for p in parts)
    return f"""(SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4), substr(h, 17, 4), substr(h, 21, 12))
        FROM (SELECT sha256(concat_ws(chr(1), {marked})) AS h))"""


CTES: dict[str, str] = {
    "business_feed": """
        SELECT CASE WHEN n % 13 <> 12 THEN source END AS business_id, source AS name, n || ' main st' AS address,
               'city' || (n % 3) AS city, 's' || (n % 4) AS state, lpad(CAST(n AS VARCHAR), 5, '0') AS postal_code,
               n * 1.5::DOUBLE AS latitude, n * -0.25::DOUBLE AS longitude, 1 + (n % 9) * 0.5::DOUBLE AS stars,
               n AS review_count, CASE WHEN n % 5 = 0 THEN 0 ELSE 1 END AS is_open,
               CASE WHEN n % 11 <> 10 THEN 'cat' || (n % 7) || ', cat' || ((n + 3) % 7) END AS categories
        FROM (SELECT DISTINCT source, CAST(substr(source, 4, 9) AS INTEGER) AS n FROM documents)""",
    "checkin_feed": f"""
        SELECT event_id, CASE WHEN event_id % 53 <> 0 THEN 'src' || (user_id % 20) END AS business_id,
               CASE WHEN event_id % 41 = 0 THEN NULL
                    WHEN event_id % 97 = 1 THEN strftime(ts, {_TS}) || ', 2016-03-09'
                    WHEN event_id % 3 = 0 THEN strftime(ts, {_TS}) || ', ' || strftime(ts + INTERVAL 40 DAY, {_TS})
                    ELSE strftime(ts, {_TS}) END AS date
        FROM events""",
    "review_feed": f"""
        SELECT doc_id, CASE WHEN doc_id % 61 <> 7 THEN CAST(doc_id AS VARCHAR) END AS review_id,
               CAST(o_custkey AS VARCHAR) AS user_id, source AS business_id, CAST(1 + doc_id % 5 AS DOUBLE) AS stars,
               CASE WHEN doc_id % 37 = 5 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, {_TS}) END AS date,
               CASE WHEN doc_id % 43 = 11 THEN '' WHEN doc_id % 47 = 13 THEN NULL ELSE text END AS text
        FROM documents JOIN orders ON doc_id = o_orderkey""",
    "tip_feed": f"""
        SELECT CASE WHEN conv_id % 17 = 4 THEN '' WHEN conv_id % 19 = 5 THEN NULL ELSE text END AS text,
               strftime(TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL 1 HOUR + turn * INTERVAL 1 MINUTE, {_TS}) AS date,
               CAST(turn AS INTEGER) AS compliment_count, 'src' || (conv_id % 20) AS business_id,
               CAST(conv_id AS VARCHAR) AS user_id
        FROM conversations, (VALUES (1), (2)) AS c(copy)
        WHERE copy = 1 OR conv_id % 3 = 0""",
    "user_feed": """
        SELECT CASE WHEN c_custkey % 71 <> 3 THEN CAST(c_custkey AS VARCHAR) END AS user_id, c_name AS name,
               CAST(c_custkey % 100 AS INTEGER) AS review_count,
               CASE c_custkey % 3 WHEN 0 THEN (c_custkey + 4) || ', ' || (c_custkey + 8) || ', ' || (c_custkey + 2)
                                  WHEN 1 THEN '' END AS friends,
               CASE WHEN c_custkey % 29 = 6 THEN 'None' WHEN c_custkey % 4 = 0 THEN '2017,2018'
                    WHEN c_custkey % 4 = 1 THEN '2018' WHEN c_custkey % 4 = 2 THEN '' END AS elite
        FROM customer""",
    "vocabulary": """
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents) GROUP BY word""",
    "lexicon": f"""
        SELECT word AS term, CAST(ascii(substr(md5(word), 1, 1)) % 9 - 4 AS DOUBLE) AS valence
        FROM vocabulary WHERE n >= 20 AND NOT {_in('word', RULE_WORDS)} AND ascii(substr(md5(word), 1, 1)) % 9 <> 4""",
    "nouns": "SELECT word AS lemma FROM vocabulary WHERE n >= 5",
    "exceptions": "SELECT lemma || 'en' AS form, lemma FROM nouns WHERE length(lemma) = 5",
    "business": """
        SELECT business_id, address, city, latitude, longitude, name, postal_code, state
        FROM business_feed WHERE business_id IS NOT NULL AND is_open = 1""",
    "business_category": """
        SELECT business_id, unnest(string_split(categories, ', ')) AS category
        FROM business_feed WHERE business_id IS NOT NULL AND is_open = 1 AND categories IS NOT NULL""",
    "checkin": f"""
        SELECT business_id, try_strptime(piece, {_TS}) AS date
        FROM (SELECT business_id, unnest(string_split(date, ', ')) AS piece FROM checkin_feed
              WHERE business_id IS NOT NULL AND date IS NOT NULL)""",
    "users": "SELECT user_id, name FROM user_feed WHERE user_id IS NOT NULL",
    "user_elite": """
        SELECT user_id, year FROM (
            SELECT user_id, TRY_CAST(unnest(string_split(elite, ',')) AS INTEGER) AS year FROM user_feed
            WHERE user_id IS NOT NULL AND length(elite) > 0) WHERE year IS NOT NULL""",
    "user_friend": """
        SELECT user_id, unnest(string_split(friends, ', ')) AS friend_id FROM user_feed
        WHERE user_id IS NOT NULL AND length(elite) > 0 AND length(friends) > 0""",
    "review_staging": f"""
        SELECT review_id, user_id, business_id, stars, try_strptime(date, {_TS}) AS date, lower(text) AS text
        FROM review_feed WHERE review_id IS NOT NULL AND length(text) > 0""",
    "tip_staging": f"""
        SELECT {_hash_id('text', 'date', 'compliment_count', 'business_id', 'user_id', 'no')} AS tip_id, user_id,
               try_strptime(date, {_TS}) AS date, business_id, lower(text) AS text
        FROM (SELECT *, row_number() OVER (PARTITION BY text, date, compliment_count, business_id, user_id) AS no
              FROM tip_feed WHERE length(text) > 0)""",
    "token_rows": f"""
        SELECT key, unnest(regexp_extract_all(text, {_text(TOKEN_PATTERN)})) AS word FROM texts""",
    "lemma_candidates": """
        SELECT f.form, f.lemma FROM (
            SELECT form, form AS lemma FROM forms_seen
            UNION SELECT form, left(form, length(form) - 1) FROM forms_seen WHERE form LIKE '%s'
            UNION SELECT form, left(form, length(form) - 2) FROM forms_seen
                  WHERE form LIKE '%ses' OR form LIKE '%xes' OR form LIKE '%zes' OR form LIKE '%ches' OR form LIKE '%shes'
            UNION SELECT form, left(form, length(form) - 3) || 'f' FROM forms_seen WHERE form LIKE '%ves'
            UNION SELECT form, left(form, length(form) - 3) || 'man' FROM forms_seen WHERE form LIKE '%men'
            UNION SELECT form, left(form, length(form) - 3) || 'y' FROM forms_seen WHERE form LIKE '%ies') f
        WHERE (f.form = f.lemma OR f.form NOT IN (SELECT form FROM exceptions)) AND f.lemma IN (SELECT lemma FROM nouns)
        UNION SELECT form, lemma FROM exceptions""",
    "forms_seen": "SELECT DISTINCT word AS form FROM token_rows",
    "lemmas": """
        SELECT form, first(lemma ORDER BY length(lemma), form <> lemma, lemma) AS lemma
        FROM lemma_candidates GROUP BY form""",
    "lemma_rows": """
        SELECT key, coalesce(lemma, word) AS word FROM token_rows LEFT JOIN lemmas ON word = form""",
    "word_rows": f"""
        SELECT key, word FROM lemma_rows
        WHERE NOT {_in('word', STOP_WORDS)} AND length(word) > 1
          AND NOT regexp_matches(word, '^''[a-z|0-9]$') AND NOT regexp_full_match(word, '\\p{{Nd}}+')""",
    "sentiment_words": f"""
        SELECT key, word, row_number() OVER (PARTITION BY key ORDER BY pos) AS pos
        FROM (SELECT key, pos, CASE WHEN length(bare) > 1 THEN bare ELSE word END AS word
              FROM (SELECT key, pos, word, regexp_replace(word, {_text(_EDGES)}, '', 'g') AS bare
                    FROM (SELECT key, unnest(found) AS word, generate_subscripts(found, 1) AS pos
                          FROM (SELECT key, regexp_extract_all(text, {_text(_BLANKS)}) AS found FROM texts))))
        WHERE length(word) > 1""",
    "sentiment_values": f"""
        SELECT key, word, pos, valence, min(CASE WHEN {_in('word', STANDIN_RULES.contrast)} THEN pos END) OVER (PARTITION BY key) AS contrast,
               {', '.join(f"lag(word, {d}) OVER w AS w{d}, lag(valence, {d}) OVER w AS v{d}" for d in (1, 2, 3))},
               lead(word, 1) OVER w AS n1, lead(word, 2) OVER w AS n2
        FROM sentiment_words LEFT JOIN lexicon ON word = term
        WINDOW w AS (PARTITION BY key ORDER BY pos)""",
}


def _turn(distance: int) -> str:
    """What the word at a distance multiplies the value by."""
    r, w = STANDIN_RULES, f"w{distance}"
    negates = f"WHEN {_in(w, r.negations)} OR contains({w}, 'n''t') THEN -0.74::DOUBLE ELSE 1::DOUBLE END"
    if distance == 2:
        return f"""CASE WHEN {_in(w, r.never)} AND {_in('w1', r.never_so)} THEN 1.5::DOUBLE
                        WHEN {_in(w, r.without)} AND {_in('w1', r.doubt)} THEN 1::DOUBLE {negates}"""
    if distance == 3:
        return f"""CASE WHEN ({_in(w, r.never)} AND {_in('w2', r.never_so)}) OR {_in('w1', r.never_so)} THEN 1.25::DOUBLE {negates}"""
    return f"CASE {negates}"


def _look_back(distance: int, boost: float) -> str:
    up, down = _in(f"w{distance}", STANDIN_RULES.increasing), _in(f"w{distance}", STANDIN_RULES.decreasing)
    return f"""CASE WHEN w{distance} IS NULL OR v{distance} IS NOT NULL THEN value ELSE
               (value + CASE WHEN value < 0 THEN -1 ELSE 1 END
                * CASE WHEN {up} THEN {boost!r}::DOUBLE WHEN {down} THEN {-boost!r}::DOUBLE ELSE 0::DOUBLE END) * {_turn(distance)} END"""


def _phrased() -> str:
    """The value after the phrases around the word; those ahead override those behind."""
    def value_of(text: str) -> str:
        return f"CASE {text} " + " ".join(f"WHEN {_text(p)} THEN {v!r}::DOUBLE" for p, v in STANDIN_RULES.phrases) + " END"

    places = ["word || ' ' || n1 || ' ' || n2", "word || ' ' || n1", "w1 || ' ' || word", "w2 || ' ' || w1 || ' ' || word",
              "w2 || ' ' || w1", "w3 || ' ' || w2 || ' ' || w1", "w3 || ' ' || w2"]
    lessened = " OR ".join(_in(f"w{d + 1} || ' ' || w{d}", STANDIN_RULES.lessening) for d in (2, 1))
    return f"""CASE WHEN w3 IS NULL OR v3 IS NOT NULL THEN value
               ELSE coalesce({', '.join(map(value_of, places))}, value) + CASE WHEN {lessened} THEN -0.293::DOUBLE ELSE 0::DOUBLE END END"""


_mute = " OR ".join(f"(word = {_text(a)} AND n1 = {_text(b)})" for a, b in STANDIN_RULES.mute_before)
_hits = f"""SELECT *, valence AS value FROM sentiment_values
    WHERE valence IS NOT NULL AND NOT {_in('word', STANDIN_RULES.increasing + STANDIN_RULES.decreasing)} AND NOT coalesce({_mute}, FALSE)"""
_least = f"{_in('w1', STANDIN_RULES.least)} AND v1 IS NULL AND NOT coalesce({_in('w2', STANDIN_RULES.not_least)}, FALSE)"
for _step in (
    *(_look_back(d, boost) for d, boost in ((1, 0.293), (2, 0.293 * 0.95), (3, 0.293 * 0.9))),
    _phrased(), f"CASE WHEN {_least} THEN value * -0.74::DOUBLE ELSE value END",
):
    _hits = f"SELECT * REPLACE ({_step} AS value) FROM ({_hits})"
CTES["scores"] = f"""
    SELECT t.key, round(coalesce(amount / sqrt(amount * amount + 15::DOUBLE), 0), 4) AS score
    FROM texts t LEFT JOIN (
        SELECT key, CASE WHEN total > 0 THEN total + emphasis WHEN total < 0 THEN total - emphasis ELSE total END AS amount
        FROM (SELECT key, CAST(sum(CAST(floor(value * CASE WHEN contrast IS NULL OR pos = contrast THEN 1::DOUBLE
                                WHEN pos < contrast THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END * 1000000000::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS DOUBLE)
                          / 1000000000::DOUBLE AS total
              FROM ({_hits}) GROUP BY key)
        JOIN (SELECT key, least(marks, 4) * 0.292::DOUBLE
                     + CASE WHEN asks > 3 THEN 0.96::DOUBLE WHEN asks > 1 THEN asks * 0.18::DOUBLE ELSE 0::DOUBLE END AS emphasis
              FROM (SELECT key, length(text) - length(replace(text, '!', '')) AS marks,
                           length(text) - length(replace(text, '?', '')) AS asks FROM texts)) USING (key)) s ON t.key = s.key"""
CTES["labels_of"] = """
    SELECT key, score, CASE WHEN score >= 0.05 THEN 'POSITIVE' WHEN score <= -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment
    FROM scores"""

# The text chain above runs on reviews or on tips: one renamed copy of it for each.
_CHAIN = (
    "token_rows forms_seen lemma_candidates lemmas lemma_rows word_rows sentiment_words sentiment_values scores labels_of"
).split()
for _kind in ("review", "tip"):
    for _name in _CHAIN:
        _body = CTES[_name]
        for _other in [*_CHAIN, "texts"]:
            _body = re.sub(rf"\b{_other}\b", f"{_kind}_{_other}", _body)
        CTES[f"{_kind}_{_name}"] = _body
    CTES[f"{_kind}_texts"] = f"SELECT {_kind}_id AS key, text FROM {_kind}_staging"
    CTES[f"{_kind}_text"] = f"SELECT key AS {_kind}_id, word FROM {_kind}_word_rows"
    CTES[_kind] = f"SELECT s.*, l.sentiment, l.score FROM {_kind}_staging s JOIN {_kind}_labels_of l ON l.key = s.{_kind}_id"
for _name in _CHAIN:
    del CTES[_name]


def query(final: str) -> str:
    """``final`` preceded by every building block it mentions, in order of need."""
    ordered: list[str] = []

    def need(sql: str, within: tuple[str, ...] = ()) -> None:
        for name in CTES:
            if name not in within and name not in ordered and re.search(rf"\b{name}\b", sql):
                need(CTES[name], (*within, name))
                ordered.append(name)

    need(final)
    if not ordered:
        return final
    blocks = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered)
    return f"WITH {blocks}\n{final}"


def ts(column: str) -> str:
    return f"strftime({column}, {_TS})"


def trend(rows: str, group: str = "", months: int = 10) -> str:
    """The latest months with rows, as (group, time, count)."""
    keys = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""SELECT {keys}year || '/' || month AS time, count FROM (
        SELECT *, row_number() OVER ({part} ORDER BY year DESC, month DESC) AS rank FROM (
            SELECT {keys}CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS count
            FROM ({rows}) WHERE date IS NOT NULL GROUP BY ALL)) WHERE rank <= {months}"""


def top_words(rows: str, group: str = "") -> str:
    keys = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""SELECT {keys}word, count FROM (
        SELECT *, row_number() OVER ({part} ORDER BY count DESC, word) AS rank FROM (
            SELECT {keys}word, count(*) AS count FROM ({rows}) GROUP BY ALL)) WHERE rank <= 5"""


def recent(rows: str, group: str = "") -> str:
    keys = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    return f"""SELECT {keys}review_id, {ts('date')} AS date, stars, text FROM (
        SELECT *, row_number() OVER ({part} ORDER BY date DESC NULLS LAST, review_id) AS rank FROM ({rows})) WHERE rank <= 5"""


_B = _text(BUSINESS)
_ELITE = "SELECT user_id FROM user_elite WHERE year = 2018"
_FRIENDS = "SELECT f.friend_id FROM user_elite e JOIN user_friend f ON e.user_id = f.user_id WHERE e.year = 2018"
_CIRCLE = f"SELECT * FROM review_staging r WHERE user_id IN ({_ELITE}) AND user_id IN ({_FRIENDS})"
_ANY = f"SELECT * FROM review_staging r WHERE user_id IN ({_ELITE}) OR user_id IN ({_FRIENDS})"
_WORDS = "SELECT r.business_id, r.user_id, t.word FROM {} r JOIN review_text t ON r.review_id = t.review_id"
_REVIEW_WORDS = _WORDS.format("review_staging")
_LABELLED_WORDS = "SELECT r.business_id, r.sentiment, t.word FROM review r JOIN review_text t ON r.review_id = t.review_id"
_PEERS = f"""SELECT business_id FROM business_category WHERE business_id <> {_B}
             AND category IN (SELECT category FROM business_category WHERE business_id = {_B})"""
_REVIEW_COLUMNS = f"review_id, user_id, business_id, stars, {ts('date')} AS date, text, sentiment"


def _check(check: str, table: str, column: str, count: str, source: str, where: str = "") -> str:
    passed = "n > 0" if check == "rows" else "n = 0"
    return f"""SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column", n, {passed} AS passed
               FROM (SELECT {count} AS n FROM {source} {where})"""


def _nulls(table: str, column: str, source: str | None = None) -> str:
    return _check("nulls", table, column, f"count(*) FILTER ({column} IS NULL)", source or table)


_SOURCE = {"user": "users", "review": "review", "tip": "tip"}
_TABLES = (
    "business business_category review review_text tip tip_text checkin user user_elite user_friend"
).split()


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _orphans(child: str, column: str, parent: str, parent_key: str) -> str:
    source, parent_source = _SOURCE.get(child, child), _SOURCE.get(parent, parent)
    where = f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_key} FROM {parent_source})"
    return _check(f"orphans of {parent}", child, column, "count(*)", source, where)


FINALS: dict[str, str] = {
    # sources and sinks
    "src_json_roundtrip": "SELECT review_id, user_id, business_id, stars, date, text FROM review_feed",
    "src_csv_roundtrip": "SELECT business_id, date FROM checkin_feed",
    "sink_parquet_roundtrip": f"SELECT review_id, user_id, business_id, stars, {ts('date')} AS date, text FROM review_staging",
    "sink_append": """SELECT business_id, category, copies FROM
        (SELECT business_id, category, count(*) * 2 AS copies FROM business_category GROUP BY ALL)""",
    "sink_bucketed_join": top_words(_REVIEW_WORDS, "business_id"),
    "limit_preview": f"SELECT review_id, user_id, {ts('date')} AS date FROM review_staging ORDER BY review_id LIMIT 2",
    "sql_view_query": f"""SELECT if(stars < 3, 'poor', 'fair') AS verdict, CAST(length(word) AS INTEGER) AS letters, count(*) AS said
        FROM review_staging r JOIN review_text t ON r.review_id = t.review_id WHERE business_id <> {_B} GROUP BY ALL""",
    # cleaning
    "clean_business": "SELECT * EXCLUDE (stars), stars FROM business_feed WHERE business_id IS NOT NULL AND is_open = 1",
    "clean_keys": """SELECT 'business' AS feed, count(*) AS n FROM business_feed WHERE business_id IS NOT NULL
        UNION ALL SELECT 'checkin', count(*) FROM checkin_feed WHERE business_id IS NOT NULL
        UNION ALL SELECT 'review', count(*) FROM review_feed WHERE review_id IS NOT NULL
        UNION ALL SELECT 'user', count(*) FROM user_feed WHERE user_id IS NOT NULL""",
    "clean_text": "SELECT review_id, user_id, text FROM review_feed WHERE text IS NOT NULL AND length(text) > 0",
    # functions
    "fn_lower_length": "SELECT doc_id, lower(text) AS lowered, CAST(length(text) AS INTEGER) AS n FROM documents",
    "fn_parse_ts": f"""SELECT event_id, strftime(try_strptime(date, {_TS}), {_TS}) AS strict,
        strftime(coalesce(try_strptime(date, {_TS}), try_strptime(date, '%Y-%m-%d')), {_TS}) AS lenient
        FROM (SELECT event_id, CASE WHEN event_id % 7 = 2 THEN strftime(ts, '%Y-%m-%d') WHEN event_id % 7 = 3 THEN 'soon'
              ELSE strftime(ts, {_TS}) END AS date FROM events)""",
    "fn_date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    "fn_month_label": """SELECT year(o_orderdate) || '/' || month(o_orderdate) AS time, count(*) AS count
        FROM orders GROUP BY ALL""",
    "fn_file_label": """SELECT o_orderkey, 'x' || CASE WHEN o_orderkey % 150 < 10 THEN '0' ELSE '' END || (o_orderkey % 150) AS label
        FROM orders""",
    "fn_stable_id": f"""SELECT {_hash_id('conv_id', 'turn', 'text')} AS id, conv_id, turn,
        {_hash_id('conv_id', 'turn', "''")} AS id_of_empty, {_hash_id('conv_id', 'turn', 'NULL')} AS id_of_null FROM conversations""",
    "explode_delimited": """SELECT event_id, unnest(string_split(date, ', ')) AS piece FROM checkin_feed WHERE date IS NOT NULL""",
    # words
    "text_tokens": f"""SELECT doc_id, array_to_string(regexp_extract_all(lower(text), {_text(TOKEN_PATTERN)}), ' ') AS tokens FROM documents""",
    "text_lemmas": """SELECT word AS form, lemma, count(*) AS n FROM review_token_rows JOIN review_lemmas ON word = form
        WHERE word <> lemma GROUP BY ALL""",
    "text_stopwords": f"""SELECT key AS review_id, word, count(*) AS n FROM review_token_rows
        WHERE NOT {_in('word', STOP_WORDS)} GROUP BY ALL""",
    "text_valid_words": r"""SELECT word, count(*) AS n FROM review_token_rows WHERE length(word) > 1
        AND NOT regexp_matches(word, '^''[a-z|0-9]$') AND NOT regexp_full_match(word, '\p{Nd}+') GROUP BY ALL""",
    "text_words": "SELECT word, count(*) AS n FROM review_text GROUP BY ALL",
    # sentiment
    "sent_lexicon_score": "SELECT key AS review_id, score FROM review_scores",
    "sent_by_join": "SELECT key AS review_id, score FROM review_scores",
    "sent_label": "SELECT sentiment, count(*) AS n FROM review GROUP BY ALL",
    # tables
    "mart_business": "SELECT * FROM business",
    "mart_business_category": "SELECT * FROM business_category",
    "mart_checkin": f"SELECT business_id, {ts('date')} AS date FROM checkin",
    "mart_user": "SELECT * FROM users",
    "mart_user_elite": "SELECT * FROM user_elite",
    "mart_user_friend": "SELECT * FROM user_friend",
    "mart_review": f"SELECT {_REVIEW_COLUMNS} FROM review",
    "mart_review_text": "SELECT review_id, word FROM review_text",
    "mart_tip": f"SELECT tip_id, user_id, {ts('date')} AS date, business_id, text, sentiment FROM tip",
    "mart_tip_text": "SELECT tip_id, word FROM tip_text",
    # joins
    "join_inner_words": "SELECT r.review_id, r.stars, t.word FROM review_staging r JOIN review_text t ON r.review_id = t.review_id",
    "join_elite_friend": "SELECT e.user_id, e.year, f.friend_id FROM user_elite e JOIN user_friend f ON e.user_id = f.user_id",
    "join_semi_elite": f"SELECT review_id, user_id FROM review_staging WHERE user_id IN ({_ELITE})",
    "join_semi_friend": f"SELECT review_id, user_id FROM review_staging WHERE user_id IN ({_FRIENDS})",
    "join_semi_nested": f"SELECT review_id, business_id FROM review_staging WHERE business_id IN ({_PEERS})",
    # insights
    "ins_avg_rating": f"SELECT round(avg(stars), 6) AS avg_stars FROM review_staging WHERE business_id = {_B}",
    "ins_avg_rating_all": "SELECT business_id, round(avg(stars), 6) AS avg_stars FROM review_staging GROUP BY ALL",
    "ins_review_trend": trend(f"SELECT date FROM review_staging WHERE business_id = {_B}"),
    "ins_review_trend_all": trend("SELECT business_id, date FROM review_staging", "business_id"),
    "ins_elite_circle_trend": trend(f"SELECT date FROM ({_CIRCLE}) WHERE business_id = {_B}"),
    "ins_elite_circle_trend_any": trend(f"SELECT date FROM ({_ANY}) WHERE business_id = {_B}"),
    "ins_elite_circle_trend_all": trend(_CIRCLE, "business_id"),
    "ins_checkin_trend": trend(f"SELECT date FROM checkin WHERE business_id = {_B}"),
    "ins_checkin_trend_all": trend("SELECT * FROM checkin", "business_id"),
    "ins_recent_reviews": recent(f"SELECT * FROM review_staging WHERE business_id = {_B}"),
    "ins_recent_reviews_all": recent("SELECT * FROM review_staging", "business_id"),
    "ins_recent_elite_reviews": recent(f"SELECT * FROM review_staging WHERE business_id = {_B} AND user_id IN ({_ELITE})"),
    "ins_recent_elite_reviews_all": recent(f"SELECT * FROM review_staging WHERE user_id IN ({_ELITE})", "business_id"),
    "ins_top_words": top_words(f"SELECT * FROM ({_REVIEW_WORDS}) WHERE business_id = {_B}"),
    "ins_top_words_all": top_words(_REVIEW_WORDS, "business_id"),
    "ins_top_words_by_sentiment": _union(
        f"SELECT '{s}' AS sentiment, * FROM (" + top_words(
            f"SELECT word FROM ({_LABELLED_WORDS}) WHERE business_id = {_B} AND sentiment = '{s}'") + ")"
        for s in ("POSITIVE", "NEGATIVE")
    ),
    "ins_top_words_by_sentiment_all": _union(
        f"SELECT '{s}' AS sentiment, * FROM (" + top_words(
            f"SELECT business_id, word FROM ({_LABELLED_WORDS}) WHERE sentiment = '{s}'", "business_id") + ")"
        for s in ("POSITIVE", "NEGATIVE")
    ),
    "ins_category_words": top_words(f"SELECT word FROM ({_REVIEW_WORDS}) WHERE business_id IN ({_PEERS})"),
    # quality
    "dq_nulls": _union([
        _nulls("business", "name"), _nulls("business_category", "category"), _nulls("review", "date"),
        _nulls("review_text", "word"), _nulls("tip", "date"), _nulls("tip_text", "word"), _nulls("checkin", "date"),
        _nulls("user", "user_id", "users"), _nulls("user_elite", "year"), _nulls("user_friend", "friend_id"),
    ]),
    "dq_domain": _union(
        _check("domain", t, "sentiment", f"count(*) FILTER (sentiment NOT IN ({allowed}))", t)
        for t in ("review", "tip") for allowed in ("'POSITIVE', 'NEUTRAL'",)
    ),
    "dq_row_counts": _union(_check("rows", t, "*", "count(*)", _SOURCE.get(t, t)) for t in _TABLES),
    "dq_missing_text": _union(
        _check("missing_text", t, "text", "count(*) FILTER (text IS NULL OR length(text) = 0)", f"{t}_feed")
        for t in ("review", "tip")
    ),
    "dq_closed_count": _check("closed", "business", "is_open", "count(*) FILTER (is_open = 0)", "business_feed"),
    "dq_duplicate_keys": _union(
        _check("duplicate_keys", t, k, "count(*)", f"(SELECT {k} FROM {_SOURCE.get(t, t)} GROUP BY {k} HAVING count(*) > 1)")
        for t, k in (("business", "business_id"), ("review", "review_id"), ("tip", "tip_id"), ("user", "user_id"))
    ),
    "dq_orphans": _union([
        _orphans("business_category", "business_id", "business", "business_id"),
        _orphans("review", "user_id", "user", "user_id"), _orphans("review", "business_id", "business", "business_id"),
        _orphans("review_text", "review_id", "review", "review_id"),
        _orphans("tip", "user_id", "user", "user_id"), _orphans("tip", "business_id", "business", "business_id"),
        _orphans("tip_text", "tip_id", "tip", "tip_id"), _orphans("checkin", "business_id", "business", "business_id"),
        _orphans("user_elite", "user_id", "user", "user_id"), _orphans("user_friend", "user_id", "user", "user_id"),
    ]),
    "dq_quarantine": """SELECT '_corrupt_record' AS "column", count(*) AS n FROM review_feed WHERE doc_id % 59 = 0
        UNION ALL SELECT 'review_id', count(*) FROM review_feed WHERE doc_id % 59 <> 0 AND review_id IS NULL
        UNION ALL SELECT 'quarantine', count(*) FROM review_feed WHERE doc_id % 59 = 0""",
    # incremental loading
    "ingest_next_file": """SELECT script_name, next_file, script_name || '/x' || CASE WHEN next_file < 10 THEN '0' ELSE '' END || next_file AS file_name
        FROM (SELECT s.script_name, coalesce(max(processed_file), -1) + 1 AS next_file
              FROM (SELECT DISTINCT source AS script_name FROM documents) s
              LEFT JOIN (SELECT source, CAST(n_chars % 120 AS BIGINT) AS processed_file FROM documents
                         WHERE source NOT IN ('src1', 'src2')) l ON s.script_name = l.source GROUP BY ALL)""",
    "ingest_ledger": _union(
        f"SELECT '{feed}' AS script_name, '{t}' AS table_name, count(*) AS n FROM {_SOURCE.get(t, t)}"
        for feed, names in (("business", ("business", "business_category")), ("checkin", ("checkin",)),
                            ("review", ("review", "review_text")), ("tip", ("tip", "tip_text")),
                            ("user", ("user", "user_elite", "user_friend")))
        for t in names
    ),
}


_DIRTY = """(SELECT CASE WHEN doc_id % 59 = 0 THEN ['unreadable'] ELSE [] END || CASE WHEN doc_id % 53 = 5 THEN ['unreadable'] ELSE [] END
    || CASE WHEN doc_id % 61 = 7 THEN ['no review_id'] ELSE [] END || CASE WHEN doc_id % 43 = 11 THEN ['no user_id'] ELSE [] END AS reasons FROM documents)"""
FINALS["load_quarantine"] = _union(
    f"""SELECT '{job}' AS job, reason AS what, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM {_DIRTY}) GROUP BY reason
        UNION ALL SELECT '{job}', 'review', count(*) FROM documents WHERE length(text) > 0
        UNION ALL SELECT '{job}', 'ids', count(DISTINCT doc_id) FROM documents WHERE length(text) > 0"""
    for job in ("load", "ingest")
)
FINALS["load_equals_ingest"] = _union(
    f"SELECT '{t}' AS table_name, count(*) AS n, CAST(0 AS BIGINT) AS differing FROM {_SOURCE.get(t, t)}" for t in _TABLES
)
FINALS["load_cut_feed"] = """SELECT CAST(doc_id AS VARCHAR) AS review_id, 'u' || (doc_id % 500) AS user_id, source AS business_id,
    CAST(1 + doc_id % 5 AS DOUBLE) AS stars, text FROM documents"""
FINALS["ingest_files"] = _union(
    f"""SELECT '{feed}' AS script_name, CAST(no AS BIGINT) AS processed_file, CAST({files} AS BIGINT) AS next_file,
        '{feed}/x' || lpad('{files}', 2, '0') AS file_name FROM range({files}) AS r(no)""" for feed, files in (("checkin", 12), ("user", 7))
)
_FIRST_HALF = "(SELECT * FROM user_feed WHERE (length(name) + review_count) % 2 = 0)"
FINALS["ingest_half_batch"] = _union(
    f"SELECT '{moment}' AS moment, '{table}' AS table_name, count(*) AS n FROM (" + CTES[cte].replace("user_feed", source) + ")"
    for moment, source in (("before", _FIRST_HALF), ("during", _FIRST_HALF), ("after", "user_feed"))
    for table, cte in (("user", "users"), ("user_elite", "user_elite"), ("user_friend", "user_friend"))
)


def _lengths() -> str:
    return _union(
        _check("length", t, c, f"count(*) FILTER (length({c}) > {limit})", _SOURCE.get(t, t))
        for t in _TABLES for c, limit in TABLES[t].max_length.items()
    )


FINALS["dq_length"] = _lengths()
FINALS["dq_table_report"] = _union([
    FINALS["dq_row_counts"],
    _lengths(),
    *(_nulls(t, c, _SOURCE.get(t, t)) for t in _TABLES for c in TABLES[t].not_null),
    *(_check("domain", t, "sentiment", "count(*) FILTER (sentiment NOT IN ('POSITIVE', 'NEGATIVE', 'NEUTRAL'))", t)
      for t in ("review", "tip")),
])
FINALS["dq_write_report"] = FINALS["dq_table_report"]


def oracle_sql() -> dict[str, str]:
    return {name: query(final) for name, final in FINALS.items()}
