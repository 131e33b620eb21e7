"""The registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions.columns import file_label, hash_id, month_label, parse_ts
from bizlens.functions.text import tokens
from bizlens.operators import clean, quality
from bizlens.operators.expand import explode_list
from bizlens.operators.joins import estimated_bytes, runtime_join
from bizlens.operators.sentiment import score_sentiment
from bizlens.operators.words import drop_stop_words, keep_valid_words, lemmatize, token_rows
from bizlens.plans import insights, marts
from bizlens.schemas import FEED_TABLES
from bizlens.session import new_folder
from bizlens.sources import records
from bizlens.sources.commits import merge_batches
from bizlens.sources.feeds import good_records, quarantined, raw_records, read_feed
from bizlens.sources.tables import append_table, buckets_for, preview, read_tables, register, sql, write_bucketed, write_table
from bizlens.streaming.ingest import FeedLoader, ingest_all, next_file, read_ledger
from checks.standins import (
    BUSINESS, STANDIN_RULES, Standins, cut_by_bytes, dirty_review_lines, given, given_texts, review_lines, standins, write_labelled,
)

FEED_FILES = 12

Query = Callable[[Standins], DataFrame]
REGISTRY: dict[str, Query] = {}


def registered(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def dated(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that two engines compare equal."""
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))


def staged_reviews(s: Standins) -> DataFrame:
    return marts.review_staging(s.feed("review"))


def review_facts(s: Standins) -> DataFrame:
    """The written review table without the label."""
    return s.table("review").drop("sentiment")


def write_feed(df: DataFrame, path: str) -> None:
    """Write a feed as ``FEED_FILES`` files at most, so that a larger feed has larger batches and not more of them."""
    df.coalesce(FEED_FILES).write.json(path)


def in_small_parts(s: Standins, reviews: DataFrame) -> DataFrame:
    """Reviews dealt over a task for each 16 MB of stored documents at most, since a task that counts words per review holds nearly all of its words."""
    stored = estimated_bytes(given(s.spark, s.sf_dir, "documents"))
    return reviews.repartition(max(s.spark.sparkContext.defaultParallelism, -(-stored // (16 << 20))), "review_id", "text")


# sources and sinks


@registered
def src_json_roundtrip(s: Standins) -> DataFrame:
    path = new_folder(s.spark, "review-json")
    s.feed("review").write.json(path)
    return good_records(read_feed(s.spark, "review", path))


@registered
def src_csv_roundtrip(s: Standins) -> DataFrame:
    path = new_folder(s.spark, "checkin-csv")
    s.feed("checkin").write.option("header", True).option("escape", '"').csv(path)
    return good_records(read_feed(s.spark, "checkin", path, "csv"))


@registered
def sink_parquet_roundtrip(s: Standins) -> DataFrame:
    return dated(write_table(staged_reviews(s), new_folder(s.spark, "review-parquet")))


@registered
def sink_append(s: Standins) -> DataFrame:
    path = new_folder(s.spark, "category-append")
    categories = s.plan("business_category")
    append_table(categories, "business_category", path)
    both = append_table(categories, "business_category", path)
    return both.groupBy("business_id", "category").agg(F.count(F.lit(1)).alias("copies"))


@registered
def sink_bucketed_join(s: Standins) -> DataFrame:
    root = new_folder(s.spark, "bucketed")
    name = f"b_{root[-32:]}"
    ids = s.table("review").select("review_id", "business_id")
    buckets = buckets_for(ids, s.table("review_text"))
    reviews = write_bucketed(ids, f"{name}_review", f"{root}/review", "review_id", buckets)
    words = write_bucketed(s.table("review_text"), f"{name}_words", f"{root}/words", "review_id", buckets)
    return insights.top_words(reviews, words)


@registered
def limit_preview(s: Standins) -> DataFrame:
    return dated(preview(staged_reviews(s).select("review_id", "user_id", "date"), 2, ["review_id"]))


@registered
def sql_view_query(s: Standins) -> DataFrame:
    """How long the words of poor and of fair reviews are, all businesses but one."""
    register(s.tables("review", "review_text"))
    return sql(
        s.spark,
        """
        select case when stars < 3 then 'poor' else 'fair' end as verdict, length(word) as letters, count(*) as said
        from review_text join review using (review_id)
        where business_id <> :without
        group by verdict, letters
        order by 1, 2
        """,
        without=BUSINESS,
    )


# cleaning


@registered
def clean_business(s: Standins) -> DataFrame:
    return clean.open_businesses(s.feed("business"))


@registered
def clean_keys(s: Standins) -> DataFrame:
    keys = {"business": "business_id", "checkin": "business_id", "review": "review_id", "user": "user_id"}
    counts = [
        clean.with_keys(s.feed(feed).select(key), key).agg(F.count(F.lit(1)).alias("n")).select(F.lit(feed).alias("feed"), "n")
        for feed, key in keys.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@registered
def clean_text(s: Standins) -> DataFrame:
    return clean.with_text(s.feed("review")).select("review_id", "user_id", "text")


# functions


@registered
def fn_lower_length(s: Standins) -> DataFrame:
    return given(s.spark, s.sf_dir, "documents").select(
        "doc_id", F.lower("text").alias("lowered"), F.length("text").alias("n")
    )


@registered
def fn_parse_ts(s: Standins) -> DataFrame:
    no = F.col("event_id")
    date = (
        F.when(no % 7 == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(no % 7 == 3, "soon")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    both = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")
    shown = "yyyy-MM-dd HH:mm:ss"
    return given(s.spark, s.sf_dir, "events").select(
        "event_id",
        F.date_format(parse_ts(date), shown).alias("strict"),
        F.date_format(parse_ts(date, both), shown).alias("lenient"),
    )


@registered
def fn_date_parts(s: Standins) -> DataFrame:
    return given(s.spark, s.sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )


@registered
def fn_month_label(s: Standins) -> DataFrame:
    orders = given(s.spark, s.sf_dir, "orders")
    label = month_label(F.year("o_orderdate"), F.month("o_orderdate"))
    return orders.groupBy(label.alias("time")).agg(F.count(F.lit(1)).alias("count"))


@registered
def fn_file_label(s: Standins) -> DataFrame:
    return given(s.spark, s.sf_dir, "orders").select(
        "o_orderkey", file_label(F.col("o_orderkey") % 150).alias("label")
    )


@registered
def fn_stable_id(s: Standins) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    return given(s.spark, s.sf_dir, "conversations").select(
        hash_id(conv, turn, F.col("text")).alias("id"), "conv_id", "turn",
        hash_id(conv, turn, F.lit("")).alias("id_of_empty"), hash_id(conv, turn, F.lit(None).cast("string")).alias("id_of_null"),
    )


@registered
def explode_delimited(s: Standins) -> DataFrame:
    events = given(s.spark, s.sf_dir, "events").select("event_id", "ts")
    no = F.col("event_id")
    first = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    second = F.date_format(F.col("ts") + F.expr("interval 40 days"), "yyyy-MM-dd HH:mm:ss")
    lists = events.select(
        "event_id",
        F.when(no % 41 == 0, F.lit(None))
        .when(no % 97 == 1, F.concat(first, F.lit(", 2016-03-09")))
        .when(no % 3 == 0, F.concat(first, F.lit(", "), second))
        .otherwise(first)
        .alias("date"),
    )
    return explode_list(lists, "event_id", "date", "piece")


# words


@registered
def text_tokens(s: Standins) -> DataFrame:
    documents = given_texts(s.spark, s.sf_dir, "documents", "doc_id")
    return documents.select("doc_id", F.concat_ws(" ", tokens(F.lower("text"))).alias("tokens"))


@registered
def text_lemmas(s: Standins) -> DataFrame:
    words = token_rows(staged_reviews(s), "review_id").select(F.col("word").alias("form"), "word")
    changed = lemmatize(words, s.lookup("forms")).filter(F.col("form") != F.col("word"))
    return changed.groupBy("form", F.col("word").alias("lemma")).agg(F.count(F.lit(1)).alias("n"))


@registered
def text_stopwords(s: Standins) -> DataFrame:
    words = drop_stop_words(token_rows(in_small_parts(s, staged_reviews(s)), "review_id"))
    return words.groupBy("review_id", "word").agg(F.count(F.lit(1)).alias("n"))


@registered
def text_valid_words(s: Standins) -> DataFrame:
    words = keep_valid_words(token_rows(staged_reviews(s), "review_id"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@registered
def text_words(s: Standins) -> DataFrame:
    return s.plan("review_text").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# sentiment


@registered
def sent_lexicon_score(s: Standins) -> DataFrame:
    scored = score_sentiment(staged_reviews(s), s.lookup("lexicon"), STANDIN_RULES)
    return scored.select("review_id", "score")


@registered
def sent_by_join(s: Standins) -> DataFrame:
    """The same scores with the lexicon joined, as one too large for the plan would be."""
    return score_sentiment(staged_reviews(s), s.lookup("lexicon"), STANDIN_RULES, by_join=True).select("review_id", "score")


@registered
def sent_label(s: Standins) -> DataFrame:
    return s.plan("review").groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


# tables


def _mart(name: str) -> Query:
    def table(s: Standins) -> DataFrame:
        df = s.plan(name)
        return dated(df) if "date" in df.columns else df

    return table


for _name in ("business", "business_category", "checkin", "user", "user_elite", "user_friend",
              "review", "review_text", "tip", "tip_text"):
    REGISTRY[f"mart_{_name}"] = _mart(_name)


# joins


@registered
def join_inner_words(s: Standins) -> DataFrame:
    words, reviews = s.table("review_text"), s.table("review").select("review_id", "stars")
    return words.join(reviews, "review_id")


@registered
def join_elite_friend(s: Standins) -> DataFrame:
    return s.table("user_elite").join(s.table("user_friend"), "user_id")


@registered
def join_semi_elite(s: Standins) -> DataFrame:
    reviews = s.table("review").select("review_id", "user_id")
    return runtime_join(reviews, insights.elite_in(s.table("user_elite")), "user_id", "left_semi").select("review_id", "user_id")


@registered
def join_semi_friend(s: Standins) -> DataFrame:
    reviews = s.table("review").select("review_id", "user_id")
    friends = insights.friends_of_elite(s.table("user_elite"), s.table("user_friend"))
    return runtime_join(reviews, friends, "user_id", "left_semi").select("review_id", "user_id")


@registered
def join_semi_nested(s: Standins) -> DataFrame:
    reviews = s.table("review").select("review_id", "business_id")
    peers = insights.category_peers(s.table("business_category"), BUSINESS)
    return runtime_join(reviews, peers, "business_id", "left_semi").select("review_id", "business_id")


# insights: about one business, and about all of them


def _both(name: str, ask: Callable[[Standins, str | None], DataFrame]) -> None:
    REGISTRY[f"ins_{name}"] = partial(lambda s, ask: ask(s, BUSINESS), ask=ask)
    REGISTRY[f"ins_{name}_all"] = partial(lambda s, ask: ask(s, None), ask=ask)


def _rating(s: Standins, business: str | None) -> DataFrame:
    out = insights.average_rating(review_facts(s), business)
    return out.withColumn("avg_stars", F.round("avg_stars", 6))


def _by_sentiment(s: Standins, business: str | None) -> DataFrame:
    parts = [
        insights.top_words(s.table("review"), s.table("review_text"), business, sentiment).withColumn("sentiment", F.lit(sentiment))
        for sentiment in ("POSITIVE", "NEGATIVE")
    ]
    return parts[0].unionByName(parts[1])


_both("avg_rating", _rating)
_both("review_trend", lambda s, b: insights.review_trend(review_facts(s), b))
_both(
    "elite_circle_trend",
    lambda s, b: insights.elite_circle_trend(review_facts(s), s.table("user_elite"), s.table("user_friend"), b),
)
_both("checkin_trend", lambda s, b: insights.checkin_trend(s.table("checkin"), b))
_both("recent_reviews", lambda s, b: dated(insights.recent_reviews(review_facts(s), b)))
_both(
    "recent_elite_reviews",
    lambda s, b: dated(insights.recent_elite_reviews(review_facts(s), s.table("user_elite"), b)),
)
_both("top_words", lambda s, b: insights.top_words(s.table("review"), s.table("review_text"), b))
_both("top_words_by_sentiment", _by_sentiment)


@registered
def ins_elite_circle_trend_any(s: Standins) -> DataFrame:
    return insights.elite_circle_trend(
        review_facts(s), s.table("user_elite"), s.table("user_friend"), BUSINESS, mode="any"
    )


@registered
def ins_category_words(s: Standins) -> DataFrame:
    return insights.category_words(s.table("review"), s.table("review_text"), s.table("business_category"), BUSINESS)


# quality


@registered
def dq_nulls(s: Standins) -> DataFrame:
    pairs = [
        ("business", "name"), ("business_category", "category"), ("review", "date"), ("review_text", "word"),
        ("tip", "date"), ("tip_text", "word"), ("checkin", "date"), ("user", "user_id"), ("user_elite", "year"),
        ("user_friend", "friend_id"),
    ]
    return quality.null_counts(s.tables(*dict(pairs)), pairs)


@registered
def dq_domain(s: Standins) -> DataFrame:
    return quality.domain_counts(s.tables("review", "tip"), allowed=("POSITIVE", "NEUTRAL"))


_ALL_TABLES = ("business", "business_category", "review", "review_text", "tip", "tip_text", "checkin",
               "user", "user_elite", "user_friend")


@registered
def dq_row_counts(s: Standins) -> DataFrame:
    return quality.row_counts(s.tables(*_ALL_TABLES))


@registered
def dq_missing_text(s: Standins) -> DataFrame:
    return quality.missing_text({name: s.feed(name) for name in ("review", "tip")})


@registered
def dq_closed_count(s: Standins) -> DataFrame:
    return quality.closed_businesses(s.feed("business"))


@registered
def dq_duplicate_keys(s: Standins) -> DataFrame:
    return quality.duplicate_keys(s.tables("business", "review", "tip", "user"))


@registered
def dq_orphans(s: Standins) -> DataFrame:
    return quality.orphans(s.tables(*_ALL_TABLES))


@registered
def dq_length(s: Standins) -> DataFrame:
    return quality.too_long(s.tables(*_ALL_TABLES))


@registered
def dq_table_report(s: Standins) -> DataFrame:
    return quality.table_report(s.tables(*_ALL_TABLES))


@registered
def dq_quarantine(s: Standins) -> DataFrame:
    """Every 59th record is cut in half; good and broken records are counted, the broken ones kept."""
    root = new_folder(s.spark, "review-broken")
    documents = given_texts(s.spark, s.sf_dir, "documents", "doc_id").select("doc_id", "source", "text")
    orders = given(s.spark, s.sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = documents.join(orders, F.col("doc_id") == F.col("o_orderkey"))
    record = F.struct(
        F.when(F.col("doc_id") % 61 != 7, F.col("doc_id").cast("string")).alias("review_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("source").alias("business_id"),
        "text",
    )
    lines = joined.select("doc_id", F.to_json(record).alias("line"))
    cut = F.when(F.col("doc_id") % 59 == 0, F.expr("left(line, length(line) div 2)")).otherwise(F.col("line"))
    lines.select(cut.alias("value")).write.text(f"{root}/in")
    feed = read_feed(s.spark, "review", f"{root}/in")
    kept = write_table(quarantined(feed), f"{root}/quarantine")
    report = quality.broken_records({"review": feed}, {"review": "review_id"}).select("column", "n")
    return report.unionByName(kept.agg(F.count("_corrupt_record").alias("n")).select(F.lit("quarantine").alias("column"), "n"))


# incremental loading


@registered
def ingest_next_file(s: Standins) -> DataFrame:
    documents = given(s.spark, s.sf_dir, "documents")
    ledger = documents.filter(~F.col("source").isin("src1", "src2")).select(
        F.col("source").alias("script_name"), (F.col("n_chars") % 120).alias("processed_file")
    )
    return next_file(ledger, documents.select(F.col("source").alias("script_name")))


@registered
def ingest_ledger(s: Standins) -> DataFrame:
    """All feeds as JSON files, loaded by streams; rows per table of the result."""
    root = new_folder(s.spark, "ingest")
    paths = {}
    for name in FEED_TABLES:
        paths[name] = f"{root}/in/{name}"
        write_feed(s.feed(name), paths[name])
    ingest_all(
        s.spark, paths, f"{root}/out", f"{root}/checkpoints", files_per_batch=8,
        lexicon=s.lookup("lexicon"), forms=s.lookup("forms"), rules=STANDIN_RULES,
    )
    loaded = read_tables(s.spark, f"{root}/out", [t for names in FEED_TABLES.values() for t in names])
    ledger = read_ledger(s.spark, f"{root}/out").select("script_name").distinct()
    counts = None
    for feed, names in FEED_TABLES.items():
        for table in names:
            one = loaded[table].agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(feed).alias("script_name"), F.lit(table).alias("table_name"), "n"
            )
            counts = one if counts is None else counts.unionByName(one)
    return counts.join(ledger, "script_name", "left_semi")


def _count(df: DataFrame, **labels: str) -> DataFrame:
    """One row: the labels and the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n")).select(*[F.lit(v).alias(k) for k, v in labels.items()], "n")


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@registered
def load_quarantine(s: Standins) -> DataFrame:
    """Reviews with broken lines, loaded as a whole and by batches: rejected records by reason, and rows of the table."""
    root = new_folder(s.spark, "dirty")
    lines = dirty_review_lines(s.spark, s.sf_dir)
    write_labelled(lines.select((F.col("doc_id") % 6).alias("no"), "value"), f"{root}/in")
    marts.write_all({"review": records.read_records(s.spark, "review", f"{root}/in")}, f"{root}/load", lexicon=s.lookup("lexicon"), rules=STANDIN_RULES)
    ingest_all(s.spark, {"review": f"{root}/in/x*"}, f"{root}/ingest", f"{root}/cp", files_per_batch=4, lexicon=s.lookup("lexicon"), rules=STANDIN_RULES)
    parts = []
    for job in ("load", "ingest"):
        lost = quality.quarantine_counts({"review": records.quarantine(s.spark, f"{root}/{job}", "review")})
        parts.append(lost.select(F.lit(job).alias("job"), F.col("column").alias("what"), "n"))
        table = read_tables(s.spark, f"{root}/{job}", ["review"])["review"]
        parts.append(_count(table, job=job, what="review"))
        parts.append(_count(table.select("review_id").distinct(), job=job, what="ids"))
    return _stack(parts)


@registered
def load_equals_ingest(s: Standins) -> DataFrame:
    """All feeds as files, loaded as a whole and by batches that are merged: rows of each table, and rows that only one has."""
    root = new_folder(s.spark, "twice")
    names = [t for tables in FEED_TABLES.values() for t in tables]
    paths = {name: f"{root}/in/{name}" for name in FEED_TABLES}
    for name, path in paths.items():
        write_feed(s.feed(name), path)
    lookups = {"lexicon": s.lookup("lexicon"), "forms": s.lookup("forms"), "rules": STANDIN_RULES}
    marts.write_all({name: records.read_records(s.spark, name, path) for name, path in paths.items()}, f"{root}/load", **lookups)
    ingest_all(s.spark, paths, f"{root}/ingest", f"{root}/cp", files_per_batch=3, **lookups)
    for name in FEED_TABLES:
        merge_batches(s.spark, f"{root}/ingest", name)
    loaded, added = (read_tables(s.spark, f"{root}/{job}", names) for job in ("load", "ingest"))
    counts = []
    for name in names:
        both = loaded[name].withColumn("_load", F.lit(1)).unionByName(added[name].withColumn("_load", F.lit(-1)))
        each = both.groupBy(*loaded[name].columns).agg(F.sum("_load").alias("d"), F.count_if(F.col("_load") == 1).alias("n"))
        sums = [F.coalesce(F.sum(x), F.lit(0)).alias(c) for c, x in (("n", F.col("n")), ("differing", F.abs("d")))]
        counts.append(each.agg(*sums).select(F.lit(name).alias("table_name"), "n", "differing"))
    return _stack(counts)


@registered
def load_cut_feed(s: Standins) -> DataFrame:
    """A feed cut into files at arbitrary bytes: every record comes back, and nothing stays in quarantine."""
    root = new_folder(s.spark, "cut")
    write_labelled(cut_by_bytes(review_lines(s.spark, s.sf_dir)), f"{root}/in")
    found = records.stage(records.read_records(s.spark, "review", f"{root}/in"), "review", root)
    lost = records.quarantine(s.spark, root, "review")
    return _stack([df.select("review_id", "user_id", "business_id", "stars", "text") for df in (found, lost)])


@registered
def ingest_files(s: Standins) -> DataFrame:
    """Check-ins in twelve files and users in seven, several files a batch: the ledger, and the next file of each feed."""
    root = new_folder(s.spark, "labelled")
    for feed, files in (("checkin", 12), ("user", 7)):
        value, no = F.to_json(F.struct("*")), F.abs(F.hash("*")) % files
        write_labelled(s.feed(feed).select(no.alias("no"), value.alias("value")), f"{root}/in/{feed}")
    ingest_all(s.spark, {feed: f"{root}/in/{feed}/x*" for feed in ("checkin", "user")}, f"{root}/out", f"{root}/cp", files_per_batch=5)
    ledger = read_ledger(s.spark, f"{root}/out")
    return ledger.select("script_name", "processed_file").join(next_file(ledger, ledger), "script_name")


class _StopsHalfWay(FeedLoader):
    """Fails after the first of the tables."""

    def write(self, df: DataFrame, dataset: str, folder: str) -> DataFrame:
        if dataset == "user_elite":
            raise InterruptedError(dataset)
        return super().write(df, dataset, folder)


@registered
def ingest_half_batch(s: Standins) -> DataFrame:
    """Rows that a reader sees before, during and after a second batch, which fails between two tables and runs again."""
    root = new_folder(s.spark, "half")
    value = F.to_json(F.struct("*")).alias("value")
    write_labelled(s.feed("user").select((F.length("name") + F.col("review_count")) % 2, value).toDF("no", "value"), f"{root}/in")
    batches = [raw_records(s.spark.read, "user", f"{root}/in/x0{k}") for k in (0, 1)]
    load, seen = FeedLoader("user", f"{root}/out"), []

    def look(moment: str) -> None:
        tables = read_tables(s.spark, f"{root}/out", FEED_TABLES["user"])
        seen.extend(_count(df, moment=moment, table_name=name) for name, df in tables.items())

    load(batches[0], 0)
    look("before")
    try:
        _StopsHalfWay("user", f"{root}/out")(batches[1], 1)
    except InterruptedError:
        look("during")
    load(batches[1], 1)
    look("after")
    return _stack(seen)


@registered
def dq_write_report(s: Standins) -> DataFrame:
    """The checks of all tables, counted while a full load writes them."""
    counters = quality.WriteCounters()
    marts.write_all(
        {name: s.feed(name) for name in FEED_TABLES}, new_folder(s.spark, "counted"), forms=s.lookup("forms"), cluster=True,
        counters=counters, lexicon=s.lookup("lexicon"), rules=STANDIN_RULES,
    )
    return counters.report(s.spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(standins(spark, sf_dir))

    return {name: bound(query) for name, query in REGISTRY.items()}
