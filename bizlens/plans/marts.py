"""The ten tables, each as a lazy plan over its feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.columns import TIMESTAMP_FORMAT, parse_ts, year_number
from bizlens.operators import clean
from bizlens.operators.expand import explode_list, with_stable_id
from bizlens.operators.quality import WriteCounters
from bizlens.operators.sentiment import Rules, label, score_sentiment
from bizlens.operators.words import word_table
from bizlens.schemas import FEED_TABLES
from bizlens.sources import records
from bizlens.sources.feeds import accepted
from bizlens.sources.tables import in_order, write_table

CLUSTERS = {
    "review": ("business_id", "review_id"),
    "tip": ("business_id", "tip_id"),
    "checkin": ("business_id", "date"),
}


def business(feed: DataFrame) -> DataFrame:
    return clean.open_businesses(feed).select(
        "business_id", "address", "city", "latitude", "longitude", "name", "postal_code", "state"
    )


def business_category(feed: DataFrame, drop_empty: bool = True) -> DataFrame:
    return explode_list(clean.open_businesses(feed), "business_id", "categories", "category", drop_empty)


def checkin(feed: DataFrame, formats: Sequence[str] = (TIMESTAMP_FORMAT,), cluster: bool = False) -> DataFrame:
    visits = explode_list(clean.with_keys(feed, "business_id"), "business_id", "date", "date", drop_empty=False)
    return in_order(visits.select("business_id", parse_ts("date", formats).alias("date")), CLUSTERS["checkin"] if cluster else ())


def user(feed: DataFrame) -> DataFrame:
    return clean.with_keys(feed, "user_id").select("user_id", "name")


def user_elite(feed: DataFrame) -> DataFrame:
    years = explode_list(clean.elite_users(feed), "user_id", "elite", "year")
    return years.withColumn("year", year_number("year")).filter(F.col("year").isNotNull())


def user_friend(feed: DataFrame) -> DataFrame:
    return explode_list(clean.elite_users_with_friends(feed), "user_id", "friends", "friend_id")


def _labelled(
    staged: DataFrame, columns: list[str], lexicon: DataFrame, rules: Rules, keep_score: bool
) -> DataFrame:
    scored = score_sentiment(staged, lexicon, rules, into="sa_score")
    out = scored.withColumn("sentiment", label("sa_score"))
    return out.select(*columns, "sentiment", *(["sa_score"] if keep_score else []))


def review_staging(feed: DataFrame, formats: Sequence[str] = (TIMESTAMP_FORMAT,)) -> DataFrame:
    return clean.with_text(clean.with_keys(feed, "review_id")).select(
        "review_id", "user_id", "business_id", "stars",
        parse_ts("date", formats).alias("date"),
        F.lower("text").alias("text"),
    )


def review(
    feed: DataFrame,
    lexicon: DataFrame,
    rules: Rules = Rules(),
    formats: Sequence[str] = (TIMESTAMP_FORMAT,),
    keep_score: bool = False,
    cluster: bool = False,
) -> DataFrame:
    """Reviews with their label; clustered rows are sorted before they are scored, so that each is scored once."""
    staged = in_order(review_staging(feed, formats), CLUSTERS["review"] if cluster else ())
    return _labelled(staged, staged.columns, lexicon, rules, keep_score)


def review_text(
    staged: DataFrame, forms: DataFrame | None = None, stop_words: DataFrame | None = None
) -> DataFrame:
    """Words per review; ``staged`` is the review table or its staging frame."""
    return word_table(staged, "review_id", forms, stop_words)


def tip_staging(
    feed: DataFrame, id_salt: str = "", formats: Sequence[str] = (TIMESTAMP_FORMAT,)
) -> DataFrame:
    return with_stable_id(clean.with_text(feed), "tip_id", id_salt).select(
        "tip_id", "user_id",
        parse_ts("date", formats).alias("date"),
        "business_id",
        F.lower("text").alias("text"),
    )


def tip(
    feed: DataFrame,
    lexicon: DataFrame,
    rules: Rules = Rules(),
    id_salt: str = "",
    formats: Sequence[str] = (TIMESTAMP_FORMAT,),
    keep_score: bool = False,
    cluster: bool = False,
) -> DataFrame:
    staged = in_order(tip_staging(feed, id_salt, formats), CLUSTERS["tip"] if cluster else ())
    return _labelled(staged, staged.columns, lexicon, rules, keep_score)


def tip_text(
    staged: DataFrame, forms: DataFrame | None = None, stop_words: DataFrame | None = None
) -> DataFrame:
    """Words per tip; ``staged`` is the tip table or its staging frame."""
    return word_table(staged, "tip_id", forms, stop_words)


WORD_TABLES = {"review": review_text, "tip": tip_text}


def feed_tables(
    name: str,
    feed: DataFrame,
    lexicon: DataFrame | None = None,
    rules: Rules = Rules(),
    id_salt: str = "",
    cluster: bool = False,
) -> dict[str, DataFrame]:
    """The tables one feed produces, as lazy plans; word tables are made from these by ``WORD_TABLES``.

    With ``cluster=True`` the rows of the tables in ``CLUSTERS`` are in that order.
    """
    if name not in FEED_TABLES:
        raise ValueError(f"unknown feed: {name}")
    feed = accepted(feed, name)
    if name == "business":
        return {"business": business(feed), "business_category": business_category(feed)}
    if name == "checkin":
        return {"checkin": checkin(feed, cluster=cluster)}
    if name == "user":
        return {"user": user(feed), "user_elite": user_elite(feed), "user_friend": user_friend(feed)}
    if lexicon is None:
        raise ValueError(f"the {name} feed needs a sentiment lexicon")
    if name == "review":
        return {"review": review(feed, lexicon, rules, cluster=cluster)}
    return {"tip": tip(feed, lexicon, rules, id_salt, cluster=cluster)}


def build_all(
    feeds: Mapping[str, DataFrame],
    forms: DataFrame | None = None,
    stop_words: DataFrame | None = None,
    **lookups,
) -> dict[str, DataFrame]:
    """All tables of the given feeds, as lazy plans."""
    tables: dict[str, DataFrame] = {}
    for name, feed in feeds.items():
        tables.update(feed_tables(name, feed, **lookups))
        if name in WORD_TABLES:
            tables[f"{name}_text"] = WORD_TABLES[name](tables[name], forms, stop_words)
    return tables


def write_all(
    feeds: Mapping[str, DataFrame],
    root: str,
    forms: DataFrame | None = None,
    stop_words: DataFrame | None = None,
    cluster: bool = False,
    counters: WriteCounters | None = None,
    **lookups,
) -> dict[str, DataFrame]:
    """Write all tables below ``root`` and return them as read back.

    With ``cluster=True`` reviews, tips and check-ins are sorted by business over all files: one
    shuffle at load time, before scoring, and questions about one business then read few row groups.

    The word tables are computed from the written review and tip tables, so each raw text is
    parsed, cleaned and lower-cased once, and nothing has to be cached.

    Every feed is read once, into the record store below ``<root>/records``; the tables are made from there, and records
    that no table can hold are read by ``records.quarantine``. ``counters`` takes the checks of the tables while they are written.
    """
    written: dict[str, DataFrame] = {}

    def write(table: str, df: DataFrame) -> None:
        df = df if counters is None else counters.watch(df, table)
        written[table] = write_table(df, f"{root}/{table}")

    for name, raw in feeds.items():
        for table, df in feed_tables(name, records.stage(raw, name, root), cluster=cluster, **lookups).items():
            write(table, df)
        if name in WORD_TABLES:
            write(f"{name}_text", WORD_TABLES[name](written[name], forms, stop_words))
    return written
