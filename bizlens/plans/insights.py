"""Dashboard questions about one business, or about every business at once.

Each function takes tables and ``business_id``; with ``business_id=None`` the same question is
answered for all businesses and the result has a ``business_id`` column in front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.columns import month_label, year_number
from bizlens.operators.joins import runtime_join, top_k

# The dashboard's cut-offs and its elite year.
MONTHS, REVIEWS, WORDS, ELITE_YEAR = 10, 5, 5, 2018


def _of(df: DataFrame, business_id: str | None) -> DataFrame:
    return df if business_id is None else df.filter(F.col("business_id") == F.lit(business_id))


def _group(business_id: str | None) -> list[str]:
    return ["business_id"] if business_id is None else []


def average_rating(review: DataFrame, business_id: str | None = None) -> DataFrame:
    """Mean stars; null for a business without reviews."""
    return _of(review, business_id).groupBy(*_group(business_id)).agg(F.avg("stars").alias("avg_stars"))


def _latest_months(monthly: DataFrame, group: list[str], months: int) -> DataFrame:
    """The latest months that have rows, oldest first, labelled year/month."""
    latest = top_k(monthly, [F.desc("year"), F.desc("month")], months, within=group)
    return latest.orderBy(*group, "year", "month").select(*group, month_label("year", "month").alias("time"), "count")


def monthly_counts(events: DataFrame, by: list[str]) -> DataFrame:
    dated = events.filter(F.col("date").isNotNull())
    return dated.groupBy(*by, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.count(F.lit(1)).alias("count")
    )


def review_trend(review: DataFrame, business_id: str | None = None, months: int = MONTHS) -> DataFrame:
    group = _group(business_id)
    return _latest_months(monthly_counts(_of(review, business_id), group), group, months)


def checkin_trend(checkin: DataFrame, business_id: str | None = None, months: int = MONTHS) -> DataFrame:
    return review_trend(checkin, business_id, months)


def elite_in(user_elite: DataFrame, year: int = ELITE_YEAR) -> DataFrame:
    """Users who were elite in a year; also reads a year stored as text."""
    return user_elite.filter(year_number("year") == year).select("user_id").distinct()


def friends_of_elite(user_elite: DataFrame, user_friend: DataFrame, year: int = ELITE_YEAR) -> DataFrame:
    """Users whom an elite user of that year lists as a friend."""
    edges = runtime_join(user_friend, elite_in(user_elite, year), "user_id", "left_semi")
    return edges.select(F.col("friend_id").alias("user_id")).distinct()


def elite_circle_trend(
    review: DataFrame,
    user_elite: DataFrame,
    user_friend: DataFrame,
    business_id: str | None = None,
    year: int = ELITE_YEAR,
    months: int = MONTHS,
    mode: str = "all",
) -> DataFrame:
    """Monthly reviews by users who are elite and also a friend of an elite user (``mode="all"``),
    or either of the two (``mode="any"``).

    Reviews are counted per user before the joins, so a very active reviewer reaches them as a few
    rows.
    """
    group = _group(business_id)
    per_user = monthly_counts(_of(review, business_id), [*group, "user_id"])
    elite = elite_in(user_elite, year)
    friends = friends_of_elite(user_elite, user_friend, year)
    if mode == "any":
        kept = runtime_join(per_user, elite.unionByName(friends).distinct(), "user_id", "left_semi")
    elif mode == "all":
        kept = runtime_join(runtime_join(per_user, elite, "user_id", "left_semi"), friends, "user_id", "left_semi")
    else:
        raise ValueError("mode is 'all' or 'any'")
    monthly = kept.groupBy(*group, "year", "month").agg(F.sum("count").alias("count"))
    return _latest_months(monthly, group, months)


def recent_reviews(review: DataFrame, business_id: str | None = None, k: int = REVIEWS) -> DataFrame:
    group = _group(business_id)
    latest = top_k(_of(review, business_id), [F.desc_nulls_last("date"), F.asc("review_id")], k, within=group)
    return latest.select(*group, "review_id", "date", "stars", "text")


def recent_elite_reviews(
    review: DataFrame,
    user_elite: DataFrame,
    business_id: str | None = None,
    year: int = ELITE_YEAR,
    k: int = REVIEWS,
) -> DataFrame:
    by_elite = runtime_join(_of(review, business_id), elite_in(user_elite, year), "user_id", "left_semi")
    return recent_reviews(by_elite, business_id, k)


def word_counts(reviews: DataFrame, review_text: DataFrame, group: list[str], selective: bool) -> DataFrame:
    """How often each word occurs in the given reviews, per group.

    Reviews are folded to one weighted row per id first, so repeated review rows cannot multiply
    the word rows. A selective review side cuts the words down while the query runs; otherwise both
    sides are facts and meet on their id, without a shuffle when both are bucketed by it.
    """
    weighted = reviews.groupBy(*group, "review_id").agg(F.count(F.lit(1)).alias("_weight")).filter("_weight > 0")
    if selective:
        joined = runtime_join(review_text, weighted, "review_id")
    else:
        joined = review_text.join(weighted, "review_id")
    return joined.groupBy(*group, "word").agg(F.sum("_weight").alias("count"))


def top_words(
    review: DataFrame,
    review_text: DataFrame,
    business_id: str | None = None,
    sentiment: str | None = None,
    k: int = WORDS,
) -> DataFrame:
    """Most frequent words, optionally only from reviews with one sentiment label."""
    group = _group(business_id)
    reviews = _of(review, business_id)
    if sentiment is not None:
        reviews = reviews.filter(F.col("sentiment") == F.lit(sentiment))
    counts = word_counts(reviews, review_text, group, selective=business_id is not None)
    return top_k(counts, [F.desc("count"), F.asc("word")], k, within=group).select(*group, "word", "count")


def category_peers(business_category: DataFrame, business_id: str) -> DataFrame:
    """Other businesses that share at least one category with the given one, each once."""
    own = business_category.filter(F.col("business_id") == F.lit(business_id)).select("category").distinct()
    others = business_category.filter(F.col("business_id") != F.lit(business_id))
    return runtime_join(others, own, "category", "left_semi").select("business_id").distinct()


def category_words(
    review: DataFrame,
    review_text: DataFrame,
    business_category: DataFrame,
    business_id: str,
    k: int = WORDS,
) -> DataFrame:
    """Most frequent words among the peers of one business."""
    peers = category_peers(business_category, business_id)
    reviews = runtime_join(review.select("business_id", "review_id"), peers, "business_id", "left_semi")
    counts = word_counts(reviews, review_text, [], selective=True)
    return top_k(counts, [F.desc("count"), F.asc("word")], k).select("word", "count")
