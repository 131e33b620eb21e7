import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from bizlens.operators.joins import runtime_join
from bizlens.plans import insights
from tests.conftest import plan, rows

SCHEMA = "review_id string, user_id string, business_id string, stars double, date timestamp, text string, sentiment string"


def day(year, month, d=1):
    return dt.datetime(year, month, d)


@pytest.fixture
def reviews(spark):
    data = [(f"r{m:02}", "both", "b1", 4.0, day(2018, m), "t", "POSITIVE") for m in range(1, 13)]
    data += [
        ("x1", "elite", "b1", 2.0, day(2018, 1, 5), "t", "NEGATIVE"),
        ("x2", "friend", "b1", 1.0, day(2018, 12, 6), "t", "NEUTRAL"),
        ("x3", "both", "b1", None, None, "t", "NEUTRAL"),
        ("y1", "nobody", "b2", 3.0, day(2017, 3), "t", "POSITIVE"),
        ("y2", "both", "b3", 3.0, day(2017, 4), "t", "NEGATIVE"),
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def elite(spark):
    return spark.createDataFrame([("both", 2018), ("elite", 2018), ("both", 2017), ("old", 2010)], "user_id string, year int")


@pytest.fixture
def friend(spark):
    return spark.createDataFrame([("elite", "both"), ("elite", "friend"), ("both", "both"), ("old", "nobody")], "user_id string, friend_id string")


@pytest.fixture
def words(spark):
    data = [("r01", "taco")] * 3 + [("r01", "salsa")] * 2 + [("x1", "burger")] * 3 + [("x1", "apple")] * 2
    data += [("r02", w) for w in ("one", "two", "six")] + [("y1", "beer")] * 2 + [("y1", "apple"), ("y2", "wine"), ("zz", "lost")]
    return spark.createDataFrame(data, "review_id string, word string")


def test_average_rating(reviews):
    assert insights.average_rating(reviews, "b2").first()[0] == 3.0
    assert insights.average_rating(reviews, "none").collect() == [(None,)]
    every = dict(rows(insights.average_rating(reviews)))
    assert every["b1"] == pytest.approx(51 / 14)


def test_trend_keeps_latest_ten_months_ascending(reviews):
    found = [tuple(r) for r in insights.review_trend(reviews, "b1").collect()]
    assert found == [(f"2018/{m}", 1) for m in range(3, 12)] + [("2018/12", 2)]


@pytest.mark.parametrize("filter_from", [10**99, 0])
def test_elite_circle(reviews, elite, friend, filter_from, monkeypatch):
    monkeypatch.setattr(insights, "runtime_join", partial(runtime_join, filter_from=filter_from))
    only_both = insights.elite_circle_trend(reviews, elite, friend, "b1", months=99)
    assert sum(r["count"] for r in only_both.collect()) == 12
    either = insights.elite_circle_trend(reviews, elite, friend, "b1", months=99, mode="any")
    assert sum(r["count"] for r in either.collect()) == 14
    with pytest.raises(ValueError):
        insights.elite_circle_trend(reviews, elite, friend, mode="none")


def test_elite_year_may_be_text(spark):
    textual = spark.createDataFrame([("u1", "2018"), ("u2", "None"), ("u3", "2017")], "user_id string, year string")
    assert rows(insights.elite_in(textual)) == [("u1",)]


def test_recent_reviews(reviews, elite):
    assert [r["review_id"] for r in insights.recent_reviews(reviews, "b1").collect()] == ["x2", "r12", "r11", "r10", "r09"]
    by_elite = insights.recent_elite_reviews(reviews, elite, "b1", k=20)
    found = [r["review_id"] for r in by_elite.collect()]
    assert len(found) == 14 and "x2" not in found and found[-1] == "x3"


def test_top_words_and_ties(reviews, words):
    assert [tuple(r) for r in insights.top_words(reviews, words, "b1").collect()] == [
        ("burger", 3), ("taco", 3), ("apple", 2), ("salsa", 2), ("one", 1),
    ]
    positive = insights.top_words(reviews, words, "b1", sentiment="POSITIVE", k=2)
    assert [tuple(r) for r in positive.collect()] == [("taco", 3), ("salsa", 2)]


def test_repeated_review_rows_count_as_in_a_plain_join(reviews, words):
    twice = reviews.unionByName(reviews.filter("review_id = 'r01'"))
    plain = twice.join(words, "review_id").filter("business_id = 'b1'").groupBy("word").count()
    found = insights.top_words(twice, words, "b1", k=99)
    assert rows(found) == rows(plain)
    every = insights.top_words(twice, words, k=99)
    assert rows(every) == rows(twice.join(words, "review_id").groupBy("business_id", "word").count())


@pytest.mark.parametrize("question", [
    lambda r, e, f, w, b: insights.average_rating(r, b),
    lambda r, e, f, w, b: insights.review_trend(r, b),
    lambda r, e, f, w, b: insights.elite_circle_trend(r, e, f, b),
    lambda r, e, f, w, b: insights.recent_reviews(r, b),
    lambda r, e, f, w, b: insights.recent_elite_reviews(r, e, b),
    lambda r, e, f, w, b: insights.top_words(r, w, b),
    lambda r, e, f, w, b: insights.top_words(r, w, b, sentiment="NEGATIVE"),
])
def test_all_businesses_form_agrees_with_single_form(reviews, elite, friend, words, question):
    every = question(reviews, elite, friend, words, None)
    for business in ("b1", "b2", "b3"):
        single = question(reviews, elite, friend, words, business)
        assert rows(every.filter(F.col("business_id") == business).drop("business_id")) == rows(single)


def test_category_words(spark, reviews, words):
    category = spark.createDataFrame(
        [("b1", "Mexican"), ("b1", "Bars"), ("b2", "Mexican"), ("b2", "Bars"), ("b3", "Cafes")],
        "business_id string, category string",
    )
    assert rows(insights.category_peers(category, "b1")) == [("b2",)]
    assert [tuple(r) for r in insights.category_words(reviews, words, category, "b1").collect()] == [("beer", 2), ("apple", 1)]
    assert insights.category_words(reviews, words, category, "b3").collect() == []


def test_membership_is_planned_as_semi_join(reviews, elite, friend):
    shown = plan(insights.elite_circle_trend(reviews, elite, friend, "b1"))
    assert shown.count("LeftSemi") >= 3 and "NestedLoop" not in shown and "Cartesian" not in shown


def test_building_a_plan_starts_no_job(spark, reviews, elite, friend, words):
    category = spark.createDataFrame([("b1", "Mexican"), ("b2", "Mexican")], "business_id string, category string")
    spark.sparkContext.setJobGroup("planning", "plans only")
    try:
        insights.elite_circle_trend(reviews, elite, friend, "b1")
        insights.elite_circle_trend(reviews, elite, friend, "b1", mode="any")
        insights.recent_elite_reviews(reviews, elite)
        insights.top_words(reviews, words, "b1")
        insights.category_words(reviews, words, category, "b1")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
