import pytest
from pyspark.sql import functions as F

from bizlens.operators.expand import explode_list, with_stable_id
from bizlens.operators.sentiment import Rules
from bizlens.plans import marts
from bizlens.schemas import TABLES
from tests.conftest import rows

USERS = [
    ("u1", "Ann", "u2, u3", "2017,2018"),
    ("u2", "Bob", "u1", ""),
    ("u3", "Cy", None, None),
    ("u4", "Di", "", "2018"),
    ("u5", "Ed", "u1,  u2", "None"),
    ("u6", "Flo", '["u1", "u2"]', "[2016, 2018]"),
    (None, "Nobody", "u1", "2018"),
]


@pytest.fixture
def users(spark):
    return spark.createDataFrame(USERS, "user_id string, name string, friends string, elite string")


def test_user_tables(users):
    assert len(rows(marts.user(users))) == 6
    assert rows(marts.user_elite(users)) == [("u1", 2017), ("u1", 2018), ("u4", 2018), ("u6", 2016), ("u6", 2018)]
    assert rows(marts.user_friend(users)) == [
        ("u1", "u2"), ("u1", "u3"), ("u5", "u1"), ("u5", "u2"), ("u6", "u1"), ("u6", "u2"),
    ]


def test_typed_arrays_need_no_split(spark):
    feed = spark.createDataFrame([("b1", 1, ["Bars", "", "Cafes"])], "business_id string, is_open int, categories array<string>")
    assert rows(marts.business_category(feed)) == [("b1", "Bars"), ("b1", "Cafes")]
    assert len(rows(marts.business_category(feed, drop_empty=False))) == 3


def test_lists_that_only_look_like_json(spark):
    lists = ["[Sic] Bar, Cafe", '["a", "b"', '["x, y", "z"]', " [1, 2]", "a,b , c", "[]", ""]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(lists)], "id string, items string")
    found = {}
    for key, item in rows(explode_list(df, "id", "items", "item")):
        found.setdefault(key, set()).add(item)
    assert found == {
        "0": {"[Sic] Bar", "Cafe"}, "1": {'["a"', '"b"'}, "2": {"x, y", "z"}, "3": {"1", "2"}, "4": {"a", "b", "c"},
    }


REVIEWS = [
    ("r1", "u1", "b1", 5.0, "2018-01-02 10:00:00", "It's GREAT, don't miss $5.99 (tacos)!! 12"),
    ("r2", "u1", "b1", 1.0, "2018-01-02", "12 . ok"),
    ("r3", "u1", "b1", 1.0, "2018-01-02 10:00:00", None),
    ("r4", "u1", "b1", 1.0, "2018-01-02 10:00:00", ""),
    (None, "u1", "b1", 1.0, "2018-01-02 10:00:00", "great"),
    ("r5", "u2", "b1", 2.0, "2018-01-02 10:00:00", "AWFUL awful"),
]


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        REVIEWS, "review_id string, user_id string, business_id string, stars double, date string, text string"
    )


def test_review_table(reviews, lexicon):
    table = marts.review(reviews, lexicon)
    assert table.columns == TABLES["review"].schema.fieldNames()
    found = {r["review_id"]: r for r in table.collect()}
    assert set(found) == {"r1", "r2", "r5"}
    assert found["r1"]["text"] == "it's great, don't miss $5.99 (tacos)!! 12"
    assert found["r2"]["date"] is None
    assert {k: r["sentiment"] for k, r in found.items()} == {"r1": "POSITIVE", "r2": "NEUTRAL", "r5": "NEGATIVE"}
    assert "sa_score" in marts.review(reviews, lexicon, keep_score=True).columns


def test_review_words(reviews):
    words = marts.review_text(marts.review_staging(reviews))
    assert rows(words.filter("review_id = 'r2'")) == [("r2", "ok")]
    assert [w for _, w in rows(words.filter("review_id = 'r1'"))] == ["$5.99", "(tacos)!!", "great", "miss"]


def tips(spark, copies=7):
    repeated = [("eat here", "2018-01-01 00:00:00", 0, "b1", "u1")] * copies
    others = [("eat here", "2018-01-01 00:00:00", 1, "b1", "u1"), ("", None, 0, "b1", "u1"), (None, None, None, "b2", "u1"),
              ("nice", None, None, "b2", None)]
    return spark.createDataFrame(
        repeated + others, "text string, date string, compliment_count int, business_id string, user_id string"
    )


def test_tip_ids_are_unique_and_repeatable(spark, lexicon):
    feed = tips(spark)
    table = marts.tip(feed, lexicon)
    ids = [r["tip_id"] for r in table.collect()]
    assert len(ids) == len(set(ids)) == 9
    assert all(len(i) == 36 for i in ids)
    again = marts.tip(feed.repartition(3).orderBy(F.desc("user_id")), lexicon)
    assert {r["tip_id"] for r in again.collect()} == set(ids)
    words = marts.tip_text(marts.tip_staging(feed))
    assert {r["tip_id"] for r in words.collect()} == set(ids)
    salted = marts.tip(feed, lexicon, id_salt="batch 1")
    assert not {r["tip_id"] for r in salted.collect()} & set(ids)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 10_000])
def test_hot_copies_are_numbered_in_blocks(spark, block):
    numbered = with_stable_id(tips(spark), "id", block=block)
    expected = with_stable_id(tips(spark), "id")
    assert numbered.count() == 11
    assert rows(numbered) == rows(expected)


def test_build_and_write_all(spark, tmp_path, reviews, lexicon, users):
    feeds = {"review": reviews, "tip": tips(spark), "user": users}
    lazy = marts.build_all(feeds, lexicon=lexicon)
    written = marts.write_all(feeds, str(tmp_path / "out"), lexicon=lexicon, rules=Rules())
    assert set(lazy) == set(written) == {
        "review", "review_text", "tip", "tip_text", "user", "user_elite", "user_friend",
    }
    for name, df in written.items():
        assert rows(df) == rows(lazy[name]), name
    with pytest.raises(ValueError):
        marts.build_all({"review": reviews})
    with pytest.raises(ValueError):
        marts.build_all({"unknown": reviews})
