import json

import pytest

from bizlens import jobs
from bizlens.operators.words import lemma_forms
from bizlens.sources import lookups
from tests.conftest import rows

FEEDS = {
    "business": [{"business_id": "b1", "name": "One", "is_open": 1, "categories": "Bars, Cafes"},
                 {"business_id": "b2", "name": "Two", "is_open": 1, "categories": "Bars"}],
    "checkin": [{"business_id": "b1", "date": "2018-01-01 10:00:00, 2018-02-01 10:00:00"}],
    "review": [{"review_id": "r1", "user_id": "u1", "business_id": "b1", "stars": 4.0,
                "date": "2018-01-01 00:00:00", "text": "Great tacos and dogs"},
               {"review_id": "r2", "user_id": "u2", "business_id": "b2", "stars": 1.0,
                "date": "2018-01-02 00:00:00", "text": "Awful TACOS"}],
    "tip": [{"text": "good", "business_id": "b1", "user_id": "u1"}],
    "user": [{"user_id": "u1", "name": "Ann", "elite": "2018", "friends": "u2, u1"}, {"user_id": "u2", "name": "Bob"}],
}


@pytest.fixture
def feeds(tmp_path):
    for feed, records in FEEDS.items():
        folder = tmp_path / "feeds" / feed
        folder.mkdir(parents=True)
        (folder / "x00").write_text("\n".join(json.dumps(r) for r in records))
    with open(tmp_path / "feeds" / "user" / "x00", "a") as more:
        more.write('\n{"name": "nobody"}\n{"user_id": "u3", "na')
    (tmp_path / "nouns").write_text("  1 a note line\ntaco n 1 0\ndog n 7 5 @\n")
    (tmp_path / "lexicon").write_text("great\t3.1\t0.7\nawful\t-2.0\ngood\t1.9\nbroken line\n")
    return tmp_path


@pytest.mark.parametrize("job", ["load", "ingest"])
def test_load_and_ask(spark, feeds, job):
    extra = ["--cluster"] if job == "load" else ["--checkpoints", f"{feeds}/cp"]
    report = jobs.main(
        [job, "--feeds", f"{feeds}/feeds", "--out", f"{feeds}/out", "--nouns", f"{feeds}/nouns",
         "--lexicon", f"{feeds}/lexicon", *extra], spark)
    assert all(r["passed"] for r in report.collect() if r["check"] in ("nulls", "domain", "length", "duplicate_keys", "missing_text"))
    counted = {(r["check"], r["table"], r["column"]): r["n"] for r in report.collect()}
    assert counted["rows", "review", "*"] == 2 and counted["closed", "business", "is_open"] == 0
    assert counted["quarantine", "user", "unreadable"] == 1 and counted["quarantine", "user", "no user_id"] == 1
    assert counted["orphans of user", "review", "user_id"] == 0

    def ask(question, *more):
        return [tuple(r) for r in jobs.main(["ask", question, "--tables", f"{feeds}/out", "--business", "b1", *more], spark).collect()]

    assert ask("top_words") == [("dog", 1), ("great", 1), ("taco", 1)]
    assert ask("top_words", "--sentiment", "NEGATIVE") == []
    assert ask("category_words") == [("awful", 1), ("taco", 1)]
    assert ask("average_rating") == [(4.0,)]
    assert ask("checkin_trend") == [("2018/1", 1), ("2018/2", 1)]
    assert ask("elite_circle_trend") == [("2018/1", 1)]
    assert [r[0] for r in ask("recent_elite_reviews")] == ["r1"]
    assert ask("review_trend") == [("2018/1", 1)] and len(ask("recent_reviews")) == 1


def test_lookup_files(spark, tmp_path):
    (tmp_path / "exc").write_text("children child\nwolves wolf\n\naxes ax axis\n")
    (tmp_path / "stop").write_text("the\n\n and \n")
    assert rows(lookups.read_exceptions(spark, f"{tmp_path}/exc")) == [
        ("axes", "ax"), ("axes", "axis"), ("children", "child"), ("wolves", "wolf"),
    ]
    assert rows(lookups.read_stop_words(spark, f"{tmp_path}/stop")) == [("and",), ("the",)]
    (tmp_path / "lex").write_text("x's\t1.5\t0.5\nx's\t-1\n\t3\nnone\tnan?\n")
    assert rows(lookups.read_lexicon(spark, f"{tmp_path}/lex")) == [("x's", 1.5)]
    nouns = spark.createDataFrame([("ax",), ("axis",)], "lemma string")
    assert ("axes", "ax") in rows(lemma_forms(nouns, lookups.read_exceptions(spark, f"{tmp_path}/exc")))
    seed = lookups.seed_lexicon(spark)
    assert seed.count() == seed.select("term").distinct().count() > 80
