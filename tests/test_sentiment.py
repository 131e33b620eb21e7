import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from bizlens.operators.sentiment import BASE_RULES, DECREASING, INCREASING, LESSENING, NEGATIONS, PHRASES, Rules, label, score_sentiment
from tests.conftest import plan

LEXICON = {"great": 3.1, "good": 1.9, "love": 3.2, "bad": -2.5, "awful": -2.0, ":)": 2.0, "<3": 1.9, "kind": 2.4, "kiss": 1.8, "death": -2.9}


RULES = Rules()


def by_hand(text, rules=True, lexicon=LEXICON):
    words = []
    for run in re.findall(r"\S+", text):
        bare = run.strip(string.punctuation)
        bare = bare if len(bare) > 1 else run
        if len(bare) > 1:
            words.append(bare)
    total = 0
    for i, word in enumerate(words):
        if word not in lexicon or (rules and (word in INCREASING + DECREASING or words[i : i + 2] == ["kind", "of"])):
            continue
        value = lexicon[word]
        if rules:
            value = surrounded(value, words, i, lexicon)
            if "but" in words:
                turn = words.index("but")
                value *= 0.5 if i < turn else 1.5 if i > turn else 1.0
        total += math.floor(value * 1e9 + 0.5)
    amount = total / 1e9
    if rules:
        asks = text.count("?")
        emphasis = min(text.count("!"), 4) * 0.292 + (0.96 if asks > 3 else asks * 0.18 if asks > 1 else 0.0)
        amount += emphasis if amount > 0 else -emphasis if amount < 0 else 0.0
    return round(amount / math.sqrt(amount * amount + 15), 4)


def surrounded(value, words, i, lexicon):
    """The valence of word ``i`` after the three words before it, the phrases around it and a least before it."""

    def word(distance):
        return words[i - distance] if i >= distance else None

    for distance, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
        before = word(distance)
        if before is None or before in lexicon:
            continue
        boost, sign = 0.293 * weight, -1 if value < 0 else 1
        value += sign * (boost if before in INCREASING else -boost if before in DECREASING else 0.0)
        negates = before in NEGATIONS or "n't" in before
        if distance == 2 and before == "never" and word(1) in ("so", "this"):
            value *= 1.5
        elif distance == 2 and before == "without" and word(1) == "doubt":
            pass
        elif distance == 3 and (before == "never" and word(2) in ("so", "this") or word(1) in ("so", "this")):
            value *= 1.25
        elif negates:
            value *= -0.74
        if distance == 3:
            found = None
            for first, size in ((-1, 2), (-2, 3), (-2, 2), (-3, 3), (-3, 2)):
                found = PHRASES.get(" ".join(words[i + first : i + first + size])) if found is None else found
            for size in (2, 3):
                found = PHRASES.get(" ".join(words[i : i + size]), found)
            value = value if found is None else found
            if any(" ".join(words[i + first : i + first + 2]) in LESSENING for first in (-3, -2)):
                value -= 0.293
    if word(1) == "least" and "least" not in lexicon and word(2) not in ("at", "very"):
        value *= -0.74
    return value


VOCABULARY = list(LEXICON) + ["but", "not", "very", "slightly", "isn't", "the", "food", "never", "so", "a", "!", "?", "??", "great!!", "(good)", "...bad", "so-so"]
VOCABULARY += ["least", "at", "without", "doubt", "this", "kind", "of", "just enough", "bad ass", "kiss of death", "yeah right", "<3", "(a)", "hand", "to", "mouth"]


def texts():
    random.seed(7)
    made = [" ".join(random.choices(VOCABULARY, k=random.randint(0, 25))) for _ in range(500)]
    return made + ["it was never so good", "never this really good", "the one without doubt great", "they cut it the least good", "at least good food",
                   "it is so good", "we all said yeah right good", "a real kiss of death there", "food of a kind of good", "i <3 it", "RT:) :)",
"", " ", "great", "not great", "very, very good!", "good but bad", "bad but good", "\tgood\n\ngreat  love"]


@pytest.mark.parametrize("by_join", [False, True])
@pytest.mark.parametrize("full", [True, False])
def test_scores_as_by_hand(spark, lexicon, by_join, full):
    made = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "id int, text string")
    scored = score_sentiment(df, lexicon, Rules() if full else BASE_RULES, by_join=by_join)
    found = {r["id"]: r["score"] for r in scored.collect()}
    assert found == {i: pytest.approx(by_hand(t, full), abs=1e-4) for i, t in enumerate(made)}


@pytest.mark.parametrize("by_join", [False, True])
def test_words_that_are_both_known_and_acting(spark, by_join):
    known = {**LEXICON, "very": 1.0, "but": -0.5, "not": 0.3, "never": -1.0, "food": 0.0}
    lexicon = spark.createDataFrame(list(known.items()), "term string, valence double")
    made = texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "id int, text string")
    found = {r["id"]: r["score"] for r in score_sentiment(df, lexicon, by_join=by_join).collect()}
    assert found == {i: pytest.approx(by_hand(t, lexicon=known), abs=1e-4) for i, t in enumerate(made)}


@pytest.mark.parametrize("by_join", [False, True])
def test_missing_text_and_copies(spark, lexicon, by_join):
    df = spark.createDataFrame([("1", None), ("2", "good"), ("2", "good"), ("2", "bad"), ("3", "nothing here")], "id string, text string")
    scored = score_sentiment(df, lexicon, by_join=by_join)
    found = sorted((r["id"], r["score"]) for r in scored.collect())
    assert found == sorted([("1", 0.0), ("2", by_hand("good")), ("2", by_hand("good")), ("2", by_hand("bad")), ("3", 0.0)])


def test_scoring_moves_no_data(spark, lexicon):
    df = spark.range(10).select(F.lit("good").alias("text"))
    shown = plan(score_sentiment(df, lexicon))
    assert "Exchange" not in shown and "EvalPython" not in shown


def test_empty_lexicon_and_quotes(spark):
    df = spark.createDataFrame([("it's 'ok' o'clock back\\slash",)], "text string")
    empty = spark.createDataFrame([], "term string, valence double")
    assert score_sentiment(df, empty).first()["score"] == 0.0
    odd = spark.createDataFrame([("o'clock", 1.0), ("back\\slash", 2.5), ("it's", 0.5)], "term string, valence double")
    assert score_sentiment(df, odd).first()["score"] == by_hand("", lexicon={}) + round(4.0 / math.sqrt(31), 4)


def test_large_lexicon_goes_through_the_join(spark, monkeypatch):
    from bizlens.operators import sentiment

    monkeypatch.setattr(sentiment, "MAX_LITERAL_TERMS", 2)
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("fine", 0.8)], "term string, valence double")
    df = spark.createDataFrame([("good fine",)], "text string")
    scored = score_sentiment(df, lexicon)
    assert "Join" in plan(scored)
    assert scored.first()["score"] == round(2.7 / math.sqrt(2.7**2 + 15), 4)


@pytest.mark.parametrize("full", [True, False])
def test_a_lexicon_beyond_the_plan_moves_no_text(spark, monkeypatch, full):
    from bizlens.operators import sentiment

    monkeypatch.setattr(sentiment, "MAX_LITERAL_TERMS", 2)
    made = [*texts(), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "id int, text string")
    lexicon = spark.createDataFrame([*LEXICON.items(), (None, 1.0), ("unvalued", None)], "term string, valence double")
    scored = score_sentiment(df, lexicon, Rules() if full else BASE_RULES)
    shown = plan(scored)
    assert "sha2" not in shown and "_both" not in shown  # no key to join texts by, and no row that carries the table
    found = {r["id"]: r["score"] for r in scored.collect()}
    assert found == {i: pytest.approx(by_hand(t, full) if t else 0.0, abs=1e-4) for i, t in enumerate(made)}


def test_joined_scores_are_made_once(spark, lexicon):
    df = spark.createDataFrame([("good",), ("good",), ("not bad",)], "text string")
    scored = score_sentiment(df, lexicon, by_join=True)
    assert "regexp_extract_all" not in plan(scored)  # texts are scored when the plan is built, not when sizes are measured and again
    assert sorted(r["score"] for r in scored.collect()) == sorted(by_hand(t) for t in ("good", "good", "not bad"))


def test_planted_phrases_and_exceptions(spark, lexicon):
    known = spark.createDataFrame([*LEXICON.items()], "term string, valence double")
    cases = {
        "i <3 it": 1.9, "really the one never so good": (1.9 + 0.293) * 1.5 * 1.25, "all of it without doubt great": 3.1,
        "the least good": 1.9 * -0.74, "at least good": 1.9, "what a kiss of death": None, "he is kind of here": 0.0, "he is kind": 2.4,
    }
    df = spark.createDataFrame([(t,) for t in cases], "text string")
    found = {r["text"]: r["score"] for r in score_sentiment(df, known).collect()}
    for text, amount in cases.items():
        assert found[text] == by_hand(text), text
        if amount is not None:
            assert found[text] == round(amount / math.sqrt(amount * amount + 15), 4), text


def test_label_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (-0.0499,), (0.0,)], "score double")
    assert [r[0] for r in df.select(label("score")).collect()] == ["POSITIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL"]
