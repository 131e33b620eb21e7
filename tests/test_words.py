import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bizlens.functions.text import STOP_WORDS, is_valid_word, tokens
from bizlens.operators.words import PLURALS, drop_stop_words, lemma_forms, lemmatize, word_table
from tests.conftest import plan, rows


def tokenised(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r[1] for r in df.select("id", tokens("text")).orderBy("id").collect()]


def test_tokens(spark):
    found = tokenised(spark, ["it's great, don't miss $5.99 (tacos)!! 12", "été naïve_x", "", "a\n\tb  $ $1.2.3x"])
    assert found == [
        ["it", "'s", "great", ",", "don", "'t", "miss", "$5.99", "(tacos)!!", "12"],
        ["été", "naïve_x"],
        [],
        ["a", "b", "$", "$1.2.3", "x"],
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZé9_$.,'! \n½", max_size=30), min_size=1, max_size=20))
def test_tokens_as_python_words(spark, texts):
    assert tokenised(spark, texts) == [re.findall(r"\w+|\$[\d\.]+|\S+", t) for t in texts]


def test_valid_words(spark):
    edge = ["'s", "'re", "a", "12", "ab", "'|", "|x", "$5", "½½", "٣٤", "1a", "...", "²²"]
    df = spark.createDataFrame([(w,) for w in edge], "word string")
    kept = {r.word for r in df.filter(is_valid_word("word")).collect()}
    assert kept == {"'re", "ab", "|x", "$5", "½½", "1a", "...", "²²"}


NOUNS = ["dog", "class", "wolf", "box", "quiz", "quizz", "church", "dish", "man", "woman", "city", "us", "u", "wa", "men", "taco", "x", "child",
         "ha", "bus", "leaf", "tie"]
EXCEPTIONS = [("children", "child"), ("leaves", "leaf"), ("boxes", "missing"), ("us", "u")]
SEEN = ["dogs", "classes", "wolves", "boxes", "quizzes", "churches", "dishes", "men", "women", "cities", "us", "was", "has", "tacos", "xs",
        "children", "leaves", "dog", "buses", "ties", "unknown", "s", "", "x"]


def lemma_by_hand(word):
    """Strip endings from the word; the dictionary decides."""
    if word in dict(EXCEPTIONS):
        found = [word] + [lemma for form, lemma in EXCEPTIONS if form == word]
    else:
        found = [word] + [
            word[: len(word) - len(tail + add)] + tail + ending
            for ending, cut, add in PLURALS
            for tail, ending in [(ending[: len(ending) - cut] if cut else ending, ending[len(ending) - cut:] if cut else "")]
            if word.endswith(tail + add)
        ]
    found = [f for f in found if f in NOUNS]
    return min(found, key=lambda f: (len(f), f != word, f)) if found else word


def lookup_tables(spark):
    nouns = spark.createDataFrame([(n,) for n in NOUNS], "lemma string")
    return nouns, spark.createDataFrame(EXCEPTIONS, "form string, lemma string")


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_lemmas(spark, max_rows):
    forms = lemma_forms(*lookup_tables(spark))
    words = spark.createDataFrame([(str(i), w) for i, w in enumerate(SEEN)], "id string, word string")
    found = dict(rows(lemmatize(words, forms, max_rows=max_rows)))
    assert found == {str(i): lemma_by_hand(w) for i, w in enumerate(SEEN)}
    assert found[str(SEEN.index("was"))] == "wa"
    assert found[str(SEEN.index("wolves"))] == "wolf"
    assert found[str(SEEN.index("boxes"))] == "boxes"  # listed as irregular, so no rule applies
    assert found[str(SEEN.index("men"))] == "men"  # a noun itself and as short as "man"


def test_lemma_lookup_does_not_shuffle_the_words(spark):
    texts = spark.range(100).select(F.col("id").cast("string").alias("review_id"), F.lit("dogs and cats").alias("text"))
    shown = plan(word_table(texts, "review_id", lemma_forms(*lookup_tables(spark))))
    big_side = shown.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert "Exchange" not in big_side and "EvalPython" not in shown


def test_of_a_large_dictionary_only_forms_that_occur_are_joined(spark):
    nouns = spark.range(200).select(F.concat(F.lit("noun"), "id").alias("lemma"))
    forms = lemma_forms(nouns)
    words = spark.createDataFrame([("1", "noun7s"), ("1", "noun7s"), ("2", "noun8"), ("2", "other"), ("3", None)], "id string, word string")
    found = lemmatize(words, forms, max_rows=100)
    assert forms.count() > 100 and "_salt" not in plan(found) and "BroadcastHashJoin" in plan(found)
    assert rows(found) == rows(spark.createDataFrame([("1", "noun7"), ("1", "noun7"), ("2", "noun8"), ("2", "other"), ("3", None)], "id string, word string"))


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_stop_word_table(spark, max_rows):
    words = spark.createDataFrame([("1", "taco"), ("1", "the"), ("2", "the"), ("2", "taco")], "id string, word string")
    listed = spark.createDataFrame([("taco",)], "word string")
    assert rows(drop_stop_words(words, listed, max_rows=max_rows)) == [("1", "the"), ("2", "the")]
    assert rows(drop_stop_words(words)) == [("1", "taco"), ("2", "taco")]


def test_stop_words_are_tested_after_lemmas(spark):
    texts = spark.createDataFrame([("1", "was the dogs us")], "id string, text string")
    forms = lemma_forms(*lookup_tables(spark))
    assert rows(word_table(texts, "id", forms)) == [("1", "dog"), ("1", "wa")]
    assert "was" in STOP_WORDS and len(STOP_WORDS) == len(set(STOP_WORDS)) == 179
