"""From texts to a word table: tokenise, lemmatise, drop stop words, keep valid words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions.text import is_stop_word, is_valid_word, tokens
from bizlens.operators.joins import MAX_BROADCAST_ROWS, fits_broadcast, lookup_join
from bizlens.session import materialize

# How a noun ending turns into its plural ending, as (noun ends in, cut, add).
PLURALS = (
    ("", 0, "s"),
    ("s", 0, "es"),
    ("f", 1, "ves"),
    ("x", 0, "es"),
    ("z", 0, "es"),
    ("ch", 0, "es"),
    ("sh", 0, "es"),
    ("man", 3, "men"),
    ("y", 1, "ies"),
)


def token_rows(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    return texts.select(key, F.explode(tokens(text)).alias("word"))


def lemma_forms(nouns: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """All inflected forms a noun list covers, as (form, lemma) with form different from lemma.

    ``nouns`` has a column ``lemma``; ``exceptions`` has ``form`` and ``lemma``. Running the noun
    rules forwards from the dictionary gives a table whose size follows the dictionary, not the
    texts, so no pass over the corpus vocabulary is needed. A form that is a noun itself competes
    with the lemmas found for it; the shortest wins and the form itself wins a tie. A form listed
    in ``exceptions`` takes its lemmas from there only.
    """
    nouns = nouns.select("lemma").distinct()
    lemma = F.col("lemma")
    plurals = []
    for ending, cut, add in PLURALS:
        form = F.concat(F.expr(f"left(lemma, length(lemma) - {cut})"), F.lit(add))
        plurals.append(F.when(lemma.endswith(ending), form))
    itself = nouns.select(lemma.alias("form"), "lemma")
    found = nouns.select(
        F.explode(F.array_distinct(F.array_compact(F.array(*plurals)))).alias("form"), "lemma"
    ).unionByName(itself)
    if exceptions is not None:
        listed = exceptions.select("form").distinct()
        irregular = exceptions.select("form", "lemma").join(nouns, "lemma", "left_semi")
        irregular_self = itself.join(listed, "form", "left_semi")
        found = found.join(listed, "form", "left_anti").unionByName(irregular).unionByName(irregular_self)
    rank = F.struct(F.length("lemma"), (F.col("form") != lemma).alias("other"), "lemma")
    best = found.groupBy("form").agg(F.min(rank).alias("best"))
    return best.select("form", F.col("best.lemma").alias("lemma")).filter(F.col("form") != F.col("lemma"))


def lemmatize(words: DataFrame, forms: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Replace ``word`` by its lemma; words without an entry stay.

    Of a dictionary too large for a broadcast only the forms that occur are joined. They are found over the distinct words,
    which combine before their shuffle, and kept in the shared folder; so the word rows are shuffled only if even these are too many.
    """
    entries = forms.select(F.col("form").alias("word"), F.col("lemma").alias("_lemma"))
    if not fits_broadcast(entries, max_rows=max_rows):
        entries = materialize(entries.join(words.select("word").distinct(), "word", "left_semi"), "forms")
    joined = lookup_join(words, entries, "word", "left", max_rows=max_rows)
    replaced = F.coalesce("_lemma", "word").alias("word")
    return joined.select(*[replaced if c == "word" else c for c in words.columns])


def drop_stop_words(
    words: DataFrame, stop_words: DataFrame | None = None, max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Drop listed words: the built-in list, or the ``word`` column of a table."""
    if stop_words is None:
        return words.filter(~is_stop_word("word"))
    return lookup_join(words, stop_words.select("word"), "word", "left_anti", max_rows=max_rows).select(
        *words.columns
    )


def keep_valid_words(words: DataFrame) -> DataFrame:
    return words.filter(is_valid_word("word"))


def word_table(
    texts: DataFrame, key: str, forms: DataFrame | None = None, stop_words: DataFrame | None = None
) -> DataFrame:
    """(key, word) rows. Stop words are tested on the lemma, not on the written form."""
    words = token_rows(texts, key)
    if forms is not None:
        words = lemmatize(words, forms)
    return keep_valid_words(drop_stop_words(words, stop_words))
