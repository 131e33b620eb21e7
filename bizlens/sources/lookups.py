"""Readers of the lookup tables: sentiment lexicon, noun list, irregular forms, stop words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A small list of our own to start with; pass a fuller lexicon with ``read_lexicon``.
SEED_LEXICON = {
    3.0: "amazing awesome best excellent fantastic love outstanding perfect superb wonderful",
    2.0: "beautiful charming clean delicious delightful enjoy enjoyed favorite friendly fun good great happy "
         "helpful impressed lovely nice pleasant recommend tasty thank thanks welcoming yummy",
    1.0: "affordable attentive comfortable cool cozy crisp decent easy fair fast fine fresh generous quick "
         "reasonable tender warm",
    -1.0: "bland boring crowded dry expensive greasy loud noisy overpriced pricey slow small soggy stale wait",
    -2.0: "bad broken cold complain dirty disappointed disappointing gross ignored mediocre nasty poor problem "
          "refused rude sad sick tasteless unfriendly unhelpful wrong",
    -3.0: "awful disgusting fraud hate horrible poison scam terrible worst",
}


def seed_lexicon(spark: SparkSession) -> DataFrame:
    entries = [(term, valence) for valence, terms in SEED_LEXICON.items() for term in terms.split()]
    return spark.createDataFrame(entries, "term string, valence double")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Lines of term, tab, mean valence and maybe more columns. A term listed twice gets its highest valence."""
    fields = F.split("value", "\t")
    entries = spark.read.text(path).select(
        F.trim(F.get(fields, F.lit(0))).alias("term"),
        F.get(fields, F.lit(1)).try_cast("double").alias("valence"),
    )
    valid = entries.filter((F.length("term") > 0) & F.col("valence").isNotNull())
    return valid.groupBy("term").agg(F.max("valence").alias("valence"))


def read_nouns(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary index: one lemma at the start of each line; lines that start with a blank are notes."""
    lines = spark.read.text(path).filter(~F.col("value").startswith(" ") & (F.length("value") > 0))
    return lines.select(F.split("value", " ")[0].alias("lemma")).distinct()


def read_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """Lines of an irregular form followed by one or more lemmas."""
    fields = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).select(fields.alias("fields")).filter(F.size("fields") > 1)
    return lines.select(
        F.col("fields")[0].alias("form"), F.explode(F.slice("fields", F.lit(2), F.size("fields") - 1)).alias("lemma")
    ).distinct()


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("word")).filter(F.length("word") > 0).distinct()
