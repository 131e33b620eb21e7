"""Lexicon sentiment: score in [-1, 1] and label, by published rules, computed inside each row.

Every text is scored where it lies, so scoring moves no data. Contributions are added as whole
billionths, which makes the sum independent of the order of addition.
"""

from __future__ import annotations

import json
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, lookup_join
from bizlens.session import materialize

# Published constants and word lists of the rules.
NORMALISER = 15.0
NEGATION_FACTOR = -0.74
BOOST = 0.293
BOOST_BY_DISTANCE = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 0.292, 4
QUESTION, MAX_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96
POSITIVE_FROM, NEGATIVE_FROM = 0.05, -0.05
NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't daren't didn't doesn't
dont hadnt hasnt havent isnt mightnt mustnt neither don't hadn't hasn't haven't isn't mightn't mustn't
neednt needn't never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent
oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite
""".split()
INCREASING = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely especially
exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin fully fucking greatly hella highly
hugely incredibly intensely majorly more most particularly purely quite really remarkably so substantially thoroughly
totally tremendously uber unbelievably unusually utterly very
""".split()
DECREASING = """
almost barely hardly kinda kindof kind-of less little marginally occasionally partly scarcely slightly
somewhat sorta sortof sort-of
""".split()
CONTRAST = ("but",)
# Phrases that set the valence of the word they end at, begin at or stand right before; phrases that only lessen it.
PHRASES = {
    "the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "yeah right": -2.0, "cut the mustard": 2.0, "kiss of death": -1.5,
    "hand to mouth": -2.0,
}
LESSENING = ("just enough", "kind of", "sort of")
NEVER_SO, NEVER_SO_FAR = 1.5, 1.25  # "never so good" is praise: right before the word, and one word further off

# Blanks that separate words, and punctuation stripped from word edges.
_BLANK = r" \t\n\r\f\x0B\p{Z}"
_SIGN = "".join(f"\\{sign}" for sign in string.punctuation)
# A run of non-blanks without the signs around it; the whole run where less than two characters would be left.
_WORD = (
    rf"(?:[{_SIGN}]+(?=[^{_BLANK}{_SIGN}][^{_BLANK}]*[^{_BLANK}{_SIGN}]))?"
    rf"([^{_BLANK}{_SIGN}][^{_BLANK}]*[^{_BLANK}{_SIGN}]|[^{_BLANK}]+)[{_SIGN}]*"
)

MAX_LITERAL_TERMS, MAX_LITERAL_BYTES = 50_000, 4 << 20


@dataclass(frozen=True)
class Rules:
    """Word lists of the optional rules; an empty list switches its rule off."""

    negations: tuple[str, ...] = tuple(NEGATIONS)
    increasing: tuple[str, ...] = tuple(INCREASING)
    decreasing: tuple[str, ...] = tuple(DECREASING)
    contrast: tuple[str, ...] = CONTRAST
    contraction: bool = True  # any word with "n't" negates
    punctuation: bool = True
    phrases: tuple[tuple[str, float], ...] = tuple(PHRASES.items())
    lessening: tuple[str, ...] = LESSENING
    never: tuple[str, ...] = ("never",)
    never_so: tuple[str, ...] = ("so", "this")
    without: tuple[str, ...] = ("without",)  # it does not negate before the words of ``doubt``
    doubt: tuple[str, ...] = ("doubt",)
    least: tuple[str, ...] = ("least",)  # it negates, but for "at least" and "very least"
    not_least: tuple[str, ...] = ("at", "very")
    mute_before: tuple[tuple[str, str], ...] = (("kind", "of"),)  # the first word has no valence before the second


BASE_RULES = Rules((), (), (), (), False, False, (), (), (), (), (), (), (), (), ())


def sentiment_words(text: Column | str) -> Column:
    """Blank-separated words without edge punctuation; runs like ``<3`` or ``:)`` stay whole, single characters go."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.regexp_extract_all(text, F.lit(_WORD), F.lit(1)), lambda word: F.length(word) > 1)


_UP, _DOWN, _NEGATES, _MUTE, _NEVER, _SO, _WITHOUT, _DOUBT, _LEAST, _NOT_LEAST, _OPENS = (1 << k for k in range(11))


def _flags(word: Column, rules: Rules) -> Column:
    """What a word does to others, as flags; 0 for an ordinary word."""
    sets = {
        _UP: rules.increasing, _DOWN: rules.decreasing, _NEGATES: rules.negations, _MUTE: _mute(rules), _NEVER: rules.never,
        _SO: rules.never_so, _WITHOUT: rules.without, _DOUBT: rules.doubt, _LEAST: rules.least, _NOT_LEAST: rules.not_least,
        _OPENS: [phrase.split(" ")[0] for phrase in _phrases(rules)],
    }
    by_word: dict[str, int] = {}
    for flag, words in sets.items():
        for each in words:
            by_word[each] = by_word.get(each, 0) | flag | (_NEGATES if rules.contraction and "n't" in each else 0)
    by_flags: dict[int, list[str]] = {}
    for each, flags in sorted(by_word.items()):
        by_flags.setdefault(flags, []).append(each)
    plain = F.when(word.contains("n't"), F.lit(_NEGATES)).otherwise(F.lit(0)) if rules.contraction else F.lit(0)
    if not by_word:
        return plain
    case = plain
    for flags, words in by_flags.items():
        case = F.when(word.isin(words), F.lit(flags)).otherwise(case)
    return F.when(word.isin(sorted(by_word)), case).otherwise(plain)  # ordinary words are told by one look-up


def _phrases(rules: Rules) -> list[str]:
    return [*(phrase for phrase, _ in rules.phrases), *rules.lessening]


def _mute(rules: Rules) -> list[str]:
    """Boosters count as known words but never carry valence."""
    return sorted({*rules.increasing, *rules.decreasing})


def _has(flags: Column, flag: int) -> Column:
    return F.coalesce(flags.bitwiseAND(F.lit(flag)) != 0, F.lit(False))


def _phrase(words: Column, at: Column, first: int, size: int) -> Column:
    """``size`` words from ``at + first`` on, with blanks between; null before the beginning, shorter at the end."""
    start = at + first + 1
    return F.when(start > 0, F.array_join(F.slice(words, F.greatest(start, F.lit(1)), F.lit(size)), " "))


#: Where a phrase may stand around a word, as (first word, number of words), the first match counts; then what may follow it.
_BACK, _AHEAD = ((-1, 2), (-2, 3), (-2, 2), (-3, 3), (-3, 2)), ((0, 2), (0, 3))


def _phrased(valence: Column, words: Column, at: Column, rules: Rules) -> Column:
    """The valence after the phrases around the word; later ones override, lessening ones count on top."""
    if rules.phrases:
        by_value: dict[float, list[str]] = {}
        for phrase, value in rules.phrases:
            by_value.setdefault(value, []).append(phrase)

        def value_of(place: tuple[int, int]) -> Column:
            text, found = _phrase(words, at, *place), F.lit(None).cast("double")
            for value, phrases in by_value.items():
                found = F.when(text.isin(phrases), F.lit(value)).otherwise(found)
            return found

        back, ahead = [[value_of(place) for place in places] for places in (_BACK, _AHEAD)]
        valence = F.coalesce(*reversed(ahead), *back, valence)
    if rules.lessening:
        before = _phrase(words, at, -3, 2).isin(list(rules.lessening)) | _phrase(words, at, -2, 2).isin(list(rules.lessening))
        valence = valence + F.when(F.coalesce(before, F.lit(False)), F.lit(-BOOST)).otherwise(F.lit(0.0))
    return valence


def _contribution(values: Column, flags: Column, words: Column, at: Column, contrast_at: Column, phrased: Column, rules: Rules) -> Column:
    """Valence of the word at index ``at`` after its surroundings, in billionths.

    The three words before it act in turn, the nearest first, unless they have a valence themselves. Phrases are looked at
    with the third, so only where it exists and has no valence.
    """
    valence = F.get(values, at)
    if rules != BASE_RULES:
        one, two, three = (F.get(flags, at - distance) for distance in (1, 2, 3))
        alone = [F.get(values, at - distance).isNull() for distance in (1, 2, 3)]
        turns = [F.when(_has(f, _NEGATES), F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0)) for f in (one, two, three)]
        turns[1] = F.when(_has(two, _NEVER) & _has(one, _SO), F.lit(NEVER_SO)).when(
            _has(two, _WITHOUT) & _has(one, _DOUBT), F.lit(1.0)
        ).otherwise(turns[1])
        # As published, "so" or "this" right before the word is enough here.
        turns[2] = F.when((_has(three, _NEVER) & _has(two, _SO)) | _has(one, _SO), F.lit(NEVER_SO_FAR)).otherwise(turns[2])
        steps = F.array(*[
            F.struct(
                (F.when(_has(f, _UP), 1.0).when(_has(f, _DOWN), -1.0).otherwise(0.0) * F.lit(BOOST * weight)).alias("boost"),
                turn.alias("turn"), (f.isNotNull() & free).alias("acts"),
            )
            for f, weight, turn, free in zip((one, two, three), BOOST_BY_DISTANCE, turns, alone)
        ])

        def look_back(value: Column, step: Column) -> Column:
            changed = (value + F.when(value < 0, -step["boost"]).otherwise(step["boost"])) * step["turn"]
            return F.when(step["acts"], changed).otherwise(value)

        turning = _UP | _DOWN | _NEGATES | _NEVER | _SO
        valence = F.when(_has(one, turning) | _has(two, turning) | _has(three, turning), F.aggregate(steps, valence, look_back)).otherwise(valence)
        if rules.phrases or rules.lessening:
            opens = reduce(Column.__or__, [_has(F.get(flags, at - distance), _OPENS) for distance in range(4)])
            far = phrased & opens & three.isNotNull() & alone[2]
            valence = F.when(far, _phrased(valence, words, at, rules)).otherwise(valence)
        if rules.least:
            least = _has(one, _LEAST) & alone[0] & ~_has(two, _NOT_LEAST)
            valence = valence * F.when(least, F.lit(NEGATION_FACTOR)).otherwise(F.lit(1.0))
    if rules.contrast:
        factor = (
            F.when(contrast_at < 0, F.lit(1.0))
            .when(at < contrast_at, F.lit(BEFORE_CONTRAST))
            .when(at > contrast_at, F.lit(AFTER_CONTRAST))
            .otherwise(F.lit(1.0))
        )
        valence = valence * factor
    return F.floor(valence * 1e9 + 0.5).cast("long")


def _emphasis(text: Column) -> Column:
    def occurrences(sign: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))

    questions = occurrences("?")
    question_part = (
        F.when(questions > MAX_QUESTIONS, F.lit(MANY_QUESTIONS))
        .when(questions > 1, questions * QUESTION)
        .otherwise(F.lit(0.0))
    )
    return F.least(occurrences("!"), F.lit(MAX_EXCLAMATIONS)) * EXCLAMATION + question_part


def _score(total: Column, text: Column, rules: Rules) -> Column:
    amount = total / F.lit(1e9)
    if rules.punctuation:
        amount = (
            F.when(amount > 0, amount + _emphasis(text))
            .when(amount < 0, amount - _emphasis(text))
            .otherwise(amount)
        )
    compound = amount / F.sqrt(amount * amount + NORMALISER)
    return F.round(F.least(F.greatest(compound, F.lit(-1.0)), F.lit(1.0)), 4)


def label(score: Column | str) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return (
        F.when(score >= POSITIVE_FROM, "POSITIVE").when(score <= NEGATIVE_FROM, "NEGATIVE").otherwise("NEUTRAL")
    )


def _entries(lexicon: DataFrame) -> DataFrame:
    """(term, valence) with one row per term: its highest valence."""
    valued = lexicon.groupBy("term").agg(F.max(F.col("valence").cast("double")).alias("valence"))
    return valued.filter(F.col("term").isNotNull() & F.col("valence").isNotNull())


def _measured(entries: DataFrame) -> tuple[int, int]:
    """The number of terms and their bytes."""
    terms, size = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return terms, size


def _literal_table(entries: DataFrame, terms: int) -> Column:
    """The entries as a literal array of small maps, addressed by the term's hash."""
    buckets: list[dict[str, float]] = [{} for _ in range(max(terms, 1))]
    placed = entries.select(F.pmod(F.hash("term"), F.lit(len(buckets))), "term", "valence")
    for bucket, term, valence in placed.collect():
        buckets[bucket][term] = valence
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,double>>")
    return F.struct(table.alias("buckets"), F.lit(len(buckets)).alias("size"))


def _values_by_literals(df: DataFrame, table: Column) -> DataFrame:
    """Per word its valence, or null."""

    def value(word: Column) -> Column:
        return F.try_element_at(F.get(table["buckets"], F.pmod(F.hash(word), table["size"])), word)

    return df.withColumn("_values", F.transform("_words", value))


def _values_by_subquery(df: DataFrame, entries: DataFrame, terms: int) -> DataFrame:
    """The same from a table that a scalar subquery makes while the query runs, so that the plan holds no entry.

    Its rows lie in one block of bytes, about four terms to a bucket, which each task gets as it gets a broadcast lookup.
    """
    size = max(terms // 4, 1)
    entry = F.struct("term", "valence")
    held = entries.groupBy(F.pmod(F.hash("term"), F.lit(size)).alias("bucket")).agg(F.collect_list(entry).alias("held"))
    every = df.sparkSession.range(size).select(F.col("id").cast("int").alias("bucket")).join(held, "bucket", "left")  # a bucket's number is its place
    table = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "held"))), lambda b: b["held"]).alias("t")).scalar()

    def value(word: Column, buckets: Column) -> Column:
        bucket = F.get(buckets, F.pmod(F.hash(word), F.lit(size)))
        return F.get(F.filter(bucket, lambda entry: entry["term"] == word), F.lit(0))["valence"]

    # Spark takes no subquery in a higher-order function but moves one there from the column before, since that is used once and
    # what it is made from twice: no row carries the table.
    valued = F.transform("_both", lambda both: F.transform(both["words"], lambda word: value(word, both["buckets"])))
    both = F.array(F.struct(F.col("_words").alias("words"), table.alias("buckets")))
    return df.withColumn("_both", both).withColumn("_values", F.get(valued, F.lit(0))).drop("_both")


def _values_by_join(df: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """The same by join; ``df`` has one row per ``key``, so a group is the words of one text."""
    exploded = df.select(key, F.posexplode("_words").alias("_at", "_word"))
    valued = lookup_join(exploded, entries.withColumnRenamed("term", "_word"), "_word", "left")
    gathered = valued.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_at", "valence"))).alias("_pairs"))
    values = gathered.select(key, F.transform("_pairs", lambda pair: pair["valence"]).alias("_values"))
    return df.join(values, key, "left")


def _scored(valued: DataFrame, columns: list[str], rules: Rules, text: str, into: str) -> DataFrame:
    """Score rows that carry their words and, aligned with them, the words' valences."""
    marked = valued.withColumn("_flags", F.transform("_words", lambda word: _flags(word, rules) if rules != BASE_RULES else F.lit(0)))
    places = [F.nullif(F.array_position("_words", word), F.lit(0)) for word in rules.contrast]
    first = F.coalesce(F.array_min(F.array(*places)), F.lit(0)).cast("int") - 1 if places else F.lit(-1)

    def carries(value: Column, at: Column) -> Column:
        quiet = _has(F.get("_flags", at), _MUTE)
        for word, following in rules.mute_before:
            quiet = quiet | F.coalesce((F.get("_words", at) == word) & (F.get("_words", at + 1) == following), F.lit(False))
        return F.when(value.isNotNull() & ~quiet, at)

    phrases = _phrases(rules)
    joined = F.array_join("_words", " ")
    phrased = reduce(Column.__or__, [joined.contains(phrase) for phrase in phrases]) if phrases else F.lit(False)
    located = marked.withColumns({
        "_contrast_at": first, "_hits": F.filter(F.transform("_values", carries), lambda i: i.isNotNull()), "_phrased": phrased,
    })
    total = F.aggregate(
        "_hits",
        F.lit(0).cast("long"),
        lambda acc, at: acc + _contribution(
            F.col("_values"), F.col("_flags"), F.col("_words"), at, F.col("_contrast_at"), F.col("_phrased"), rules
        ),
    )
    summed = located.withColumn("_total", F.coalesce(total, F.lit(0).cast("long")))
    score = F.coalesce(_score(F.col("_total"), F.col(text), rules), F.lit(0.0))
    return summed.select(*columns, score.alias(into))


def score_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    rules: Rules = Rules(),
    text: str = "text",
    into: str = "score",
    by_join: bool | None = None,
) -> DataFrame:
    """Add the column ``into``: 0.0 for a text without lexicon words.

    ``lexicon`` has ``term`` and ``valence``. One that measures small is written into the plan, and one up to the limits of
    a broadcast is looked up in a table made at run time: every row is scored in place. A larger one, or any with ``by_join``,
    is joined, word by word, once per distinct text; only the scores, which are kept in the shared folder, travel back to the rows.
    """
    entries = _entries(lexicon)
    terms, size = _measured(entries)
    if not by_join and terms <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES:
        worded = df.withColumn("_words", sentiment_words(text))
        small = terms <= MAX_LITERAL_TERMS and size <= MAX_LITERAL_BYTES
        valued = _values_by_literals(worded, _literal_table(entries, terms)) if small else _values_by_subquery(worded, entries, terms)
        return _scored(valued, df.columns, rules, text, into)
    key = F.unhex(F.sha2(F.col(text), 256))
    texts = df.select(text).filter(F.col(text).isNotNull()).distinct()
    worded = texts.select(key.alias("_text_key"), text, sentiment_words(text).alias("_words"))
    valued = _values_by_join(worded, entries, "_text_key")
    scores = materialize(_scored(valued, ["_text_key"], rules, text, into), "scores")  # else they are made to be measured and again to be joined
    joined = lookup_join(df.withColumn("_text_key", key), scores, "_text_key", "left")
    return joined.select(*df.columns, F.coalesce(into, F.lit(0.0)).alias(into))
