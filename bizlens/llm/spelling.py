"""Groups of spelling variants: words one edit apart, found in a trie of letter-group counts.

A word's vector counts its letters by group. One edit changes the vector by at most one count too many and one too few, so
near words are found by a search down a trie whose levels are the groups, with a budget of one surplus and one deficit. The
upper levels (the length and the groups of ``UPPER``) are the shuffle key; the lower ones are searched within a task.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import text_of
from bizlens.operators.joins import lookup_join
from bizlens.session import materialize

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Fixed value: the share of runs that lose a code point.
EVERY = 199
UPPER = ("e", "a", "i", "n")
LOWER = ("r", "s", "t", "o", "l", "du", "cm", "pg", "hb", "fvy", "kwz", "jqx")
#: Words of a trie, and words that search it, in one piece of work at most, about.
TRIE, SEARCHES = 8_192, 131_072
LEAF, BATCH = 12, 8_192

_GROUP = np.full(256, len(LOWER), np.int64)  # all other letters are the last group
for _k, _letters in enumerate(LOWER):
    for _letter in _letters:
        _GROUP[ord(_letter)] = _k
for _letter in UPPER:
    _GROUP[ord(_letter)] = len(LOWER) + 1  # not counted
LEVELS = len(LOWER) + 1


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n`` of ``docs(doc_id, text)``: runs of Latin letters after the planted deletions, often enough and long enough.

    Null texts have no words; a null id counts as empty text.
    """
    lowered = F.translate(text_of(docs), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= LEAST_LENGTH)
    crc = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (crc % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(crc % EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _moves() -> list[tuple[int, list[int], int, int]]:
    """The upper paths a word searches: ``(longer, change of each upper count, surplus left, deficit left)``.

    Longer words are searched from the shorter one. Words of one length are searched from the one whose upper path is
    smaller, so each pair is met once; on the same path the words' order decides.
    """
    still = [0] * len(UPPER)

    def changed(**by):
        return [by.get(f"g{k}", 0) for k in range(len(UPPER))]

    found = [(1, still, 1, 0), (0, still, 1, 1)]
    for k in range(len(UPPER)):
        found.append((1, changed(**{f"g{k}": 1}), 0, 0))
        found.append((0, changed(**{f"g{k}": 1}), 0, 1))
    for a, b in combinations(range(len(UPPER)), 2):
        found.append((0, changed(**{f"g{a}": 1, f"g{b}": -1}), 0, 0))
    return found


def _rows(words: DataFrame) -> DataFrame:
    """``path, kind, surplus, deficit, word, n``: each word once to be found (kind 0) and once for every search (kind 1)."""
    counts = [F.length("word") - F.length(F.replace("word", F.lit(letter), F.lit(""))) for letter in UPPER]
    kinds = [(0, [0] * len(UPPER), 0, 0, 0)] + [(longer, change, surplus, deficit, 1) for longer, change, surplus, deficit in _moves()]
    moves = F.array(*[
        F.struct(
            F.lit(longer).alias("longer"), F.array(*map(F.lit, change)).alias("change"), F.lit(kind).alias("kind"),
            F.lit(surplus).alias("surplus"), F.lit(deficit).alias("deficit"),
        )
        for longer, change, surplus, deficit, kind in kinds
    ])
    moved = words.select("word", "n", F.array(*counts).alias("counts"), F.explode(moves).alias("m"))
    path = F.concat_ws(
        ",", F.length("word") + F.col("m.longer"), *[F.get("counts", F.lit(k)) + F.get("m.change", F.lit(k)) for k in range(len(UPPER))]
    )
    return moved.select(path.alias("path"), "m.kind", "m.surplus", "m.deficit", "word", "n")


def vectors(words: list[str]) -> np.ndarray:
    """The lower counts of words, a row each."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    cells = np.repeat(np.arange(len(words)) * (LEVELS + 1), sizes) + _GROUP[letters]
    return np.bincount(cells, minlength=len(words) * (LEVELS + 1)).reshape(-1, LEVELS + 1)[:, :LEVELS].astype(np.int32)


def search(trie: np.ndarray, asked: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``asked``, row of ``trie``) whose counts differ by no more than the budgets.

    ``trie`` is in lexicographic order, so that a node is a stretch of rows; the walk goes depth first, and all words that
    can still reach a node go down together.
    """
    stack = [(0, 0, len(trie), np.arange(len(asked)), surplus, deficit)]
    while stack:
        level, low, high, alive, up, down = stack.pop()
        if high - low <= LEAF or level == LEVELS:
            for start in range(low, high, LEAF):
                leaf = trie[start : min(start + LEAF, high), level:]
                rest = leaf[None, :, :] - asked[alive, level:][:, None, :]
                more, total = np.maximum(rest, 0).sum(axis=2), rest.sum(axis=2)
                q, w = np.nonzero((more <= up[:, None]) & (more - total <= down[:, None]))
                if len(q):
                    yield alive[q], start + w
            continue
        column = trie[low:high, level]
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
        have = asked[alive, level]
        for a, b in zip(edges, edges[1:], strict=False):
            step = column[a] - have
            keep = np.flatnonzero((step <= up) & (-step <= down))
            if len(keep):
                step = step[keep]
                stack.append((level + 1, low + a, low + b, alive[keep], up[keep] - np.maximum(step, 0), down[keep] - np.maximum(-step, 0)))


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class _Trie:
    def __init__(self, words: list[str], counts: list[int]) -> None:
        counted = vectors(words)
        order = np.lexsort(counted.T[::-1])
        self.rows, self.words, self.counts = counted[order], [words[i] for i in order], [counts[i] for i in order]

    def near(self, words: list[str], counts: list[int], surplus: np.ndarray, deficit: np.ndarray) -> Iterator[tuple]:
        same = (surplus + deficit == 2).tolist()
        for asked, found in search(self.rows, vectors(words), surplus, deficit):
            for q, w in zip(asked.tolist(), found.tolist(), strict=True):
                a, b = words[q], self.words[w]
                if (a < b or not same[q]) and one_edit(a, b):
                    yield a, counts[q], b, self.counts[w]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell, words to be found first: only they and one batch of searches are held."""
    cell, words, counts, trie = None, [], [], None
    for batch in batches:
        path, i, j = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "i", "j"))
        kind, surplus, deficit = (batch.column(c).to_numpy() for c in ("kind", "surplus", "deficit"))
        word, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        new = (path[1:] != path[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (kind[1:] != kind[:-1])
        edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(word)]
        found: list[tuple] = []
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            here = (path[a], i[a], j[a])
            if here != cell:
                cell, words, counts, trie = here, [], [], None
            if kind[a] == 0:
                words += word[a:b]
                counts += n[a:b]
                continue
            if not words:
                continue
            trie = trie or _Trie(words, counts)
            for s in range(a, b, BATCH):
                e = min(s + BATCH, b)
                found.extend(trie.near(word[s:e], n[s:e], surplus[s:e], deficit[s:e]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[k] for f in found], pa.int64() if k % 2 else pa.string()) for k in range(4)], ["word", "n", "near", "near_n"]
        )


def near_words(words: DataFrame) -> DataFrame:
    """Pairs ``word, n, near, near_n`` of the stored ``words(word, n)``, distinct, that differ by one edit; each pair once.

    A path with many words is dealt over a grid of cells: the words to be found in rows, those that search in columns.
    """
    rows = _rows(words)
    sized = rows.groupBy("path").agg(
        F.ceil(F.count_if(F.col("kind") == 0) / TRIE).cast("int").alias("tries"), F.ceil(F.count_if(F.col("kind") == 1) / SEARCHES).cast("int").alias("lots")
    )
    sized = materialize(sized.filter("tries > 0 and lots > 0"), "paths")
    rows = lookup_join(rows, sized, "path")
    held = F.col("kind") == 0
    mine = F.xxhash64("word")
    i = F.when(held, F.array(F.pmod(mine, "tries").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("tries") - 1))
    j = F.when(held, F.sequence(F.lit(0), F.col("lots") - 1)).otherwise(F.array(F.pmod(mine, "lots").cast("int")))
    cells = rows.withColumn("i", F.explode(i)).withColumn("j", F.explode(j)).select("path", "i", "j", "kind", "surplus", "deficit", "word", "n")
    dealt = cells.repartition("path", "i", "j").sortWithinPartitions("path", "i", "j", "kind")
    return dealt.mapInArrow(_searched, "word string, n long, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` for ``links(word, form)``: the end of each word's chain of forms, by pointer doubling.

    A form occurs at least ``RATIO`` times as often as its word, so chains are short and have no circles.
    """
    found = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = materialize(
            lookup_join(found, further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "roots",
        )
        found = stepped.drop("_moved")
        if stepped.filter("_moved").isEmpty():
            return found


def grouped(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs(doc_id, text)``; see ``vocabulary`` for the words.

    A word's form is its near word of the largest n (ties: the first in code-point order) if that is at least ``RATIO``
    times the word's own. Null texts have no words; repeated rows count each. Other columns are ignored; an empty table
    gives no rows.
    """
    words = materialize(vocabulary(docs), "words")
    pairs = materialize(near_words(words), "near")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near", "near_n")).alias("best")
    )
    known = words.join(best, "word", "left")
    is_form = F.col("best.near_n") >= RATIO * F.col("n")
    known = materialize(
        known.select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near_n")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(known.filter("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
