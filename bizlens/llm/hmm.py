"""Scoring of texts by a hidden Markov language model trained with Baum-Welch over all training texts."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import chunks, fold, text_of
from bizlens.session import materialize

STATES = 8
ITERATIONS = 5
#: The most frequent words have a class each; all others share classes by their last three bytes. Class 0 is the end.
TOP = 4096
TAILS = 1024
CLASSES = 1 + TOP + TAILS
SEGMENT = 256
BLOCK_BYTES = 16 << 20
SEED = 7

BLOCKS = "block long, doc_id long, held_out boolean, ids binary, word binary, idx int, n long"
SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, within double, classes binary"
)


def _planes(ids: np.ndarray) -> bytes:
    """Ids below 2^24 as three planes of bytes, which pack well."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    low, mid, high = np.frombuffer(data, np.uint8).reshape(3, -1).astype(np.int64)
    return low | mid << 8 | high << 16


def _blocked(batches):
    """Each block of texts as its distinct words with their training counts, and each text as numbers of its words."""
    part, block = TaskContext.get().partitionId(), 0
    names = ["block", "doc_id", "held_out", "ids", "word", "idx", "n"]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int32(), pa.int64()]
    for batch in chunks(batches, "text", BLOCK_BYTES):
        known: dict[bytes, int] = {b"": 0}
        numbers = []
        for text in batch.column("text").to_pylist():
            words = text.encode().lower().split()  # of bytes: lowers A-Z and splits at ASCII white space only
            numbers.append(np.fromiter([known.setdefault(w, len(known)) for w in words] + [0], np.int64, len(words) + 1))
        held = np.asarray(batch.column("held_out"))
        sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
        flat, training = np.concatenate(numbers), np.repeat(~held, sizes)
        order = np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        counts = np.bincount(flat[training], minlength=len(known))[order]
        key = part << 32 | block
        block += 1
        n = len(numbers)
        nothing = [pa.nulls(n, t) for t in types[4:]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, key)), batch.column("doc_id"), batch.column("held_out"), pa.array([_planes(place[x]) for x in numbers], pa.binary()), *nothing], names
        )
        words = list(known)
        words = pa.array([words[i] for i in order], pa.binary())
        for a in range(0, len(words), 50_000):
            n = min(50_000, len(words) - a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key)), *(pa.nulls(n, t) for t in types[1:4]), words.slice(a, n), pa.array(np.arange(a, a + n, dtype=np.int32)), pa.array(counts[a : a + n])], names
            )


def prepared(docs: DataFrame) -> tuple[DataFrame, dict]:
    """Base scores and class sequences of all texts, and the counts of the training texts.

    A text is split once: blocks of 16 MB of texts are stored as numbers with a dictionary of distinct words. Counts are summed and
    looked up for the dictionaries, by shuffles over their words, and then meet the numbered texts of their block. No vocabulary is
    sent to the driver or broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 1).alias("held_out"), text_of(docs).alias("text"))
    stored = materialize(rows.mapInArrow(_blocked, BLOCKS), "blocks")
    words = stored.filter("word is not null").select("block", "idx", "word", "n")
    counts = materialize(words.groupBy("word").agg(F.sum("n").alias("c")).filter("c > 0"), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tail = lambda w: F.lit(1 + TOP) + F.pmod(F.crc32(F.substring(w, -3, 3)), F.lit(TAILS))
    top = counts.filter(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(TOP)
    ranked = materialize(top.select("word", (F.monotonically_increasing_id() + 1).alias("cls")), "top")
    classed = counts.join(ranked, "word", "left").withColumn("cls", F.coalesce("cls", F.when(F.octet_length("word") == 0, 0).otherwise(tail(F.col("word")))))
    classed = materialize(classed.withColumn("cls", F.col("cls").cast("int")), "classed")
    own = classed.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()  # CLASSES rows at most
    mass = np.zeros(CLASSES)
    room = np.full(CLASSES, 0.5)  # a class without training words holds an unseen word only
    for r in own:
        mass[r.cls] = r.n
        room[r.cls] = r.n if r.cls <= TOP else r.n + 0.5 * (r.v + 1)
    facts = {"total": int(total), "distinct": int(distinct), "mass": mass, "room": room}
    looked = words.join(classed, "word", "left").select(
        F.col("block").alias("_block"), "idx", F.coalesce("c", F.lit(0)).alias("c"),
        F.coalesce("cls", F.when(F.octet_length("word") == 0, 0).otherwise(tail(F.col("word")))).cast("int").alias("cls"),
    )
    texts = stored.filter("ids is not null").select("block", "doc_id", "held_out", "ids")
    bottom = np.log10(total + 0.5 * (distinct + 1))

    def score(texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        n = dictionary.num_rows
        count, cls = np.zeros(n), np.zeros(n, np.int64)
        at = dictionary.column("idx").to_numpy()
        count[at], cls[at] = dictionary.column("c").to_numpy(), dictionary.column("cls").to_numpy()
        base = np.log10(count + 0.5) - bottom
        single = (cls <= TOP) & (count > 0)
        within = np.where(single, 0.0, np.log10(np.where(single, 1.0, count + 0.5) / room[cls]))
        if not texts.num_rows:
            return texts.select(["doc_id"]).slice(0, 0).cast(pa.schema([("doc_id", pa.int64())]))
        numbers = [_unplaned(x) for x in texts.column("ids").to_pylist()]
        sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
        starts, flat = np.cumsum(sizes) - sizes, np.concatenate(numbers)
        sums = [np.add.reduceat(x[flat], starts) for x in ((count > 0).astype(np.int64), base, within)]
        classes = [cls[x].astype("<u2").tobytes() for x in numbers]
        return pa.table(
            [texts.column("doc_id"), texts.column("held_out"), sizes, *sums, pa.array(classes, pa.binary())],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "within", "classes"],
        )

    grouped = texts.groupBy("block").cogroup(looked.groupBy("_block")).applyInArrow(score, SCORED)
    return materialize(grouped, "scored"), facts


class Model:
    """Start, transition and emission probabilities over word classes."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, mass: np.ndarray, states: int = STATES) -> Model:
        """Class frequencies, shaken differently for each state, and states that tend to stay."""
        rng = np.random.default_rng(SEED)
        emit = (mass + 0.01 * mass.sum() / len(mass) + 1e-9)[:, None] * rng.gamma(1.0, 1.0, (len(mass), states))
        step = np.full((states, states), 0.2 / max(states - 1, 1)) + np.eye(states) * (0.8 - 0.2 / max(states - 1, 1))
        return cls(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(0))

    @classmethod
    def of(cls, start: np.ndarray, step: np.ndarray, emit: np.ndarray, mass: np.ndarray) -> Model:
        """From expected counts, smoothed so that nothing has probability 0."""
        share = (mass + 0.5) / (mass + 0.5).sum()
        emit = emit + 1.0 * share[:, None] + 1e-6
        step, start = step + 0.1, start + 0.1
        return cls(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))

    def expected(self, sequences: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Baum-Welch counts (start, step, emit) of sequences, rows of classes filled up beyond their sizes."""
        n, longest = sequences.shape
        emit, step = self.emit.astype(np.float32), self.step.astype(np.float32)
        ahead = np.empty((longest, n, len(step)), np.float32)
        seen = emit[sequences.T]
        inside = np.arange(longest)[:, None] < sizes
        seen[~inside] = 1.0
        scale = np.empty((longest, n, 1), np.float32)
        now = self.start.astype(np.float32) * seen[0]
        for t in range(longest):
            if t:
                now = (now @ step) * seen[t]
            scale[t] = now.sum(1, keepdims=True)
            now = now / scale[t]
            ahead[t] = now
        back = np.ones((n, len(step)), np.float32)
        steps = np.zeros_like(self.step)
        for t in range(longest - 1, -1, -1):
            here = ahead[t]
            ahead[t] = here * back  # of the states at t, given the whole sequence
            if t:
                weighted = seen[t] * back / scale[t]
                use = inside[t][:, None]
                steps += (ahead[t - 1] * use).T.astype(np.float64) @ weighted
                back = np.where(use, weighted @ step.T, back)
        steps *= self.step
        given = ahead.reshape(-1, len(step))[inside.reshape(-1)]
        flat = sequences.T.reshape(-1)[inside.reshape(-1)]
        emits = np.stack([np.bincount(flat, given[:, k], len(emit)) for k in range(len(step))], axis=1)
        return ahead[0].sum(0).astype(np.float64), steps, emits

    def likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each whole sequence by the scaled forward recursion."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences))
        order = np.argsort(-sizes, kind="stable")
        flat = np.concatenate([sequences[i] for i in order])
        starts = np.cumsum(sizes[order]) - sizes[order]
        active = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), "right")
        total = np.zeros(len(sequences))
        now = self.start * self.emit[flat[starts]]
        for t, n in enumerate(active):
            if t:
                now = (now[:n] @ self.step) * self.emit[flat[starts[:n] + t]]
            size = now.sum(1, keepdims=True)
            total[:n] += np.log10(size[:, 0])
            now = now / size
        out = np.empty(len(sequences))
        out[order] = total
        return out


def _segments(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    parts = [x[a : a + SEGMENT] for x in (np.frombuffer(c, "<u2") for c in batch.column("classes").to_pylist()) for a in range(0, len(x), SEGMENT)]
    parts.sort(key=len)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.zeros((len(parts), int(sizes.max(initial=1))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate(parts)
    return out, sizes


def trained(scored: DataFrame, facts: dict, states: int = STATES, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over the class sequences of all training texts, cut into segments of 256 classes.

    Each round is one pass: tasks sum expected counts, one row for each class, and the sums (CLASSES + STATES + 1 rows) come to the
    driver, which makes the next model. Sums are rounded to millionths before they are added up, so the result doesn't depend on the order.
    """
    model = Model.first(facts["mass"], states)
    spark, names = scored.sparkSession, [f"s{k}" for k in range(states)]
    training = scored.filter("not held_out").select("classes")
    for _ in range(iterations if facts["total"] else 0):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches, shared=shared):
            model, total = shared.value, None
            for batch in chunks(batches, "classes", 1 << 20):
                segments, sizes = _segments(batch)
                found = model.expected(segments, sizes)
                total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
            if total is not None:
                start, step, emit = total
                table = np.concatenate((emit, step, start[None]))
                some = np.flatnonzero(table.sum(1) > 0)
                whole = np.rint(table[some] * 1e6).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(np.ascontiguousarray(whole[:, k])) for k in range(states))], ["i", *names])

        summed = training.mapInArrow(expect, "i long, " + ", ".join(f"{n} long" for n in names))
        table = np.zeros((CLASSES + states + 1, states))
        for r in summed.groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect():
            table[r.i] = [r[n] / 1e6 for n in names]
        model = Model.of(table[-1], table[CLASSES:-1], table[:CLASSES], facts["mass"])
    return model


def scores(docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts whose crc32(doc_id as text) mod 5 is 1 are held out of all counts. The model: hidden states follow a Markov chain, a state emits
    a word class, and a class its word: one of the 4,096 most frequent words, or one of 1,024 classes by ending, whose words are
    as likely as their smoothed counts, with room for one unseen word. ``score`` is the exact log10 probability of all tokens, the
    end included, by the scaled forward recursion over the whole text; ``base_score`` is the smoothed unigram score.

    A null or empty text is its end alone. Repeated rows are scored each; a null doc_id counts as empty text in the split. Other columns
    are ignored; an empty table gives no rows.
    """
    scored, facts = prepared(docs)
    model = trained(scored, facts, states, iterations)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in chunks(batches, "classes", 4 << 20):
            found = model.likelihoods([np.frombuffer(c, "<u2") for c in batch.column("classes").to_pylist()])
            score = found + batch.column("within").to_numpy()
            kept = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(score)], [*kept, "score"])

    out = scored.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(facts["total"]).cast("long"))


def tail_class(word: bytes) -> int:
    """The shared class of a word that is not among the most frequent ones (for tests)."""
    return 1 + TOP + zlib.crc32(word[-3:]) % TAILS
