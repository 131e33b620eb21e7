"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, trained here in numpy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import chunks, fold, text_of

WINDOW = 32
STRIDE = 16
HIDDEN = 8
WORD_SLOTS, CHAR_SLOTS, WIDTH = 32_768, 16_384, 8
#: A word has an embedding of its own if so many texts of the sample hold it; a rarer one has its characters only.
LEAST_TEXTS = 6
#: Bounds of the training sample: labelled texts of each kind, windows of one text, characters of one window.
MOST_TOXIC, MOST_CLEAN, MOST_WINDOWS, MOST_CHARS = 2_000, 4_000, 8, 2_000
#: With so many toxic texts in the sample, one half trains the network and the other the regression over windows.
ENOUGH = 200
EPOCHS, BATCH, RATE, DECAY, SEED = 7, 256, 0.01, 0.02, 3
MAX_WORDS = 200_000
EDGES = ".,;:!?\"'()[]"


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all runs of 3 and of 4 bytes of ``^word$``, and how many each word has (3 bytes at least, so one or more)."""
    coded = [b"^" + (w.encode() or b"_") + b"$" for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.frombuffer(b"".join(coded) + b"\0\0\0", np.uint8).astype(np.int64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())  # bytes from here to the end of the word
    three = flat[:-3] * 65_599 + flat[1:-2] * 257 + flat[2:-1]
    n = len(left)
    first, second = three[:n] * 2_654_435_761 >> 7, (three[:n] * 31_337 + flat[3 : n + 3]) * 2_246_822_519 >> 9
    slots = np.stack((first, second), axis=1) % CHAR_SLOTS
    used = np.stack((left >= 3, left >= 4), axis=1)
    owner = np.repeat(np.arange(len(coded)), sizes)
    counts = np.bincount(owner, used.sum(1), len(coded)).astype(np.int64)
    return slots[used], counts


def word_slots(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.strip(EDGES).encode()) % WORD_SLOTS for w in words), np.int64, len(words))


def spans(n: int) -> list[int]:
    """Where the overlapping windows of a text of ``n`` words begin; the last one ends with the text."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Word and character embeddings, a GRU in each direction, attention pooling and one output.

    ``p`` holds the parameters. Of the GRU, ``wx`` and ``wh`` hold both directions and the update, reset and new-state gates.
    """

    def __init__(self, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, 2 * WIDTH
        normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
        self.join = np.array([1.0, 0.0, 0.0, 0.0, 0.0])
        self.usual = np.ones((WORD_SLOTS, 1), np.float32)
        self.p = {
            "word": rng.normal(0, 0.1, (WORD_SLOTS, WIDTH)).astype(np.float32), "char": rng.normal(0, 0.3, (CHAR_SLOTS, WIDTH)).astype(np.float32),
            "wx": normal(2, d, 3 * h), "wh": normal(2, h, 3 * h), "bx": np.zeros((2, 1, 3 * h), np.float32),
            "wa": normal(2 * h, h), "va": normal(h, 1), "wo": normal(2 * h, 1), "bo": np.zeros(1, np.float32),
        }

    def features(self, words: list[str]) -> tuple:
        """Inputs of distinct words: their embedding, and the mean embedding of their characters' runs."""
        slots, counts = grams(words)
        ends = np.cumsum(counts)
        sums = np.add.reduceat(self.p["char"][slots], ends - counts, axis=0) / counts[:, None].astype(np.float32)
        own = word_slots(words)
        return np.concatenate((self.p["word"][own] * self.usual[own], sums), axis=1), own, slots, counts

    def forward(self, projected: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows. ``projected``: for each direction, gate inputs of distinct words; ``index``: (windows, words)."""
        p, h = self.p, HIDDEN
        n, steps = index.shape
        state, states, cache = np.zeros((2, n, h), np.float32), np.empty((steps, 2, n, h), np.float32), []
        for t in range(steps):
            at = (t, steps - 1 - t)
            gates = np.stack((projected[0][index[:, at[0]]], projected[1][index[:, at[1]]]))
            inner = state @ p["wh"]
            zr = _sigmoid(gates[:, :, : 2 * h] + inner[:, :, : 2 * h])
            z, r = zr[:, :, :h], zr[:, :, h:]
            new = np.tanh(gates[:, :, 2 * h :] + r * inner[:, :, 2 * h :])
            after = z * state + (1 - z) * new
            if mask is not None:
                m = np.stack((mask[:, at[0]], mask[:, at[1]]))[:, :, None]
                after = np.where(m, after, state)
            if keep:
                cache.append((state, inner, z, r, new))
            state = after
            states[t] = after
        both = np.concatenate((states[:, 0], states[::-1, 1]), axis=2)  # (words, windows, 2h)
        hidden = np.tanh(both @ p["wa"])
        weight = (hidden @ p["va"])[:, :, 0]
        if mask is not None:
            weight = np.where(mask.T, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tnk->nk", weight, both)
        logit = (pooled @ p["wo"])[:, 0] + p["bo"]
        return (logit, cache, both, hidden, weight, pooled) if keep else logit

    def gradients(self, words: list[str], index: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """Logits, and gradients of the weighted cross-entropy by back-propagation through time."""
        p, h = self.p, HIDDEN
        x, own, slots, counts = self.features(words)
        projected = x @ p["wx"] + p["bx"]
        logit, cache, both, hidden, att, pooled = self.forward(projected, index, mask, keep=True)
        n, steps = index.shape
        d_logit = ((_sigmoid(logit) - target) * weight / weight.sum()).astype(np.float32)[:, None]
        g = {"wo": pooled.T @ d_logit, "bo": d_logit.sum(0)}
        d_pooled = d_logit @ p["wo"].T
        d_both = att[:, :, None] * d_pooled
        d_att = np.einsum("tnk,nk->tn", both, d_pooled)
        d_score = (att * (d_att - (att * d_att).sum(0)))[:, :, None]
        g["va"] = np.einsum("tnh,tno->ho", hidden, d_score)
        d_hidden = d_score * p["va"][:, 0] * (1 - hidden**2)
        g["wa"] = np.einsum("tnk,tnh->kh", both, d_hidden)
        d_both = d_both + d_hidden @ p["wa"].T
        d_states = np.stack((d_both[:, :, :h], d_both[::-1, :, h:]), axis=1)
        d_projected = np.zeros_like(projected)
        g["wh"], d_state = np.zeros_like(p["wh"]), np.zeros((2, n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            state, inner, z, r, new = cache[t]
            at = (t, steps - 1 - t)
            d_after = d_state + d_states[t]
            m = np.stack((mask[:, at[0]], mask[:, at[1]]))[:, :, None]
            d_state = np.where(m, 0, d_after)
            d_after = np.where(m, d_after, 0)
            d_new = d_after * (1 - z) * (1 - new**2)
            d_z = d_after * (state - new) * z * (1 - z)
            d_r = d_new * inner[:, :, 2 * h :] * r * (1 - r)
            d_inner = np.concatenate((d_z, d_r, d_new * r), axis=2)
            g["wh"] += state.transpose(0, 2, 1) @ d_inner
            d_state = d_state + d_after * z + d_inner @ p["wh"].transpose(0, 2, 1)
            d_gates = np.concatenate((d_z, d_r, d_new), axis=2)
            for k in (0, 1):
                np.add.at(d_projected[k], index[:, at[k]], d_gates[k])
        g["bx"] = d_projected.sum(1, keepdims=True)
        g["wx"] = x.T @ d_projected
        d_x = (d_projected @ p["wx"].transpose(0, 2, 1)).sum(0)
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], own, d_x[:, :WIDTH] * self.usual[own])
        np.add.at(g["char"], slots, np.repeat(d_x[:, WIDTH:] / counts[:, None].astype(np.float32), counts, axis=0))
        return logit, g


def indexed(windows: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, and windows as numbers of words with a mask for short ones."""
    known: dict[str, int] = {}
    index, mask = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), bool)
    for row, words in enumerate(windows):
        index[row, : len(words)] = [known.setdefault(w, len(known)) for w in words]
        mask[row, : len(words)] = True
    return list(known), index, mask


def fit(windows: list[list[str]], owner: np.ndarray, toxic: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Train on windows of texts; ``owner`` numbers the texts, ``toxic`` is the label of each window's text.

    A toxic text may have harmless windows, and a text's score is that of its worst window. So from the third epoch on
    each toxic text counts by the windows that score at least 0.7 of its highest score.
    """
    net, rng = Network(), np.random.default_rng(SEED)
    texts: dict[int, set] = {}
    for k, words in zip(owner, windows, strict=True):
        texts.setdefault(int(k), set()).update(words)
    held = np.zeros(WORD_SLOTS, np.int64)
    for words in texts.values():
        held[np.unique(word_slots(list(words)))] += 1
    net.usual = (held >= LEAST_TEXTS).astype(np.float32)[:, None]
    moment = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    weight = np.where(toxic > 0, 0.5 / max(toxic.sum(), 1), 0.5 / max((1 - toxic).sum(), 1)) * len(toxic)
    logit, step = np.zeros(len(windows)), 0
    for epoch in range(epochs):
        live = weight.copy()
        if epoch >= 2:
            score = _sigmoid(logit)
            best = np.zeros(int(owner.max()) + 1)
            np.maximum.at(best, owner, score)
            live[(toxic > 0) & (score < 0.7 * best[owner])] = 0
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            rows = order[a : a + BATCH]
            if not live[rows].sum():
                continue
            words, index, mask = indexed([windows[i] for i in rows])
            logit[rows], g = net.gradients(words, index, mask, toxic[rows], live[rows])
            step += 1
            rate = RATE * (1 - 0.8 * epoch / max(epochs, 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, d in g.items():
                moment[k] = 0.9 * moment[k] + 0.1 * d
                square[k] = 0.999 * square[k] + 0.001 * d * d
                net.p[k] -= (rate * (moment[k] / (np.sqrt(square[k]) + 1e-8) + DECAY * net.p[k])).astype(np.float32)
    return net


def _half(doc_id: int) -> int:
    return zlib.crc32(f"half {doc_id}".encode()) & 1


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Fit the network on labelled rows whose crc32(doc_id as text) mod 5 is not 0; None without any of a kind.

    The sample is bounded: at most 2,000 toxic and 4,000 other texts, chosen by a hash of their ids, and at most 8 windows of each, spread over
    the whole text; windows of over 2,000 characters are left out. Of several labels of an id, toxic wins; null labels don't count.
    """
    known = labels.filter("toxic is not null and doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    known = known.filter(fold() != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [
        known.filter(F.col("toxic") == t).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(most)
        for t, most in ((1, MOST_TOXIC), (0, MOST_CLEAN))
    ]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 6,000 rows at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).join(chosen, "doc_id")

    def windows(batches):
        for batch in chunks(batches, "text"):
            out = []
            for doc_id, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True):
                words = text.lower().split()
                starts = spans(len(words)) if words else []
                if len(starts) > MOST_WINDOWS:
                    starts = [starts[(2 * k + 1) * len(starts) // (2 * MOST_WINDOWS)] for k in range(MOST_WINDOWS)]
                cut = [" ".join(words[s : s + WINDOW]) for s in starts]
                out += [{"doc_id": doc_id, "toxic": toxic, "place": k, "words": w} for k, w in enumerate(cut) if len(w) <= MOST_CHARS]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("place", pa.int32()), ("words", pa.string())]))

    rows = rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    sample = rows.mapInArrow(windows, "doc_id long, toxic int, place int, words string").distinct()
    sample = sample.orderBy("doc_id", "place", "words").limit(MOST_WINDOWS * (MOST_TOXIC + MOST_CLEAN)).toPandas()
    toxic = sample["toxic"].to_numpy(np.float64)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    halves = len(sample.loc[sample["toxic"] > 0, "doc_id"].unique()) >= ENOUGH
    if halves:
        sample = sample[sample["doc_id"].map(_half) == 0]
        toxic = sample["toxic"].to_numpy(np.float64)
    owner = np.unique(sample["doc_id"].to_numpy(), return_inverse=True)[1]
    net = fit([w.split(" ") for w in sample["words"]], owner, toxic)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def facts(batches):
        scorer = Scorer(shared.value)
        for batch in chunks(batches, "text", 4 << 20):
            some, found = scorer.facts(batch.column("text").to_pylist())
            out = [batch.column("doc_id"), batch.column("toxic"), *(pa.array(np.ascontiguousarray(x)) for x in found.T)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "toxic", "a", "b", "c", "d"]).filter(pa.array(some))

    # Whole texts of the sample, one row of numbers each; of repeated ids one row.
    known = rows.mapInArrow(facts, "doc_id long, toxic int, a double, b double, c double, d double").groupBy("doc_id").agg(
        *[F.max(x).alias(x) for x in ("toxic", "a", "b", "c", "d")]
    ).orderBy("doc_id").toPandas()
    if halves:
        known = known[known["doc_id"].map(_half) == 1]
    net.join = joined(known[["a", "b", "c", "d"]].to_numpy(), known["toxic"].to_numpy(np.float64))
    return net


class Scorer:
    """Scores texts; gate inputs of up to ``MAX_WORDS`` distinct words are remembered."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((2, 0, 3 * HIDDEN), np.float32)

    def facts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each text has words, and what its windows say: highest logit, mean score, mean logit and how many they are."""
        if len(self.known) > MAX_WORDS:
            self.forget()
        known, first = self.known, len(self.known)
        numbers, sizes = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            words = text.lower().split()
            sizes[k] = len(words)
            numbers.append(np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words)))
        if len(known) > first:
            x = self.net.features(list(known)[first:])[0]
            self.table = np.concatenate((self.table, x @ self.net.p["wx"] + self.net.p["bx"]), axis=1)
        out = np.zeros((len(texts), 4))
        for rows, full in ((np.flatnonzero(sizes >= WINDOW), True), (np.flatnonzero((sizes > 0) & (sizes < WINDOW)), False)):
            if not len(rows):
                continue
            flat = np.concatenate([numbers[i] for i in rows])
            base = np.cumsum(sizes[rows]) - sizes[rows]
            if full:
                starts = [np.array(spans(int(n))) + b for n, b in zip(sizes[rows], base, strict=True)]
                counts = np.fromiter(map(len, starts), np.int64, len(starts))
                begin = np.concatenate(starts)
                best = np.empty(len(begin))
                for a in range(0, len(begin), 4096):
                    index = flat[begin[a : a + 4096, None] + np.arange(WINDOW)]
                    best[a : a + 4096] = self.net.forward(self.table, index, None)
                best, at = np.clip(best, -8, 8), np.cumsum(counts) - counts
                means = [np.add.reduceat(x, at) / counts for x in (_sigmoid(best), best)]
                out[rows] = np.stack((np.maximum.reduceat(best, at), *means, np.log(counts)), axis=1)
            else:
                place = np.arange(WINDOW)
                mask = place < sizes[rows][:, None]
                index = flat[np.minimum(base[:, None] + place, len(flat) - 1)]
                logit = np.clip(self.net.forward(self.table, index, mask).astype(np.float64), -8, 8)
                out[rows] = np.stack((logit, _sigmoid(logit), logit, np.zeros(len(rows))), axis=1)
        return sizes > 0, out

    def scores(self, texts: list[str]) -> np.ndarray:
        """The score of each text from all its windows; 0 for texts without words."""
        some, facts = self.facts(texts)
        return np.where(some, _sigmoid(facts @ self.net.join[:-1] + self.net.join[-1]), 0.0)


def joined(facts: np.ndarray, toxic: np.ndarray, steps: int = 25) -> np.ndarray:
    """Logistic regression from the facts of a text's windows to its label (Newton's method, both labels equally heavy)."""
    scale = np.maximum(np.abs(facts).max(axis=0), 1e-9)
    x, beta = np.column_stack((facts / scale, np.ones(len(facts)))), np.zeros(facts.shape[1] + 1)
    weight = np.where(toxic > 0, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())
    ridge = np.diag([1e-4] * facts.shape[1] + [1e-6])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        beta -= np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (p - toxic)) + ridge @ beta)
    return np.append(beta[:-1] / scale, beta[-1])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Toxicity of every whole text of ``docs(doc_id, text)``: ``doc_id, held_out, score, predicted``.

    The network is trained on ``labels(doc_id, toxic)`` (see ``train``) and scores all windows of 32 words that begin every 16 words; a logistic
    regression joins the highest logit, the mean score and the mean logit of a text's windows and their number. Only the text is an input. Null and empty texts, and all texts if nothing could be learned,
    score 0. Repeated rows are scored each. Other columns are ignored; an empty table gives no rows.
    """
    net = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), text_of(docs).alias("text"))

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for batch in chunks(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(found)], ["doc_id", "held_out", "score"])

    out = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns, whatever their names. Null and empty texts stay."""
    net = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for batch in chunks(batches, "text", 1 << 20):
            if scorer:
                texts = [text or "" for text in batch.column("text").to_pylist()]
                batch = batch.filter(pa.array(scorer.scores(texts) < 0.5))
            yield batch

    return docs.mapInArrow(run, docs.schema)
