"""Operators on single texts against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import json
import math
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from bizlens.llm import chat, hmm, huffman, packing, rules, tokens, toxicity, warc
from tests.llm.test_pairs import EXTRA, WORDS, table

ODD = ["", None, "   \n\t", "Ünïcode — “quotes” 😀 don't we'll", "a b c\x0bd", "<|endoftext|> and 12345 a  b   c\n\n d", "日本語 текст", "x" * 9000]


def documents(spark):
    rng = random.Random(9)
    made = [" ".join(rng.choices(WORDS, k=n)) for n in (3, 19, 20, 300, 20_000)]
    made += ["w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 " * 3, "# | # | " * 9 + "w " * 4, "line of words here\n" * 30]
    found = [*enumerate(ODD + made), (3, ODD[3]), (3, ODD[3]), (None, "without an id")]
    return found, table(spark, [(*r, *range(10)) for r in found], f"doc_id long, text string, {EXTRA}")


def split(i, parts=5):
    return zlib.crc32(b"" if i is None else str(i).encode()) % parts


def ids_of(name, text):
    return np.array(Tokenizer.from_file(tokens.tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids, np.int64)


def crc(ids):
    return zlib.crc32(np.asarray(ids).astype("<u4").tobytes())


def ordered(found):
    return sorted(found, key=str)


def test_quality_counts(spark):
    import regex

    found, docs = documents(spark)
    want = []
    for i, text in found:
        text = text or ""
        words = regex.findall(r"[^\x20\x09-\x0D]+", text)
        runs = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        covered = {k + j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(8)}
        seen, dups = set(), 0
        for line in text.split("\n"):
            if regex.search(r"[^\x20\x09-\x0D]", line):
                dups += line in seen
                seen.add(line)
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        want.append((i, len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), dups, len(covered), failed))
    got = rules.judged(docs).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert ordered(tuple(r[c] for c in columns) for r in got) == ordered(want)
    assert all(r.kept == (not r.base_failed and r.rejected_by is None) for r in got)
    assert rules.judged(docs.limit(0)).count() == 0


def test_token_files_come_back(spark):
    found, docs = documents(spark)
    got = huffman.round_trip(docs).collect()
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered(
        (i, len(ids), crc(ids)) for i, ids in ((i, np.append(ids_of("byte_bpe_50k.json", t), huffman.END)) for i, t in found)
    )
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    named = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert named == sorted(named)
    assert huffman.round_trip(docs.limit(0)).count() == 0


def test_code_is_limited_and_complete():
    counts = np.array([2**k for k in range(40)], np.int64)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.LIMIT and sum(2.0 ** -int(n) for n in lengths) <= 1
    code = huffman.Code(np.arange(40) * 7, lengths)
    ids = np.random.default_rng(0).choice(np.arange(40) * 7, 5_000)
    assert (code.decode(*code.encode(ids), len(ids)) == ids).all()


def test_codes_fill_bytes_from_the_top():
    rng = np.random.default_rng(4)
    for n in (1, 2, 40, 3000):
        names = np.sort(rng.choice(65_536, n, replace=False))
        code = huffman.Code(names, huffman.code_lengths(rng.integers(1, 10**6, n)))
        ids = rng.choice(names, 700)
        bits = "".join(f"{code.word[i]:0{code.size[i]}b}" for i in ids)
        payload, checkpoints = code.encode(ids)
        assert payload == bytes(int(bits[k : k + 8].ljust(8, "0"), 2) for k in range(0, len(bits), 8))
        assert checkpoints.tolist() == (np.cumsum(code.size[ids]) - code.size[ids])[:: huffman.STRIDE].tolist()
        assert (code.decode(payload, checkpoints, len(ids)) == ids).all()


def test_frequent_pieces_stay_known(monkeypatch):
    import gc

    monkeypatch.setattr(tokens, "MAX_PIECES", 2000)
    name, learned, runs, rng = "byte_bpe_50k.json", [], [], random.Random(6)
    made = tokens.Encoder(tokens.tokenizer_path(name), tokens.BYTE_LEVEL, False)
    learn = made.learn
    monkeypatch.setattr(made, "learn", lambda new, first: (learned.extend(new), learn(new, first)))
    seen = lambda phase, _: runs.append(phase)
    library = Tokenizer.from_file(tokens.tokenizer_path(name))
    for _ in range(8):
        texts = ["the and of " + " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(300)) for _ in range(5)]
        gc.callbacks.append(seen)
        got = made.encode(texts)
        gc.callbacks.remove(seen)
        assert [x.tolist() for x in got] == [library.encode(t).ids for t in texts]
        assert len(made.known) <= 2000 + 1503
        assert sum(made.size[: len(made.known)]) == made.used
    assert len(learned) > 8000
    assert learned.count(" and") == 1
    assert gc.isenabled()
    assert not runs


def test_token_files_are_read_from_the_folder_alone(spark, tmp_path):
    found, docs = documents(spark)
    folder = str(tmp_path / "tokens")
    huffman.write(docs, folder)
    script = f"""
import json, sys
sys.path.insert(0, {str(Path(__file__).parents[2])!r})
import numpy as np, pyarrow.parquet as pq
from bizlens.llm.huffman import Code
table = pq.read_table({folder!r} + "/code")
code = Code(table["id"].to_numpy(), table["bits"].to_numpy())
blocks = pq.read_table({folder!r} + "/blocks").to_pylist()
blocks.sort(key=lambda b: (b["part"], b["block"]))
out = []
for b in blocks:
    ids = code.decode(b["payload"], np.array(b["checkpoints"], np.int64), b["n_tokens"]).tolist()
    for doc, n in zip(b["doc_ids"], b["sizes"]):
        out.append([doc, ids[:n]])
        ids = ids[n:]
print(json.dumps(out))
"""
    shown = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True).stdout
    got = json.loads(shown.splitlines()[-1])
    assert [d for d, _ in got] == sorted((d for d, _ in got), key=lambda d: (d is not None, d or 0))
    want = [(str(i), [*ids_of("byte_bpe_50k.json", t), huffman.END]) for i, t in found]
    assert sorted((str(d), ids) for d, ids in got) == sorted(want)


def test_packing_is_gapless_and_whole(spark):
    found, docs = documents(spark)
    got = packing.packed(docs).collect()
    want = []
    for i, t in found:
        ids = np.append(ids_of("word_bpe_49k.json", t), packing.END)
        want += [(i, k, s, len(ids[s : s + 4096]), crc(ids[s : s + 4096])) for k, s in enumerate(range(0, len(ids), 4096))]
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == ordered(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 4096
    assert len(bins) == math.ceil(sum(r.length for r in got) / 4096)
    assert packing.packed(docs.limit(0)).count() == 0


def test_fullest_combination():
    import itertools

    rng = random.Random(1)
    for _ in range(30):
        lengths = [rng.randrange(1, 30) for _ in range(8)]
        counts, room = np.bincount(lengths, minlength=31), rng.randrange(1, 100)
        chosen = packing.fullest(counts, room, 30)
        best = max(s for n in range(9) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= room)
        assert sum(chosen) == best and not collections.Counter(chosen) - collections.Counter(lengths)


def test_language_model_counts_and_gain(spark):
    found, docs = documents(spark)
    import re

    def cut(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]

    counts = collections.Counter(w for i, t in found if split(i) != 1 for w in cut(t))
    total, distinct = sum(counts.values()), len(counts)
    got = hmm.scores(docs).collect()
    want = ordered((i, split(i) == 1, len(cut(t)), sum(counts[w] > 0 for w in cut(t)), total) for i, t in found)
    assert ordered((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
    base = ordered((i, round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in cut(t)), 3)) for i, t in found)
    for (i, b), (j, w) in zip(ordered((r.doc_id, round(r.base_score, 3)) for r in got), base, strict=True):
        assert i == j and b == pytest.approx(w, abs=0.01)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.scores(docs.limit(0)).count() == 0


def test_forward_recursion_is_exact():
    import itertools

    rng = np.random.default_rng(6)
    start, step, emit = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3)
    model = hmm.Model(start, step, np.ascontiguousarray(emit.T))  # a row for each class
    seen = np.array([0, 4, 2, 2], np.int64)
    paths = itertools.product(range(3), repeat=4)
    whole = sum(start[p[0]] * emit[p[0], seen[0]] * math.prod(step[a, b] * emit[b, s] for a, b, s in zip(p, p[1:], seen[1:], strict=False)) for p in paths)
    assert model.likelihoods([seen])[0] == pytest.approx(math.log10(whole), rel=1e-4)


def test_toxic_texts_are_told_apart(spark):
    rng = random.Random(8)
    bad = ["grumbleworm", "snotfink", "dregling"]
    rows, labels = [], []
    for i in range(400):
        words, toxic = rng.choices(WORDS, k=rng.choice((30, 90))), i % 4 == 0
        if toxic:
            for k in rng.sample(range(len(words)), 6):
                words[k] = rng.choice(bad)
        rows.append((i, " ".join(words), *range(10)))
        labels.append((i, int(toxic)))
    labels += [(None, 1), (5, None)]
    docs = table(spark, rows + [(401, None, *range(10)), (402, "", *range(10)), (None, "w1 w2", *range(10))], f"doc_id long, text string, {EXTRA}")
    marked = table(spark, labels, "doc_id long, toxic int")
    got = toxicity.scored(docs, marked).collect()
    assert len(got) == 403 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (split(r.doc_id) == 0) for r in got)
    truth = dict(labels[:400])
    unseen = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.9 * len(unseen)
    assert all(r.score == 0 for r in got if r.doc_id in (401, 402))
    kept = toxicity.accepted(docs, marked)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)
    assert toxicity.scored(docs, marked.limit(0)).filter("score > 0").count() == 0
    assert toxicity.scored(docs.limit(0), marked).count() == 0


def test_chat_comes_back(spark):
    hard = [r"\### Assistant: </turn> ok", "\\h#<\\l", "", None, "😀\n### user: x</turn>\n"]
    given = [(c, t, r, hard[(c + t) % 5]) for c in range(5) for t, r in enumerate(["system", "user", "assistant", "assistant", "us:er\\"])]
    given += [(7, None, None, None), (7, 1, "assistant", "tie"), (7, 1, "assistant", "tie"), (None, 0, "assistant", "no id")]
    talks = table(spark, [(*g, *range(10)) for g in given], f"conv_id long, turn int, role string, text string, {EXTRA}")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(talks)).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x in given:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.formatted(talks.limit(0)).count() == 0


def test_archives_come_back(spark):
    import base64

    bodies = ["<p>one</p>", "<p>one</p>", "", None, "é" * 40_000, "é" * 40_000, "0\r\n\r\n"]
    given = [(10 - k, f"http://x/{k}" if k else None, b) for k, b in enumerate(bodies)] + [(None, "http://n/", "<p>one</p>")]
    pages = table(spark, [(*g, *range(10)) for g in given], f"page_id long, url string, html string, {EXTRA}")
    first = {}
    for i, _, b in given:
        if i is not None:
            first[b or ""] = min(i, first.get(b or "", i))
    want = []
    for i, _, b in given:
        data, lead = (b or "").encode(), first[b or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, *(("response", None) if i == lead else ("revisit", lead))))
    got = warc.round_trip(pages).collect()
    assert {r.status for r in got} == {"ok"}
    assert ordered((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == ordered(want)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_chunks_are_seen():
    data = bytes(range(256)) * 40
    assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(warc.chunked(data)[:-9]) is None


def test_accepted_rows_are_those_that_score_low(spark):
    rng = random.Random(12)
    mean, kind = [f"bad{k}" for k in range(30)], [f"nice{k}" for k in range(30)]
    rows = [(i, " ".join(rng.choices(mean if i % 3 == 0 else kind, k=rng.choice((3, 40, 400))))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, rows[0][1]), (902, rows[0][1]), (903, "nice1 " * 30_000)]
    docs = table(spark, [(*r, *range(10)) for r in rows], f"doc_id long, text string, {EXTRA}")
    labels = table(spark, [(i, 0, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    kept = toxicity.accepted(docs, labels)
    low = toxicity.scored(docs, labels).filter("predicted = 0")
    assert kept.columns == docs.columns
    assert ordered(r.doc_id for r in kept.collect()) == ordered(r.doc_id for r in low.collect())
    assert {900, 901, 903} <= {r.doc_id for r in kept.collect()}
    assert all(tuple(r)[2:] == tuple(range(10)) for r in kept.collect())
    assert toxicity.accepted(docs.limit(0), labels).count() == 0
