"""Manifest, spelling variants and token counts against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from bizlens.llm import counts, merkle, spelling, tokens
from tests.llm.test_pairs import EXTRA, table


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


# manifest


def brute_tree(nodes):
    """The root and, per leaf, its siblings from below as (digest or None, left)."""
    paths = [[] for _ in nodes]
    groups = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for k, members in enumerate(groups):
            other = k ^ 1
            for i in members:
                paths[i].append((nodes[other], other < k) if other < len(nodes) else (None, False))
        nodes = [h("".join(nodes[k : k + 2])) for k in range(0, len(nodes), 2)]
        groups = [sum(groups[k : k + 2], []) for k in range(0, len(groups), 2)]
    return nodes[0], paths


def brute_manifest(rows):
    def leaf(row):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def shown(row):
        chosen = zlib.crc32(b"" if row[0] is None else str(row[0]).encode()) % 7 == 0
        return leaf((*row[:3], row[3] + 1 if chosen and row[3] is not None else row[3], row[4]))

    by_lang = collections.defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(brute_tree([leaf(r) for r in by_lang[lang]]))
    if not trees:
        return []
    root, above = brute_tree([t[0] for t in trees])
    out = []
    for lang, (subroot, paths), top in zip(langs, trees, above, strict=True):
        for row, path in zip(by_lang[lang], paths, strict=True):
            folded = shown(row)
            for node, left in path + top:
                folded = h(folded) if node is None else h(node + folded) if left else h(folded + node)
            out.append((row[0], leaf(row), subroot, root, h("".join(n for n, _ in path + top if n is not None)), folded, folded == root))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 37, 400])
def test_manifest(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["s1", None, "é"]), "en" if i % 3 else rng.choice(["de", "fr", None, "", "élan"]), rng.choice([i, None]),
             rng.choice(["", None, "text 😀", "x" * 5000])) for i in range(n)]
    if n > 30:
        rows += [rows[5]] * 3 + [(None, None, None, None, None), (None, "s1", "en", 7, "t"), (5, "other", "en", 1, "tie")]
    docs = table(spark, [(*r, *range(10)) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {EXTRA}")
    got = merkle.verified(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_manifest(rows), key=str)


def test_missing_nodes_are_minimal():
    """What a run asks for is what its proofs use from elsewhere and can't be derived from its own leaves."""
    for size in range(1, 40):
        leaves = [h(str(i)) for i in range(size)]
        root, paths = brute_tree(leaves)
        for low in range(size):
            for high in range(low + 1, size + 1):
                asked = merkle.missing(low, high, size)
                assert len(set(asked)) == len(asked)
                levels, got = merkle.shared_levels(leaves[low:high], low, size, {(lv, k): merkle_node(leaves, lv, k) for lv, k in asked})
                assert got == root
                for i in range(low, high):
                    assert list(merkle.path(levels, i)) == paths[i]
                for lv, k in asked:  # disjoint from the run, with a parent that is not
                    assert (k + 1) << lv <= low or k << lv >= high
                    assert (k >> 1) << (lv + 1) < high and ((k >> 1) + 1) << (lv + 1) > low
                for lv, k, node in merkle.frontier(leaves[low:high], low, size):
                    assert node == merkle_node(leaves, lv, k)


def merkle_node(leaves, level, number):
    for _ in range(level):
        leaves = [h("".join(leaves[k : k + 2])) for k in range(0, len(leaves), 2)]
    return leaves[number]


# spelling variants


def brute_words(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if crc % 199 == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_groups(rows):
    n = brute_words(rows)
    near = {w: [x for x in n if distance_one(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def variants(rng, count):
    letters = "abcdeinorst" + "éßÀ÷"
    words = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(count)] + ["ananas", "banana", "x" * 3000, "Éclair", "éclair", "colour", "color"]
    for w in list(words):
        for _ in range(rng.randint(0, 4)):
            at, c = rng.randrange(len(w)), rng.choice(letters)
            words.append(rng.choice([w[:at] + w[at + 1 :], w[:at] + c + w[at:], w[:at] + c + w[at + 1 :]]))
    return words


@pytest.mark.parametrize("cells", [None, 3])
def test_spelling_variants(spark, monkeypatch, cells):
    if cells:  # every path is dealt over several cells
        monkeypatch.setattr(spelling, "TRIE", cells)
        monkeypatch.setattr(spelling, "SEARCHES", 2 * cells)
    rng = random.Random(3)
    rows = [(None, None), (1, ""), (2, " \n "), (3, "12 ,. no")]
    for k, w in enumerate(variants(rng, 60)):
        for i in range(rng.choice([1, 4, 5, 6, 30, 160, 800])):
            rows.append((rng.randrange(5000), rng.choice([w, w.upper(), w + " " + w, f"({w})7{w}"])))
    rows += [rows[-1]] * 7 + [(None, "ananas Banana " * 5)]
    docs = table(spark, [(*r, *range(10)) for r in rows], f"doc_id long, text string, {EXTRA}")
    got = spelling.grouped(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_groups(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[2] != w[1] and w[1] for w in want), "a chain of forms is among the cases"
    assert spelling.grouped(docs.limit(0)).count() == 0


def test_one_edit():
    rng = random.Random(1)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(300)]
    for a in words:
        for b in words:
            assert spelling.one_edit(a, b) == distance_one(a, b)


# token counts


LIBRARY = Tokenizer.from_file(tokens.tokenizer_path("byte_bpe_50k.json"))


def n_tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def texts(rng):
    marks = [" ", "  ", "\n", "\n\n ", "'s", "'ll", "'S", "!", "...", "<|endoftext|>", "<|endof", "12", "３", "é", "日本語", "。", " ", "​", "😀", "é", "\t"]
    out = ["", None, " ", "short", "x" * 3000, "don't " * 400, " " * 2500, "日" * 900, "<|endoftext|>" * 120, "a" * 700 + " " + "b" * 900, "_" * 1500 + "é1" * 300]
    for _ in range(30):
        parts = [rng.choice([rng.choice(marks), "".join(rng.choices("abcdefghij", k=rng.randint(1, 12))), " word"]) for _ in range(rng.randint(1, 900))]
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("chunk, overlap", [(120, 60), (300, 64), (16_384, 256)])
def test_token_counts(spark, chunk, overlap):
    rng = random.Random(chunk)
    rows = [*enumerate(texts(rng)), (4, "don't " * 400), (None, "x y " * 300), (None, "x y " * 300)]
    docs = table(spark, [(*r, *range(10)) for r in rows], f"doc_id long, text string, {EXTRA}")
    got = counts.counted(docs, chunk=chunk, overlap=overlap)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), n_tokens(t), n_tokens(t) > 1024) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert counts.counted(docs.limit(0)).count() == 0


def test_stable_places_part_the_text():
    """At each stable place the library encodes the two sides as it encodes the whole."""
    rng = random.Random(8)
    for text in texts(rng)[11:20]:
        whole = LIBRARY.encode(text, add_special_tokens=False)
        ids, starts = whole.ids, np.array([a for a, _ in whole.offsets])
        places, before = counts.boundaries(text, starts, 1, len(text) - 1)
        assert len(text) < 50 or len(places)
        for p, n in list(zip(places, before, strict=True))[::7]:
            assert LIBRARY.encode(text[:p], add_special_tokens=False).ids == ids[:n]
            assert LIBRARY.encode(text[p:], add_special_tokens=False).ids == ids[n:]
