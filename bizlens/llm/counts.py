"""Token counts of whole texts. Huge texts are encoded in overlapping chunks that are spliced where both encodings agree."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.llm.common import chunks, text_of
from bizlens.llm.tokens import BYTE_LEVEL, encoder, tokenizer_path
from bizlens.operators.joins import lookup_join
from bizlens.session import materialize

#: Characters of a chunk, and of the overlap of neighbouring chunks at the first attempt.
CHUNK, OVERLAP = 16_384, 256
#: What both grow by where an alignment failed.
WIDER, WIDER_OVERLAP = 4, 16
LIMIT = 1024

_LETTER, _DIGIT, _SIGN, _BLANK, _UNSURE = range(5)


@cache
def _kind(char: str) -> int:
    """The class of a character in the splitting pattern; unsure unless every Unicode version agrees on it."""
    if char in " \t\n\r\x0b\x0c":
        return _BLANK
    kind = unicodedata.category(char)[0]
    if unicodedata.ucd_3_2_0.category(char)[0] != kind:
        return _UNSURE
    return {"L": _LETTER, "N": _DIGIT, "P": _SIGN, "S": _SIGN, "M": _SIGN}.get(kind, _UNSURE)


def stable(text: str) -> np.ndarray:
    """Places of ``text`` where a byte-level tokenizer's pieces must part, whatever stands before and behind.

    A piece is a run of letters, of digits or of signs, with at most a blank in front, a contraction (an apostrophe and
    letters), or blanks. So one always ends between a letter or digit and a character of another class, and between a
    sign and a digit or blank. What follows such a place is split and merged as if the text began there.
    """
    kinds = np.array([_kind(c) for c in text], np.int8)
    a, b = kinds[:-1], kinds[1:]
    parts = (a <= _DIGIT) & (a != b) | (a == _SIGN) & ((b == _DIGIT) | (b == _BLANK))
    return np.flatnonzero(parts & (a != _UNSURE) & (b != _UNSURE)) + 1


def boundaries(text: str, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable places ``low <= p <= high`` where a token starts, and the number of tokens that start before each."""
    first = max(low - 1, 0)
    places = stable(text[first : high + 1]) + first
    places = places[(places >= low) & (places <= high)]
    before = np.searchsorted(starts, places)
    held = before < len(starts)
    held[held] = starts[before[held]] == places[held]
    return places[held], before[held]


def _cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``key, k, last, piece`` of ``texts(key, text)``: chunk ``k`` starts at ``k * (chunk - overlap)``."""
    step = chunk - overlap

    def run(batches):
        for batch in chunks(batches, "text", 4 << 20):
            rows: list[tuple] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                last = max(-(-(len(text) - overlap) // step), 1) - 1
                for k in range(last + 1):
                    rows.append((key, k, k == last, text[k * step : k * step + chunk]))
                    if len(rows) * chunk > 8 << 20:
                        yield table(rows)
                        rows = []
            yield table(rows)

    def table(rows):
        kinds = (pa.string(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["key", "k", "last", "piece"])

    return texts.mapInArrow(run, "key string, k int, last boolean, piece string")


def _encoded(pieces: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``key, k, n, head, tail`` of every chunk: its tokens, and maps from stable places (counted in the whole text) in
    the overlap with the chunk before to the tokens before them, and in the overlap behind to the tokens from them on."""
    step = chunk - overlap

    def run(batches):
        tokenizer = encoder(path, BYTE_LEVEL).tokenizer
        # A special token's text is taken out before the splitting, so it must be seen whole by both chunks.
        margin = max([len(t.content) for t in tokenizer.get_added_tokens_decoder().values()], default=0) + 1
        for batch in chunks(batches, "piece", 1 << 20):
            rows = []
            texts = batch.column("piece").to_pylist()
            found = tokenizer.encode_batch(texts, add_special_tokens=False)
            for text, e, key, k, last in zip(texts, found, *(batch.column(c).to_pylist() for c in ("key", "k", "last")), strict=True):
                starts = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
                row = {"key": key, "k": k, "n": len(starts), "head": [], "tail": []}
                if k:
                    places, before = boundaries(text, starts, margin, overlap - margin)
                    row["head"] = list(zip((places + k * step).tolist(), before.tolist(), strict=True))
                if not last:
                    places, before = boundaries(text, starts, step + margin, chunk - margin)
                    row["tail"] = list(zip((places + k * step).tolist(), (len(starts) - before).tolist(), strict=True))
                rows.append(row)
            places = pa.map_(pa.int64(), pa.int64())
            schema = pa.schema([("key", pa.string()), ("k", pa.int32()), ("n", pa.int64()), ("head", places), ("tail", places)])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return pieces.mapInArrow(run, "key string, k int, n long, head map<long,long>, tail map<long,long>")


def spliced(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_tokens`` of the distinct ``texts(key, text)``; a key stands for one text.

    The chunks of a text lie in any tasks. Two neighbours both know the stable places of their overlap; the sum of all
    chunks' tokens less those behind (in the first) and before (in the second) the first place where both start a token is the
    count of the whole text. Texts with an overlap that has no such place are cut anew with wider chunks and overlaps, at
    last as one chunk.
    """
    done, left = None, texts
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        pieces = _cut(left, chunk, overlap).repartition(tasks)  # one huge text meets many tasks
        parts = materialize(_encoded(pieces, path, chunk, overlap).dropDuplicates(["key", "k"]), "chunks")
        heads = parts.filter("k > 0").select("key", (F.col("k") - 1).alias("k"), "head")
        place = F.get(F.array_intersect(F.map_keys("tail"), F.map_keys("head")), F.lit(0))
        seams = parts.select("key", "k", "tail").join(heads, ["key", "k"]).select(
            "key", (F.try_element_at("tail", place) + F.try_element_at("head", place)).alias("twice")
        )
        each = parts.select("key", "n", F.lit(0).cast("long").alias("twice"), F.lit(0).alias("open")).unionByName(
            seams.select("key", F.lit(0).cast("long").alias("n"), F.coalesce("twice", F.lit(0)).alias("twice"), F.isnull("twice").cast("int").alias("open"))
        )
        found = materialize(each.groupBy("key").agg((F.sum("n") - F.sum("twice")).alias("n_tokens"), F.max("open").alias("open")), "spliced")
        whole = found.filter("open = 0").select("key", "n_tokens")
        done = whole if done is None else done.unionByName(whole)
        failed = found.filter("open = 1").select("key")
        if failed.isEmpty():
            return done
        left = lookup_join(texts, failed, "key", "left_semi")
        chunk, overlap = chunk * WIDER, min(overlap * WIDER_OVERLAP, chunk * WIDER // 2)


def counted(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text)``, as the library counts whole texts.

    A text of at most ``chunk`` characters is encoded as it is; longer ones go through ``spliced``, equal ones once. A null
    text is empty and has no tokens; null ids and repeated rows stay. Other columns are ignored; an empty table gives no
    rows. ``overlap`` has to exceed twice the longest special token.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")
    text = text_of(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    short, long = rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk)

    def run(batches):
        encode = encoder(path, BYTE_LEVEL).encode
        for batch in chunks(batches, "text", 4 << 20):
            sizes = [len(ids) for ids in encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(sizes, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    key = F.sha2("text", 256).alias("key")
    sizes = spliced(long.select(key, "text"), path, chunk, overlap)
    whole = lookup_join(long.select("doc_id", "n_bytes", key), sizes, "key").select("doc_id", "n_bytes", "n_tokens")
    found = short.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").unionByName(whole)
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
