"""Token ids as files of canonical, length-limited Huffman codes in blocks that decode on their own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.llm.common import chunks, crc_of, text_of
from bizlens.llm.tokens import BYTE_LEVEL, encoder, tokenizer_path
from bizlens.session import materialize, new_folder

END = 2
LIMIT = 16
BLOCK_TOKENS = 65_536
STRIDE = 64
FILE = (
    "part int, block int, start long, n_tokens long, doc_ids array<long>, sizes array<int>, "
    "checkpoints array<long>, payload binary"
)
#: Ids are counted and held as 16 bits, and a code of at most ``LIMIT`` bits names no more of them.
MOST_IDS = 1 << LIMIT


def code_lengths(weights: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits for positive weights (package-merge)."""
    n = len(weights)
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(weights, kind="stable")
    leaves = weights[order].astype(np.int64)
    row, leaf_of = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        at = np.argsort(both, kind="stable")
        row = both[at]
        leaf_of.append(at < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaf_of):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code over the ids that occur: arrays to encode by id, and a table to decode by ``LIMIT`` bits."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((ids, lengths))
        self.size = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
        self.word = np.zeros(len(self.size), np.int64)
        ids, lengths = ids[order], lengths[order]
        steps = 1 << (LIMIT - lengths)
        first = np.cumsum(steps) - steps
        self.size[ids], self.word[ids] = lengths, first >> (LIMIT - lengths)
        self.symbol = np.zeros(1 << LIMIT, np.uint32)
        self.bits = np.zeros(1 << LIMIT, np.uint8)
        used = int(steps.sum())
        self.symbol[:used], self.bits[:used] = np.repeat(ids, steps), np.repeat(lengths, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, and the bit offset of every ``STRIDE``-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        at = ends - sizes
        # Codes fill 64-bit words from the top; in every word a code begins, and the last one there may go on in the next.
        last = np.append(np.flatnonzero(np.diff(at >> 6)), len(ids) - 1)
        room = 64 - sizes - (at & 63)
        over = np.maximum(-room[last], 0).astype(np.uint64)
        room[last] = np.maximum(room[last], 0)
        word = self.word[ids].view(np.uint64)
        tails = word[last]
        word <<= room.view(np.uint64)
        word[last] = tails >> over << room[last].view(np.uint64)
        out = np.zeros(len(last) + 1, np.uint64)
        out[:-1] = np.bitwise_or.reduceat(word, np.append(0, last[:-1] + 1))
        on = np.flatnonzero(over)
        out[on + 1] |= tails[on] << (np.uint64(64) - over[on])
        return out.astype(">u8").tobytes()[: int(ends[-1] + 7 >> 3)], at[::STRIDE]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The ids, all stretches between checkpoints side by side, one table look-up for each id."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(payload + bytes(STRIDE * LIMIT // 8 + 8), np.uint8).astype(np.uint32)
        words = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = checkpoints.astype(np.int64)
        out = np.empty((STRIDE, len(at)), np.uint32)
        for k in range(STRIDE):
            seen = words[at >> 3] >> (32 - LIMIT - (at & 7)).astype(np.uint32) & np.uint32((1 << LIMIT) - 1)
            out[k] = self.symbol[seen]
            at = np.minimum(at + self.bits[seen], 8 * len(words) - 8)
        return out.T.reshape(-1)[:n]


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids_crc32, ids`` (little-endian 16-bit ids, the end id 2 last) of every text, stored. Null is empty.

    Tokenizers of more than 65,536 ids raise a ValueError.
    """
    path = path or tokenizer_path("byte_bpe_50k.json")

    def run(batches):
        found = encoder(path, BYTE_LEVEL)
        encode = found.encode
        if found.tokenizer.get_vocab_size() > MOST_IDS:
            raise ValueError(f"the token files hold ids below {MOST_IDS}; this tokenizer has more")
        for batch in chunks(batches, "text", 4 << 20):
            ids = [np.append(x, END) for x in encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(crc_of, ids), pa.int64()), pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())],
                ["doc_id", "ids_crc32", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, ids_crc32 long, ids binary"), "tokens")


def global_lengths(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All ids that occur, and the code lengths for their counts. At most 65,536 counts come to the driver, one for each id."""

    def count(batches):
        total = np.zeros(MOST_IDS, np.int64)
        for batch in batches:
            for piece in chunks([batch], "ids", 4 << 20):
                total += np.bincount(np.frombuffer(b"".join(piece.column("ids").to_pylist()), "<u2"), minlength=MOST_IDS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])

    counted = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted((r.id, r.n) for r in counted.collect())
    return np.array([i for i, _ in rows], np.int64), code_lengths(np.array([n for _, n in rows], np.int64))


def write(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Write the ids of ``docs(doc_id, text)`` to ``folder`` in ascending order of doc_id (nulls first).

    ``folder/code`` has the code length of each id, from which the canonical code follows; ``folder/blocks`` has the ids. A
    row there is one block: whole documents, at least ``BLOCK_TOKENS`` ids unless it ends the part, their ids and
    sizes, where the block starts within its part, a bit offset for every 64th id, and the bits. Parts follow each
    other in order of doc_id. Rows that share a doc_id are all written, in order of their checksum.
    """
    tokens = tokenized(docs, path)
    ids, lengths = global_lengths(tokens)
    shared = docs.sparkSession.sparkContext.broadcast(Code(ids, lengths))
    table = pa.table({"id": pa.array(ids, pa.int64()), "bits": pa.array(lengths, pa.int64())})
    docs.sparkSession.createDataFrame(table).coalesce(1).write.mode("errorifexists").parquet(f"{folder}/code")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ties are spread by checksum, so that a much repeated id may fill several parts.
    ordered = tokens.repartitionByRange(parts, "doc_id", "ids_crc32").sortWithinPartitions("doc_id", "ids_crc32")

    def blocks(batches):
        part, block, start, code = TaskContext.get().partitionId(), 0, 0, shared.value
        names, parts, held = [], [], 0

        def row():
            ids = np.concatenate(parts)
            payload, checkpoints = code.encode(ids)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "start": start, "n_tokens": len(ids), "doc_ids": names, "sizes": [len(p) for p in parts], "checkpoints": checkpoints.tolist(), "payload": payload}],
                schema=schema,
            )

        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("checkpoints", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                parts.append(np.frombuffer(ids.as_py(), "<u2").astype(np.int64))
                names.append(doc_id)
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield row()
                    block, start = block + 1, start + held
                    names, parts, held = [], [], 0
        if parts:
            yield row()

    ordered.mapInArrow(blocks, FILE).write.mode("errorifexists").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Decode the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts all ids before the document."""
    lengths = spark.read.schema("id long, bits long").parquet(f"{folder}/code").collect()  # at most 65,536 rows
    code = Code(np.array([r.id for r in lengths], np.int64), np.array([r.bits for r in lengths], np.int64))
    files = spark.read.schema(FILE).parquet(f"{folder}/blocks")
    totals = files.groupBy("part").agg(F.max(F.col("start") + F.col("n_tokens")).alias("n")).collect()  # a row per part
    before, at = {}, 0
    for part, n in sorted((r.part, r.n) for r in totals):
        before[part], at = at, at + n
    shared = spark.sparkContext.broadcast((code, before))

    def decode(batches):
        code, before = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                ids = code.decode(row["payload"].as_py(), row["checkpoints"].values.to_numpy(), row["n_tokens"].as_py())
                sizes = row["sizes"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(sizes)
                starts = before[row["part"].as_py()] + row["start"].as_py() + ends - sizes
                crcs = [crc_of(ids[a:b]) for a, b in zip(ends - sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(starts), pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` and read the files back: ``doc_id, start, n_tokens, ids_crc32`` for each row.

    A null or empty text is its end id alone. Repeated rows and ids are kept. Other columns are ignored; an empty table gives
    no rows.
    """
    folder = new_folder(docs.sparkSession, "huffman")
    write(docs, folder, path)
    return read(docs.sparkSession, folder)
