"""Merkle manifest of a table: a tree per language, a tree of their roots, and the proof of every row.

Proofs are made as octopus multiproofs. Leaves lie in runs (a stretch of one tree within one range partition). A run works out
the smallest set of nodes outside it that all its proofs together need, gets them in one join, derives every interior node
that its leaves share, and then expands the single proofs without any further data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.operators.joins import lookup_join
from bizlens.session import materialize

#: Fixed value: rows whose crc32 of the decimal id this number divides are tampered with.
TAMPERED = 7
#: Leaves that a run has at most, about; a run is held by one task.
RUN = 250_000
_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _encoded(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, id, leaf, shown`` of every row: its tree (by lang), its digest, and the digest after the tampering."""
    fields = {c: F.col(c).cast("string") for c in _FIELDS}
    whole = F.concat(*[_encoded(fields[c]) for c in _FIELDS])
    more = {**fields, "n_chars": (F.col("n_chars") + 1).cast("string")}
    crc = F.crc32(F.coalesce(fields["doc_id"], F.lit("")).cast("binary"))
    changed = F.when(crc % TAMPERED == 0, F.concat(*[_encoded(more[c]) for c in _FIELDS])).otherwise(whole)
    # The letter in front keeps null apart from every lang, and before them.
    tree = F.coalesce(F.concat(F.lit("v"), fields["lang"]), F.lit("n"))
    return docs.select(
        tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), F.sha2(whole, 256).alias("leaf"), F.sha2(changed, 256).alias("shown")
    )


# A tree of n leaves: nodes of a level are numbered from 0; a level of s nodes has (s + 1) // 2 above it.


def missing(low: int, high: int, size: int) -> list[tuple[int, int]]:
    """The nodes ``(level, number)`` outside the leaves ``low..high-1`` that their proofs need, each once."""
    found, level = [], 0
    while size > 1:
        if low & 1:
            found.append((level, low - 1))
        if high & 1 and high < size:
            found.append((level, high))
        low, high, size, level = low >> 1, (high + 1) >> 1, (size + 1) >> 1, level + 1
    return found


def _above(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def frontier(nodes: list[str], low: int, size: int) -> list[tuple[int, int, str]]:
    """The largest whole subtrees of the leaves from number ``low`` on, as ``(level, number, digest)``."""
    found, level = [], 0
    while nodes:
        if size == 1:
            found.append((level, 0, nodes[0]))
            break
        if low & 1:
            found.append((level, low, nodes[0]))
            nodes, low = nodes[1:], low + 1
        high = low + len(nodes)
        if nodes and high & 1 and high < size:
            found.append((level, high - 1, nodes[-1]))
            nodes = nodes[:-1]
        nodes, low, size, level = _above(nodes), low >> 1, (size + 1) >> 1, level + 1
    return found


def shared_levels(nodes: list[str], low: int, size: int, fetched: dict[tuple[int, int], str]) -> tuple[list, str]:
    """Every level as ``(number of its first node here, nodes, size)``, completed by the fetched nodes, and the root."""
    levels, level = [], 0
    while size > 1:
        high = low + len(nodes)
        if low & 1:
            nodes, low = [fetched[level, low - 1], *nodes], low - 1
        if high & 1 and high < size:
            nodes = [*nodes, fetched[level, high]]
        levels.append((low, nodes, size))
        nodes, low, size, level = _above(nodes), low >> 1, (size + 1) >> 1, level + 1
    return levels, nodes[0]


def path(levels: list, number: int) -> Iterator[tuple[str | None, bool]]:
    """From the leaf up: the sibling at each level (None where a node stands alone) and whether it stands to the left."""
    for first, nodes, size in levels:
        other = number ^ 1
        yield (nodes[other - first], other < number) if other < size else (None, False)
        number >>= 1


def fold(leaf: str, siblings: list[tuple[str | None, bool]]) -> str:
    for other, left in siblings:
        leaf = digest(leaf if other is None else other + leaf if left else leaf + other)
    return leaf


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """The stored ``rows`` with ``part`` and ``at``: the run's number and the place within the run."""
    spark = rows.sparkSession
    rows = rows.withColumn("_row", F.monotonically_increasing_id())  # equal rows may fill several partitions
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RUN))
    keys = ["tree", *order, "_row"]
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_row")

    def number(batches):
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for tree in batch.column("tree").to_pylist():
                n = n + 1 if tree == last else 0
                last = tree
                places.append(n)
            columns = [*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "at"])

    fields = ", ".join(f"{name} {kind}" for name, kind in dealt.dtypes)
    return materialize(dealt.mapInArrow(number, f"{fields}, part int, at long"), "placed")


def _frontiers(key: tuple, table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["at", "leaf", "low", "size"]).to_pylist(), key=lambda r: r["at"])
    found = frontier([r["leaf"] for r in rows], rows[0]["low"], rows[0]["size"])
    tree = key[0].as_py()
    return pa.table({
        "tree": pa.array([tree] * len(found), pa.string()), "size": pa.array([rows[0]["size"]] * len(found), pa.int64()),
        "level": pa.array([f[0] for f in found], pa.int32()), "number": pa.array([f[1] for f in found], pa.int64()),
        "node": pa.array([f[2] for f in found], pa.string()),
    })


def _spine(table: pa.Table) -> pa.Table:
    """The nodes of one tree that several runs share, and those they are made of; the last one is the root."""
    by_level: dict[int, dict[int, str]] = {}
    for r in table.to_pylist():
        by_level.setdefault(r["level"], {})[r["number"]] = r["node"]
    size, level, found = table.column("size")[0].as_py(), 0, []
    while True:
        nodes = by_level.get(level, {})
        found += [(level, k, v, size == 1) for k, v in nodes.items()]
        if size == 1:
            break
        for k in {k >> 1 for k in nodes}:
            pair = [nodes.get(2 * k), nodes.get(2 * k + 1)]
            # A node that no pair is known of lies within one run and has its parent there.
            if pair[0] is not None and (pair[1] is not None or 2 * k + 1 >= size):
                by_level.setdefault(level + 1, {}).setdefault(k, digest("".join(x for x in pair if x is not None)))
        size, level = (size + 1) >> 1, level + 1
    tree = table.column("tree")[0].as_py()
    return pa.table({
        "tree": pa.array([tree] * len(found), pa.string()), "level": pa.array([f[0] for f in found], pa.int32()),
        "number": pa.array([f[1] for f in found], pa.int64()), "node": pa.array([f[2] for f in found], pa.string()),
        "is_root": pa.array([f[3] for f in found], pa.bool_()),
    })


def _requests(batches):
    for batch in batches:
        rows = [
            {"tree": r["tree"], "part": r["part"], "level": level, "number": number}
            for r in batch.to_pylist() for level, number in missing(r["low"], r["low"] + r["n"], r["size"])
        ]
        schema = pa.schema([("tree", pa.string()), ("part", pa.int32()), ("level", pa.int32()), ("number", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def forest(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trees over the stored ``rows(tree, leaf, ...)``, leaves ascending by ``order``: ``(placed, runs, roots)``.

    ``runs(tree, part, low, size, fetched)`` names each run's first leaf, its tree's size and the nodes it needs from
    elsewhere; ``roots(tree, root)``. A run has at most two nodes of each level in the frontier, so the group that builds the
    upper part of a tree holds some ``2 * log2(rows)`` nodes a partition, not leaves.
    """
    placed = _placed(rows, order)
    runs = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part")) - F.col("n")
    size = F.sum("n").over(Window.partitionBy("tree"))
    runs = materialize(runs.select("tree", "part", "n", before.alias("low"), size.alias("size")), "runs")
    edges = lookup_join(placed.select("tree", "part", "at", "leaf"), runs.drop("n"), ["tree", "part"]).groupBy("tree", "part")
    found = edges.applyInArrow(_frontiers, "tree string, size long, level int, number long, node string")
    nodes = found.groupBy("tree").applyInArrow(_spine, "tree string, level int, number long, node string, is_root boolean")
    nodes = materialize(nodes, "nodes")
    asked = runs.mapInArrow(_requests, "tree string, part int, level int, number long")
    fetched = asked.join(nodes.drop("is_root"), ["tree", "level", "number"]).groupBy("tree", "part").agg(
        F.collect_list(F.struct("level", "number", "node")).alias("fetched")
    )
    roots = nodes.filter("is_root").select("tree", F.col("node").alias("root"))
    return placed, runs.drop("n").join(fetched, ["tree", "part"], "left"), roots


def _levels(table: pa.Table, run: pa.Table) -> tuple[list[dict], dict, list, str]:
    """The rows of a run in order, what is known of the run, its levels and its tree's root."""
    about = run.to_pylist()[0]
    rows = sorted(table.to_pylist(), key=lambda r: r["at"])
    fetched = {(f["level"], f["number"]): f["node"] for f in about["fetched"] or ()}
    return rows, about, *shared_levels([r["leaf"] for r in rows], about["low"], about["size"], fetched)


def _paths(key: tuple, table: pa.Table, run: pa.Table) -> pa.Table:
    rows, about, levels, root = _levels(table, run)
    found = [[{"node": node, "left": left} for node, left in path(levels, about["low"] + r["at"])] for r in rows]
    kind = pa.list_(pa.struct([("node", pa.string()), ("left", pa.bool_())]))
    return pa.table({"tree": pa.array([r["name"] for r in rows], pa.string()), "above": pa.array(found, kind), "root": pa.array([root] * len(rows), pa.string())})


def _proofs(key: tuple, table: pa.Table, run: pa.Table) -> pa.Table:
    rows, about, levels, subroot = _levels(table, run)
    above = [(a["node"], a["left"]) for a in about["above"]]
    out: dict[str, list] = {"doc_id": [], "leaf": [], "subroot": [], "root": [], "siblings": [], "folded_root": []}
    for r in rows:
        steps = [*path(levels, about["low"] + r["at"]), *above]
        out["doc_id"].append(r["id"])
        out["leaf"].append(r["leaf"])
        out["siblings"].append([node for node, _ in steps if node is not None])
        out["folded_root"].append(fold(r["shown"], steps))
    out["subroot"], out["root"] = [subroot] * len(rows), [about["root"]] * len(rows)
    kinds = {"doc_id": pa.int64(), "siblings": pa.list_(pa.string())}
    return pa.table({name: pa.array(values, kinds.get(name, pa.string())) for name, values in out.items()})


def proofs(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, siblings, folded_root`` of every row of ``docs(doc_id, source, lang, n_chars, text)``.

    ``siblings`` are the proof, from the leaf up; ``folded_root`` is made from them and the leaf, or the tampered leaf of
    the rows that ``TAMPERED`` chooses. Null fields count as ``-``; null ids come first and choose like an empty text; null is a
    language of its own, before all others. Rows with one id go by leaf; repeated rows are leaves each. Other columns
    are ignored; an empty table gives no rows.
    """
    placed, runs, roots = forest(materialize(leaves(docs), "leaves"), ["id", "leaf", "shown"])
    tops = materialize(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf")), "subroots")
    top_placed, top_runs, _ = forest(tops, ["name"])
    above = top_placed.groupBy("tree", "part").cogroup(top_runs.groupBy("tree", "part")).applyInArrow(
        _paths, "tree string, above array<struct<node:string,left:boolean>>, root string"
    )
    about = runs.join(materialize(above, "above"), "tree")
    return placed.groupBy("tree", "part").cogroup(about.groupBy("tree", "part")).applyInArrow(
        _proofs, "doc_id long, leaf string, subroot string, root string, siblings array<string>, folded_root string"
    )


def verified(docs: DataFrame) -> DataFrame:
    """The proofs as digests: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    found = proofs(docs)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
