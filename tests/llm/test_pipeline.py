"""Every stage of the pipeline against a brute-force version on its own input."""

import collections
import math
import os

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from bizlens.llm import decontam, lines, toxicity
from bizlens.session import materialize
from tests.llm.test_pairs import brute_classes

FOLDER = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry_points.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry_points.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = materialize(stage(spark, docs, FOLDER), name)
        assert made.columns == columns
        after = {r.doc_id: r for r in made.collect()}
        assert made.count() == len(after)
        if name == "toxicity":
            assert set(after) == {r.doc_id for r in toxicity.scored(docs, labels).filter("predicted = 0").collect()}
        elif name == "line_dedup":
            gone = {r.doc_id: set(r.removed) for r in lines.removed_lines(docs).collect()}
            assert set(after) == set(before)
            for i, r in before.items():
                held = [x for k, x in enumerate((r.text or "").split("\n")) if k not in gone[i]]
                assert after[i].text == (r.text if not gone[i] else "\n".join(held))
        elif name == "near_dedup":
            assert set(after) == set(brute_classes(sorted((i, r.text) for i, r in before.items())).values())
        else:
            import regex

            def cut(text):
                words = regex.findall(decontam.WORDS, (text or "").lower())
                return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

            wanted = [s for s in map(cut, items) if s]
            assert set(after) == {i for i, r in before.items() if not any(len(cut(r.text) & s) >= 0.8 * len(s) for s in wanted)}
        if name != "line_dedup":
            assert all(after[i] == before[i] for i in after)
        docs, before = made, after
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in placed} == set(before)
    bins = collections.Counter()
    for r in placed:
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 4096
    assert len(bins) <= math.ceil(sum(bins.values()) / 4096) + 1


@needs_data
def test_whole_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0


@needs_data
@pytest.mark.parametrize("name", ["op2_quality_rules", "op5_decontamination", "op6_chat_format", "op8_warc"])
def test_same_rows_as_sql(spark, name):
    pytest.importorskip("duckdb")
    from checks.compare import compare, connect

    assert compare(spark, connect(FOLDER), name, FOLDER).startswith("ok")


@needs_data
def test_native_operators_have_no_python_in_the_plan(spark):
    from tests.conftest import plan

    for name in ("op2_quality_rules", "op6_chat_format"):
        shown = plan(entry_points.queries()[name](spark, FOLDER))
        assert "EvalPython" not in shown and "InArrow" not in shown and "InPandas" not in shown
