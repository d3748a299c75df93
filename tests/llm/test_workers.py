"""What bounds the memory of the Python workers that a pipeline leaves behind."""

import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from larder.llm import common, packing, substring_dedup, suffix_dedup, windows
from tests.llm import brute


def _chained(df) -> list[str]:
    """Python nodes that feed another one inside a task."""
    found, inside = [], False
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        if re.search(r"Exchange|Scan|QueryStage|== ", line):
            inside = False
        elif "InArrow" in line:
            if inside:
                found.append(line)
            inside = True
        elif "Union" in line:
            inside = False
    return found


def _docs(spark):
    twice = "".join(f"{k * 7919 % 1000} " for k in range(300))
    rows = [(1, "a " + twice), (2, twice + "b"), (3, "short"), (4, None), (None, twice), (6, "alone " * 3), (6, "alone " * 3)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_no_task_of_the_deduplicators_chains_python_nodes(spark):
    docs = _docs(spark)
    assert _chained(docs.mapInArrow(lambda x: x, docs.schema).select(F.upper("text").alias("text")).mapInArrow(lambda x: x, "text string"))
    stored = spark.createDataFrame(docs.collect(), docs.schema)
    for df in (suffix_dedup.report(stored), suffix_dedup.deduplicated(stored), substring_dedup.report(stored)):
        assert not _chained(df)
        assert df.count() == docs.count()


def test_rows_with_and_without_spans_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in _docs(spark).collect()]
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.report(_docs(spark)).collect())
    want = brute.repeated_bytes([t or "" for _, t in rows], 400)
    assert got == sorted((i or 0, len(b), int(sum(drop))) for (i, _), (b, drop) in zip(rows, want))
    assert {x[2] > 0 for x in got} == {True, False}


def test_special_tokens_are_those_of_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing._special(path) == [t.content for t in packing._library(path).get_added_tokens_decoder().values()] != []


def test_anchors_are_not_written_to_be_read_again(spark, monkeypatch):
    # on local folders executors begin a process for every file they write
    written = []
    for module in (substring_dedup, suffix_dedup, windows):
        monkeypatch.setattr(module, "keep", lambda df, name: (written.append(name), common.keep(df, name))[1])
    docs = _docs(spark)
    for module, of_crowded in ((suffix_dedup, ["crowded", "twice"]), (substring_dedup, ["crowded", "least"])):
        want = sorted(map(tuple, module.report(docs).collect()), key=str)
        assert written == ["spans"]
        written.clear()
        assert sorted(map(tuple, module.report(docs, hot=1).collect()), key=str) == want
        assert written == [*of_crowded, "spans"]
        written.clear()


def test_filter_and_marked_values_of_one_pass(spark):
    rows = [(k * 2**58 - 2**62, k % 3 == 0) for k in range(32)] + [(None, True), (7, None), (-5, True)]
    found, marked = common.bloom_and_marked(spark.createDataFrame(rows, "value long, marked boolean").repartition(3))
    assert marked.tolist() == sorted(v % 2**64 for v, m in rows if m and v is not None)
    assert found.has(np.array([v for v, _ in rows if v is not None], np.int64).view(np.uint64)).all()
    none, empty = common.bloom_and_marked(spark.createDataFrame([], "value long, marked boolean"))
    assert not none.words.any() and not len(empty)
