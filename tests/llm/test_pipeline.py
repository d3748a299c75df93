"""The pipeline on the smallest table, each stage against a plain version of it."""

import re

import corpus_pipeline
from larder.llm import registry
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages_in_order_and_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_copies", "suffix_dedup", "personal_data", "packing"]
    assert sorted(registry.queries(), key=lambda n: int(re.match(r"op(\d+)_", n)[1])) == [
        "op1_html_text", "op2_fingerprints", "op3_jaccard_join", "op4_byte_bpe", "op5_suffix_dedup", "op6_personal_data",
        "op7_neighbours", "op8_packing", "op9_substring_dedup", "op10_language_id"]


def test_every_stage_equals_its_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    known = corpus_pipeline.known_language(spark, docs, SF_SMALL)
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: r.text for r in known.collect()}
    assert known.columns == columns
    assert set(after) == set(before)  # every document here is in a known language
    assert after == before

    heads = corpus_pipeline.one_of_near_copies(spark, docs, SF_SMALL)
    want = {i for i, (_, c) in brute.jaccard_components(list(before.items())).items() if i == c}
    assert heads.columns == columns and sorted(r.doc_id for r in heads.collect()) == sorted(want)

    rest = corpus_pipeline.without_repeats(spark, heads, SF_SMALL)
    kept = sorted((i, before[i]) for i in want)
    texts = {i: "".join(map(chr, b"")) for i, _ in kept}
    for (i, _), (b, drop) in zip(kept, brute.repeated_bytes([t for _, t in kept], 400)):
        texts[i] = bytes(x for x, d in zip(b, drop) if not d).decode("utf-8", "ignore")
    got = rest.collect()
    assert rest.columns == columns and {r.doc_id: r.text for r in got} == texts
    assert all(r.n_chars == len(r.text) for r in got)

    clean = corpus_pipeline.without_personal_data(spark, rest, SF_SMALL)
    assert clean.columns == columns
    for r in clean.collect():
        assert not any(brute.personal_data(r.text))
        if not any(brute.personal_data(texts[r.doc_id])):
            assert r.text == texts[r.doc_id] or "[IBAN]" in r.text or "[SSN]" in r.text

    pieces = corpus_pipeline.packed(spark, clean, SF_SMALL)
    assert {r.doc_id for r in pieces.collect()} == set(texts)


def test_stages_with_odd_rows_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, token long, key string, hits long"
    text = "the quick words of this text are in a language " * 4
    rows = [(1, text, "en", "s", 5, "a", 1, "k", 1), (1, text, "en", "s", 5, "a", 1, "k", 1), (2, None, None, None, None, None, None, None, None),
            (None, text, "en", None, 1, None, None, None, None), (3, "", "en", "s", 0, None, 2, "k", None), (4, "write to a@b.cd " + text, "en", "s", 9, "b", 3, "q", 2)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.packed(spark, docs, "").collect()


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    text = {k: " ".join(f"{k}{j}" for j in range(30)) for k in "abc"}
    rows = [(1, text["a"]), (1, text["b"]), (1, text["b"]), (2, text["b"] + " end"), (3, text["c"]), (3, text["a"]), (4, None), (4, ""), (5, text["c"]), (None, text["a"])]
    out = corpus_pipeline.one_of_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, text["a"]), (1, text["b"]), (3, text["c"]), (4, None), (4, ""), (None, text["a"])], key=str)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert rows and max(fill.values()) <= 1024
