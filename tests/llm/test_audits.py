import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import divergence, quality_rules, registry, spelling
from larder.llm.common import flat, span_hashes
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.brute import DOCS


def docs(spark, rows):
    """Rows (doc_id, text, lang, source), with a column whose name the operators use themselves."""
    return spark.createDataFrame([(*r, 0, "own") for r in rows], DOCS + ", terms string").withColumn("n", F.lit("x"))


def same_as_sql(spark, key, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = sorted(map(str, con.execute(registry.oracle_sql()[key]).fetchall()))
    df = registry.queries()[key](spark, sf_dir)
    assert sorted(str(tuple(r)) for r in df.collect()) == want and want
    return df


# --- source divergence -------------------------------------------------------


def vocabulary_rows(rng, langs, sources, n):
    words = ["the", "The", "été", "ÉTÉ", "漢字", "a1b", "x-y", "zz", "rare", "w", "v", "u", "𝒳y"]
    text = lambda: rng.choice([None, "", "12 34", *(" ".join(rng.choices(words, weights=range(1, 14), k=rng.randrange(1, 30))) for _ in range(9))])
    return [(i, text(), rng.choice(langs), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block", [2, 3, 64])
def test_divergence_equals_brute_force(spark, block):
    rng = random.Random(block)
    rows = vocabulary_rows(rng, ["en", "de", "", None], ["s1", "s2", "s3", "S10", "é", "", None], 240)
    rows += [(1, "the the", "one", "only")] * 12 + [(2, "the", "few", s) for s in "abc"]  # one source; no kept term
    got = sorted(map(tuple, divergence.audit(docs(spark, rows).repartition(5), min_df=10, top=4, block=block).collect()))
    assert got == sorted(brute.divergence([r[1:] for r in rows], 10, 4))
    assert {(r[2], r[4]) for r in got if r[0] == "few"} == {("pair", 0)} and not [r for r in got if r[0] == "one" and r[2] == "pair"]


def test_divergence_ties_go_by_bytes_and_a_hot_source_counts_in_full(spark):
    rows = [(i, "b a é z", "en", "hot") for i in range(900)] + [(i, "q r", "en", s) for i, s in enumerate(["y", "x"] * 40)]
    got = sorted(map(tuple, divergence.audit(docs(spark, rows), min_df=30).collect()))
    assert got == sorted(brute.divergence([r[1:] for r in rows], 30, 50))
    assert [r[3] for r in got if r[1] == "hot" and r[2] == "term"] == ["a", "b", "z", "é"]


def test_divergence_edges(spark):
    assert divergence.audit(docs(spark, [])).count() == 0
    long = "word und été " * 100_000
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (2, None, None, None)]
    got = sorted(map(tuple, divergence.audit(docs(spark, rows), min_df=2).collect()))
    assert got == sorted(brute.divergence([r[1:] for r in rows], 2, 50))


def test_rates_are_exact_for_great_counts(spark):
    rows = spark.createDataFrame([(10**17, 3 * 10**18, 10**6), (0, 0, 1), (7, 10**18, 1)], "c long, t long, v long")
    got = [r[0] for r in rows.select(divergence.rate(F.col("c"), F.col("t"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 5) // (t + 5 * v) for c, t, v in ((10**17, 3 * 10**18, 10**6), (0, 0, 1), (7, 10**18, 1))]


def test_divergence_equals_sql(spark):
    df = same_as_sql(spark, "op11_source_divergence", SF_CHECK)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]


# --- spelling variants -------------------------------------------------------


def misspelt(rng, word, alphabet):
    k = rng.randrange(len(word))
    return rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice(alphabet) + word[k:], word[:k] + rng.choice(alphabet) + word[k + 1 :]])


def test_spelling_equals_brute_force(spark):
    rng = random.Random(5)
    for alphabet, length in (("aéÀzÿ", 8), ("abcdefgh", 14)):
        base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(5, length))) for _ in range(25)]
        known = base + [misspelt(rng, misspelt(rng, w, alphabet), alphabet) for w in base] + [misspelt(rng, w, alphabet) for w in base * 3]
        rows = [(i, " ".join(rng.choices(known, weights=[5 ** rng.randrange(4) for _ in known], k=300)).title(), None, None) for i in range(60)]
        rows += [(None, rows[0][1], None, None), (3, None, None, None), (3, "", None, None), (3, rows[1][1], None, None)]
        want = brute.spelling([r[:2] for r in rows])
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs(spark, rows).repartition(4)).collect()}
        assert got == want and any(v[0] for v in want.values())


def test_chains_of_forms_end_at_their_root(spark):
    words = ["kettle" + "s" * k for k in range(7)]
    rows = [(i, w, None, None) for k, w in enumerate(reversed(words)) for i in range(5 * 5**k if k < 5 else 0)]
    want = brute.spelling([r[:2] for r in rows])
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs(spark, rows)).collect()}
    assert got == want


def test_every_pair_is_found_once(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(400)})
    pairs = sorted((r.word, r.near) for r in spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect())
    assert pairs == sorted((a, b) for a in words for b in words if brute.one_edit(a, b))


def test_a_run_whose_checksum_says_so_loses_a_code_point(spark):
    i = next(i for i in range(10**5) if zlib.crc32(f"{i}:kettles".encode()) % 199 == 0)
    got = spelling.variants(docs(spark, [(i, "KETTLES " * 5, None, None)])).collect()
    at = zlib.crc32(f"{i}:kettles".encode()) % 7
    assert [(r.word, r.n) for r in got] == [("kettles"[:at] + "kettles"[at + 1 :], 5)]


def test_spelling_edges(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, "short words here only", None, None)])).count() == 0
    long = "ab" * 50_000
    assert [(r.word, r.n) for r in spelling.variants(docs(spark, [(None, f"{long} " * 5, None, None)])).collect()] == [(long, 5)]


def test_spelling_equals_sql(spark):
    df = same_as_sql(spark, "op12_spelling_variants", SF_SMALL)
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "string", "string", "bigint", "bigint", "bigint"]


# --- quality rules -----------------------------------------------------------


def test_hashes_do_not_depend_on_the_block():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 3001, 500))
    ends = np.maximum.accumulate(np.minimum(starts + rng.integers(0, 700, 500), 3000))
    whole = span_hashes(data, starts, ends)
    for block in (64, 1000, 4096):
        assert (span_hashes(data, starts, ends, block=block) == whole).all()
    again = np.concatenate([np.zeros(777, np.uint8), data])
    assert (span_hashes(again, starts + 777, ends + 777, block=64) == whole).all()
    low = np.frombuffer(b"Abc abc ABC", np.uint8)
    assert len(set(span_hashes(low, np.array([0, 4, 8]), np.array([3, 7, 11]), lower=True).tolist())) == 1


def test_hashing_a_very_long_text_needs_little_memory():
    data = np.random.default_rng(4).integers(97, 123, 32 << 20).astype(np.uint8)
    at = np.arange(0, len(data) - 1000, 1000)
    tracemalloc.start()
    span_hashes(data, at, at + 900)
    assert tracemalloc.get_traced_memory()[1] < 24 << 20
    tracemalloc.stop()


def rule_texts():
    rng = random.Random(9)
    parts = ["a", "b", "c d", "\n", "\n", " ", "\t", "#", "<|>", "é漢", "𝒳", "same line here\n", "x y z u v w ", "\r\n", "\x0b"]
    return [None, "", " \n ", "\n\n", "one", *("".join(rng.choice([p, p + " "]) for p in rng.choices(parts, k=rng.randrange(60))) for _ in range(300)),
            "a b c d e " * 3000, "line of words\n" * 2000, "#" * 50_000]


def test_rule_counts_equal_brute_force(spark):
    texts = rule_texts()
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules.report(docs(spark, rows).repartition(3), labels).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.rule_counts(t), t
        assert r.kept == (not r.base_failed)  # no labels: the base rules alone


def test_verdicts_on_held_out_labels(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    half = labels.filter("doc_id % 2 = 0")
    out = quality_rules.report(table, half).join(labels.filter("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.avg((F.col("kept") | F.col("base_failed")).cast("int")).alias("passed")).collect()
    by = {r.quality: r for r in out}
    assert by[1].passed > 0.985 and by[0].kept < 0.03


def test_fit_is_bounded_and_repeatable(spark):
    table = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    first = quality_rules.fit(table, labels, sample=120)
    again = quality_rules.fit(table.repartition(7), labels.unionAll(labels).repartition(3), sample=120)
    assert first.thresholds == again.thresholds and (first.forest.split == again.forest.split).all()
    kept = quality_rules.clean(table, first)
    assert kept.columns == table.columns
    want = {r.doc_id for r in quality_rules.judge(table, first).filter("kept").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == want


def test_quality_with_null_and_repeated_ids_and_labels(spark):
    good = "The quiet river ran past the old mill and on to the sea. "
    rows = [(None, good * 3, None, None), (1, good, None, None), (1, good, None, None), (2, None, None, None)]
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 1, 0), (1, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_rules.report(docs(spark, rows), labels).collect()
    assert len(got) == 4 and sorted(r.kept for r in got) == [False, False, True, True]
    assert quality_rules.report(docs(spark, []), labels).count() == 0


def test_counts_of_a_very_long_text_need_little_memory():

    text = pa.array(["some words of a very long text, again and\n" * 400_000])
    tracemalloc.start()
    data, at = flat(text)
    c = quality_rules.counts(data, at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert c[0, 0] == 9 * 400_000 and peak < 25 * len(data)


def test_fitting_reads_every_labelled_document(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"{a}{b}" for a in ("ri", "mill", "sto", "qui", "lam", "har", "fie", "let") for b in ("ver", "er", "ne", "et", "p", "bour", "ld", "ter")]
    rows = [(i, "".join(" ".join(rng.choice(vocabulary, 12)) + ".\n" for _ in range(4)), None, None) for i in range(600)]
    rows += [(600 + i, " ".join(rng.choice(["#|#", "<%>", "ABC", "9 9"], 40)), None, None) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 600), 0) for i in range(800)], "doc_id long, quality int, toxic int")
    seen = []
    counted = quality_rules._node_counts

    def noted(good):
        count = counted(good)
        return lambda forest: seen.append((good.count(), int((found := count(forest)).sum()))) or found

    quality_rules._node_counts = noted
    try:
        model = quality_rules.fit(docs(spark, rows), labels)
    finally:
        quality_rules._node_counts = counted
    half = spark.range(600).filter("(shiftright(xxhash64(id, 'quality'), 7) & 1) = 1").count()
    # every tree holds all good documents of its half after each round
    assert seen and all(n == half and total == half * quality_rules.TREES for n, total in seen)
    kept = {r.doc_id for r in quality_rules.judge(docs(spark, rows), model).filter("kept").collect()}
    assert len([i for i in kept if i < 600]) >= 590 and not [i for i in kept if i >= 600]


def test_divergence_terms_of_odd_texts_are_those_of_the_pattern():
    pieces = ["a", "Zz", "é", "漢字", "𝒳", " ", "\n", "\x00", "\x7f", "@[`{", "9", "_", "ÀB", "\u0085", "\u2028"]
    rng = random.Random(4)
    texts = [None, "", " ", "abc", "abc", "é", *("".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(500))]
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(fold)) for t in texts]
    assert divergence.terms(pa.array(texts)).to_pylist() == want
    assert divergence.terms(pa.array(texts).slice(3, 200)).to_pylist() == want[3:203]
    assert divergence.terms(pa.array(["", None], pa.string())).to_pylist() == [[], []]


def test_vector_sums_add_whole_numbers_by_source_and_term(monkeypatch):
    monkeypatch.setattr(divergence, "_ENTRIES", 3)
    vectors = [("a", [1, 4], [2.0, 1.0]), ("", [], []), ("b", [1], [5.0]), ("a", [4, 7], [3.0, 1.0]), ("b", [1], [1.0])]
    kind = pa.schema([("source", pa.string()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float64()))])
    batches = [pa.RecordBatch.from_arrays([pa.array([v[k]], kind.field(k).type) for k in range(3)], schema=kind) for v in vectors]
    held = {}
    for out in divergence._vector_sums(iter(batches)):
        for row in out.to_pylist():
            held[row["source"], row["at"]] = held.get((row["source"], row["at"]), 0) + row["n"]
    assert held == {("a", 1): 2, ("a", 4): 4, ("a", 7): 1, ("b", 1): 6}
    assert not list(divergence._vector_sums(iter([])))


def test_divergence_documents_name_a_term_once_and_bags_add_up(monkeypatch):
    monkeypatch.setattr(divergence, "_BAG", 3)
    monkeypatch.setattr(divergence, "_CHUNK", 150)
    rng = random.Random(8)
    words = ["a", "b", "é", "漢字", "zz", "w", "v"]
    rows = [(rng.randrange(2), rng.choice(["s", "", "t"]), rng.choice([None, "", "1 2", " ".join(rng.choices(words, k=rng.randrange(1, 60)))])) for _ in range(80)]
    rows.append((1, "s", "a " * 1000))
    found = [divergence.terms(pa.array([t], pa.string())).to_pylist()[0] for _, _, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.string(), pa.string()))], names=["lang_no", "source", "text"])
    out = [r for part in divergence._cut(iter([batch.slice(0, 50), batch.slice(50)])) for r in part.to_pylist()]
    own = [(r["lang_no"], sorted(r["terms"])) for r in out if not r["bag"]]
    assert own == [(r[0], sorted(set(f))) for r, f in zip(rows, found)]
    want, got = {}, {}
    for (lang, source, _), f in zip(rows, found):
        for w in f:
            want[lang, source, w] = want.get((lang, source, w), 0) + 1
    bags = [r for r in out if r["bag"]]
    for r in bags:
        assert 0 < len(r["terms"]) <= 3 and len(set(r["terms"])) == len(r["terms"])
        for w in r["terms"]:
            got[r["lang_no"], r["source"], w] = got.get((r["lang_no"], r["source"], w), 0) + r["weight"]
    assert got == want and sum(len(r["terms"]) for r in bags) < sum(map(len, found)) / 2


def test_vector_sums_count_a_vector_as_often_as_it_weighs():
    vectors = {"source": ["a", "b", "a"], "at": [[1, 4], [1], [4]], "n": [[1.0, 1.0], [1.0], [1.0]], "weight": [1, 8, 2]}
    kind = pa.schema([("source", pa.string()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float64())), ("weight", pa.int64())])
    rows = [tuple(r.values()) for out in divergence._vector_sums(iter([pa.RecordBatch.from_pydict(vectors, schema=kind)])) for r in out.to_pylist()]
    assert sorted(rows) == [("a", 1, 1), ("a", 4, 3), ("b", 1, 8)]


def test_divergence_of_documents_without_any_term(spark):
    rows = [(i, t, "en", s) for i, t in enumerate([None, "", "12 34"]) for s in "abc"]
    got = sorted(map(tuple, divergence.audit(docs(spark, rows), min_df=2).collect()))
    assert got == sorted(brute.divergence([r[1:] for r in rows], 2, 50)) and len(got) == 6
