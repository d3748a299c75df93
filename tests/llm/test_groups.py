import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.llm import jaccard_join, neighbours, substring_dedup, suffix_dedup
from larder.llm.components import components
from tests.llm import brute
from tests.llm.brute import DOCS


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 0) for i, t in rows], DOCS).repartition(3)


def near_copies(seed, families=12, size=9):
    """Families of near copies, exact copies, and unrelated texts that share long passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for f in range(families):
        base = [word() for _ in range(rng.randrange(3, 160))]
        if f % 3 == 0:
            base = base[:20] + passage + base[20:]
        for _ in range(rng.randrange(1, size)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 25)):
                own[rng.randrange(len(own))] = word()
            text = rng.choice([" ", "\n", "\t "]).join(own)
            texts.append(text.upper() if rng.random() < 0.2 else text)
    return texts


EDGES = [None, "", "  \n", "one", "ONE", "one two three four", "one two three four five", "one two three four five"]


@pytest.mark.parametrize("seed,block,fanout", [(1, 512, 32), (2, 2, 2)])
def test_join_equals_brute_force(spark, monkeypatch, seed, block, fanout):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FANOUT", fanout)
    rows = list(enumerate([*EDGES, *near_copies(seed)]))
    random.Random(seed).shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(spark, rows).withColumnRenamed("lang", "token")).collect()}
    assert got == brute.jaccard_components(rows)


def test_join_with_chains_and_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    base = [f"c{k}" for k in range(100)]
    chain = [" ".join([f"x{j}" for j in range(2 * k)] + base[2 * k :]) for k in range(20)]  # neighbours link, ends do not
    hub = [" ".join(f"h{k}" if k != 40 + j % 20 else f"e{j}" for k in range(100)) for j in range(120)]
    rows = list(enumerate([*chain, *hub]))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs(spark, rows)).collect()}
    assert got == brute.jaccard_components(rows)


def test_join_with_null_and_repeated_ids(spark):
    text = " ".join(f"k{j}" for j in range(30))
    rows = [(3, text), (3, text), (7, text), (None, text), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(3, 26, 3), (7, 26, 3), (None, 26, None), (None, 0, None)], key=str)
    assert jaccard_join.join(docs(spark, [])).count() == 0


def test_tree_finds_all_that_the_bound_allows():
    rng = np.random.default_rng(3)
    points = rng.poisson(2, (300, jaccard_join.GROUPS)).astype(np.int64)
    points[100:200] = np.maximum(0, points[0] + rng.integers(-1, 2, (100, jaccard_join.GROUPS)) * (rng.random((100, jaccard_join.GROUPS)) < 0.1))
    sizes = points.sum(axis=1)
    tree = jaccard_join.CountTree(points, sizes)
    for i in range(300):
        bound = np.minimum(points, points[i]).sum(axis=1)
        need = jaccard_join.least_overlap(sizes[i], sizes)
        assert np.flatnonzero(bound >= need).tolist() == sorted(tree.search(points[i], int(sizes[i])).tolist())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_block_tells_only_links_that_join_components(seed):
    rng = np.random.default_rng(seed)
    bases = [rng.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(6)]
    sets = [np.unique(np.concatenate([b[rng.random(60) < 0.93], rng.integers(0, 2**63, 3, dtype=np.uint64)])) for b in bases for _ in range(25)]
    sets.append(np.zeros(0, np.uint64))
    n = len(sets)
    known = np.where(rng.random(n) < 0.5, np.arange(n), np.repeat(np.arange(n)[::25], 25)[:n])
    side = rng.random(n) < 0.5
    for sides in (None, side):
        want = {i: {i} for i in set(known.tolist())}  # components merged by all links of the block
        for i in range(n):
            for j in range(i):
                shared = len(np.intersect1d(sets[i], sets[j]))
                if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared) and (sides is None or sides[i] != sides[j]):
                    both = want[known[i]] | want[known[j]]
                    want.update({k: both for k in both})
        a, b = jaccard_join.joining_links(np.arange(n), known, sets, sides)
        got = {i: {i} for i in set(known.tolist())}
        for i, j in zip(a.tolist(), b.tolist()):
            assert known[j] not in got[known[i]]  # each link joins two components that were apart
            both = got[known[i]] | got[known[j]]
            got.update({k: both for k in both})
        assert got == want


def test_components(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 100), (7, 7), (200, 200), (None, 3)] + [(300, 300 + k) for k in range(50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100, 200: 200, **{300 + k: 300 for k in range(50)}}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def passages(seed, unit):
    """Texts made of shared and own passages, some inside one document twice."""
    rng = random.Random(seed)
    fresh = lambda n: "".join(rng.choice("abcdefgh é漢 \n") for _ in range(n))
    shared = [fresh(rng.randrange(unit // 2, 4 * unit)) for _ in range(6)]
    texts = []
    for _ in range(40):
        texts.append("".join(rng.choice(shared) if rng.random() < 0.5 else fresh(rng.randrange(0, 2 * unit)) for _ in range(rng.randrange(5))))
    return [*texts, texts[0], texts[0], "z" * (3 * unit), "ab" * (2 * unit), None, "", "short"]


@pytest.mark.parametrize("length,hot", [(40, 100_000), (400, 100_000), (40, 3)])
def test_suffix_dedup_equals_brute_force(spark, length, hot):
    rows = list(enumerate(passages(length, length)))
    rows[5] = (None, rows[5][1])
    got = suffix_dedup.report(docs(spark, rows).withColumnRenamed("lang", "key"), length=length, hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute.byte_report(rows, length), key=str)


def test_suffix_dedup_edges(spark):
    assert suffix_dedup.report(docs(spark, [])).count() == 0
    text = "".join(chr(97 + (k * k) % 23) + str(k) for k in range(300))
    rows = [(1, text), (1, text), (2, "x" * 399), (3, None)]
    got = suffix_dedup.report(docs(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute.byte_report(rows, 400), key=str)
    out = suffix_dedup.deduplicated(docs(spark, [*rows, (4, "é" * 300 + text)]))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[1] == "" and kept[2] == "x" * 399 and kept[3] is None


def test_a_range_without_repeats_has_no_spans():
    assert suffix_dedup._repeated([], 400) == ([], [], [])


def test_loser_tree_merges_and_knows_prefixes():
    rng = random.Random(5)
    for _ in range(60):
        runs = []
        for _ in range(rng.randrange(0, 9)):
            run = sorted("".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(rng.randrange(8)))
            before, own = b"", []
            for text in run:
                own.append((text, suffix_dedup.shared_prefix(before, text), None))
                before = text
            runs.append(own)
        out = list(suffix_dedup.LoserTree([iter(r) for r in runs]))
        want = sorted(x[0] for r in runs for x in r)
        assert [x[0] for x in out] == want
        for (a, _, _), (b, shared, _) in zip(out, out[1:]):
            k = 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            assert shared == k


def window_texts(seed, size):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    shared = [fresh(rng.randrange(size // 2, 4 * size)) for _ in range(6)]
    texts = []
    for _ in range(40):
        own = [w for _ in range(rng.randrange(5)) for w in (rng.choice(shared) if rng.random() < 0.5 else fresh(rng.randrange(2 * size)))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(own))
    return [*texts, texts[0], "a " * (4 * size), "a " * (3 * size), None, "", "one"]


@pytest.mark.parametrize("size,hot", [(8, 100_000), (50, 100_000), (8, 3)])
def test_substring_dedup_equals_brute_force(spark, size, hot):
    rows = list(enumerate(window_texts(size, size)))
    rows[4] = (None, rows[4][1])
    rows[6] = (2, rows[6][1])
    got = substring_dedup.report(docs(spark, rows).withColumnRenamed("lang", "doc"), window=size, gram=min(6, size // 2), hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute.window_report(rows, size), key=str)
    assert substring_dedup.report(docs(spark, [])).count() == 0


def near(vectors, ids, every):
    v = np.array(vectors, float)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for k, q in enumerate(ids):
        if q % every == 0:
            score = np.round(u @ u[k], 12)
            best = [j for j in np.lexsort((ids, -score)) if ids[j] != q][: neighbours.NEAREST]
            out[q] = [int(ids[j]) for j in best]
    return out


def test_neighbours_recall_ties_and_rows_that_take_no_part(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "LOT", 4)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    v = centres[rng.integers(0, 12, 900)] + 0.3 * rng.normal(size=(900, 16))
    v[300:600] = v[300]  # one very common vector
    ids = np.arange(900) * 7
    rows = [(int(i), [float(x) for x in r], 0) for i, r in zip(ids, v)]
    odd = [(70_000, None, 0), (70_050, [0.0] * 16, 0), (70_100, [1.0] * 15 + [None], 0), (70_150, [float("nan")] * 16, 0), (70_200, [1.0], 0), (None, [1.0] * 16, 0)]
    table = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, leaf int")
    got = {}
    for r in neighbours.search(table).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    v32 = np.array([[np.float32(x) for x in r[1]] for r in rows], float)
    want = near(v32, ids, 50)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 5 for q in want]) >= 0.9
    common = [q for q in want if 300 <= q // 7 < 600]
    assert common and all(got[q] == want[q] for q in common)


def test_neighbours_with_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, 2.0])], schema)
    got = [(r.query_id, r["rank"], r.vec_id) for r in neighbours.search(few).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert neighbours.search(spark.createDataFrame([], schema)).count() == 0
    assert neighbours.search(spark.createDataFrame([(0, [1.0])], schema)).count() == 0


def test_neighbours_where_the_visited_leaves_hold_few_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 3)
    monkeypatch.setattr(neighbours, "TARGET", 0.1)  # one visit
    rng = np.random.default_rng(2)
    rows = [(10 * k, [float(x) for x in rng.normal(size=8)]) for k in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(table).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == {i for i, _ in rows if i % 50 == 0} and all(len(own) == 5 for own in got.values())


@pytest.mark.parametrize("size", [1, 9])
def test_neighbours_with_malformed_vectors_sampled_first(spark, size):
    rng = np.random.default_rng(5)
    ids = list(range(0, 1000, 10))
    table = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in ids], "vec_id long, embedding array<double>")
    first = table.orderBy(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30))).first().vec_id
    table = table.filter(F.col("vec_id") != first).unionByName(spark.createDataFrame([(first, [1.0] * size)], table.schema))
    counts = {r.query_id: r["count"] for r in neighbours.search(table).groupBy("query_id").count().collect()}
    assert counts == {i: 5 for i in ids if i % 50 == 0 and i != first}
