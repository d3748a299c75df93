"""Quality rules: an isolation forest over rule statistics of whole texts.

Every document gets the counts that common quality rules are made of (words,
symbols, repeated lines, words in repeated five-word windows, and some more).
Two base rules reject a document outright: fewer than ten words, or over 20 % of
its words in repeated windows. On the others an isolation forest decides: its
trees split random statistics of good documents at random points, anywhere in the
box that all labelled documents span; a document that lies where good ones are
rare reaches a leaf early, so a short mean path marks an anomaly. How short is too short is calibrated on labelled rows, in
each band of document lengths on its own, because statistics of short texts vary
more.

Fitting uses every labelled document: half of them (by a hash of the id) grow the
trees, the other half sets the thresholds. Texts are counted once, and fitting
goes over the counts in Spark jobs whose results are tables of fixed resolution:
histograms of the statistics, good documents by tree node, histograms of the
scores. A tree takes no subsample: all good documents of its half are counted in
its nodes, and a node is split while it holds more than one part in ``LEAVES`` of
them.

Defined cases: a null text has no words, so it is rejected; an empty table gives
no rows; every row is judged on its own, also where ids are null or repeat;
without labelled rows of both kinds, only the base rules reject; an id with
several labels counts as bad if one of them says so; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import flat, gathered, keep, mix, owners, span_hashes, words

TREES = 128
#: A node with more than this part of the good documents is split, down to the greatest depth.
LEAVES = 256
DEPTH = 14
#: Levels that are grown between two counts of the documents in the nodes.
ROUNDS = (5, 3, 3, 3)
#: Bits of the mantissa that histograms of statistics keep (0.1 %), and decimals of a score.
BITS = 10
DECIMALS = 5
#: Words from which the bands with thresholds of their own begin.
BANDS = (10, 50, 150)
#: A threshold may reject at most this share of the good documents of its band.
MOST_GOOD_LOST = 0.005
#: Spreads that a statistic has at least, in the order of ``features``.
LEAST_SPREAD = np.array([0.05, 0.02, 0.05, 0.02, 0.1, 0.01, 0.01, 0.01, 0.02, 0.05, 0.05])
WINDOW = 5
FEWEST_WORDS = 10
#: Bytes of text handled at once; a longer single text is handled alone.
CHUNK = 4 << 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_marks", "n_ends", "n_distinct")
_WORD_HEAD = np.ones(256, bool)  # bytes that begin a code point of a word
_WORD_HEAD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, *range(0x80, 0xC0)]] = False
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "!?;:\"'()[]{}/\\_=+~^@"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC0:] = True  # other scripts by their first byte
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def _per_text(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """How many bytes that the table marks each text has, counted block by block."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for begin in range(0, len(data), block):
        at = np.flatnonzero(table[data[begin : begin + block]]) + begin
        out += np.bincount(np.searchsorted(offsets, at, side="right") - 1, minlength=len(out))
    return out


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the ``\\n``-split lines of the texts, empty ones included."""
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    return np.sort(starts), np.sort(ends)


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[:-1] | same[1:]
    return out


def _own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside one text."""
    return mix(hashes + mix(text.astype(np.uint64) + np.uint64(1)))


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The ``COUNTS`` of every text, one row each."""
    texts = len(offsets) - 1
    out = np.zeros((texts, len(COUNTS)), np.int64)
    starts, ends, firsts = words(data, offsets)
    text = owners(firsts)
    out[:, 0] = np.diff(firsts)
    for k, table in ((1, _WORD_HEAD), (2, _SYMBOLS), (6, _UPPER), (7, _LETTER), (8, _DIGIT), (9, _MARKS)):
        out[:, k] = _per_text(table, data, offsets)
    # lines with a word
    low, high = _lines(data, offsets)
    at = np.searchsorted(starts, low)
    full = np.flatnonzero((at < len(starts)) & (np.append(starts, len(data))[at] < high))
    low, high, at = low[full], high[full], at[full]
    line_text = text[at] if len(at) else at
    keys = _own(span_hashes(data, low, high), line_text)
    distinct = np.unique(keys, return_index=True)[1]
    out[:, 5] = np.bincount(line_text, minlength=texts)
    out[:, 3] = out[:, 5] - np.bincount(line_text[distinct], minlength=texts)
    if len(at):
        last = np.append(at[1:], len(starts)) - 1  # last word of each such line
        out[:, 10] = np.bincount(line_text[_END[data[ends[last] - 1]]], minlength=texts)
    # words in windows that the text holds twice or more
    hashes = span_hashes(data, starts, ends)
    own = _own(hashes, text)
    out[:, 11] = np.bincount(text[np.unique(own, return_index=True)[1]], minlength=texts)
    if len(starts) >= WINDOW:
        n = len(starts) - WINDOW + 1
        window = own[:n].copy()
        for k in range(1, WINDOW):
            window = mix(window * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + n])
        whole = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
        again = whole[_repeats(window[whole])]
        edges = np.zeros(len(starts) + 1, np.int32)
        np.add.at(edges, again, 1)
        np.add.at(edges, again + WINDOW, -1)
        out[:, 4] = np.bincount(text[np.cumsum(edges[:-1]) > 0], minlength=texts)
    return out


def base_failed(c: np.ndarray) -> np.ndarray:
    return (c[:, 0] < FEWEST_WORDS) | (100 * c[:, 4] > 20 * c[:, 0])


def features(c: np.ndarray) -> np.ndarray:
    """Rule statistics: shares and means that do not grow with the document."""
    c = c.astype(np.float64)
    n_words, lines, letters, chars = (np.maximum(c[:, k], 1) for k in (0, 5, 7, 1))
    return np.stack([
        c[:, 1] / n_words,  # mean word length
        c[:, 2] / n_words,  # symbols a word
        c[:, 3] / lines,  # repeated lines
        c[:, 4] / n_words,  # words in repeated windows
        np.log2(n_words / lines),  # words a line
        c[:, 6] / letters,  # upper case
        c[:, 7] / chars,  # letters
        c[:, 8] / chars,  # digits
        c[:, 9] / n_words,  # punctuation marks a word
        c[:, 10] / lines,  # lines that end like a sentence
        c[:, 11] / n_words ** 0.8,  # different words
    ], axis=1)


@dataclass
class Forest:
    """Trees as flat arrays; the children of a node stand side by side."""

    middle: np.ndarray  # ordinary value and spread of every statistic
    spread: np.ndarray
    roots: np.ndarray
    feature: np.ndarray  # -1 in a leaf
    split: np.ndarray
    child: np.ndarray  # left child; the right one follows
    path: np.ndarray  # of a leaf: steps to it and the mean further path of the rows left in it
    unit: float

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The leaf that every row reaches, tree by tree."""
        x = scaled(x, self.middle, self.spread)
        for root in self.roots:
            node = np.full(len(x), root)
            going = np.arange(len(x))
            while len(going := going[self.feature[node[going]] >= 0]):
                at = node[going]
                node[going] = self.child[at] + (x[going, self.feature[at]] >= self.split[at])
            yield node

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1; one half is an ordinary document."""
        total = np.zeros(len(x))
        for node in self.leaves(x):
            total += self.path[node]
        return np.round(2.0 ** (-total / (len(self.roots) * self.unit)), DECIMALS)


def scaled(x: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Distance from the ordinary value in spreads, on a logarithmic scale, so that far values do not take all splits."""
    away = (x - middle) / spread
    return np.sign(away) * np.log1p(np.abs(away))


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of n keys; between whole numbers under 3 on a line."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    most = np.maximum(n, 3)
    few = np.interp(n, [1, 2, 3], [0, 1, 2 * (np.log(2) + np.euler_gamma) - 4 / 3])
    return np.where(n >= 3, 2 * (np.log(most - 1) + np.euler_gamma) - 2 * (most - 1) / most, few)


def grow(count: Callable[[Forest], np.ndarray], rows: int, middle: np.ndarray, spread: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, seed: int = 7) -> Forest:
    """Isolation trees over the good rows, in the scaled box that all rows span.

    A split takes a random statistic at a random point of the node's box, so it
    can also part the good rows from a place where only others lie. It does not
    depend on the rows, so several levels are grown at a time; ``count`` then
    tells how many of all the good rows end in each node, and nodes that hold too
    few of them to be split become leaves again.
    """
    rng = np.random.default_rng(seed)
    size = min(LEAVES, rows)
    fewest = rows / size
    feature, split, child, steps = [], [], [], []

    def node(depth: int) -> int:
        for held, value in ((feature, -1), (split, 0.0), (child, 0), (steps, depth)):
            held.append(value)
        return len(feature) - 1

    def forest(path: np.ndarray) -> Forest:
        return Forest(middle, spread, np.arange(trees), np.array(feature), np.array(split), np.array(child), path, max(float(_mean_path(size)), 1.0))

    live = [(node(0), low, high) for _ in range(trees)]
    mass = np.full(trees, rows)
    for levels in ROUNDS:
        begun, reached = len(feature), live
        for _ in range(levels):
            below = []
            for k, least, most in reached:
                varies = np.flatnonzero(most > least)
                if not len(varies):
                    continue
                f = int(rng.choice(varies))
                at = float(rng.uniform(least[f], most[f]))
                feature[k], split[k], child[k] = f, at, node(steps[k] + 1)
                node(steps[k] + 1)
                left, right = most.copy(), least.copy()
                left[f] = right[f] = at
                below += [(child[k], least, left), (child[k] + 1, right, most)]
            reached = below
        if len(feature) == begun:
            break
        mass = count(forest(np.zeros(len(feature))))
        for k in range(len(feature) - 1, -1, -1):  # children stand behind their parent
            if feature[k] >= 0:
                mass[k] = mass[child[k]] + mass[child[k] + 1]
        for k in range(len(feature)):
            if feature[k] >= 0 and mass[k] <= fewest:
                feature[k] = -1
        live = [(k, least, most) for k, least, most in reached if mass[k] > fewest]
        if not live:
            break
    return forest(np.array(steps) + _mean_path(mass / fewest))


@dataclass
class Model:
    """The forest and, for each band of lengths, the score beyond which a document goes."""

    forest: Forest | None
    thresholds: tuple[float, ...]

    def verdicts(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, kept) of documents with these counts."""
        failed = base_failed(c)
        if self.forest is None:
            return np.zeros(len(c)), ~failed
        score = self.forest.scores(features(c))
        band = np.clip(np.searchsorted(BANDS, c[:, 0], side="right") - 1, 0, None)
        return score, ~failed & (score <= np.array(self.thresholds)[band])


def threshold(scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The score that parts bad rows from good ones best, among those that lose at most ``MOST_GOOD_LOST`` of the good.

    The scores are ascending; the others are the rows of each kind that have them.
    """
    if not good.sum() or not bad.sum():
        return 1.0
    lost, caught = (1 - np.cumsum(n) / n.sum() for n in (good, bad))
    allowed = np.flatnonzero(lost <= MOST_GOOD_LOST)
    best = allowed[np.argmax((caught - lost)[allowed])]
    above = scores[best + 1] if best + 1 < len(scores) else 1.0
    return float((scores[best] + above) / 2)


def _counted(docs: DataFrame, *carry: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "text", CHUNK):
            table = counts(*flat(part.column(part.schema.get_field_index("text"))))
            own = [part.column(part.schema.get_field_index(c)) for c in carry]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(table[:, k]) for k in range(len(COUNTS)))], names=[*carry, *COUNTS])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)
    return docs.select(*carry, "text").mapInArrow(run, f"{kept}, " + ", ".join(f"{c} long" for c in COUNTS))


def _labelled(counted: DataFrame, labels: DataFrame, sample: int | None) -> DataFrame:
    """(good, part, band, statistics) of the labelled documents that no base rule rejects, one row an id."""
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good"))
    # of rows that share an id, the least counts
    own = counted.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("c"))
    spin = F.xxhash64("doc_id", F.lit("quality"))
    rows = marked.join(own, "doc_id").withColumn("spin", spin)
    if sample is not None:
        rows = rows.filter("good >= 1").orderBy("spin").limit(sample).unionAll(rows.filter("good < 1").orderBy("spin").limit(sample))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = np.stack([batch.column(2 + k).to_numpy() for k in range(len(COUNTS))], axis=1)
            use = ~base_failed(c)
            x = features(c[use])
            band = np.searchsorted(BANDS, c[use, 0], side="right") - 1
            marks = [batch.column(k).filter(pa.array(use)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*marks, pa.array(band, pa.int32()), *(pa.array(x[:, k]) for k in range(x.shape[1]))], names=["good", "part", "band", *_X])

    part = F.shiftright("spin", 7).bitwiseAND(1) == 1
    return rows.select((F.col("good") >= 1).alias("good"), part.alias("part"), "c.*").mapInArrow(run, "good boolean, part boolean, band int, " + ", ".join(f"{x} double" for x in _X))


_X = [f"x{k}" for k in range(len(LEAST_SPREAD))]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(x)).to_numpy() for x in _X], axis=1)


def _quantiles(rows: DataFrame, share: float, value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A quantile of every statistic's value (not negative) over all rows, from histograms with bins of 0.1 %."""
    shift = 52 - BITS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.abs(value(_matrix(batch))).view(np.int64) >> shift
            for k in range(codes.shape[1]):
                code, n = np.unique(codes[:, k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), k, np.int32)), pa.array(code), pa.array(n)], names=["k", "code", "n"])

    bins = rows.mapInArrow(run, "k int, code long, n long").groupBy("k", "code").agg(F.sum("n").alias("n")).toArrow()
    k, code, n = (bins[c].to_numpy() for c in ("k", "code", "n"))
    out = np.zeros(len(_X))
    for j in range(len(_X)):
        own = np.flatnonzero(k == j)
        own = own[np.argsort(code[own])]
        reached = np.cumsum(n[own])
        found = code[own][np.searchsorted(reached, share * reached[-1])]
        out[j] = ((np.array([found]) << shift) + (1 << shift >> 1)).view(np.float64)[0] if found else 0.0
    return out


def _node_counts(rows: DataFrame) -> Callable[[Forest], np.ndarray]:
    """Counts all rows in the leaves of a forest."""

    def count(forest: Forest) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast(forest)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(len(shared.value.feature), np.int64)
            for batch in batches:
                for leaf in shared.value.leaves(_matrix(batch)):
                    at, n = np.unique(leaf, return_counts=True)
                    held[at] += n
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["node", "n"])

        found = rows.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).toArrow()
        out = np.zeros(len(forest.feature), np.int64)
        out[found["node"].to_numpy()] = found["n"].to_numpy()
        shared.destroy()
        return out

    return count


def _thresholds(rows: DataFrame, forest: Forest) -> tuple[float, ...]:
    """Of every band, from the scores of all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [batch.column(batch.schema.get_field_index(c)) for c in ("band", "good")]
            yield pa.RecordBatch.from_arrays([*marks, pa.array(shared.value.scores(_matrix(batch)))], names=["band", "good", "score"])

    found = rows.mapInArrow(run, "band int, good boolean, score double").groupBy("band", "score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).orderBy("score").toArrow()
    band, score, good, bad = (found[c].to_numpy() for c in ("band", "score", "good", "bad"))
    values, place = np.unique(score, return_inverse=True)
    every = threshold(values, np.bincount(place, good), np.bincount(place, bad))
    cuts = []
    for k in range(len(BANDS)):
        own = band == k
        enough = min(int(good[own].sum()), int(bad[own].sum())) >= 20
        cuts.append(threshold(score[own], good[own], bad[own]) if enough else every)
    return tuple(cuts)


def _fitted(counted: DataFrame, labels: DataFrame, sample: int | None = None) -> Model:
    rows = keep(_labelled(counted, labels, sample), "quality-rows")
    ends = [f(x).alias(f"{name}_{x}") for x in _X for name, f in (("low", F.min), ("high", F.max))]
    kinds = {(r.good, r.part): r for r in rows.groupBy("good", "part").agg(F.count("*").alias("n"), *ends).collect()}
    if not {(True, True), (True, False), (False, False)} <= kinds.keys():
        return Model(None, (1.0,) * len(BANDS))
    good = rows.filter("part AND good").select(*_X)
    middle = _quantiles(good, 0.5, lambda x: x)
    spread = np.maximum(_quantiles(good, 0.75, lambda x: x - middle), LEAST_SPREAD)
    own = [r for (_, part), r in kinds.items() if part]
    low, high = (scaled(np.array([f(r[f"{name}_{x}"] for r in own) for x in _X]), middle, spread) for name, f in (("low", min), ("high", max)))
    forest = grow(_node_counts(good), kinds[True, True].n, middle, spread, low, high)
    return Model(forest, _thresholds(rows.filter("NOT part"), forest))


def fit(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> Model:
    """Forest and thresholds from all labelled documents (with ``sample``: from so many of each quality at most)."""
    return _fitted(keep(_counted(docs, "doc_id"), "quality-counts"), labels, sample)


def _judged(counted: DataFrame, model: Model) -> DataFrame:
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            table = np.stack([part.column(1 + k).to_numpy() for k in range(len(COUNTS))], axis=1)
            score, kept = shared.value.verdicts(table)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(base_failed(table)), pa.array(score), pa.array(kept)], names=["doc_id", *COUNTS, "base_failed", "score", "kept"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return counted.mapInArrow(run, schema)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, the counts, base_failed, score, kept) of every row."""
    return _judged(_counted(_named(docs), "doc_id"), model)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict of every document, by a model fitted on the labelled ones; texts are counted once."""
    counted = keep(_counted(_named(docs), "doc_id"), "quality-counts")
    return _judged(counted, _fitted(counted, labels))


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in gathered(batches, "text", CHUNK):
            kept = shared.value.verdicts(counts(*flat(part.column(place))))[1]
            yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
