"""Language identification by sparse multinomial regression on character n-grams.

Features are the 1-, 2- and 3-grams of lower-cased letters (any other run of
characters is one blank), hashed to ``FEATURES`` columns; a column's value is
its share of the text's n-grams times its inverse document frequency. Document
frequencies are counted over all labelled training documents. Weights are
learned by the follow-the-regularised-leader rule with L1 and L2 penalties on a
bounded sample of at most ``SAMPLE`` labelled documents, dealt evenly over the
languages and picked by a hash of the id; about a fifth of each language's,
dealt by a second hash and kept out of the fitting, sets the temperature of the
scores. The fitted table has
FEATURES x languages floats and is broadcast.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if no row is labelled; null ids are not learned from;
equal texts get equal predictions; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import flat, gathered, mix
from larder.llm.pretokens import LETTER, classes, code_points

FEATURES = 1 << 15
SAMPLE = 6000
SCALE = 32.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
PASSES = 4
UNKNOWN = "und"
#: ``accepted`` rejects a document whose score is less than this part of the way from chance (one in the number
#: of languages) to 1: 0.3 for four languages.
LEAST_MARGIN = 1 / 15
#: It also rejects one whose share of n-grams known in the called language is less than this part of the way from
#: chance (the share of all columns known there) to the share that the calibration documents of the language have.
LEAST_KNOWN = 0.5
#: What counts as the latter share above chance where a language has no calibration documents.
FEW_KNOWN = 0.1
#: Bytes of text whose n-grams are taken at once; the working arrays are many times that.
_CHUNK = 512 << 10
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


_STEP, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)
_SHIFT = np.uint32(32 - FEATURES.bit_length() + 1)


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.uint32]:
    """A 32-bit code for the lower case of every letter, one code for everything else."""
    low = np.full(0x110000, 0x20, np.uint64)
    for c in np.flatnonzero(classes() == LETTER).tolist():
        small = chr(c).lower()
        low[c] = ord(small) if len(small) == 1 else c
    codes = (mix(low) >> np.uint64(32)).astype(np.uint32)
    return codes, codes[0x20]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hashed n-grams of every text, by size 1, 2, 3: columns and offsets (n+1); and whether it has a letter."""
    points, at = code_points(data)
    codes, other = _letters()
    c = codes[points]
    first = np.searchsorted(at, offsets)
    new = np.zeros(len(c) + 1, bool)
    new[first] = True
    blank = c == other
    keep = np.ones(len(c), bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | new[1:-1]  # a run of others is one blank
    kept = np.concatenate([[0], np.cumsum(keep)])
    first = kept[first]
    c, blank, new = c[keep], blank[keep], new[:-1][keep]
    out = []
    letter = ~blank
    at_letter = np.concatenate([[0], np.cumsum(letter)])[first]
    out.append(((c[letter] * _SPREAD) >> _SHIFT, at_letter))
    key, crossing = c, new
    for size in (2, 3):
        if len(c) < size:
            out.append((np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)))
            continue
        key = key[:-1] * _STEP + c[size - 1 :]
        crossing = new[1:] if size == 2 else crossing[:-1] | new[2:]
        inside = ~crossing
        bounds = np.concatenate([[0], np.cumsum(inside)])[np.minimum(first, len(inside))]
        out.append((((key[inside] + np.uint32(size)) * _SPREAD) >> _SHIFT, bounds))
    return out, np.diff(at_letter) > 0


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that have each column, over all training rows; one row of counts from each task, then summed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in gathered(batches, "text", _CHUNK):
            sized, _ = grams(*flat(batch.column(0)))
            seen = np.empty(FEATURES, np.uint8)
            for k in range(batch.num_rows):
                seen[:] = 0
                for column, at in sized:
                    seen[column[at[k] : at[k + 1]]] = 1
                total += seen
            n += batch.num_rows
        if n:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], n))], names=["column", "n"]
            )

    rows = train.select("text").mapInArrow(run, "column int, n long").groupBy("column").agg(F.sum("n")).collect()
    # FEATURES + 1 rows at most, whatever the input
    total, n = np.zeros(FEATURES, np.int64), 0
    for row in rows:
        if row[0] < 0:
            n = row[1]
        else:
            total[row[0]] = row[1]
    return total, n


def _sample(train: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray, int]]:
    """(label, columns, shares, lot from 0 to 4) of at most SAMPLE training documents, even over the labels."""
    sizes = {r[0]: r[1] for r in train.groupBy("lang").count().collect()}
    if not sizes:
        return []
    each = max(1, SAMPLE // len(sizes))
    rate = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, each / v))])
    spin = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # from 0 to 1 in every label, so that order and limit treat all labels alike
    picked = train.withColumn("spin", spin / rate[F.col("lang")]).filter(F.col("spin") < 1)
    picked = picked.withColumn("lot", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(5)).cast("int"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            sized, _ = grams(*flat(batch.column(1)))
            ids, shares = [], []
            for k in range(batch.num_rows):
                own, count = np.unique(np.concatenate([column[at[k] : at[k + 1]] for column, at in sized]), return_counts=True)
                ids.append(own.astype("<i4").tobytes())
                shares.append((count / max(1, count.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(shares, pa.binary()), batch.column(2), batch.column(3)], names=["lang", "ids", "shares", "spin", "lot"])

    rows = picked.select("lang", "text", "spin", "lot").mapInArrow(run, "lang string, ids binary, shares binary, spin double, lot int").orderBy("spin", "lang", "ids").limit(SAMPLE).collect()
    return [(r[0], np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4"), r[4]) for r in rows]


def _dealt(sample: list) -> tuple[list, list]:
    """(calibration rows, fitting rows); every label keeps rows to be fitted on."""
    fitted = {s[0] for s in sample if s[3]}
    held = [s for s in sample if not s[3] and s[0] in fitted]
    rest = [s for s in sample if s[3] or s[0] not in fitted]
    return (held, rest) if held else (sample, sample)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # langs x FEATURES: weight of one whole share of a column
    bias: np.ndarray
    temperature: float
    known: np.ndarray  # langs x FEATURES: columns that the language's sampled documents have
    least_known: np.ndarray  # share of known n-grams that a text of the language must have

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each language for every text, and whether it has a letter."""
        sized, has = grams(data, offsets)
        return self._scores(sized, has), has

    def accepts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts are in a known language (see LEAST_MARGIN and LEAST_KNOWN), whatever the number of languages."""
        sized, has = grams(data, offsets)
        p = self._scores(sized, has)
        called, chance = p.argmax(axis=1), 1 / len(self.langs)
        n, known = np.zeros(len(has), np.int64), np.zeros(len(has))
        for column, at in sized:
            each = np.diff(at)
            n += each
            full = np.flatnonzero(each)
            if len(full):
                known[full] += np.add.reduceat(self.known[np.repeat(called, each), column], at[full], dtype=np.int64)
        sure = p.max(axis=1, initial=0) >= chance + LEAST_MARGIN * (1 - chance)
        return has & sure & (known >= self.least_known[called] * n)

    def _scores(self, sized: list[tuple[np.ndarray, np.ndarray]], has: np.ndarray) -> np.ndarray:
        n = np.zeros(len(has), np.int64)
        sums = np.zeros((len(has), len(self.langs)))
        for column, at in sized:
            n += np.diff(at)
            full = np.flatnonzero(np.diff(at))
            if len(full):
                for k in range(len(self.langs)):
                    sums[full, k] += np.add.reduceat(self.table[k][column], at[full])
        return _softmax((sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(sample: list, langs: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES x langs, and biases) by the proximal follow-the-regularised-leader rule."""
    z = np.zeros((FEATURES + 1, len(langs)))
    n = np.zeros_like(z)

    def weights(i: np.ndarray) -> np.ndarray:
        shrunk = z[i] - np.sign(z[i]) * L1
        return np.where(np.abs(z[i]) <= L1, 0.0, -shrunk / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    order = np.random.default_rng(11)
    for _ in range(PASSES):
        for k in order.permutation(len(sample)):
            label, ids, shares, _ = sample[k]
            i = np.append(ids, FEATURES)
            x = np.append(SCALE * shares * idf[ids], 1.0)
            w = weights(i)
            p = _softmax(x @ w)
            p[langs.index(label)] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def _known(sample: list, held: list, rest: list, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Columns that each language's sampled documents have, and the least share of them in a text of it."""

    def columns(rows: list) -> np.ndarray:
        out = np.zeros((len(langs), FEATURES), np.uint8)
        for label, ids, *_ in rows:
            out[langs.index(label), ids] = 1
        return out

    fitted, least = columns(rest), np.zeros(len(langs))
    for k, lang in enumerate(langs):
        chance = fitted[k].mean()
        shares = [s[fitted[k][i] > 0].sum() for label, i, s, _ in held if label == lang and len(i)] if held is not rest else []
        usual = np.quantile(shares, 0.01) if shares else chance + FEW_KNOWN
        least[k] = chance + LEAST_KNOWN * max(0.0, usual - chance)
    return columns(sample), least


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """Model of the labelled documents that are not held out; None if there are none."""
    train = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    train = train.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sample = _sample(train)
    if not sample:
        return None
    frequency, n = _document_frequencies(train)
    idf = np.log((1 + n) / (1 + frequency)) + 1.0
    langs = sorted({s[0] for s in sample})
    held, rest = _dealt(sample)
    w, bias = _ftrl(rest, langs, idf)
    table = SCALE * idf[:, None] * w
    logits = np.array([s @ table[i] + bias for _, i, s, _ in held])
    truth = np.array([langs.index(x[0]) for x in held])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 120))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    known, least = _known(sample, held, rest, langs)
    return LanguageModel(langs, np.ascontiguousarray(table.T, np.float32), bias, float(grid[int(np.argmin(loss))]), known, least)


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in gathered(batches, "text", _CHUNK):
            if own is None:
                names, best = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                p, has = own.scores(*flat(batch.column(2)))
                names = [own.langs[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1), has)]
                best = np.where(has, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(best)], names=["doc_id", "held_out", "lang_pred", "score"])

    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return cols.mapInArrow(run, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the labelled documents and predict every one."""
    return predict(docs, fit(docs))


def accepted(docs: DataFrame) -> DataFrame:
    """Rows whose text is in a known language (see ``LanguageModel.accepts``); all columns kept."""
    model = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in gathered(batches, "text", _CHUNK):
            if own is not None:
                yield batch.filter(pa.array(own.accepts(*flat(batch.column(place)))))

    return docs.mapInArrow(run, docs.schema)
