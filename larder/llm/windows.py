"""Windows of a fixed length that repeat across a corpus: what the two exact deduplicators share.

Each window of W elements (bytes or words) is owned by its minimizer, the
k-gram of least hash in it (leftmost on ties), so equal windows have equal
minimizers at equal places. Windows with the same minimizer are consecutive;
together they are a segment: the anchor, ``left`` elements before it and
``right`` from it on. An anchor that occurs once in the corpus owns no repeated
window, which sets most of the text aside before anything is sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import bloom, keep, mix, side_of

#: Column that ``with_spans`` adds.
SPANS = "__spans"
#: Occurrences beyond which an anchor's windows are counted by hash, with partial sums, instead of being sorted together.
HOT = 100_000


def sliding_minimum(values: np.ndarray, w: int) -> np.ndarray:
    """min(values[i : i + w]) for every i with a whole window."""
    n = len(values)
    if n < w:
        return values[:0]
    padded = np.concatenate([values, np.full(-n % w, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def segments(grams: np.ndarray, whole: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, and the first and last window of each.

    ``grams[i]`` is the hash of the k-gram at i, ``whole[i]`` whether a window
    begins at i, and w the k-grams in a window.
    """
    if len(grams) < w or not whole.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    bits = max(1, int(len(grams)).bit_length())
    place = np.uint64((1 << bits) - 1)
    key = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_minimum(key, w) & place).astype(np.int64)
    whole = whole[: len(least)]
    new = whole.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new)
    end = whole.copy()
    end[:-1] &= (least[1:] != least[:-1]) | ~whole[1:]
    return least[first], first, np.flatnonzero(end)


def begins(offsets: np.ndarray, length: int, total: int) -> np.ndarray:
    """Whether a window of this length that stays in its text begins at each element."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)
    return left >= length


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """Hashes of the first 1, 2, ... columns of every row of a matrix of 64-bit values."""
    out = np.zeros((len(values), values.shape[1] + 1), np.uint64)
    weight = np.array([pow(0x9FB21C651E98DF25, k + 1, 1 << 64) for k in range(values.shape[1])], np.uint64)
    np.cumsum(mix(values + np.uint64(1)) * weight, axis=1, out=out[:, 1:])
    return out


def unions(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals merged where they overlap or touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]


def spans_of(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of every run of True in the rows of a matrix."""
    edge = np.zeros((len(marks), 1), bool)
    steps = np.diff(np.concatenate([edge, marks, edge], axis=1).astype(np.int8), axis=1)
    row, first = np.nonzero(steps == 1)
    return row, first, np.nonzero(steps == -1)[1] - 1


def spans_table(keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    return pa.table({"key": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64())})


def with_spans(docs: DataFrame, spans: DataFrame, key: str, run: Callable, schema: str) -> DataFrame:
    """``run`` over all rows of docs, given the spans of each; only rows that may have some are shuffled.

    No task has two Python nodes in a row, which would need two workers a core;
    Spark keeps these and their memory for all that follows. So the rows without
    spans are picked and run in one pass, and the others always shuffled between.
    """
    grouped = keep(spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias(SPANS)), "spans")
    wanted = docs.sparkSession.sparkContext.broadcast(bloom(grouped.select("key")))
    hit = docs.mapInArrow(side_of(docs, key, wanted, True), docs.schema)
    hit = hit.hint("merge").join(grouped.withColumnRenamed("key", key), key, "left").select(*docs.columns, SPANS)
    others = side_of(docs, key, wanted, False)
    none = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, none)], names=[*b.schema.names, SPANS]) for b in others(batches))

    return docs.mapInArrow(alone, schema).unionByName(hit.mapInArrow(run, schema))


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (null: empty) and a key that equal rows share."""
    cols = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return cols.withColumn("key", F.xxhash64("doc_id", "text"))
