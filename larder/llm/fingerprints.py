"""Document fingerprints: quartile bucket digests.

The byte triplet at every position is hashed to one of ``BUCKETS`` counters. The digest names, for each counter,
the quartile of the text's counters that it falls in (two bits), and the length
on a log scale (one byte), all in hex. Two digests differ by the sum of their
quartile distances plus a bounded length difference; likeness is one minus that
sum over its bound.

``edited_pairs`` also needs each document's successor. Rows are range-dealt by
descending id, so most successors stand in the same task; only the first and
last row of each task meet those of its neighbours in a second, small step.

Defined cases: null and empty texts (and those under three bytes) have the
digest of no triplets; equal texts have equal digests; rows with equal ids are
ordered by a hash of their text, null ids come last; no rows give no rows; a
single row is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import flat, gathered, keep, shuffle_width

BUCKETS = 1024
#: Rows handled at once: each takes BUCKETS counters.
ROWS = 2000
LENGTH_BOUND = 24
MOST = 3 * BUCKETS + LENGTH_BOUND
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Digest of every text: a row of BUCKETS quartiles and one length code (uint8)."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.int64)
    if len(data) > 2:
        text = np.repeat(np.arange(n) * BUCKETS, np.diff(offsets))
        wide = data.astype(np.uint32)
        mixed = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
        bucket = (mixed * np.uint32(0x165667B1)) >> np.uint32(33 - BUCKETS.bit_length())
        inside = text[2:] == text[:-2]
        counts = np.bincount((text[2:] + bucket)[inside], minlength=n * BUCKETS)
    counts = counts.reshape(n, BUCKETS)
    marks = [q * BUCKETS // 4 - 1 for q in (1, 2, 3)]
    ordered = np.partition(counts, marks, axis=1)
    out = np.zeros((n, BUCKETS + 1), np.uint8)
    for k in marks:
        out[:, :-1] += counts > ordered[:, k][:, None]
    out[:, -1] = np.minimum(255, np.round(8 * np.log2(1 + np.diff(offsets)))).astype(np.uint8)
    return out


def to_hex(digest: np.ndarray) -> list[str]:
    """Hex of digest rows: length byte, then four quartiles a byte."""
    q = digest[:, :-1].reshape(len(digest), -1, 4)
    packed = (q << np.array([6, 4, 2, 0], np.uint8)).sum(axis=2).astype(np.uint8)
    raw = np.concatenate([digest[:, -1:], packed], axis=1)
    return [row.tobytes().hex() for row in raw]


def from_hex(text: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(text), np.uint8)
    q = (raw[1:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3
    return np.append(q.ravel(), raw[0]).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness, 0 to 1, of digest rows."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    return 1.0 - (apart[:, :-1].sum(axis=1) + np.minimum(LENGTH_BOUND, apart[:, -1])) / MOST


def _edit(raw: bytes, offsets: np.ndarray, data: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Edited text of every document but the last given, with the next as its successor; and code points of all."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(heads, offsets)
    n = np.diff(first)
    heads = np.append(heads, len(data))
    moved = n[:-1] // 2
    cut = heads[first[:-2] + n[:-1] - moved] if len(n) > 1 else np.zeros(0, np.int64)
    end = np.minimum(heads[np.minimum(first[1:-1] + moved, first[2:])], offsets[2:])
    cut = np.where(moved > 0, cut, offsets[1:-1])
    end = np.where(moved > 0, end, offsets[1:-1])
    return [raw[a:b] + raw[c:d] for a, b, c, d in zip(offsets[:-2].tolist(), cut.tolist(), offsets[1:-1].tolist(), end.tolist())], n


def _rows(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Result rows of all but the last text, whose successor is the text after it."""
    data, offsets = flat(texts)
    edited, n = _edit(data.tobytes(), offsets, data)
    own = digests(data, offsets)
    joined = np.frombuffer(b"".join(edited), np.uint8)
    other = digests(joined, np.concatenate([[0], np.cumsum([len(e) for e in edited])]).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            ids.slice(0, len(edited)),
            pa.array(n[:-1], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            pa.array(to_hex(own[:-1]), pa.string()),
            pa.array(to_hex(other), pa.string()),
            pa.array(likeness(own[:-1], other), pa.float64()),
            pa.array(likeness(own[:-1], own[1:]), pa.float64()),
        ],
        names=[f.split()[0] for f in SCHEMA.split(", ")],
    )


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document, its edited text and its successor (see the module)."""
    spark = docs.sparkSession

    def inside(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None

        def out(rows: pa.RecordBatch, edge: str | None = None, text: pa.Array | None = None) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.string()), text if text is not None else pa.nulls(n, pa.string())],
                names=[*rows.schema.names, "part", "edge", "text"],
            )

        def bare(row: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([row.column(0), *[pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in gathered(batches, "text", 2 << 20, ROWS):
            batch = batch.select(["doc_id", "text"])
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            else:
                first = batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1)
            if batch.num_rows > 1:
                yield out(_rows(batch.column(0), batch.column(1)))
        if first is not None:
            yield out(bare(first), "first", first.column(1))
            yield out(bare(last), "last", last.column(1))

    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    cols = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    cols = cols.withColumn("tie", F.xxhash64("text")).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    done = keep(cols.select("doc_id", "text").mapInArrow(inside, SCHEMA + ", part int, edge string, text string"), "fingerprints")

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    whole = done.filter(F.col("edge").isNull()).select(*names)
    # The last row of each task and the first of the next: two rows a task.
    parts = sorted(r[0] for r in done.filter(F.col("edge") == "first").select("part").collect())
    if not parts:
        return whole
    follows = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]])), "part int, after int")
    lasts = done.filter(F.col("edge") == "last").select("part", "doc_id", "text").join(follows, "part")
    firsts = done.filter(F.col("edge") == "first").select(F.col("part").alias("after"), F.col("text").alias("next_text"))

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                yield _rows(row.column(0), pa.concat_arrays([row.column(1), row.column(2)]))

    return whole.unionByName(lasts.join(firsts, "after").select("doc_id", "text", "next_text").mapInArrow(across, SCHEMA))
