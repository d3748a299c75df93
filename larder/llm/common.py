"""Helpers shared by the corpus operators: reading tables, Arrow text, hashing.

Tasks work on flat arrays: the UTF-8 bytes of many texts in one numpy array and
the offset at which each text begins. Nulls in a text column count as empty.
"""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 4 << 20
#: Rows handled at once.
CHUNK_ROWS = 50_000
#: Bytes of a written row group, which a writing task holds in memory.
ROW_GROUP = 16 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_IDENTITY = np.arange(256, dtype=np.uint8)
_LOWER = _IDENTITY.copy()
_LOWER[65:91] += 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that whole texts travel in, unless the session has its own setting."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")):
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)


def shuffle_width(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions, which sizes every bucketed exchange."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, what = column.buffers()
    if len(column) == 0 or what is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(what, np.uint8)[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back to the system; a worker that Spark reuses would else keep the peak of each task it had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES, max_rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``max_rows`` and ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        _, at = flat(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + max_bytes, side="right")) - 1)
            j = min(j, i + max_rows)
            yield batch.slice(i, j - i)
            i = j


def gathered(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int, max_rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """As ``slices``, but small neighbouring batches are joined first; memory freed before and since is released."""
    release()
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for part in slices(batches, column, max_bytes, max_rows):
        own = int(flat(part.column(part.schema.get_field_index(column)))[1][-1])
        if held and (size + own > max_bytes or rows + part.num_rows > max_rows):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, rows = [], 0, 0
        if part.num_rows:
            held.append(part)
            size += own
            rows += part.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    held.clear()
    release()


_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes hashed at once: the working arrays of a hash do not grow with the text.
_BLOCK = 1 << 18
_powers: dict[str, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; tables of up to ``_BLOCK`` values are kept."""
    key = str(base)
    have = _powers.get(key)
    if have is not None and len(have) >= n:
        return have[:n]
    size = max(n, _BLOCK)
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    if size == _BLOCK:
        _powers[key] = out
    return out[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, block: int = _BLOCK) -> np.ndarray:
    """64-bit hash of every span's bytes, wherever the span stands.

    The text is read block by block; a running total and the power at the
    block's start carry the sums over. Memory grows with the spans only.
    ``starts`` and ``ends`` must each be in ascending order.
    """
    low, high, shift = (np.zeros(len(starts), np.uint64) for _ in range(3))
    table = _TABLE[_LOWER] if lower else _TABLE
    ahead, back = powers(block), powers(block, pow(_BASE, -1, 1 << 64))
    total, up, down = 0, 1, 1
    sums = np.zeros(block + 1, np.uint64)
    for begin in range(0, len(data), block):
        part = data[begin : begin + block]
        size = len(part)
        np.cumsum(table[part] * ahead[:size], out=sums[1 : size + 1])
        last = begin + size == len(data)
        for at, out in ((starts, low), (ends, high)):
            i, j = np.searchsorted(at, [begin, begin + size + last])
            near = at[i:j] - begin
            out[i:j] = np.uint64(total) + np.uint64(up) * sums[near]
            if out is low:
                shift[i:j] = np.uint64(down) * back[np.minimum(near, size - 1)]
        total = (total + up * int(sums[size])) % (1 << 64)
        up = up * pow(_BASE, block, 1 << 64) % (1 << 64)
        down = down * pow(_BASE, -block, 1 << 64) % (1 << 64)
    return mix((high - low) * shift + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts: starts, ends, and the first word of each text (n+1)."""
    n = len(data)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def owners(firsts: np.ndarray) -> np.ndarray:
    """Text number of every element, given each text's first element (n+1)."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))


def sha256_hex(parts: Iterable[bytes]) -> list[str]:
    return [hashlib.sha256(p).hexdigest() for p in parts]


def cut(data: np.ndarray | bytes, offsets: np.ndarray) -> list[bytes]:
    """The texts as separate byte strings."""
    raw = data if isinstance(data, bytes) else data.tobytes()
    at = offsets.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def n_chars(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return heads[offsets[1:]] - heads[offsets[:-1]]


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of rows with equal keys, from batches sorted by them."""
    release()
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            column = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
            if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != column[0]:
                new[0] = True
        edges = np.flatnonzero(new).tolist()
        starts = set(edges)
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            if a in starts and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
    held = []
    release()


#: Bits of a Bloom filter that is broadcast: 8 MB, whatever the input.
BLOOM_BITS = 1 << 26


class Bloom:
    """A filter of fixed size over 64-bit values: no false negatives; false positives only cost time."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(values: np.ndarray, bits: int) -> list[np.ndarray]:
        h = mix(values.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
        return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value], np.int64).view(np.uint64))[0])

    def has(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), bool)
        for at in self.places(values, 64 * len(self.words)):
            out &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


def _bloom_words(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of a filter that the 64-bit values set bits in, and these bits."""
    at = np.unique(np.concatenate(Bloom.places(values, bits)))
    word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    return word[first], np.bitwise_or.reduceat(bit, first)


def bloom(values: DataFrame, bits: int = BLOOM_BITS) -> Bloom:
    """Filter over the one long column of ``values``; at most bits / 64 words reach the driver."""
    return bloom_and_marked(values.select(values[0].alias("value"), F.lit(False).alias("marked")), bits)[0]


def bloom_and_marked(values: DataFrame, bits: int = BLOOM_BITS) -> tuple[Bloom, np.ndarray]:
    """Filter over the first, long column of ``values``, and in ascending order (unsigned) those whose second column is true.

    One pass, so that ``values`` need not be written to be read twice; all that is marked reaches the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).drop_null().to_numpy().view(np.uint64)
            if len(own):
                word, bit = _bloom_words(own, bits)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(bit.view(np.int64)), pa.nulls(len(word), pa.int64())], names=["word", "bits", "value"])
            marked = batch.column(0).filter(batch.column(1)).drop_null()
            if len(marked):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(marked), pa.int32()), pa.nulls(len(marked), pa.int64()), marked], names=["word", "bits", "value"])

    table = values.mapInArrow(run, "word int, bits long, value long").groupBy("word", "value").agg(F.bit_or("bits").alias("bits"))
    table = table.select("word", F.coalesce("value", "bits").alias("bits")).toArrow()
    marked = np.sort(table.filter(pc.is_null(table["word"]))["bits"].to_numpy().view(np.uint64))
    table = table.filter(pc.is_valid(table["word"]))
    words = np.zeros(bits // 64, np.uint64)
    if table.num_rows:
        words[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return Bloom(words), marked


def side_of(docs: DataFrame, key: str, shared: Broadcast, inside: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For batches of docs: the rows whose long ``key`` may be in the filter, or (not ``inside``) surely is not; keys are not null."""
    place = docs.columns.index(key)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = shared.value.has(batch.column(place).to_numpy().astype(np.int64).view(np.uint64))
            yield batch.filter(pa.array(has if inside else ~has))

    return split


def parted(docs: DataFrame, key: str, wanted: Bloom) -> tuple[DataFrame, DataFrame]:
    """(rows whose long ``key`` may be in the filter, rows whose key surely is not); keys are not null."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    return docs.mapInArrow(side_of(docs, key, shared, True), docs.schema), docs.mapInArrow(side_of(docs, key, shared, False), docs.schema)


def transposed(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, which shuffle compression likes."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def restored(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(kind).ravel()
