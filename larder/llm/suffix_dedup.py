"""Exact substring deduplication by a distributed merge sort of suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere
else in the corpus. Strings are judged on the input; matches stay in a document.

1. Texts are cut into segments at minimizers (``windows``); anchors are counted
   over the corpus, and those that occur twice or more go into a Bloom filter of
   fixed size, which is broadcast. A false positive only costs time.
2. Each task sorts the suffixes at its repeated anchors and writes them as runs,
   one per chunk and range of anchor hashes, front-coded: what a suffix shares
   with the one before it in the run is sent as a number. Equal suffixes of a
   chunk are one entry with all their places.
3. A range's runs are combined by a loser tree that keeps, for each loser, the
   prefix it shares with the winner that passed it; two heads are compared only
   beyond the prefix both are known to share. The result is a sparse suffix
   array with its common-prefix lengths.
4. A window that begins o bytes before its anchor repeats where two suffixes
   share LENGTH - o bytes (runs of the common-prefix array) and the o bytes
   before them. Segments that are equal as a whole are taken together first.

Anchors with more than ``HOT`` places are not sorted in one task: their windows
are hashed and counted with partial sums, and joined back.

Defined cases: null and empty texts have nothing to remove; repeated rows are
separate documents with equal text, and so repeat each other; rows with null or
equal ids are told apart by their text; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import _BASE, _TABLE, bloom_and_marked, flat, gathered, keep, mix, powers, shuffle_width
from larder.llm.windows import HOT, begins, keyed_rows, segments, spans_of, spans_table, unions, with_spans

LENGTH = 400
GRAM = 64
_CHUNK = 512 << 10
#: Bytes of text whose suffixes are sorted into one run.
_RUN_TEXT = 8 << 20
_MEMBERS = 1024
_RUN = "bucket int, shared binary, sizes binary, rest binary, counts binary, keys binary, places binary, lefts binary, before binary"
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def byte_segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Anchor hash and place, first and last window of every segment."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(n), out=sums[1:])
    grams = mix((sums[gram:] - sums[: n - gram + 1]) * powers(n + 1, pow(_BASE, -1, 1 << 64))[: n - gram + 1])
    at, first, last = segments(grams, begins(offsets, length, n), length - gram + 1)
    return mix(grams[at]), at, first, last  # scrambled: least hashes are all small, ranges of them would be uneven


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, given that the first ``known`` bytes are equal."""
    most = min(len(a), len(b))
    step = 8
    while known < most and a[known : known + step] == b[known : known + step]:
        known += step
        step *= 2
    known = min(known, most)
    while step > 1:
        step //= 2
        if known + step <= most and a[known : known + step] == b[known : known + step]:
            known += step
    return known


class LoserTree:
    """Merges sorted runs of (bytes, prefix shared with the run's previous entry, value)."""

    def __init__(self, sources: list[Iterator[tuple[bytes, int, object]]]):
        self.sources = sources
        self.size = 1
        while self.size < len(sources):
            self.size *= 2
        self.heads: list[tuple[bytes, object] | None] = []
        self.shared = [0] * self.size
        for k in range(self.size):
            got = next(sources[k], None) if k < len(sources) else None
            self.heads.append((got[0], got[2]) if got else None)
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads; the loser keeps what it shares with the winner."""
        x, y = self.heads[a], self.heads[b]
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        s, t = self.shared[a], self.shared[b]
        if s > t:
            return a, b
        if t > s:
            return b, a
        m = shared_prefix(x[0], y[0], s)
        a_first = m == len(x[0]) or m < len(y[0]) and x[0][m] < y[0][m]
        self.shared[b if a_first else a] = m
        return (a, b) if a_first else (b, a)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[bytes, int, object]]:
        """(bytes, prefix shared with the entry before, value) in ascending order."""
        while self.heads[self.winner] is not None:
            k = self.winner
            text, value = self.heads[k]
            yield text, self.shared[k], value
            got = next(self.sources[k], None)
            self.heads[k] = (got[0], got[2]) if got else None
            self.shared[k] = got[1] if got else 0
            node = (k + self.size) // 2
            while node:
                k, self.losers[node] = self._play(k, self.losers[node])
                node //= 2
            self.winner = k


def _read_run(row: dict) -> Iterator[tuple[bytes, int, list]]:
    shared = np.frombuffer(row["shared"], "<i4").tolist()
    sizes = np.frombuffer(row["sizes"], "<i4").tolist()
    counts = np.frombuffer(row["counts"], "<i4").tolist()
    keys, places = np.frombuffer(row["keys"], "<i8").tolist(), np.frombuffer(row["places"], "<i8").tolist()
    lefts = np.frombuffer(row["lefts"], "<i4").tolist()
    text, at, member, before = b"", 0, 0, 0
    for s, size, count in zip(shared, sizes, counts):
        text = text[:s] + row["rest"][at : at + size]
        at += size
        own = []
        for k in range(member, member + count):
            own.append((row["before"][before : before + lefts[k]], keys[k], places[k]))
            before += lefts[k]
        member += count
        yield text, s, own


def _write_runs(entries: list[tuple[bytes, list]], buckets: int) -> list[dict]:
    """Front-coded runs of sorted entries, one for each range of anchor hashes."""
    out: dict[int, dict] = {}
    for text, own in entries:
        bucket = (int.from_bytes(text[:4], "big") * buckets) >> 32
        run = out.setdefault(bucket, {"last": b"", "shared": [], "sizes": [], "rest": [], "counts": [], "keys": [], "places": [], "lefts": [], "before": []})
        s = shared_prefix(run["last"], text)
        run["last"] = text
        run["shared"].append(s)
        run["sizes"].append(len(text) - s)
        run["rest"].append(text[s:])
        run["counts"].append(len(own))
        for left, key, place in own:
            run["keys"].append(key)
            run["places"].append(place)
            run["lefts"].append(len(left))
            run["before"].append(left)
    kinds = {"shared": "<i4", "sizes": "<i4", "counts": "<i4", "keys": "<i8", "places": "<i8", "lefts": "<i4"}
    return [
        {"bucket": b, **{k: np.array(run[k], kind).tobytes() for k, kind in kinds.items()}, "rest": b"".join(run["rest"]), "before": b"".join(run["before"])}
        for b, run in out.items()
    ]


def _repeated(members: list[tuple[int, int, bytes, bytes, list]], length: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Spans of repeated windows. members: (prefix shared with the one before, right size, suffix, left, places)."""
    if not members:
        return [], [], []
    lefts = np.array([len(m[3]) for m in members])
    rights = np.array([m[1] for m in members])
    width = int(lefts.max(initial=0))
    grid = np.zeros((width, len(members)), np.uint8)
    for i, m in enumerate(members):
        grid[: lefts[i], i] = np.frombuffer(m[3], np.uint8)[::-1]
    before = np.zeros(len(members), np.uint64)  # hash of the o bytes before each anchor
    common = np.array([m[0] for m in members])
    many = np.array([len(m[4]) > 1 for m in members])
    marks = np.zeros((len(members), width + 1), bool)
    for o in range(width + 1):
        if o:
            before = mix(before + _TABLE[grid[o - 1]])
        owned = (o >= length - rights) & (o <= lefts)
        marks[:, o] = owned & many  # equal as a whole
        rows = np.flatnonzero(owned)
        if len(rows) > 1:
            group = np.cumsum(common < length - o)[rows]
            key = mix(group.astype(np.uint64)) ^ before[rows]
            order = np.argsort(key)
            same = key[order][1:] == key[order][:-1]
            marks[rows[order[1:][same]], o] = True
            marks[rows[order[:-1][same]], o] = True
    row, first, last = spans_of(marks)
    keys, starts, ends = [], [], []
    for r, a, b in zip(row.tolist(), first.tolist(), last.tolist()):
        own = members[r][4]
        places = np.array([p for _, p in own], np.int64)
        keys.append(np.array([k for k, _ in own], np.int64))
        starts.append(places - b)
        ends.append(places - a + length)
    return keys, starts, ends


def _merge(length: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        members: list = []

        def flush() -> None:
            for have, new in zip(found, _repeated(members, length)):
                have.extend(new)
            members.clear()

        group: list[tuple[bytes, int, dict]] = []

        def close() -> None:
            """Take one anchor's suffixes into the members, unless it has a single place."""
            if sum(len(p) for _, _, own in group for p in own.values()) > 1:
                for text, s, own in group:
                    for k, (left, places) in enumerate(own.items()):
                        # within an entry suffixes are equal; the first of an anchor shares less than its gram with what is before
                        members.append((len(text) - 8 if k else max(0, s - 8) if s >= 8 else 0, len(text) - 8, text, left, places))
            group.clear()
            if len(members) >= _MEMBERS:
                flush()

        for text, s, own in LoserTree([_read_run(row) for row in table.to_pylist()]):
            if s < 8 and group:
                close()
            if group and s == len(text) == len(group[-1][0]):
                held = group[-1][2]
            else:
                held = {}
                group.append((text, s, held))
            for left, key, place in own:
                held.setdefault(left, []).append((key, place))
        close()
        flush()
        empty = np.zeros(0, np.int64)
        return spans_table(*(np.concatenate(f) if f else empty for f in found))

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key, start, end) of byte spans made of repeated windows; docs has key and text."""
    spark = docs.sparkSession
    buckets = 8 * shuffle_width(spark)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            anchor = byte_segments(*flat(batch.column(1)), length, gram)[0]
            own, n = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    anchors = docs.mapInArrow(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    # marked: at most (bytes of the corpus) / hot of these
    found, marked = bloom_and_marked(anchors.filter("n > 1").select("anchor", F.col("n") > hot))
    repeated, crowded = spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(marked)

    def candidates(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        data, offsets = flat(batch.column(1))
        anchor, at, first, last = byte_segments(data, offsets, length, gram)
        some = repeated.value.has(anchor)
        text = np.searchsorted(offsets, at[some], side="right") - 1
        return data, offsets, anchor[some], at[some], first[some], last[some], text

    schema = pa.schema([("bucket", pa.int32()), *[(f.split()[0], pa.binary()) for f in _RUN.split(", ")[1:]]])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[bytes, list] = {}
        read = 0
        for batch in gathered(batches, "text", _CHUNK):
            keys = batch.column(0).to_numpy()
            data, offsets, anchor, at, first, last, text = candidates(batch)
            raw = data.tobytes()
            calm = ~np.isin(anchor, crowded.value)
            head = anchor.astype(">u8").tobytes()
            for i in np.flatnonzero(calm).tolist():
                a, f, e = int(at[i]), int(first[i]), int(last[i])
                suffix = head[8 * i : 8 * i + 8] + raw[a : e + length]
                entries.setdefault(suffix, []).append((raw[f:a], int(keys[text[i]]), a - int(offsets[text[i]])))
            read += len(data)
            if read >= _RUN_TEXT and entries:
                yield pa.RecordBatch.from_pylist(_write_runs(sorted(entries.items()), buckets), schema=schema)
                entries, read = {}, 0
        if entries:
            yield pa.RecordBatch.from_pylist(_write_runs(sorted(entries.items()), buckets), schema=schema)

    spans = docs.mapInArrow(sort, _RUN).groupBy("bucket").applyInArrow(_merge(length), "key long, start long, end long")
    if not len(crowded.value):
        return spans

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every window of the crowded anchors: two hashes and its place."""
        for batch in gathered(batches, "text", _CHUNK):
            keys = batch.column(0).to_numpy()
            data, offsets, anchor, at, first, last, text = candidates(batch)
            busy = np.flatnonzero(np.isin(anchor, crowded.value))
            n = last[busy] - first[busy] + 1
            start = np.repeat(first[busy] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            whose = np.repeat(text[busy], n)
            out = []
            for salt in (0, 1):
                sums = np.zeros(len(data) + 1, np.uint64)
                np.cumsum(mix(_TABLE + np.uint64(salt))[data] * powers(len(data)), out=sums[1:])
                out.append(mix((sums[start + length] - sums[start]) * powers(len(data) + 1, pow(_BASE, -1, 1 << 64))[start]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(keys[whose]), pa.array(start - offsets[whose])], names=["h1", "h2", "key", "start"])

    every = keep(docs.mapInArrow(hashed, "h1 long, h2 long, key long, start long"), "crowded")
    twice = keep(every.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2"), "twice")
    return spans.unionByName(every.join(twice, ["h1", "h2"]).select("key", "start", (F.col("start") + length).alias("end")))


def _kept(raw: bytes, spans: list | None) -> tuple[bytes, int, int]:
    """What is left of a text, bytes removed and runs removed."""
    if not spans:
        return raw, 0, 0
    pairs = np.array([(s["start"], s["end"]) for s in spans], np.int64)
    starts, ends = unions(pairs[:, 0], pairs[:, 1])
    at, out = 0, []
    for a, b in zip(starts.tolist(), ends.tolist()):
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]]), int((ends - starts).sum()), len(starts)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Sizes and digest of what is left of every document (see the module)."""
    keyed = keyed_rows(docs, id_col, text_col)
    spans = repeated_spans(keyed.select("key", "text"), length, min(GRAM, length), hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            out = [(len(raw := text.encode()), *_kept(raw, own)) for text, own in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64()),
                 pa.array([hashlib.sha256(x[1]).hexdigest() for x in out], pa.string())],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

    return with_spans(keyed, spans, "key", run, SCHEMA)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated bytes; a character that is cut apart goes whole. All columns kept."""
    mark = "__key"
    keyed = docs.withColumn(mark, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    spans = repeated_spans(keyed.select(F.col(mark).alias("key"), F.coalesce("text", F.lit("")).alias("text")))
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            kept = [None if text is None else text if not own else _kept(text.encode(), own)[0].decode("utf-8", "ignore")
                    for text, own in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if i == at else batch.column(i) for i in range(len(names))], names=names)

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return with_spans(keyed, spans, mark, run, ddl)
