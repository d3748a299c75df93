"""Exact window deduplication by prefix-partitioned suffix trees over words.

A word goes if it lies in a window of ``WINDOW`` consecutive words that also
starts in a document with a smaller id. Windows are judged on the input.

Suffixes are split by their prefix into groups that fit a task. A suffix starts
at an anchor (``windows``), its first ``GRAM`` words are the prefix that deals it
out, and prefixes that no two documents share are set aside beforehand with a
Bloom filter of fixed size. For each prefix a compacted suffix tree is built:
suffixes that continue alike stay in one node, and a node branches at the first
word where they differ; branches with a single suffix end there. A node of depth
d is a repeat of d words. The windows that reach d words past the anchor and o
= WINDOW - d before it are repeated where suffixes of the node also have those o
words before them, and their least document keeps them.

A prefix with more than ``HOT`` places is split further by the longest prefix
there is, the whole window: its windows are hashed and reduced to their least
document with partial minima, and joined back.

Defined cases: null and empty texts have no words; fewer than WINDOW words, no
window; rows with equal ids do not outrank each other, so repeated rows stay; a
null id is larger than every other; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import bloom_and_marked, cut, flat, gathered, keep, mix, shuffle_width, span_hashes, words
from larder.llm.windows import HOT, begins, keyed_rows, prefix_hashes, segments, spans_of, spans_table, unions, with_spans

WINDOW = 50
GRAM = 6
_CHUNK = 512 << 10
#: Bytes of text whose equal segments are taken together before they travel.
_DEAL_TEXT = 8 << 20
_WORD = 6  # bytes of a word's hash that travel
_LAST = 2**63 - 1
_GROUP = "bucket int, anchors binary, counts binary, keys binary, docs binary, places binary, lefts binary, rights binary, text binary"
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_segments(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Word hashes, first words of the texts; anchor hash and place, first and last window of every segment."""
    starts, ends, first = words(data, offsets)
    w = span_hashes(data, starts, ends)
    n = len(w)
    none = np.zeros(0, np.int64)
    if n < window:
        return w, first, none.astype(np.uint64), none, none, none
    grams = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        grams += w[k : n - gram + 1 + k] * np.uint64(pow(0xD1342543DE82EF95, k, 1 << 64))
    grams = mix(grams)
    at, begin, last = segments(grams, begins(first, window, n), window - gram + 1)
    return w, first, mix(grams[at]), at, begin, last  # scrambled: least hashes are all small


def _pack(rows: list[tuple[int, bytes, int, int, list]]) -> dict:
    """Columns of one group row: (anchor, words, left, right, places) of each distinct segment."""
    places = [p for r in rows for p in r[4]]
    return {
        "anchors": np.array([r[0] for r in rows], np.uint64).tobytes(),
        "counts": np.array([len(r[4]) for r in rows], "<i4").tobytes(),
        "keys": np.array([p[0] for p in places], "<i8").tobytes(),
        "docs": np.array([p[1] for p in places], "<i8").tobytes(),
        "places": np.array([p[2] for p in places], "<i8").tobytes(),
        "lefts": np.array([r[2] for r in rows], "<i4").tobytes(),
        "rights": np.array([r[3] for r in rows], "<i4").tobytes(),
        "text": b"".join(r[1] for r in rows),
    }


def _unpack(row: dict) -> Iterator[tuple[int, bytes, int, int, list]]:
    anchors = np.frombuffer(row["anchors"], np.uint64).tolist()
    counts, lefts, rights = (np.frombuffer(row[c], "<i4").tolist() for c in ("counts", "lefts", "rights"))
    places = list(zip(*(np.frombuffer(row[c], "<i8").tolist() for c in ("keys", "docs", "places"))))
    at = member = 0
    for anchor, count, left, right in zip(anchors, counts, lefts, rights):
        size = (left + right) * _WORD
        yield anchor, row["text"][at : at + size], left, right, places[member : member + count]
        at += size
        member += count


class SuffixTree:
    """Compacted tree of the suffixes of one prefix, and for each of their windows the least document that has it."""

    def __init__(self, segments: list[tuple[bytes, int, int, list]], window: int, gram: int):
        self.window = window
        self.left = np.array([s[1] for s in segments])
        self.right = np.array([s[2] for s in segments])
        self.docs = np.array([min(p[1] for p in s[3]) for s in segments], np.int64)
        width, depth = int(self.left.max(initial=0)), int(self.right.max(initial=0))
        back = np.zeros((len(segments), width), np.uint64)
        self.ahead = np.full((len(segments), depth), np.uint64(2**64 - 1))
        for i, (text, left, right, _) in enumerate(segments):
            own = np.zeros((left + right, 8), np.uint8)
            own[:, :_WORD] = np.frombuffer(text, np.uint8).reshape(-1, _WORD)
            own = own.view(np.uint64).ravel()
            back[i, :left] = own[:left][::-1]
            self.ahead[i, :right] = own[left:]
        self.before = prefix_hashes(back)
        #: least[i, o]: least document with the window of suffix i that begins o words before the anchor
        self.least = np.repeat(self.docs[:, None], width + 1, axis=1)
        todo = [(np.arange(len(segments)), gram - 1)]
        while todo:
            rows, above = todo.pop()
            alike = (self.ahead[rows] == self.ahead[rows[0]]).all(axis=0)
            below = int(np.append(alike, False)[above + 1 :].argmin()) + above + 1
            self._node(rows, above, below)
            if below < depth:
                following = self.ahead[rows, below]
                order = np.argsort(following, kind="stable")
                edges = np.flatnonzero(np.diff(following[order])) + 1
                todo += [(own, below) for own in np.split(rows[order], edges) if len(own) > 1]

    def _node(self, rows: np.ndarray, above: int, below: int) -> None:
        """Windows that end above + 1 to below words past the anchor, for the suffixes of one node."""
        for o in range(max(0, self.window - below), min(self.window - above - 1, self.least.shape[1] - 1) + 1):
            own = rows[(self.left[rows] >= o) & (self.right[rows] >= self.window - o)]
            if len(own) > 1:
                key = self.before[own, o]
                order = np.lexsort((self.docs[own], key))
                own, key = own[order], key[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                self.least[own, o] = np.repeat(self.docs[own][first], np.diff(np.append(first, len(own))))


def _group(window: int, gram: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        groups: dict[int, dict[tuple[bytes, int], tuple[int, list]]] = {}
        for row in table.to_pylist():
            for anchor, text, left, right, places in _unpack(row):
                groups.setdefault(anchor, {}).setdefault((text, left), (right, []))[1].extend(places)
        keys, starts, ends = [], [], []
        while groups:
            _, own = groups.popitem()
            if sum(len(p) for _, p in own.values()) < 2:
                continue
            group = [(text, left, right, places) for (text, left), (right, places) in own.items()]
            if len(group) == 1:  # every place has the same words around it
                text, left, right, places = group[0]
                least = min(p[1] for p in places)
                for key, doc, place in places:
                    if doc > least:
                        keys.append(key)
                        starts.append(place - left)
                        ends.append(place - (window - right) + window)
                continue
            tree = SuffixTree(group, window, gram)
            offsets = np.arange(tree.least.shape[1])
            for i, (_, left, right, places) in enumerate(group):
                owned = (offsets <= left) & (offsets >= window - right)
                marks = owned & (np.array([p[1] for p in places])[:, None] > tree.least[i])
                for r, a, b in zip(*(x.tolist() for x in spans_of(marks))):
                    keys.append(places[r][0])
                    starts.append(places[r][2] - b)
                    ends.append(places[r][2] - a + window)
        return spans_table(np.array(keys, np.int64), np.array(starts, np.int64), np.array(ends, np.int64))

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key, start, end) of word spans made of windows that a smaller document has; docs has key, doc and text."""
    spark = docs.sparkSession
    buckets = 8 * shuffle_width(spark)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            ids = batch.column(1).to_numpy()
            _, first, anchor, at, _, _ = word_segments(*flat(batch.column(2)), window, gram)
            doc = ids[np.searchsorted(first, at, side="right") - 1] if len(at) else np.zeros(0, np.int64)
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            edge = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
            end = np.append(edge[1:], len(anchor)).astype(np.int64)[: len(edge)]
            yield pa.RecordBatch.from_arrays([pa.array(anchor[edge].view(np.int64)), pa.array(doc[edge]), pa.array(doc[end - 1]), pa.array(end - edge)], names=["anchor", "low", "high", "n"])

    anchors = docs.mapInArrow(count, "anchor long, low long, high long, n long").groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    # marked: at most (words of the corpus) / hot of these
    found, marked = bloom_and_marked(anchors.filter("low < high").select("anchor", F.col("n") > hot))
    shared, crowded = spark.sparkContext.broadcast(found), spark.sparkContext.broadcast(marked)

    def candidates(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        w, texts, anchor, at, first, last = word_segments(*flat(batch.column(2)), window, gram)
        some = shared.value.has(anchor)
        text = np.searchsorted(texts, at[some], side="right") - 1
        return w, texts, anchor[some], at[some], first[some], last[some], text

    schema = pa.schema([("bucket", pa.int32()), *[(f.split()[0], pa.binary()) for f in _GROUP.split(", ")[1:]]])

    def packed(held: dict[tuple, list]) -> pa.RecordBatch:
        out: dict[int, list] = {}
        for (hashed, text, left, right), places in held.items():
            out.setdefault((hashed >> 32) * buckets >> 32, []).append((hashed, text, left, right, places))
        return pa.RecordBatch.from_pylist([{"bucket": b, **_pack(rows)} for b, rows in out.items()], schema=schema)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        read = 0
        for batch in gathered(batches, "text", _CHUNK):
            keys, ids = batch.column(0).to_numpy().tolist(), batch.column(1).to_numpy().tolist()
            w, texts, anchor, at, first, last, text = candidates(batch)
            short = np.ascontiguousarray(w.view(np.uint8).reshape(-1, 8)[:, :_WORD]).tobytes()
            for i in np.flatnonzero(~np.isin(anchor, crowded.value)).tolist():
                a, f, e, t = int(at[i]), int(first[i]), int(last[i]), int(text[i])
                segment = (int(anchor[i]), short[f * _WORD : (e + window) * _WORD], a - f, e + window - a)
                held.setdefault(segment, []).append((keys[t], ids[t], a - int(texts[t])))
            read += batch.column(2).nbytes
            if read >= _DEAL_TEXT and held:
                yield packed(held)
                held, read = {}, 0
        if held:
            yield packed(held)

    spans = docs.mapInArrow(deal, _GROUP).groupBy("bucket").applyInArrow(_group(window, gram), "key long, start long, end long")
    if not len(crowded.value):
        return spans

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every window of the crowded prefixes: two hashes, document and place."""
        for batch in gathered(batches, "text", _CHUNK):
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            w, texts, anchor, at, first, last, text = candidates(batch)
            busy = np.flatnonzero(np.isin(anchor, crowded.value))
            n = last[busy] - first[busy] + 1
            start = np.repeat(first[busy] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            whose = np.repeat(text[busy], n)
            out = []
            for base in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93):
                total = np.zeros(len(start), np.uint64)
                for k in range(window):
                    total += w[start + k] * np.uint64(pow(base, k, 1 << 64))
                out.append(mix(total).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(keys[whose]), pa.array(ids[whose]), pa.array(start - texts[whose])], names=["h1", "h2", "key", "doc", "start"])

    every = keep(docs.mapInArrow(hashed, "h1 long, h2 long, key long, doc long, start long"), "crowded")
    least = keep(every.groupBy("h1", "h2").agg(F.min("doc").alias("least")), "least")
    late = every.join(least, ["h1", "h2"]).filter("doc > least")
    return spans.unionByName(late.select("key", "start", (F.col("start") + window).alias("end")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Word counts and digest of what is left of every document (see the module)."""
    keyed = keyed_rows(docs, id_col, text_col)
    spans = repeated_spans(keyed.select("key", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "text"), window, min(gram, window), hot)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            data, offsets = flat(batch.column(1))
            starts, ends, first = words(data, offsets)
            drop = np.zeros(len(starts), bool)
            for t, own in enumerate(batch.column(3).to_pylist()):
                if own:
                    pairs = np.array([(s["start"], s["end"]) for s in own], np.int64)
                    for a, b in zip(*(x.tolist() for x in unions(pairs[:, 0], pairs[:, 1]))):
                        drop[first[t] + a : first[t] + b] = True
            stay = ~drop
            n = np.diff(np.concatenate([[0], np.cumsum(stay)])[first])
            raw = cut(data, np.stack([starts, ends], axis=1).ravel())[::2] if len(starts) else []
            kept = [x for x, k in zip(raw, stay.tolist()) if k]
            at = np.concatenate([[0], np.cumsum(n)]).tolist()
            digest = [hashlib.sha256(b" ".join(kept[a:b])).hexdigest() for a, b in zip(at, at[1:])]
            total = np.diff(first)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(total - n, pa.int64()), pa.array(digest, pa.string())], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return with_spans(keyed, spans, "key", run, SCHEMA)
