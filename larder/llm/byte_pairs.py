"""Byte-level BPE encoding and decoding on padded numpy matrices.

A text is split into pieces (``pretokens``); each distinct piece of a chunk is
encoded once. Pieces are dealt to matrices by length, rounded up, one piece a
row. In every round each row that still has a mergeable pair merges its
leftmost pair of least rank; the matrix is then compacted by one column. Ranks
of pairs come from an open-addressing hash table over (left id, right id).
Pieces longer than ``LONG_PIECE`` bytes would make the matrices quadratic; they
merge in the same order with a heap over a linked list.

A task remembers the pieces it has encoded, up to ``MEMORY_IDS`` ids; then it
starts anew, and it forgets them at its end. Results do not depend on that.

Defined cases: null and empty texts have no ids; equal texts have equal ids;
rows are independent, so repeated rows and repeated or null ids pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import cut, flat, gathered, span_hashes
from larder.llm.pretokens import pieces

LONG_PIECE = 1024
MEMORY_IDS = 2_000_000
NEVER = np.int32(2**31 - 1)
PAD = 0xFFFF
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def json_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE JSON, where every byte is written as a printable character."""
    with open(path, encoding="utf-8") as f:
        read = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain}
    byte |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"] for t in read.get("added_tokens", [])}
    return {bytes(byte[c] for c in t): i for t, i in read["model"]["vocab"].items() if t not in special}


class BytePairEncoder:
    """Vocabulary of a rank file (base64 token, rank a line) or of a byte-level tokenizer JSON, below 65,535 ids."""

    def __init__(self, path: str):
        self.ranks = json_ranks(path) if path.endswith(".json") else rank_file(path)
        size = max(self.ranks.values()) + 1
        if size >= PAD:
            raise ValueError("ranks must fit 16 bits")
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self._table(tokens)
        self.forget()

    def _table(self, tokens: list[bytes]) -> None:
        keys, values, ranks = [], [], self.ranks
        for rank, token in enumerate(tokens):
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 16 | b)
                    values.append(rank)
        key = np.array(keys, np.uint32)
        value = np.array(values, np.int32)
        self.bits = max(12, int(np.ceil(np.log2(4 * max(len(key), 1)))))
        self.slots = np.full(1 << self.bits, 0xFFFFFFFF, np.uint32)
        self.merged = np.full(1 << self.bits, NEVER, np.int32)
        slot, left, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(left):
            self.probes += 1
            free = left[self.slots[slot[left]] == 0xFFFFFFFF]
            self.slots[slot[free]] = key[free]  # of several, one stays
            stored = free[self.slots[slot[free]] == key[free]]
            self.merged[slot[stored]] = value[stored]
            left = left[self.slots[slot[left]] != key[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NEVER where it has none."""
        key = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        slot = self._slot(key)
        out = np.where(self.slots[slot] == key, self.merged[slot], NEVER)
        rest = np.flatnonzero((self.slots[slot] != key) & (self.slots[slot] != 0xFFFFFFFF))
        for _ in range(self.probes - 1):
            if not len(rest):
                break
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            hit = self.slots[slot[rest]] == key[rest]
            out[rest[hit]] = self.merged[slot[rest[hit]]]
            rest = rest[~hit & (self.slots[slot[rest]] != 0xFFFFFFFF)]
        return out

    def _merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of a padded matrix to its end: flat ids in row order, and ids a row."""
        rows, width = ids.shape
        out = np.full((rows, width), PAD, np.int32)
        live = np.arange(rows)
        rank = np.full((rows, width), NEVER, np.int32)
        if width > 1:
            rank[:, :-1] = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(rows, width - 1)
        while len(live):
            at = rank.argmin(axis=1)
            each = np.arange(len(live))
            best = rank[each, at]
            done = best == NEVER
            if done.any():
                out[live[done], : ids.shape[1]] = ids[done]
                stay = ~done
                live, ids, rank, at, best = live[stay], ids[stay], rank[stay], at[stay], best[stay]
                each = np.arange(len(live))
                if not len(live):
                    break
            ids[each, at] = best
            keep = np.ones(ids.shape, bool)
            keep[each, at + 1] = False
            ids = ids[keep].reshape(len(live), -1)
            rank = rank[keep].reshape(len(live), -1)
            w = ids.shape[1]
            right = np.where(at + 1 < w, ids[each, np.minimum(at + 1, w - 1)], PAD)
            rank[each, at] = self.pair_ranks(best, right)
            inner = np.flatnonzero(at > 0)
            rank[inner, at[inner] - 1] = self.pair_ranks(ids[inner, at[inner] - 1], best[inner])
        used = out != PAD
        return out[used], used.sum(axis=1)

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.pair_ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i) for i, r in enumerate(rank) if r != NEVER]
        heapq.heapify(heap)
        rank.append(int(NEVER))

        def again(i: int) -> None:
            j = after[i]
            rank[i] = int(self.pair_ranks(np.array([ids[i]]), np.array([ids[j]]))[0]) if j < n else int(NEVER)
            if rank[i] != NEVER:
                heapq.heappush(heap, (rank[i], i))

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank[i] != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            again(i)
            if before[i] >= 0:
                again(before[i])
        return [x for x in ids if x >= 0]

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every given piece: flat ids, and offsets (n+1)."""
        sizes = ends - starts
        counts = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        width = np.where(sizes <= 16, sizes + (sizes & 1), 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        padded = np.concatenate([self.single[data], np.full(LONG_PIECE, PAD, np.int32)])
        for w in np.unique(width[sizes <= LONG_PIECE]):
            own = np.flatnonzero((width == w) & (sizes <= LONG_PIECE))
            step = max(1, (1 << 20) // int(w))
            for k in range(0, len(own), step):
                part = own[k : k + step]
                grid = padded[starts[part][:, None] + np.arange(w)]
                grid[np.arange(w) >= sizes[part][:, None]] = PAD
                ids, n = self._merge_rows(grid)
                counts[part] = n
                found.append((part, ids, n))
        for i in np.flatnonzero(sizes > LONG_PIECE):
            ids = np.array(self._merge_long(data[starts[i] : ends[i]].tobytes()), np.int32)
            counts[i] = len(ids)
            found.append((np.array([i]), ids, counts[i : i + 1]))
        at = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(at[-1], np.int32)
        for part, ids, n in found:
            out[spread(at[part], n)] = ids
        return out, at

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.known_ids = np.empty(1 << 16, np.int32)
        self.known_at = np.zeros((1 << 14) + 1, np.int64)

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        have, used = len(self.known), int(self.known_at[len(self.known)])
        while have + len(hashes) + 1 > len(self.known_at):
            self.known_at = np.concatenate([self.known_at, np.zeros(len(self.known_at), np.int64)])
        while used + len(ids) > len(self.known_ids):
            self.known_ids = np.concatenate([self.known_ids, np.empty(len(self.known_ids), np.int32)])
        self.known_ids[used : used + len(ids)] = ids
        self.known_at[have + 1 : have + 1 + len(hashes)] = used + at[1:]
        self.known.update(zip(hashes.tolist(), range(have, have + len(hashes))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every text: flat ids, and offsets (n+1)."""
        starts = pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        code, distinct = pd.factorize(span_hashes(data, starts, ends))
        if self.known_at[len(self.known)] > MEMORY_IDS:
            self.forget()
        row = np.array([self.known.get(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(row < 0)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            ids, at = self.encode_pieces(data, starts[first[new]], ends[first[new]])
            row[new] = len(self.known) + np.arange(len(new))
            self._learn(distinct[new], ids, at)
        row = row[code]
        counts = self.known_at[row + 1] - self.known_at[row]
        out = self.known_ids[spread(self.known_at[row], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        return out, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of every id sequence: flat bytes, and offsets (n+1)."""
        sizes = self.token_at[ids + 1] - self.token_at[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.token_bytes[spread(self.token_at[ids], sizes)], total[offsets]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for counts[0] steps, then the same for the next."""
    at = np.concatenate([[0], np.cumsum(counts)])
    return np.repeat(starts - at[:-1], counts) + np.arange(at[-1])


@lru_cache(maxsize=2)
def encoder(path: str) -> BytePairEncoder:
    """The worker's encoder of a rank file."""
    return BytePairEncoder(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids, and return digests of both (see the module)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in gathered(batches, "text", 2 << 20):
            data, offsets = flat(batch.column(1))
            ids, at = enc.encode(data, offsets)
            raw, back = enc.decode(ids, at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(at)),
                    pa.array([hashlib.sha256(p).hexdigest() for p in cut(ids.astype("<u4").tobytes(), at * 4)], pa.string()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in cut(raw, back)], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        enc.forget()

    cols = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return cols.mapInArrow(run, SCHEMA)
