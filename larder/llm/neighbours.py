"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted by spherical k-means on a bounded sample (``SAMPLE`` rows)
and has at most that many leaves; every row is then dealt to a leaf by walking
down to the nearest centroid. A query walks the tree best bin first: a priority
queue holds unopened nodes by their centroid's cosine, and leaves are visited
until ``visits`` of them are open and hold enough rows for all neighbours. ``visits`` is widened on queries from the
sample until their recall against brute force there reaches ``TARGET``.

Rows of a leaf are packed in blocks of about ``BLOCK`` vectors and its queries
in lots of about ``LOT``, both dealt by a hash of the id, so a leaf that holds a
third of all rows (one very common vector, say) is many blocks on many tasks.
Blocks meet lots in an equality join on the leaf, which Spark may split.

Cosines are taken in double precision on the original vectors, each pair by the
same order of additions, so that equal vectors tie exactly.

Defined cases: vectors that are null, zero, of another length than most
(of lengths equally frequent, the longest counts), or that hold nulls or non-finite numbers take no part, nor do rows
with a null id; rows with the query's id are its own; with fewer candidates all
are returned; no rows give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from larder.llm.common import keep

SAMPLE = 20_000
BRANCH = 12
LEAF = 48
TARGET = 0.985
CALIBRATION = 400
BLOCK = 4096
LOT = 1024
NEAREST = 5


@dataclass
class Tree:
    """Nodes with their centroid (unit length); a node's children, or its leaf number."""

    centroids: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    visits: int = 1

    @property
    def leaves(self) -> int:
        return 1 + max(self.leaf)

    def deal(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of every vector: down to the nearest centroid at each node."""
        out = np.zeros(len(unit), np.int32)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            kids = self.children[node]
            best = (unit[rows] @ self.centroids[kids].T).argmax(axis=1)
            todo += [(kid, rows[best == k]) for k, kid in enumerate(kids) if (best == k).any()]
        return out

    def order(self, unit: np.ndarray, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """Leaves that one query visits, best bin first, until ``visits`` of them and ``least`` rows are open."""
        heap, found, rows = [(-1.0, 0)], [], 0
        near = self.centroids @ unit
        while heap and (len(found) < visits or rows < least):
            _, node = heapq.heappop(heap)
            kids = self.children[node]
            if kids:
                for kid in kids:
                    heapq.heappush(heap, (-float(near[kid]), kid))
            else:
                found.append(self.leaf[node])
                rows += least if sizes is None else int(sizes[self.leaf[node]])
        return found


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Spherical k-means: the cluster of every row."""
    centres = x[rng.choice(len(x), k, replace=False)]
    label = np.zeros(len(x), np.int64)
    for _ in range(8):
        label = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return label


def grow(x: np.ndarray, seed: int = 1) -> Tree:
    """The tree of a sample of unit vectors, with its calibrated number of visits."""
    rng = np.random.default_rng(seed)
    centroids: list[np.ndarray] = []
    tree = Tree(np.zeros((0, x.shape[1])))

    def add(rows: np.ndarray) -> int:
        mean = x[rows].sum(axis=0)
        centroids.append(mean / max(np.linalg.norm(mean), 1e-300))
        tree.children.append([])
        tree.leaf.append(-1)
        return len(centroids) - 1

    todo = [(add(np.arange(len(x))), np.arange(len(x)))]
    leaves = 0
    while todo:
        node, rows = todo.pop()
        label = _means(x[rows], min(BRANCH, len(rows)), rng) if len(rows) > LEAF else np.zeros(len(rows), np.int64)
        groups = [rows[label == k] for k in np.unique(label)]
        if len(groups) == 1:
            tree.leaf[node] = leaves
            leaves += 1
            continue
        for own in groups:
            kid = add(own)
            tree.children[node].append(kid)
            todo.append((kid, own))
    tree.centroids = np.array(centroids)

    dealt = tree.deal(x)
    asked = rng.choice(len(x), min(CALIBRATION, len(x)), replace=False)
    needed = []  # for each true neighbour, how many leaves are open when it is met
    for q in asked:
        near = x @ x[q]
        near[q] = -2
        best = np.argsort(-near, kind="stable")[: min(NEAREST, len(x) - 1)]
        place = {leaf: k + 1 for k, leaf in enumerate(tree.order(x[q], leaves))}
        needed += [place[leaf] for leaf in dealt[best].tolist()]
    tree.visits = int(np.quantile(needed, TARGET, method="higher")) if needed else 1
    return tree


def vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector counts, and these vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.int64), np.zeros((0, dim))
    right = np.flatnonzero(np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float), nan=-1) == dim)
    flat = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(right), dim)
    good = np.isfinite(flat).all(axis=1) & (np.abs(flat).max(axis=1, initial=0) > 0)
    return right[good], flat[good]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def search(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50) -> DataFrame:
    """The NEAREST neighbours of each row whose id is divisible by ``every`` (see the module)."""
    spark = rows.sparkSession
    cols = rows.select(rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("v"))
    cols = cols.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    spin = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = cols.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head()
    if lengths is None:
        return empty
    dim, count = lengths
    cols = cols.filter(F.size("v") == dim)
    share = min(1.0, 1.2 * SAMPLE / max(count, 1))
    taken = cols.withColumn("spin", spin).filter(F.col("spin") <= F.lit(int(share * (1 << 30)))).orderBy("spin", "id").limit(SAMPLE)
    table = taken.select("id", "v").toArrow()
    _, x = vectors(table["v"], dim)
    if not len(x):
        return empty
    tree = grow(_unit(x))
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, v = vectors(batch.column(1), dim)
            if len(at):
                leaf = shared.value.deal(_unit(v))
                packed = v.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), batch.column(0).take(pa.array(at)), pa.array([packed[k : k + 8 * dim] for k in range(0, len(packed), 8 * dim)], pa.binary())],
                    names=["leaf", "id", "v"],
                )

    index = keep(cols.mapInArrow(deal, "leaf int, id long, v binary"), "vectors")
    sizes = {r[0]: r[1] for r in index.groupBy("leaf").count().collect()}  # a row for each leaf of the tree
    crowded = {leaf: -(-n // BLOCK) for leaf, n in sizes.items() if n > BLOCK}
    blocks = F.create_map(*[F.lit(k) for pair in crowded.items() for k in pair])[F.col("leaf")] if crowded else F.lit(None).cast("int")
    salt = F.pmod(F.xxhash64("id"), F.coalesce(blocks, F.lit(1))).cast("int")

    def packs(key: str):
        def pack(table: pa.Table) -> pa.Table:
            data = b"".join(table["v"].to_pylist())
            ids = table["id"].combine_chunks().to_numpy().astype("<i8").tobytes()
            return pa.table({"leaf": table["leaf"].slice(0, 1), f"{key}_ids": pa.array([ids], pa.binary()), f"{key}_vs": pa.array([data], pa.binary())})

        return pack

    held = index.withColumn("salt", salt).groupBy("leaf", "salt").applyInArrow(packs("row"), "leaf int, row_ids binary, row_vs binary")

    rows_of = np.zeros(tree.leaves, np.int64)
    rows_of[list(sizes)] = list(sizes.values())
    leaf_rows = spark.sparkContext.broadcast(rows_of)

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            v = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(-1, dim)
            visits = [own.order(u, own.visits, leaf_rows.value, NEAREST + 1) for u in _unit(v)] if len(v) else []
            each = np.repeat(np.arange(len(visits)), [len(o) for o in visits])
            if len(each):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(visits).astype(np.int32)), batch.column(0).take(pa.array(each)), batch.column(1).take(pa.array(each))], names=["leaf", "id", "v"])

    asked = index.filter(F.pmod("id", F.lit(every)) == 0).select("id", "v")
    # queries of one leaf go in lots; the most a leaf can get is all of them
    lots = max(1, -(-count // every // LOT))
    walked = asked.mapInArrow(walk, "leaf int, id long, v binary").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(lots)).cast("int"))
    asked = walked.groupBy("leaf", "salt").applyInArrow(packs("query"), "leaf int, query_ids binary, query_vs binary")

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, q_ids = np.frombuffer(row["row_ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
                v, q = (np.frombuffer(row[k], np.float64).reshape(-1, dim) for k in ("row_vs", "query_vs"))
                near = _unit(q) @ _unit(v).T
                near[q_ids[:, None] == ids[None, :]] = -np.inf
                k = min(NEAREST, len(ids))
                least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k]
                least = np.where(np.isfinite(least), least - 1e-9, -2.0)
                a, b = np.nonzero(near >= least[:, None])  # all that may be among the k, ties included
                score = _cosines(q[a], v[b])
                best = np.lexsort((ids[b], -score, a))
                first = np.searchsorted(a[best], a[best])
                best = best[np.arange(len(best)) - first < NEAREST]
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[a[best]]), pa.array(ids[b[best]]), pa.array(score[best])], names=["query_id", "vec_id", "score"])

    found = held.join(asked, "leaf").select("row_ids", "row_vs", "query_ids", "query_vs").mapInArrow(meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")
