"""N-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct shingles of five words. Two sets link when
their Jaccard similarity is 0.8 or more; the join returns connected components.

The tree. A set's shingles are hashed to ``GROUPS`` groups, and the group counts
are a point. Two sets cannot share more than the sum over groups of the smaller
count, and a set cannot share more with any set in a tree node than the same sum
against the node's largest counts, so a search goes down only where that bound
reaches the overlap that 0.8 asks for. Surviving pairs are verified on the sets
themselves; a search skips what is already in its component.

How sets meet on a cluster, exactly:

1. Each set posts its ``posted`` shingles of least hash. By the prefix rule two
   linked sets share at least 0.16 of their size among these, so a set with
   fewer repeated ones has no link and is done. Shingles are counted inside each
   task first: a shingle posts once per chunk of texts, however many hold it.
2. Sets that are left are reduced to one per distinct set, with its least id.
3. Of the posted shingles each set keeps those of least document frequency (the
   ``HEAVY`` most frequent come last, the rest in hash order), again by the
   prefix rule, so any two linked sets share one of them.
4. Each set goes with its content to the pivot that most of its kept shingles
   name (the least set that holds the shingle). A pivot's sets are searched with
   a tree in blocks of at most about ``BLOCK``, the pivot in each of them.
5. Of the kept shingles whose holders are still in several components, every set
   goes, once, to each pivot that they name. There the tree finds the sets of other
   components, they are verified at once, and only links that join two components
   are told. A pivot's sets are dealt to blocks of about ``BLOCK``; blocks meet in
   twos, but those of its largest component only meet the others.

So groups of near copies are joined through their pivots and never expanded into
all pairs, while no pair is left out unless the bound excludes it or its sets
are in one component already. Shingles are compared as 64-bit hashes.

Defined cases: null and empty texts have the empty set and link with nothing;
with one to four words the whole sequence is the one shingle; rows that repeat
an id count as one document; rows with a null id get a size, no component.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from larder.llm.common import bloom, flat, gathered, keep, mix, release, restored, runs, shuffle_width, span_hashes, transposed, words
from larder.llm.components import components

SHINGLE = 5
GROUPS = 64
HEAVY = 1 << 20
HEAVY_FROM = 4
BLOCK = 512
FANOUT = 32
_CHUNK = 2 << 20


def least_overlap(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Shared shingles that sets of these sizes need: 100 * shared >= 80 * union."""
    return -(-4 * (n + m) // 9)


def posted(n: np.ndarray) -> np.ndarray:
    """Shingles of least hash that a set of size n posts."""
    return n - (4 * n + 4) // 5 + (n + 4) // 5


def shared_posted(n: np.ndarray) -> np.ndarray:
    """Posted shingles that a set of size n has in common with any set it links to, at least."""
    return (4 * n + 24) // 25


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text in ascending order, and offsets (n+1)."""
    starts, ends, first = words(data, offsets)
    w = span_hashes(data, starts, ends, lower=True)
    n = np.diff(first)
    weights = [np.uint64(pow(0xD6E8FEB86659FD93, k, 1 << 64)) for k in range(SHINGLE)]
    own = np.repeat(np.arange(len(n), dtype=np.int64), n)
    parts, whose = [], []
    if len(w) >= SHINGLE:
        m = len(w) - SHINGLE + 1
        whole = own[SHINGLE - 1 :] == own[:m]
        parts.append(mix(sum((w[k : k + m] * weights[k] for k in range(SHINGLE)), np.zeros(m, np.uint64)))[whole])
        whose.append(own[:m][whole])
    for size in range(1, SHINGLE):
        at = first[:-1][n == size]
        parts.append(mix(sum((w[at + k] * weights[k] for k in range(size)), np.full(len(at), size, np.uint64))))
        whose.append(np.flatnonzero(n == size))
    h, who = np.concatenate(parts), np.concatenate(whose)
    order = np.argsort(h)
    h, who = h[order], who[order]
    order = np.argsort(who.astype(np.uint16) if len(n) < 65536 else who, kind="stable")
    h, who = h[order], who[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
    h, who = h[new], who[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(n)))])


_POSTINGS = "bucket int, doc_id long, n int, sig1 long, sig2 long, hits int, hashes binary, ids binary, counts binary"
_FOUND = "part int, ids binary, hits binary, sizes binary, sig1 binary, sig2 binary, tokens binary, dfs binary"
_SIZES = "doc_id long, n int, sig1 long, sig2 long, hits long"


def _post(buckets: int):
    """Rows for every document, and packed postings of each chunk by hash range."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _POSTINGS.split(", ")]
        for batch in gathered(batches, "text", _CHUNK):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            h, first = shingle_sets(*flat(batch.column(1)))
            n = np.diff(first)
            who = np.repeat(np.arange(len(n)), n)
            scrambled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h), dtype=np.uint64)])
            squared = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
            sig1, sig2 = ((s[first[1:]] - s[first[:-1]]).view(np.int64) for s in (scrambled, squared))
            post = np.arange(len(h)) - first[:-1][who] < posted(n)[who]
            t, who = mix(h[post]), who[post]  # scrambled: least hashes would crowd the low ranges
            order = np.argsort(t)
            t, who = t[order], who[order]
            new = np.ones(len(t), bool)
            new[1:] = t[1:] != t[:-1]
            at = np.flatnonzero(new)
            counts = np.diff(np.append(at, len(t)))
            hits = np.bincount(who, np.repeat(counts > 1, counts), minlength=len(n)).astype(np.int32)
            t, one = t[at], ids[who[at]]
            edges = np.searchsorted((t >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            none = pa.nulls(len(n), pa.binary())
            spread = (np.arange(len(n)) % buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(ids), pa.array(n.astype(np.int32)), pa.array(sig1), pa.array(sig2), pa.array(hits), none, none, none], names=names)
            k = len(full)
            cut = [(int(edges[b]), int(edges[b + 1])) for b in full]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full.astype(np.int32)), *[pa.nulls(k, x) for x in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())],
                 pa.array([t[a:b].tobytes() for a, b in cut], pa.binary()),
                 pa.array([transposed(one[a:b]) for a, b in cut], pa.binary()),
                 pa.array([counts[a:b].astype(np.int32).tobytes() for a, b in cut], pa.binary())],
                names=names,
            )

    return run


def _meet(parts: int):
    """One hash range: documents with their own hits, hits told by other chunks, and frequent shingles, packed by document part."""

    def run(table: pa.Table) -> pa.Table:
        release()  # groups follow each other in one worker
        packed = table["hashes"].is_valid()
        docs, rows = table.filter(pa.compute.invert(packed)), table.filter(packed)
        out: list[dict] = []
        for part, own in _parts(docs["doc_id"].to_numpy(), parts):
            columns = {k: docs[c].take(pa.array(own)).to_numpy() for k, c in (("ids", "doc_id"), ("hits", "hits"), ("sizes", "n"), ("sig1", "sig1"), ("sig2", "sig2"))}
            out.append({"part": part, **{k: v.astype(np.int64).tobytes() for k, v in columns.items()}})
        if rows.num_rows:
            t = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["hashes"].to_pylist()])
            ids = np.concatenate([restored(x) for x in rows["ids"].to_pylist()])
            counts = np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"].to_pylist()])
            order = np.argsort(t)
            t, ids, counts = t[order], ids[order], counts[order]
            at = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
            size = np.diff(np.append(at, len(t)))
            told = ids[np.repeat(size > 1, size) & (counts == 1)]  # inside a chunk repeated ones are counted already
            who, hits = np.unique(told, return_counts=True)
            for part, own in _parts(who, parts):
                out.append({"part": part, "ids": who[own].tobytes(), "hits": hits[own].astype(np.int64).tobytes()})
            df = np.add.reduceat(counts, at)
            heavy = np.flatnonzero(df >= HEAVY_FROM)
            if len(heavy):
                out.append({"part": -1, "tokens": t[at][heavy].tobytes(), "dfs": df[heavy].astype(np.int64).tobytes()})
        return pa.Table.from_pylist(out, schema=pa.schema([("part", pa.int32()), *[(f.split()[0], pa.binary()) for f in _FOUND.split(", ")[1:]]]))

    return run


def _parts(ids: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of the ids of each part."""
    part = (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        yield p, order[edges[p] : edges[p + 1]]


def _total(table: pa.Table) -> pa.Table:
    """One part: every document with all its hits."""
    release()
    hold: dict[int, list] = {}
    for row in table.to_pylist():
        ids, hits = (np.frombuffer(row[c], np.int64).tolist() for c in ("ids", "hits"))
        if row["sizes"] is None:
            for doc, n in zip(ids, hits):
                hold.setdefault(doc, [0, 0, 0, 0])[3] += n
        else:
            for doc, n, *own in zip(ids, hits, *(np.frombuffer(row[c], np.int64).tolist() for c in ("sizes", "sig1", "sig2"))):
                have = hold.setdefault(doc, [0, 0, 0, 0])
                have[:3] = max(have[:3], own)
                have[3] += n
    out = list(hold.values())
    columns = [list(hold), *([x[k] for x in out] for k in range(4))]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in _SIZES.split(", ")])


def _heavy(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent posted shingles, HEAVY at most, ascending, and their frequencies."""
    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for token, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(token, np.int64)), pa.array(np.frombuffer(df, np.int64))], names=["token", "df"])

    frequent = found.filter("part = -1").select("tokens", "dfs").mapInArrow(unpack, "token long, df long")
    bands = frequent.groupBy(F.floor(F.log2("df")).alias("band")).count().collect()
    least, total = 63, 0
    for band, n in sorted(((r[0], r[1]) for r in bands), reverse=True):
        if total + n > HEAVY:
            break
        least, total = band, total + n
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = frequent.filter(F.col("df") >= F.lit(1 << least)).select("token", "df").toArrow()
    token, df = rows["token"].to_numpy().view(np.uint64), rows["df"].to_numpy()
    order = np.argsort(token)
    return token[order], df[order]


class CountTree:
    """R-tree over group counts of sets, bulk-loaded by halving along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        parts, done = [np.arange(len(sizes))], []
        while parts:
            own = parts.pop()
            if len(own) <= FANOUT:
                done.append(own)
                continue
            spread = np.append(np.ptp(points[own], axis=0) * 4, np.ptp(sizes[own]))
            axis = int(spread.argmax())
            value = sizes[own] if axis == points.shape[1] else points[own, axis]
            order = own[np.argsort(value, kind="stable")]
            half = max(FANOUT, len(own) // 2 // FANOUT * FANOUT)
            parts += [order[half:], order[:half]]
        self.order = np.concatenate(done)
        self.levels = []
        at = np.concatenate([[0], np.cumsum([len(d) for d in done])])
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        while True:
            top = np.maximum.reduceat(top, at[:-1], axis=0)
            low, high = np.minimum.reduceat(low, at[:-1]), np.maximum.reduceat(high, at[:-1])
            self.levels.append((at, top, low, high))
            if len(top) <= FANOUT:
                break
            at = np.append(np.arange(0, len(top), FANOUT), len(top))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Sets whose bound reaches the overlap that a link with this set needs."""
        nodes = np.arange(len(self.levels[-1][1]))
        for at, top, low, high in reversed(self.levels):
            bound = np.minimum(top[nodes], point).sum(axis=1)
            nodes = nodes[(bound >= least_overlap(size, low[nodes])) & (5 * high[nodes] >= 4 * size) & (4 * low[nodes] <= 5 * size)]
            if not len(nodes):
                return nodes
            count = at[nodes + 1] - at[nodes]
            nodes = np.repeat(at[nodes] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        found = self.order[nodes]
        other = self.sizes[found]
        return found[np.minimum(self.points[found], point).sum(axis=1) >= least_overlap(size, other)]


def counts_of(token: np.ndarray) -> np.ndarray:
    return np.bincount((token & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


class Sets:
    """The sets of one block, each an ascending array, with a shingle's number in the block in place of its hash."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        tokens, self.codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
        self.marked = np.zeros(len(tokens), bool)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Of the other sets, none empty, those with a similarity of 0.8 or more to set i."""
        own = self.codes[self.first[i] : self.first[i + 1]]
        self.marked[own] = True
        out = []
        # some 2^20 shingles are looked up at a time
        ends = np.cumsum(self.sizes[others])
        for part in np.split(others, np.searchsorted(ends, np.arange(1 << 20, int(ends[-1]) if len(ends) else 0, 1 << 20))):
            if not len(part):
                continue
            size = self.sizes[part]
            at = np.concatenate([[0], np.cumsum(size)])
            places = np.repeat(self.first[part] - at[:-1], size) + np.arange(at[-1])
            shared = np.add.reduceat(self.marked[self.codes[places]].astype(np.int64), at[:-1])
            out.append(part[100 * shared >= 80 * (len(own) + size - shared)])
        self.marked[own] = False
        return np.concatenate(out) if out else others[:0]


def joining_links(ids: np.ndarray, component: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of a block (with ``side``: between its two sides) that join two components, given those known before: fewer than sets."""
    held = Sets(sets)
    points = np.array([counts_of(s) for s in sets]).reshape(len(sets), GROUPS)
    tree = CountTree(points, held.sizes)
    label = np.unique(component, return_inverse=True)[1]
    most = np.bincount(label).argmax()
    a, b = [], []
    # searches from all but one component find every link between components
    for i in np.flatnonzero(label != most).tolist():
        if not held.sizes[i]:
            continue
        near = tree.search(points[i], int(held.sizes[i]))
        near = near[(label[near] != label[i]) & (held.sizes[near] > 0)]
        if side is not None:
            near = near[side[near] != side[i]]
        for j in held.linked(i, near).tolist():
            if label[j] != label[i]:
                a.append(ids[i])
                b.append(ids[j])
                label[label == label[j]] = label[i]
    return np.array(a, np.int64), np.array(b, np.int64)


def join_block(ids: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """For every set of a block the least id it reaches by links inside the block."""
    a, b = joining_links(ids, ids, sets)
    least = {}

    def root(x: int) -> int:
        while least.get(x, x) != x:
            x = least[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = sorted((root(x), root(y)))
        least[y] = x
    return np.array([root(x) for x in ids.tolist()], np.int64)


def _blocks_of(sizes: DataFrame, key: str) -> DataFrame:
    return sizes.select(key, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document (see the module)."""
    spark = docs.sparkSession
    cols = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    named = cols.filter(F.col("doc_id").isNotNull())
    buckets = 4 * shuffle_width(spark)

    # 1. posted shingles meet by hash range
    found = keep(named.mapInArrow(_post(buckets), _POSTINGS).groupBy("bucket").applyInArrow(_meet(shuffle_width(spark)), _FOUND), "posted")
    sizes = keep(found.filter("part >= 0").groupBy("part").applyInArrow(_total, _SIZES), "sizes")
    left = sizes.filter((F.col("n") > 0) & (25 * F.col("hits") >= 4 * F.col("n")))
    token, df = _heavy(found)
    heavy = spark.sparkContext.broadcast((token, df))

    # 2. one set for all documents that have it
    classes = keep(left.groupBy("n", "sig1", "sig2").agg(F.min("doc_id").alias("rep")), "classes")
    wanted = spark.sparkContext.broadcast(bloom(classes.select("rep")))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            ids = batch.column(0).to_numpy()
            own = batch.filter(pa.array(wanted.value.has(ids.view(np.uint64))))
            h, first = shingle_sets(*flat(own.column(1)))
            first = first.tolist()
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array([h[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary())], names=["rep", "tokens"])

    sets = named.mapInArrow(read, "rep long, tokens binary").join(classes.select("rep"), "rep", "left_semi")
    sets = keep(sets.dropDuplicates(["rep"]), "sets")

    # 3. shingles that linked sets are sure to share
    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, df = heavy.value
        for batch in batches:
            reps, out, who, size = batch.column(0).to_numpy(), [], [], []
            for rep, raw in zip(reps.tolist(), batch.column(1).to_pylist()):
                own = np.frombuffer(raw, np.uint64)
                n = len(own)
                own = mix(own[: int(posted(n))])
                place = np.minimum(np.searchsorted(token, own), max(len(token) - 1, 0))
                weight = np.where(token[place] == own, df[place], 0) if len(token) else np.zeros(len(own), np.int64)
                own = own[np.lexsort((own, weight))][: len(own) - int(shared_posted(n)) + 1]
                out.append(own)
                who.append(np.full(len(own), rep))
                size.append(np.full(len(own), n, np.int32))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), pa.array(np.concatenate(who)), pa.array(np.concatenate(size))], names=["token", "rep", "n"])

    postings = sets.mapInArrow(kept, "token long, rep long, n int")
    holders = keep(postings.groupBy("token").agg(F.count("*").alias("count"), F.min("rep").alias("pivot")).filter("count > 1"), "holders")
    postings = keep(postings.join(holders, "token"), "postings")

    # 4. each set goes to one pivot
    votes = postings.groupBy("rep", "pivot").agg(F.count("*").alias("votes"))
    chosen = keep(votes.groupBy("rep").agg(F.max_by("pivot", F.struct("votes", -F.col("pivot"))).alias("pivot")), "chosen")
    crowds = keep(_blocks_of(chosen.groupBy("pivot").count(), "pivot"), "crowds")
    member = chosen.filter("rep <> pivot").join(crowds, "pivot").select("rep", "pivot", F.pmod(F.xxhash64("rep"), "blocks").cast("int").alias("block"))
    pivots = crowds.select(F.col("pivot").alias("rep"), "pivot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    routes = keep(member.unionByName(pivots), "routes")
    width = shuffle_width(spark)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["pivot", "block"]):
            ids = block["rep"].to_numpy()
            least = join_block(ids, [np.frombuffer(x, np.uint64) for x in block["tokens"].to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(least)], names=["a", "b"])

    dealt = sets.join(routes, "rep").repartition(width, "pivot", "block").sortWithinPartitions("pivot", "block")
    links = keep(dealt.select("pivot", "block", "rep", "tokens").mapInArrow(search, "a long, b long"), "links")
    joined = keep(components(links), "joined")

    # 5. sets that share a kept shingle but are still apart meet at that shingle's pivot
    apart = postings.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    apart = keep(apart.select("token", "pivot", "rep", "component"), "apart")
    open_tokens = keep(apart.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("token"), "open")
    apart = keep(apart.join(open_tokens, "token").groupBy("pivot", "rep").agg(F.min("component").alias("component")), "meeting")
    held = apart.groupBy("pivot", "component").count()
    main = held.groupBy("pivot").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.max("count").alias("same"), F.sum("count").alias("all"))
    main = main.select("pivot", "main", F.ceil((F.col("all") - F.col("same")) / BLOCK).cast("int").alias("others"), F.ceil(F.col("same") / BLOCK).cast("int").alias("blocks"))
    # sets of the largest component need not meet each other: their blocks meet those of the others only
    inside = F.col("component") == F.col("main")
    place = F.xxhash64("rep")
    dealt = apart.join(keep(main, "main"), "pivot").withColumn("own", F.when(inside, F.col("others") + F.pmod(place, "blocks")).otherwise(F.pmod(place, "others")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(inside, F.col("others")).otherwise(F.col("others") + F.col("blocks")) - 1)))
    dealt = dealt.select("pivot", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "rep", "component", "own")

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["pivot", "low", "high"]):
            ids, component, own, low, high = (block[c].to_numpy() for c in ("rep", "component", "own", "low", "high"))
            side = own == low if low[0] != high[0] else None
            a, b = joining_links(ids, component, [np.frombuffer(x, np.uint64) for x in block["tokens"].to_pylist()], side)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = sets.join(keep(dealt, "across"), "rep").repartition(width, "pivot", "low", "high").sortWithinPartitions("pivot", "low", "high")
    late = keep(dealt.select("pivot", "low", "high", "rep", "component", "own", "tokens").mapInArrow(across, "a long, b long"), "late")
    if late.isEmpty():
        found_components = joined
    else:
        found_components = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late))

    reached = classes.join(found_components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    reached = keep(reached.select("n", "sig1", "sig2", "component"), "reached")
    out = sizes.join(reached, ["n", "sig1", "sig2"], "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))

    def unnamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", _CHUNK):
            n = np.diff(shingle_sets(*flat(batch.column(1)))[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), batch.column(0)], names=["doc_id", "n_shingles", "component_id"])

    return out.unionByName(cols.filter(F.col("doc_id").isNull()).mapInArrow(unnamed, "doc_id long, n_shingles long, component_id long"))
