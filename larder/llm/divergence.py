"""Source divergence audit: how far the vocabulary use of a language's sources lies apart.

For each language a ``CountVectorizer`` (``minDF`` documents, greatest integer
vocabulary) is fitted on every document, given as its distinct terms: only these
decide in how many documents a term is. Vectors add up, so what is vectorized are
not the documents one by one, but bags: the terms that a chunk's documents of one
source hold, counted, with the count told in powers of two, so that a bag of
weight w names a term once for w occurrences. The exact sparse vectors are summed
by source, times their weight: one row per source and term that occurs there, so
a source with a third of all rows is pre-aggregated in every task. From the sums
come smoothed integer rates, and from them two parts:

* ``pair``: the distance of every source to every other source of its language,
  over all kept terms;
* ``term``: the ``TOP`` terms that a source uses more than its language does.

Pairs are evaluated from term rows, each the rates of one term in a block of
``BLOCK`` sources; terms that none of the sources has differ by a constant, which
is added by count. All arithmetic is on integers (the vectors hold whole numbers
under 2**53).

A language with fewer than ``minDF`` documents keeps no term and needs no
vectorizer, so the number of fits is at most that of languages with ``minDF``
documents. A vocabulary passes through the driver and is broadcast by Spark's
vectorizer: its size is that of the kept terms of one language.

Defined cases: null text, language and source read as empty; a language without
kept terms has pairs of value 0 and no terms; a language of one source has no
pairs; repeated rows count each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.llm.common import flat, gathered, keep
from larder.session import ensure_checkpoint_dir

MIN_DF = 30
TOP = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Sources that are compared in one matrix.
BLOCK = 64
#: Numbered languages up to which their table is broadcast; more are joined by a shuffle.
BROADCAST_LANGS = 10_000
#: Vector entries that a task sums at once.
_ENTRIES = 1 << 20
#: Greatest vocabulary that the vectorizer accepts.
MAX_VOCABULARY = 2**31 - 1
#: What each byte of a term becomes; 0 for those between terms.
_TERM = np.arange(256, dtype=np.uint8)
_TERM[65:91] += 32
_TERM[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0
#: Bytes of text whose terms are taken at once.
_CHUNK = 2 << 20
#: Terms of a bag.
_BAG = 1024
_CUT = "lang_no int, bag int, source string, weight long, terms array<string>"


def terms(column: pa.Array) -> pa.Array:
    """Runs of letters and characters beyond ASCII of every text, with A-Z lower-cased."""
    data, offsets = flat(column)
    data = _TERM[data]
    inside = data != 0
    new = inside.copy()
    new[1:] &= ~inside[:-1]
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    new &= inside  # begins of terms, also of those at the start of a text
    starts = np.flatnonzero(new)
    data, new = data[inside], new[inside]
    ends = np.append(np.flatnonzero(new), len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, offsets).astype(np.int32)), words)


def _lists(lang_no: pa.Array, bag: int, source: pa.Array, weight: int, offsets: np.ndarray, words: pa.Array) -> pa.RecordBatch:
    n = len(lang_no)
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words)
    columns = [lang_no, pa.array(np.full(n, bag, np.int32)), source, pa.array(np.full(n, weight)), lists]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _CUT.split(", ")])


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (``bag`` 0) as their distinct terms, and bags (1) of what a chunk of them holds."""
    for batch in gathered(batches, "text", _CHUNK):
        lang_no, source = batch.column(0), batch.column(1)
        found = terms(batch.column(2))
        coded = found.flatten().dictionary_encode()
        kinds = max(1, len(coded.dictionary))
        key, n = np.unique(np.repeat(np.arange(len(found)) * kinds, np.diff(found.offsets.to_numpy())) + coded.indices.to_numpy(), return_counts=True)
        at = np.searchsorted(key, np.arange(len(found) + 1) * kinds)
        sizes = np.diff(at)
        term = key - np.repeat(np.arange(len(found)) * kinds, sizes)
        yield _lists(lang_no, 0, source, 1, at, coded.dictionary.take(pa.array(term)))
        named = source.dictionary_encode()
        groups, of = np.unique(lang_no.to_numpy().astype(np.int64) << 32 | named.indices.to_numpy(), return_inverse=True)
        bits = int(n.max(initial=0)).bit_length()
        packed = np.sort((np.repeat(of * kinds, sizes) + term) << bits | n)  # sorted by group and term, counts below
        key = packed >> bits
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))[: len(key)]
        n = np.add.reduceat(packed & (1 << bits) - 1, first) if len(first) else first
        group, term = np.divmod(key[first], kinds)
        for bag in _bags(group, term, n):
            whose = groups[bag[1]]
            yield _lists(pa.array((whose >> 32).astype(np.int32)), 1, named.dictionary.take(pa.array(whose & 0xFFFFFFFF)), bag[0], bag[2], coded.dictionary.take(pa.array(bag[3])))


def _bags(group: np.ndarray, term: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(weight, group of each bag, their offsets, their terms), in which each term's weights add up to its count; sorted by group."""
    for bit in range(int(n.max(initial=0)).bit_length()):
        some = np.flatnonzero(n >> bit & 1)
        if len(some):
            first = np.flatnonzero(np.append(True, group[some][1:] != group[some][:-1]))
            parts = -(-np.diff(np.append(first, len(some))) // _BAG)
            at = np.repeat(first - _BAG * (np.cumsum(parts) - parts), parts) + _BAG * np.arange(parts.sum())
            yield 1 << bit, group[some][at], np.append(at, len(some)), term[some]


def rate(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), exactly."""
    over = (count + F.lit(PRIOR)).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    under = (total + F.lit(PRIOR) * kept).cast("decimal(29,0)")
    return F.lit(1) + F.call_function("div", over.cast("decimal(29,0)"), under)


def _stored(docs: DataFrame, min_df: int) -> tuple[str, list[tuple[int, str]], DataFrame]:
    """(folder of documents and bags by language number, numbered languages, all groups)."""
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    groups = keep(read.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")), "divergence-groups")
    sizes = groups.groupBy("lang").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= min_df)
    langs = sorted(r.lang for r in sizes.collect())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/divergence-terms-{uuid.uuid4().hex}"
    numbers = list(enumerate(langs))
    named = spark.createDataFrame(numbers, "lang_no int, lang string")

    texts = read.join(F.broadcast(named) if len(numbers) <= BROADCAST_LANGS else named, "lang").select("lang_no", "source", "text")
    texts.mapInArrow(_cut, _CUT).write.partitionBy("lang_no", "bag").option("compression", "zstd").parquet(path)
    return path, numbers, groups


def _vectorized(path: str, number: int, docs: DataFrame, min_df: int) -> tuple[list[str], DataFrame]:
    """(kept terms in vector order, (source, at, n): occurrences of kept terms by source)."""
    spark = docs.sparkSession
    own = docs.filter((F.col("lang_no") == number) & (F.col("bag") == 0)).select("terms")
    bags = docs.filter((F.col("lang_no") == number) & (F.col("bag") == 1)).select("source", "weight", "terms")
    # a term of its own kind in min_df documents, since a vectorizer without any term is refused
    mark = spark.range(min_df).select(F.array(F.lit("")).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(min_df), vocabSize=MAX_VOCABULARY).fit(own.unionAll(mark))
    vector = F.unwrap_udt("counts")
    entries = model.transform(bags).select("source", vector["indices"].alias("at"), vector["values"].alias("n"), "weight")
    sums = entries.mapInArrow(_vector_sums, "source string, at int, n long").groupBy("source", "at").agg(F.sum("n").alias("n"))
    return model.vocabulary, sums


def _vector_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences by source and term of the vectors of a task, times their weight if they have one, summed about ``_ENTRIES`` at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        if size:
            table = pa.Table.from_batches(held).combine_chunks()
            source = table["source"].combine_chunks().dictionary_encode()
            at = table["at"].combine_chunks()
            places, values = at.flatten().to_numpy().astype(np.int64), table["n"].combine_chunks().flatten().to_numpy()
            sizes = np.diff(at.offsets.to_numpy())
            whose = np.repeat(source.indices.to_numpy().astype(np.int64), sizes)
            if "weight" in table.column_names:
                values = values * np.repeat(table["weight"].to_numpy(), sizes)
            key, place = np.unique(whose << 32 | places, return_inverse=True)
            n = np.bincount(place, values).astype(np.int64)
            yield pa.RecordBatch.from_arrays([source.dictionary.take(pa.array(key >> 32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], names=["source", "at", "n"])

    for batch in batches:
        held.append(batch)
        size += len(batch.column(1).flatten())
        if size >= _ENTRIES:
            yield from rows()
            held, size = [], 0
    yield from rows()


def _summed(docs: DataFrame, min_df: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups with their totals, term sums by group, kept terms), as stored tables."""
    spark = docs.sparkSession
    path, numbers, groups = _stored(docs, min_df)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/divergence-{uuid.uuid4().hex}"
    sums_schema, vocabulary_schema = "source string, at int, n long", "at int, term string"
    tokens = spark.read.schema(_CUT).parquet(path) if numbers else None
    sizes = []
    for number, lang in numbers:
        vocabulary, sums = _vectorized(path, number, tokens, min_df)
        sums.write.option("compression", "zstd").parquet(f"{folder}/sums/lang_no={number}")
        places = [(k, t) for k, t in enumerate(vocabulary) if t]
        table = pa.table({"at": pa.array([k for k, _ in places], pa.int32()), "term": pa.array([t for _, t in places], pa.string())})
        frame = spark.createDataFrame(table) if places else spark.createDataFrame([], vocabulary_schema)
        frame.write.option("compression", "zstd").parquet(f"{folder}/terms/lang_no={number}")
        sizes.append((number, lang, len(places)))
    if not numbers:
        sums = spark.createDataFrame([], f"{sums_schema}, lang_no int")
        vocabulary = spark.createDataFrame([], f"{vocabulary_schema}, lang_no int")
    else:
        sums = spark.read.schema(f"{sums_schema}, lang_no int").parquet(f"{folder}/sums")
        vocabulary = spark.read.schema(f"{vocabulary_schema}, lang_no int").parquet(f"{folder}/terms")
    known = spark.createDataFrame(sizes, "lang_no int, lang string, kept long")
    totals = sums.groupBy("lang_no", "source").agg(F.sum("n").alias("total"))
    by_lang = Window.partitionBy("lang").orderBy("source")
    own = (
        groups.select("lang", "source")
        .join(known, "lang", "left")
        .join(totals, ["lang_no", "source"], "left")
        .select(
            "lang", "source", "lang_no",
            F.coalesce("kept", F.lit(0)).cast("long").alias("kept"),
            F.coalesce("total", F.lit(0)).cast("long").alias("total"),
            (F.row_number().over(by_lang) - 1).alias("no"),
            F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("sources"),
        )
    )
    return keep(own, "divergence-own"), sums, vocabulary


def _rates(own: DataFrame, sums: DataFrame) -> DataFrame:
    """(lang_no, lang, source, no, sources, kept, at, n, p) of every term that occurs in a group."""
    return sums.join(own, ["lang_no", "source"]).withColumn("p", rate(F.col("n"), F.col("total"), F.col("kept")))


def _term_part(own: DataFrame, sums: DataFrame, vocabulary: DataFrame, rates: DataFrame, top: int) -> DataFrame:
    whole = own.filter("lang_no IS NOT NULL").groupBy("lang_no").agg(F.sum("total").alias("whole"), F.max("kept").alias("of"))
    q = (
        sums.groupBy("lang_no", "at").agg(F.sum("n").alias("all"))
        .join(whole, "lang_no")
        .join(vocabulary, ["lang_no", "at"])
        .select("lang_no", "at", "term", rate(F.col("all"), F.col("whole"), F.col("of")).alias("q"))
    )
    above = rates.join(q, ["lang_no", "at"]).filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(above, "term").filter(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _matrix_sums(block: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of |p - q| over the terms of a task, one row per pair of source blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            if held:
                keys = list(held)
                columns = [pa.array([k[j] for k in keys], pa.int32()) for j in range(3)]
                matrices = pa.array([held[k][0].ravel() for k in keys], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*columns, matrices, pa.array([held[k][1] for k in keys], pa.int64())], names=["lang_no", "a", "b", "sums", "terms"])
                held.clear()

        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            key = np.stack([get(c).to_numpy().astype(np.int64) for c in ("lang_no", "a", "b")], axis=1)
            order = np.lexsort(key.T[::-1])
            edges = np.flatnonzero(np.append(True, (key[order][1:] != key[order][:-1]).any(axis=1))) if len(order) else []
            for i, j in zip(edges, [*edges[1:], len(order)]):
                some = pa.array(order[i:j])
                entries, base = get("entries").take(some), get("base")[int(order[i])].as_py()
                a, b = int(key[order[i], 1]), int(key[order[i], 2])
                left = min(block, len(base)) if a != b else len(base)
                grid = np.tile(np.array(base, np.int64), (j - i, 1))
                inner = entries.flatten()
                grid[np.repeat(np.arange(j - i), np.diff(entries.offsets.to_numpy())), inner.field("slot").to_numpy()] = inner.field("p").to_numpy()
                right = slice(0, left) if a == b else slice(left, None)
                found = np.stack([np.abs(grid[:, k : k + 1] - grid[:, right]).sum(axis=0) for k in range(left)])
                own = held.setdefault(tuple(key[order[i]].tolist()), [np.zeros_like(found), 0])
                own[0] += found
                own[1] += int(j - i)
            if len(held) > 256:
                yield from rows()
        yield from rows()

    return run


def _pair_part(own: DataFrame, rates: DataFrame, size: int) -> DataFrame:
    sources = own.select("lang", "source", "lang_no", "no", "sources", "kept", F.when(F.col("kept") > 0, rate(F.lit(0), F.col("total"), F.col("kept"))).otherwise(0).alias("z"))
    block = F.floor(F.col("no") / size).cast("int")
    blocks = F.ceil(F.col("sources") / size).cast("int")

    def met(rows: DataFrame) -> DataFrame:
        """Every row for each pair (a, b), a <= b, of blocks that its own is in; ``slot`` is its column there."""
        other = rows.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        a, b = F.least("own", "other"), F.greatest("own", "other")
        slot = F.col("no") % size + F.when(F.col("own") > a, size).otherwise(0)
        return other.withColumns({"a": a, "b": b, "slot": slot.cast("int")})

    base = met(sources.filter("kept > 0")).groupBy("lang_no", "a", "b").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "z"))), lambda s: s["z"]).alias("base"))
    rows = met(rates).groupBy("lang_no", "a", "b", "at").agg(F.collect_list(F.struct("slot", "p")).alias("entries"))
    partial = rows.join(base, ["lang_no", "a", "b"]).select("lang_no", "a", "b", "entries", "base").mapInArrow(_matrix_sums(size), "lang_no int, a int, b int, sums array<long>, terms long")
    # block matrix -> (left number, right number)
    sized = own.filter("kept > 0").select("lang_no", "sources").distinct()
    wide = F.least(F.lit(size), F.col("sources") - F.col("b") * size)
    cells = (
        partial.join(sized, "lang_no")
        .select("lang_no", "a", "b", "terms", wide.alias("wide"), F.posexplode("sums").alias("cell", "f"))
        .select("lang_no", "terms", "f", (F.col("a") * size + F.floor(F.col("cell") / F.col("wide"))).cast("int").alias("x"), (F.col("b") * size + F.col("cell") % F.col("wide")).cast("int").alias("y"))
        .filter("x < y")
        .groupBy("lang_no", "x", "y").agg(F.sum("f").alias("f"), F.sum("terms").alias("terms"))
    )
    left = sources.select("lang", "lang_no", "kept", F.col("source").alias("s1"), F.col("no").alias("x"), F.col("z").alias("z1"))
    right = sources.select("lang", F.col("source").alias("s2"), F.col("no").alias("y"), F.col("z").alias("z2"))
    pairs = left.join(right, "lang").filter("x < y").join(cells, ["lang_no", "x", "y"], "left")
    # the terms that no source of the two blocks has
    rest = (F.col("kept") - F.coalesce("terms", F.lit(0))) * F.abs(F.col("z1") - F.col("z2"))
    value = (F.coalesce("f", F.lit(0)) + rest).alias("value")
    both = F.explode(F.array(F.struct(F.col("s1").alias("source"), F.col("s2").alias("item")), F.struct(F.col("s2").alias("source"), F.col("s1").alias("item")))).alias("e")
    return _ranked(pairs.select("lang", both, value).select("lang", "e.*", "value"), "pair")


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts."""
    own, sums, vocabulary = _summed(docs, min_df)
    rates = _rates(own, sums)
    return _pair_part(own, rates, block).unionByName(_term_part(own, sums, vocabulary, rates, top))


ORACLE_SQL = r"""
WITH docs AS (
    SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row_no FROM documents
),
tokens AS (
    SELECT lang, source, row_no,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT row_no) >= 30),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
occurring AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n
    FROM occurring g JOIN kept k USING (lang) LEFT JOIN found f ON (f.lang, f.source, f.term) = (g.lang, g.source, k.term)
),
rates AS (
    SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS BIGINT) AS p
    FROM grid JOIN sizes USING (lang)
),
whole AS (
    SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS BIGINT) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM grid GROUP BY ALL) JOIN sizes USING (lang)
),
distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
    FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON (d.lang, d.source, d.item) = (a.lang, a.source, b.source)
),
above AS (
    SELECT r.lang, r.source, r.term AS item, r.p - w.q AS value FROM rates r JOIN whole w USING (lang, term) WHERE r.n > 0 AND r.p > w.q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL
SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
        CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM above
) WHERE rank <= 50
"""
