"""Spelling variant grouping: every word's most likely intended form.

Two words are near if one inserted, deleted or replaced code point makes one the
other. Near pairs are found by asymmetric chunks. The shorter word (of two equally
long ones, either) contributes its two disjoint halves; the longer one contributes
its positional grams of those lengths, at the places to which one edit can move a
half (by at most one). One edit leaves one half whole, so the pair meets in it. The
part that holds the edit is halved in the same way, and one of its halves is whole
too, so the key of the join holds three quarters of the word: no frequent beginning
or ending gathers all its words in one group. A pair is taken at the first key at
which it meets, and verified there: behind its first difference all must be equal.

A word's form is its near word that occurs most often, if that is ``FACTOR`` times
as often as the word itself. Forms of forms are followed by doubling: since every
step multiplies the count by ``FACTOR``, the number of rounds is known from the
greatest count.

Defined cases: a null text has no words, and a null id stands for no characters in
the checksum that picks a run; repeated rows count each; a table without enough
words gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from larder.llm.common import keep

FEWEST_CHARS = 6
LEAST_COUNT = 5
FACTOR = 5
#: One run in so many, by its checksum, loses a code point.
EVERY = 199
_BETWEEN = "[^A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct results of enough code points and occurrences."""
    # split is linear in the text; extracting all matches copies it for each of them
    runs = F.split(F.translate("text", _UPPER, _LOWER), _BETWEEN)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    # a shorter run can only become a shorter word
    rows = rows.filter(F.length("run") >= FEWEST_CHARS)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(h % EVERY == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= FEWEST_CHARS).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _cut(word: Column, start: Column, size: Column) -> Column:
    return F.substring(word, (start + 1).cast("int"), size.cast("int"))


def _keys(word: Column, length: Column, shift: Column) -> Column:
    """Keys at which a word meets those of ``length`` code points; it has ``shift`` more itself.

    Of the halves of ``length``, one is kept and the other holds the edit; the
    latter has a half of its own that is kept. Code points behind the edit are
    moved by ``shift``.
    """
    half = F.floor(length / 2)
    keys = []
    for kept in (0, 1):
        whole = _cut(word, F.lit(0), half) if kept == 0 else _cut(word, half + shift, length - half)
        start, size = (half, length - half) if kept == 0 else (F.lit(0), half)
        quarter = F.floor(size / 2)
        for inner in (0, 1):
            part = _cut(word, start, quarter) if inner == 0 else _cut(word, start + quarter + shift, size - quarter)
            keys.append(F.struct(
                (length * 4 + 2 * kept + inner).cast("int").alias("place"),
                F.concat_ws(" ", whole, part).alias("gram"),
            ))
    return F.array(*keys)


def _first_meeting(x: Column, y: Column, place: Column, shift: Column) -> Column:
    """Whether no earlier key of the pair is equal as well."""
    length, kept, inner = F.floor(place / 4), F.floor(place % 4 / 2), place % 2
    half = F.floor(length / 2)
    start, size = F.when(kept == 0, half).otherwise(0), F.when(kept == 0, length - half).otherwise(half)
    quarter = F.floor(size / 2)
    halves_differ = _cut(x, F.lit(0), half) != _cut(y, F.lit(0), half)
    quarters_differ = _cut(x, start, quarter) != _cut(y, start, quarter)
    return ((kept == 0) | halves_differ) & ((inner == 0) | quarters_differ)


def _one_edit(x: Column, y: Column, shift: Column) -> Column:
    """Whether what follows the first difference is equal; time is linear in the word."""
    at = F.array_position(F.zip_with(F.split(x, ""), F.split(y, ""), lambda a, b: ~a.eqNullSafe(b)), True).cast("int")
    return F.substring(x, at + 1 - shift, F.length(x)) == F.substring(y, at + 1, F.length(y))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of near words, in both directions."""
    length = F.length("word")
    chunks = words.select("word", "n", F.explode(_keys(F.col("word"), length, F.lit(0))).alias("k")).select("k.*", F.col("word").alias("x"), F.col("n").alias("xn"))
    shorter = F.when(length > FEWEST_CHARS, _keys(F.col("word"), length - 1, F.lit(1))).otherwise(F.array())
    grams = words.select("word", "n", F.explode(F.concat(_keys(F.col("word"), length, F.lit(0)), shorter)).alias("k")).select("k.*", F.col("word").alias("y"), F.col("n").alias("yn"))
    shift = F.length("y") - F.length("x")
    met = chunks.join(grams, ["place", "gram"]).filter(F.col("x") != F.col("y"))
    pairs = met.filter(_first_meeting(F.col("x"), F.col("y"), F.col("place"), shift)).filter(_one_edit(F.col("x"), F.col("y"), shift))
    there = F.struct(F.col("x").alias("word"), F.col("xn").alias("n"), F.col("y").alias("near"), F.col("yn").alias("near_n"))
    back = F.struct(F.col("y").alias("word"), F.col("yn").alias("n"), F.col("x").alias("near"), F.col("xn").alias("near_n"))
    # equally long words meet from both sides
    return pairs.select(F.explode(F.when(shift == 0, F.array(there)).otherwise(F.array(there, back))).alias("p")).select("p.*")


def _roots(forms: DataFrame, greatest: int) -> DataFrame:
    """(word, root) of words with a form, by following twice as many steps each round."""
    steps = math.ceil(math.log(max(greatest, FACTOR), FACTOR)) + 1
    top = keep(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(math.ceil(math.log2(steps))):
        beyond = top.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        top = keep(top.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
    return top


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = keep(counted_words(docs), "spelling-words")
    # frequent first, then in code-point order (that of the UTF-8 bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    often = -F.col("best.less") >= FACTOR * F.col("n")
    table = keep(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(often, F.col("best.near")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    greatest = table.agg(F.max("n")).first()[0] or 0
    roots = _roots(table.filter("form IS NOT NULL"), greatest)
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# crc32 byte by byte, its table from the reversed polynomial 0xEDB88320; near words by their deletions
ORACLE_SQL = r"""
WITH RECURSIVE polynomial(byte, round, c) AS (
    SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT byte, round + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM polynomial WHERE round < 8
),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM polynomial WHERE round = 8),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
),
distinct_runs AS (SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY id, run),
hashed AS (
    SELECT run, n, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
    FROM distinct_runs, crc_table
),
results AS (
    SELECT n, CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word FROM hashed
),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
deletions AS (
    SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS less FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)
),
near AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM deletions a JOIN deletions b ON a.k = b.k AND a.less = b.less AND a.word <> b.word
    UNION
    SELECT a.word, a.n, b.word, b.n FROM deletions a JOIN words b ON a.less = b.word
    UNION
    SELECT b.word, b.n, a.word, a.n FROM deletions a JOIN words b ON a.less = b.word
),
best AS (SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS b FROM near GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * w.n THEN b.near END AS form, CASE WHEN -b.less >= 5 * w.n THEN -b.less END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
steps(word, root) AS (
    SELECT word, word FROM forms
    UNION ALL
    SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL
),
last AS (SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)
"""
