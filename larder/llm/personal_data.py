"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, validators confirm them (Luhn for card
numbers, mod-97 for IBANs, number ranges for addresses, digit counts), and
context words shortly before a span raise its score. The four base kinds are
always reported; a further kind is reported from ``LEAST_SCORE`` on, which for
``ssn`` takes a context word.

The base expressions are written with possessive repeats and anchored at the
start of a run, which finds the same leftmost non-overlapping matches in linear
time. A span's place comes from running sums over the lengths of the pieces
between matches, and text at a place from the block that holds it, so the work
grows with the text and n log n in its matches.

Defined cases: null and empty texts have no spans; offsets are code points, end
exclusive; rows are independent, so repeated rows and null ids pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Code points before a span in which context words count.
CONTEXT = 40
CONTEXT_GAIN = 0.4
LEAST_SCORE = 0.6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _luhn(match: Column) -> Column:
    def passes(digits: Column) -> Column:
        n = F.length(digits)
        weighed = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substring(digits, n - k, F.lit(1)).cast("int") * (k % 2 + 1))
        total = F.aggregate(weighed, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
        return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)

    return _let(F.regexp_replace(match, "[ -]", ""), passes)


def _mod97(match: Column) -> Column:
    compact = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4)), "")
    value = lambda c: F.when(c.between("A", "Z"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    rest = F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.between("A", "Z"), 100).otherwise(10) + value(c)) % 97)
    return F.length(compact).between(15, 34) & (rest == 1)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: str  # a text without a match of this has none of the kind
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         lambda m: F.lit(True), 0.8, "e-?mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]\\.[0-9]",
         lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"), 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,}+", "[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
         _luhn, 0.8, "card|visa|credit|debit"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]",
         lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15), 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}",
         _mod97, 0.8, "iban|account|bank", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]{2}-[0-9]",
         lambda m: F.lit(True), 0.3, r"\bssn\b|social security", False),
)
#: Code points in a block (as a power of two) of a text that is read at many places.
_BITS = 13
_PLACED = "array<struct<start:int,end:int,match:string>>"
_SCORED = "array<struct<start:int,end:int,score:double>>"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of the first 1, 2, ... values, in steps of doubled width: n log n for n values."""
    def doubled(v: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda w: w < F.size(v))
        return F.aggregate(steps, v, lambda a, w: F.transform(a, lambda x, i: F.when(i >= w, join(x, F.get(a, i - w))).otherwise(x)))

    return _let(values, lambda v: F.when(F.size(v) > 1, doubled(v)).otherwise(v))


def _blocks(text: Column) -> Column:
    """The text in pieces of 2 ** ``_BITS`` code points."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _BITS}}}"), F.lit(0))
    return F.when(F.length(text) > 1 << _BITS, cut).otherwise(F.array(text))


def _part(blocks: Column, at: Column, length: Column) -> Column:
    """``length`` code points from place ``at`` (from 0) on; reads only the blocks that hold them."""
    first = F.shiftright(at, _BITS)
    count = F.shiftright(at + length, _BITS) - first + 1
    return F.substring(F.array_join(F.slice(blocks, first + 1, count), ""), at - F.shiftleft(first, _BITS) + 1, length)


def _spans(text: Column, kind: Kind) -> Column:
    """Valid spans of one kind, in order: start, end, score."""
    none = F.array().cast(_PLACED)

    def place(found: Column) -> Column:
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
        ends = _running(F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda x: F.length(x["gap"]) + F.length(x["match"])), lambda x, y: x + y)
        spans = lambda e: F.transform(
            F.arrays_zip(e.alias("end"), found.alias("match")),
            lambda x: F.struct((x["end"] - F.length(x["match"])).alias("start"), x["end"].alias("end"), x["match"].alias("match")))
        return F.when(F.size(found) > 0, spans(ends)).otherwise(none)

    found = F.when(text.rlike(kind.gate), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    valid = F.filter(_let(found, place), lambda x: kind.valid(x["match"]))

    def score(spans: Column, blocks: Column) -> Column:
        near = lambda x: F.lower(_part(blocks, F.greatest(x["start"] - CONTEXT, F.lit(0)), F.least(x["start"], F.lit(CONTEXT))))
        return F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"),
            F.least(F.lit(1.0), F.lit(kind.score) + F.when(near(x).rlike(kind.context), CONTEXT_GAIN).otherwise(0.0)).alias("score")))

    scored = _let(valid, lambda spans: F.when(F.size(spans) > 0, _let(_blocks(text), lambda blocks: score(spans, blocks))).otherwise(F.array().cast(_SCORED)))
    if not kind.base:
        scored = F.filter(scored, lambda x: x["score"] >= LEAST_SCORE)
    return scored


def find(docs: DataFrame, text_col: str = "text", prefix: str = "pii_") -> DataFrame:
    """``docs`` with one column of spans per kind, named ``prefix`` and the kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select("*", *[_spans(text, k).alias(prefix + k.name) for k in KINDS])


def _listed(kinds: tuple[Kind, ...], prefix: str) -> Column:
    def named(kind: Kind) -> Column:
        return F.transform(F.col(prefix + kind.name), lambda x: F.concat_ws(":", F.lit(kind.name), x["start"], x["end"]))

    parts = [named(k) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest of the base spans, all spans and their scores, for every text."""
    found = find(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    base = tuple(k for k in KINDS if k.base)
    return found.select(
        "doc_id",
        *[F.size(f"pii_{k.name}").cast("long").alias(f"n_{k.name}") for k in base],
        F.sha2(_listed(base, "pii_"), 256).alias("base_sha256"),
        _listed(KINDS, "pii_").alias("spans"),
        F.array_join(F.concat(*[F.transform(F.col(f"pii_{k.name}"), lambda x: F.format_string("%.2f", x["score"])) for k in KINDS]), ",").alias("scores"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in brackets; all columns kept.

    Where spans of two kinds overlap, the earlier (then the longer) one is replaced and the
    rest of the later one goes with it.
    """
    mark = "__pii_"
    found = find(docs, text_col, mark)

    def labelled(kind: Kind) -> Column:
        label = F.lit(f"[{kind.name.upper()}]").alias("label")
        return F.transform(F.col(mark + kind.name), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), label))

    every = F.concat(*[labelled(k) for k in KINDS])
    text = F.col(text_col)

    def replaced(spans: Column, reached: Column, blocks: Column) -> Column:
        """The text before and the label of each span that begins where all earlier ones have ended, then the rest."""
        def piece(x: Column, i: Column) -> Column:
            at = F.coalesce(F.get(reached, i - 1), F.lit(0))
            return F.when(x["start"] >= at, F.concat(_part(blocks, at, x["start"] - at), x["label"])).otherwise("")

        rest = _part(blocks, F.element_at(reached, -1), F.length(text))
        return F.concat(F.array_join(F.transform(spans, piece), ""), rest)

    def clean_of(spans: Column) -> Column:
        reached = _running(F.transform(spans, lambda x: -x["back"]), F.greatest)
        return _let(reached, lambda r: _let(_blocks(text), lambda b: replaced(spans, r, b)))

    clean = _let(F.array_sort(every), clean_of)
    shown = F.when(F.size(every) > 0, clean).otherwise(text)
    return found.select(*[shown.alias(c) if c == text_col else F.col(c) for c in docs.columns])
