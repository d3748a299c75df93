"""CSV sources: the three raw files read with an all-string schema.

* no type inference: every column is text and is cast by the cleaning step
  (inference would turn ``Date of Meal`` into a zoned timestamp and shift it);
* doubled quotes and line breaks inside a quoted field are read the way a standard
  CSV reader does; a quote inside an unquoted field is an ordinary character;
* the header row must name the expected columns in their order, else the read
  fails;
* a row that is too short is filled up with missing values, one that is too long
  fails the read, as does a quote that is never closed; blank lines are skipped;
* the usual missing-value tokens become nulls;
* ``_row_order`` records the file order (file, split start, row); staging turns
  it into one long (``number_rows``), so that customer ids by first appearance do
  not depend on Spark's partitioning.

Files are split among tasks also where records hold line breaks. A task cannot
know whether its split begins inside a quoted field, so there are two passes over
the lines. The first finds, for each split, the state in which it ends for either
state it may begin in; chaining these small maps in file order (one row a split
reaches the driver) gives the state at every split's start. The second pass cuts
the lines into records; the pieces of a record that crosses a border, one or two a
split, are brought together by the split in which the record begins.

Records end with ``\\n`` or ``\\r\\n``; a lone ``\\r`` outside quotes fails the read. Compressed
files are one split each. ``multi_line=False`` refuses files in which a line has an
odd number of quotes.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.schemas import INVOICE_CSV_COLUMNS, LEADS_CSV_COLUMNS, SALESTEAM_CSV_COLUMNS
from larder.sources.testdomain import ROW_ORDER, RawSources

# ---------------------------------------------------------------------------
# Text read as a missing value (the pandas ``read_csv`` defaults;
# an empty field is missing too).
# ---------------------------------------------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


_CLOSING = re.compile(r'[^"]*(?:""[^"]*)*"(?!")')
_LINES = "file string, split long, line string"
_PIECES = "file string, split long, row long, owner long, torn boolean, record string"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, given whether it begins in one."""
    at = 0
    if not inside and not line.startswith('"'):
        at = line.find(',"') + 1
        if not at:
            return False
    at += not inside  # behind the opening quote
    while True:
        closing = _CLOSING.match(line, at)
        if closing is None:
            return True
        at = line.find(',"', closing.end()) + 2
        if at == 1:
            return False


def _by_split(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array, dict[int, str]]]:
    """(file, split, lines, the lines with a quote) for each run of lines of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, split, lines = batch.columns
        changed = pc.or_(pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)), pc.not_equal(split.slice(1), split.slice(0, len(split) - 1)))
        edges = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), len(lines)]
        for i, j in zip(edges, edges[1:]):
            own = lines.slice(i, j - i)
            quoted = np.flatnonzero(pc.match_substring(own, '"').to_numpy(zero_copy_only=False))
            yield file[i].as_py(), split[i].as_py(), own, dict(zip(quoted.tolist(), own.take(pa.array(quoted)).to_pylist()))


def _end_states(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its end state for a start outside and inside quotes, and whether a record begins in the latter case."""
    found: dict[tuple[str, int], list[bool]] = {}
    for file, split, lines, quoted in _by_split(batches):
        own = found.setdefault((file, split), [False, True, False])
        own[2] = own[2] or not own[1]
        for at, line in quoted.items():
            own[0], own[1] = ends_inside(line, own[0]), ends_inside(line, own[1])
            own[2] = own[2] or (not own[1] and at + 1 < len(lines))
    if found:
        columns = [[k[0] for k in found], [k[1] for k in found], *([own[j] for own in found.values()] for j in range(3))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["file", "split", "outside", "inside", "begins"])


def _continued(spark: SparkSession, lines: DataFrame, path: str) -> dict[tuple[str, int], int]:
    """For each split that begins inside a record: the split in which that record begins."""
    states = lines.mapInArrow(_end_states, "file string, split long, outside boolean, inside boolean, begins boolean").collect()
    owners: dict[tuple[str, int], int] = {}
    inside, last, owner = False, None, 0
    for r in sorted(states):
        if r.file != last and inside:
            raise ValueError(f"{last}: a quote is never closed")
        if inside:
            owners[r.file, r.split] = owner
            owner = r.split if r.begins else owner
        else:
            owner = r.split
        inside, last = (r.inside if inside else r.outside), r.file
    if inside:
        raise ValueError(f"{last or path}: a quote is never closed")
    return owners


def _cut_records(owners, columns: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines to records. ``row`` counts the records that begin in a split; a torn record comes in pieces, the first of
    which has its row, and all of which name the split in which it begins."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inside, row, owner = ("", 0), False, 0, 0
        held: list[str] = []

        def as_batch(pieces: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            columns_ = zip(*((*place, *p) for p in pieces))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns_, kinds)], names=["file", "split", "row", "owner", "torn", "record"])

        def rest() -> Iterator[pa.RecordBatch]:
            """A record that goes on in the next split, or a piece of one that began before this split."""
            if held:
                yield as_batch([(row if owner == place[1] else None, owner, True, "\n".join(held))])

        for file, split, lines, quoted in _by_split(batches):
            if (file, split) != place:
                yield from rest()
                place, row = (file, split), 0
                held.clear()
                inside = place in owners.value
                owner = owners.value.get(place, split)
            pieces = []
            for k, line in enumerate(lines.to_pylist()):
                held.append(line)
                if k in quoted:
                    inside = ends_inside(line, inside)
                if inside:
                    continue
                record = "\n".join(held)
                held.clear()
                if owner != split:
                    pieces.append((None, owner, True, record))
                    owner = split
                elif record.strip():
                    if split == 0 and row == 0:
                        _check_header(record, columns, file)
                    pieces.append((row, split, False, record))
                    row += 1
            if pieces:
                yield as_batch(pieces)
        yield from rest()

    return run


def _check_header(record: str, columns: list[str], file: str) -> None:
    names = next(csv.reader([record.lstrip("\ufeff").rstrip("\r")]))
    if names != columns:
        raise ValueError(f"{file}: the header names {names}, expected are {columns}")


def scan_csv(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """Read a headered UTF-8 CSV as text columns named ``columns``, split among tasks."""
    text = spark.read.option("lineSep", "\n").text(path)
    if not multi_line:
        odd = text.filter(F.regexp_count("value", F.lit('"')) % 2 == 1).select("value").head(1)
        if odd:
            raise ValueError(f"{path}: a line has an odd number of quotes; records with line breaks need multi_line=True")
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("line"))
    owners = _continued(spark, lines, path)
    pieces = lines.mapInArrow(_cut_records(spark.sparkContext.broadcast(owners), columns), _PIECES)
    # only the pieces of torn records, at most two a split, are brought together
    torn = pieces.filter("torn").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("split", "row", "record"))).alias("p"))
    joined = torn.select("file", F.col("owner").alias("split"), F.col("p")[0]["row"].alias("row"), F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    whole = pieces.filter("NOT torn").select("file", "split", "row", "record")
    records = whole.unionByName(joined) if owners else whole
    data = records.filter("split != 0 OR row != 0")  # without headers
    order = [F.col("file"), F.col("split"), F.col("row")]
    fields = data.select(*order, "record").mapInArrow(_fields(columns), ", ".join(["file string, split long, row long", *(f"`{c}` string" for c in columns)]))
    return fields.select(F.struct(*order).alias(ROW_ORDER), *[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in columns])


def _fields(columns: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records to their fields; short ones are filled up, long ones refused."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            rows = list(csv.reader(batch.column(3).to_pylist()))
            for k, row in enumerate(rows):
                if len(row) > len(columns):
                    raise ValueError(f"{batch.column(0)[k]}: row with too many fields, {len(row)} instead of {len(columns)}")
                row.extend([None] * (len(columns) - len(row)))
            values = zip(*rows) if rows else [[]] * len(columns)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(v, pa.string()) for v in values)], names=["file", "split", "row", *columns])

    return run


def number_rows(df: DataFrame) -> DataFrame:
    """Replace a (file, split, row) order by one long, in the same order.

    ``df`` must be stored (rows keep their numbers when it is read again). Rows of
    a split are consecutive, so a running offset per split, one small row each,
    is all that has to be gathered.
    """
    spark = df.sparkSession
    place = [F.col(f"{ROW_ORDER}.file").alias("_file"), F.col(f"{ROW_ORDER}.split").alias("_split")]
    sizes = df.groupBy(*place).agg(F.count("*").alias("n"), F.min(f"{ROW_ORDER}.row").alias("first")).collect()
    offsets, running = [], 0
    for file, split, n, first in sorted(sizes):
        offsets.append((file, split, running - first))
        running += n
    table = spark.createDataFrame(offsets, "_file string, _split long, _offset long")
    numbered = df.withColumns({"_file": place[0], "_split": place[1]}).join(table, ["_file", "_split"])
    return numbered.select(
        (F.col(f"{ROW_ORDER}.row") + F.col("_offset")).alias(ROW_ORDER), *[c for c in df.columns if c != ROW_ORDER]
    )


def load_csv_sources(
    spark: SparkSession, invoices_path: str, leads_path: str, salesteam_path: str, multi_line: bool = True
) -> RawSources:
    return RawSources(
        invoices=scan_csv(spark, invoices_path, INVOICE_CSV_COLUMNS, multi_line),
        leads=scan_csv(spark, leads_path, LEADS_CSV_COLUMNS, multi_line),
        salesteam=scan_csv(spark, salesteam_path, SALESTEAM_CSV_COLUMNS, multi_line),
    )
