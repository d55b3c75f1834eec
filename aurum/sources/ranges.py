"""Text files read in byte ranges: dense record numbers and quoted line feeds.

Spark cuts a text file into splits at line feeds and reads them in parallel.  Two things
about a line then depend on what lies before its split: its number in the file, and --
in delimited text with quoted line feeds -- whether it starts inside a quoted cell.  Both
are solved in two passes.  Pass one boils every split down to one row; a window over the
splits of a file (bytes / split size rows) says what each split starts with; pass two
reads the lines again with that knowledge.  Neither pass sorts or shuffles the text, and the
results do not depend on how the file was cut or on which task was retried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.session import materialize

#: One row per split: so many may be broadcast to the second pass (128 MB each: 32 TB of text).
SPLITS = 250_000
#: Splits of more rows are joined by a shuffle and put in order again.
_KEY = ["_file", "_block"]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_file, _block, _at, _raw): physical lines; ``_at`` rises within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"), F.col("value").alias("_raw"))


def _with_splits(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with their split's columns, in the order of the file."""
    if splits.limit(SPLITS + 1).count() <= SPLITS:
        return lines.join(F.broadcast(splits), _KEY)
    return lines.join(splits, _KEY).sortWithinPartitions(*_KEY, "_at")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(_file, _line_no, _raw): every line with its number in its file, 0, 1, 2, ...

    ``_file`` is the whole path.  Built-in functions only: the lines of a split are counted in
    pass one, numbered from the sum of the splits before in pass two."""
    lines = _lines(spark, path)
    splits = lines.groupBy(*_KEY).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits.select(*_KEY, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return _with_splits(lines, splits).select("_file", (F.col("_at") - F.col("_first") + F.col("_before")).alias("_line_no"), "_raw")


# ------------------------------------------------------ quoted line feeds
class Quotes:
    """Where a line of delimited text leaves a reader: inside a quoted cell or not.

    A cell is quoted when a quote is its first character; it ends at a quote before a
    delimiter or the line's end.  Doubled quotes are text, and so are quotes within an
    unquoted cell."""

    def __init__(self, delimiter: str):
        d = re.escape(delimiter)
        self.open = re.compile(f'(?:^|(?<={d}))"')
        self.close = re.compile(f'(?:[^"]|"")*"(?={d}|\\r?$)')

    def inside_after(self, line: str, inside: bool) -> bool:
        at = 0
        while True:
            if not inside:
                m = self.open.search(line, at)
                if m is None:
                    return False
                at = m.end()
            m = self.close.match(line, at)
            if m is None:
                return True
            at, inside = m.end(), False


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Pieces of a batch that belong to one split."""
    files, blocks = batch.column("_file").to_pylist(), batch.column("_block").to_pylist()
    lo = 0
    for i in range(1, len(files) + 1):
        if i == len(files) or files[i] != files[lo] or blocks[i] != blocks[lo]:
            yield files[lo], blocks[lo], batch.slice(lo, i - lo)
            lo = i


def _quoted_lines(piece: pa.RecordBatch) -> list[tuple[int, str]]:
    """(place, text) of the lines that hold a quote; no other line changes anything."""
    raw = piece.column("_raw")
    at = np.flatnonzero(pc.match_substring(raw, '"').to_numpy(zero_copy_only=False))
    return list(zip(at.tolist(), raw.take(pa.array(at)).to_pylist()))


_EFFECT = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("to0", pa.bool_()), ("to1", pa.bool_()),
                     ("n0", pa.int64()), ("n1", pa.int64())])


def _effects(delimiter: str):
    """Pass one: per split, from outside (0) and from inside (1) a quoted cell, where it
    ends and how many records start in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, key, state, starts = Quotes(delimiter), None, [False, True], [0, 0]

        def row() -> pa.RecordBatch:
            return pa.record_batch([pa.array([x], f.type) for x, f in zip((*key, *state, *starts), _EFFECT)], schema=_EFFECT)
        for batch in batches:
            for file, block, piece in _runs(batch):
                if (file, block) != key:
                    if key:
                        yield row()
                    key, state, starts = (file, block), [False, True], [0, 0]
                at = 0
                for i, line in _quoted_lines(piece):
                    for k in (0, 1):
                        starts[k] += 0 if state[k] else i + 1 - at
                    after = {s: quotes.inside_after(line, s) for s in set(state)}
                    state = [after[s] for s in state]
                    at = i + 1
                for k in (0, 1):
                    starts[k] += 0 if state[k] else len(piece) - at
        if key:
            yield row()
    return run


_PIECE = pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("kind", pa.int8()), ("_record_no", pa.int64()), ("_raw", pa.string())])
_PIECE_SQL = "_file string, _block bigint, kind tinyint, _record_no bigint, _raw string"
WHOLE, LEAD, OPEN = 0, 1, 2


def _records(delimiter: str):
    """Pass two: records that lie in one split, and the pieces of those that do not: the
    lines that finish a record of an earlier split (LEAD), the record that the split leaves open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, key, inside, number, lead, parts = Quotes(delimiter), None, False, 0, False, []

        def made(kinds, numbers, raws) -> pa.RecordBatch:
            n = len(raws)
            return pa.record_batch([pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                                    pa.array(kinds, pa.int8()), pa.array(numbers, pa.int64()), pa.array(raws, pa.string())], schema=_PIECE)

        def left() -> Iterator[pa.RecordBatch]:
            if parts:
                yield made([LEAD if lead else OPEN], [number], ["\n".join(parts)])
        for batch in batches:
            for file, block, piece in _runs(batch):
                if (file, block) != key:
                    yield from left()
                    key, parts = (file, block), []
                    inside = lead = piece.column("_inside")[0].as_py()
                    number = piece.column("_first_no")[0].as_py()
                raw, at = piece.column("_raw"), 0
                kinds, numbers, raws = [], [], []

                def plain(lo: int, hi: int) -> None:
                    """Lines without a quote: records outside a quoted cell, text inside one."""
                    nonlocal number
                    if inside:
                        parts.extend(raw.slice(lo, hi - lo).to_pylist())
                    else:
                        kinds.extend([WHOLE] * (hi - lo))
                        numbers.extend(range(number, number + hi - lo))
                        raws.extend(raw.slice(lo, hi - lo).to_pylist())
                        number += hi - lo
                for i, line in _quoted_lines(piece):
                    plain(at, i)
                    at = i + 1
                    parts.append(line)
                    inside = quotes.inside_after(line, inside)
                    if not inside:
                        kinds.append(LEAD if lead else WHOLE)
                        numbers.append(number)
                        raws.append("\n".join(parts))
                        number += 0 if lead else 1
                        parts, lead = [], False
                plain(at, len(piece))
                if raws:
                    yield made(kinds, numbers, raws)
        yield from left()
    return run


def _start_states(effects: DataFrame) -> DataFrame:
    """(_file, _block, _inside, _first_no): what every split starts with.

    A split keeps the state, turns it round, or ends in one whatever it starts with; so the
    state before a split is where the last of the latter ended, turned by those since."""
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sure = F.col("to0") == F.col("to1")
    turns = F.coalesce(F.sum(F.when(F.col("to0") & ~F.col("to1"), 1).otherwise(0)).over(
        Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    e = effects.withColumn("turns", turns)
    fixed = F.last(F.when(sure, F.struct(F.col("to0").cast("int").alias("to"), "turns")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.last("turns").over(before), F.lit(0))
    inside = F.coalesce(fixed["to"], F.lit(0)) + so_far - F.coalesce(fixed["turns"], F.lit(0))
    e = e.withColumn("_inside", inside % 2 == 1)
    return e.select(*_KEY, "_inside", F.coalesce(F.sum(F.when(F.col("_inside"), F.col("n1")).otherwise(F.col("n0"))).over(before),
                                                 F.lit(0)).alias("_first_no"))


def quoted_records(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """(_file, _record_no, _raw): the records of delimited text with quoted line feeds.

    A file of any size is read by as many tasks as it has splits.  ``_record_no`` counts the
    file's records from 0 (a header is record 0).  A record that crosses splits travels as one
    piece per split and is put together by file and record.  A quote that is never
    closed makes the rest of its file one record, as it would for any reader."""
    lines = _lines(spark, path)
    plain = "_file string, _block bigint, to0 boolean, to1 boolean, n0 bigint, n1 bigint"
    splits = materialize(_start_states(lines.select(*_KEY, "_raw").mapInArrow(_effects(delimiter), plain)))
    known = _with_splits(lines, splits).select(*_KEY, "_raw", "_inside", "_first_no")
    pieces = materialize(known.mapInArrow(_records(delimiter), _PIECE_SQL))
    whole = pieces.filter(F.col("kind") == WHOLE).select("_file", "_record_no", "_raw")
    owner = F.last(F.when(F.col("kind") == OPEN, F.struct("_block", "_record_no")), ignorenulls=True).over(
        Window.partitionBy("_file").orderBy("_block", "kind").rowsBetween(Window.unboundedPreceding, 0))
    cut = pieces.filter(F.col("kind") != WHOLE).withColumn("owner", owner)
    joined = cut.groupBy("_file", "owner").agg(F.sort_array(F.collect_list(F.struct("_block", "kind", "_raw"))).alias("p")).select(
        "_file", F.col("owner._record_no").alias("_record_no"), F.array_join("p._raw", "\n").alias("_raw"))
    return whole.unionByName(joined)


def quoted_cells(records: DataFrame, schema: str, delimiter: str = ",", header: bool = True,
                 corrupt: str | None = "_corrupt_record") -> DataFrame:
    """The cells of ``quoted_records`` as columns of ``schema`` (DDL), with _file and _record_no.

    Blank records are no rows.  ``corrupt`` holds the text of records with too few or too
    many cells; short ones are padded with NULL."""
    text: Column = F.regexp_replace("_raw", "\r$", "")
    rows = records.filter(F.trim(text) != "")
    if header:
        rows = rows.filter("_record_no > 0")
    full = f"{schema}, {corrupt} string" if corrupt else schema
    options = {"sep": delimiter, "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
    return rows.select("_file", "_record_no", F.from_csv(text, F.lit(full), options).alias("_cells")).select("_file", "_record_no", "_cells.*")
