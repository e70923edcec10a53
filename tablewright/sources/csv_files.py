"""Tolerant scan of delimited files: the same rows whatever the size of a file, its line ends and its splits."""

from __future__ import annotations

import csv
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import file_header
from tablewright.functions.text import missing_to_null
from tablewright.sources.files import stored, total_bytes

RAW_RECORD = "_corrupt_record"
# a quoted field opens after a comma or at the start; possessive repeats keep long cells off the stack
QUOTED_FIELD = r'(?<![^,])"[^"]*+(?:""[^"]*+)*+"'
# for Arrow's linear-time matcher: lines that end outside of quotes, if they begin outside, and if inside
_CELL = r'(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|(?:[^",][^,]*)?)'
CLOSED_LINE = rf'(?s)^{_CELL}(?:,{_CELL})*$'
CLOSING_LINE = rf'(?s)^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_CELL})*$'
LONGEST_RECORD = 16 << 20  # bytes of a record with line breaks inside quotes; longer ones are malformed
TASK_BYTES = 4 << 20       # of text that a task joins at least
MOST_HEADERS = 100  # different headers among the parts of one table
CSV_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_RECORD, "escape": '"', "maxCharsPerColumn": "-1"}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Names from the first row; only the beginning of one file is read."""
    first = (
        spark.read.option("header", "false").option("multiLine", "true")
        .option("escape", '"').option("maxCharsPerColumn", "-1").csv(path).first()
    )
    if first is None:
        raise ValueError(f"No columns to read in {path}")
    return file_header(list(first))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines, ended by LF, CRLF or CR, with their file and block; those of a block follow each other in one task."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("idx"))


def _opens(text: Column) -> Column:
    """Whether a quote stays open at the end of a text that begins outside of quotes."""
    return F.contains(text, F.lit('"')) & F.regexp_replace(text, QUOTED_FIELD, "").rlike('(?:^|,)"')


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """file, header (its first line with text) and open (whether any line leaves a quote open) of each file."""
    line = F.col("value")
    place = F.when(F.trim(line) != "", F.struct("block", "idx"))
    first = F.min_by(F.ltrim(line, F.lit("\ufeff")), place)
    return _lines(spark, path).groupBy("file").agg(first.alias("header"), (F.count_if(_opens(line)) > 0).alias("open"))


def _line_states(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line, whether a quote is open at its end: if none was at its beginning, and if one was."""
    lines = lines.cast(pa.binary())  # whatever the bytes are
    quotes = pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)
    after_none, after_open = np.zeros(len(lines), bool), ~quotes
    if quotes.any():
        some = lines.filter(pa.array(quotes))
        after_none[quotes] = ~pc.match_substring_regex(some, CLOSED_LINE).to_numpy(zero_copy_only=False)
        after_open[quotes] = ~pc.match_substring_regex(some, CLOSING_LINE).to_numpy(zero_copy_only=False)
    return after_none, after_open


def _states_after(after_none: np.ndarray, after_open: np.ndarray, begin: bool) -> np.ndarray:
    """Whether a quote is open after each line, if that is so (`begin`) before the first.

    A line sets the state, flips it or leaves it: what holds is the last one set, or else the first, and the flips since.
    """
    place = np.arange(len(after_none))
    last = np.maximum.accumulate(np.where(after_none == after_open, place, -1))
    flips = np.cumsum(after_none & ~after_open)
    base = np.where(last >= 0, after_none[last], begin)
    return base ^ ((flips - np.where(last >= 0, flips[last], 0)) % 2).astype(bool)


def _block_runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """file, block, and where its lines begin and end, of each run of lines of one block."""
    file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
    if len(block):
        code = file.indices.to_numpy()
        at = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        for begin, end in zip([0, *at], [*at, len(block)]):
            yield file.dictionary[int(code[begin])].as_py(), int(block[begin]), int(begin), int(end)


def _blocks(lines: DataFrame) -> DataFrame:
    """file, block, start (whether it begins inside of quotes) and owner (the block that its first lines belong to).

    What a block does to the state is a function of two values, told by one pass over its lines; functions are put
    together from block to block. One row for each block.
    """

    def run(batches):
        now, ends, begun = None, [False, True], False
        for batch in batches:
            done = []
            for file, block, begin, end in _block_runs(batch):
                if now is not None and now != (file, block):
                    done.append((*now, *ends, begun))
                if now != (file, block):
                    now, ends, begun = (file, block), [False, True], False
                states = _line_states(batch.column("value").slice(begin, end - begin))
                # a record begins where no quote is open, but for the first line of a block that begins inside
                inside = _states_after(*states, ends[1])
                begun |= bool((~inside[:-1]).any()) or not ends[1]
                ends = [bool(_states_after(*states, ends[0])[-1]), bool(inside[-1])]
            if done:
                yield made(done)
        if now is not None:
            yield made([(*now, *ends, begun)])

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file", "block", "none", "open", "begun"])

    blocks = lines.select("value", "file", "block").mapInArrow(
        run, "file string, block long, none boolean, open boolean, begun boolean")
    chain = Window.partitionBy("file").orderBy("block")
    fixed, flips = F.col("none") == F.col("open"), F.sum((F.col("none") & ~F.col("open")).cast("int")).over(chain)
    blocks = stored(blocks, "blocks").withColumn("flips", flips).withColumn(
        "base", F.last(F.when(fixed, F.struct(F.col("none").cast("int").alias("to"), "flips")), ignorenulls=True).over(chain))
    after = F.pmod(F.coalesce("base.to", F.lit(0)) + F.col("flips") - F.coalesce("base.flips", F.lit(0)), F.lit(2)) == 1
    start = F.coalesce(F.lag(after).over(chain), F.lit(False))
    blocks = blocks.withColumn("start", start).withColumn("begins", F.col("begun") | ~F.col("start"))
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before)
    return blocks.select("file", "block", "start", owner.alias("owner"))


def _records(lines: DataFrame) -> DataFrame:
    """file and record: lines joined, by LF, where a quoted field goes on in the next one; headers and blanks left out.

    Blocks are read side by side, each from the state it begins in. Records that lie in one block are joined there;
    only those across the seam of blocks are put together from their parts. A record of more than LONGEST_RECORD
    bytes is malformed, as after a stray quote that nothing closes, and left out; no task ever holds it.
    """
    blocks = stored(_blocks(lines), "starts")
    # two numbers a block, of some 128 MB of text
    starts = F.broadcast(blocks.filter("start").select(F.xxhash64("file", "block").alias("key"), F.lit(True).alias("start")))
    marked = lines.withColumn("key", F.xxhash64("file", "block")).join(starts, "key", "left")
    marked = marked.select("value", "file", "block", F.coalesce("start", F.lit(False)).alias("start"))
    pieces = stored(marked.mapInArrow(
        _joiner(LONGEST_RECORD), "file string, block long, part string, first boolean, size long, record string"), "records")

    whole = pieces.filter(F.col("part") == "whole").select("file", "block", "first", "record")
    across = pieces.filter(F.col("part") != "whole").join(blocks.select("file", "block", "owner"), ["file", "block"])
    home = F.when(F.col("part") == "tail", F.col("block")).otherwise(F.col("owner"))
    text = F.array_sort(F.collect_list(F.when(F.col("size") <= LONGEST_RECORD, F.struct("block", "record"))))
    across = across.groupBy("file", home.alias("block")).agg(
        F.sum("size").alias("size"), F.max("first").alias("first"), text.alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    record = F.when(F.col("size") <= LONGEST_RECORD, joined)
    records = whole.unionByName(across.select("file", "block", "first", record.alias("record")))
    heads = records.filter("first").groupBy("file").agg(F.min("block").alias("head"))
    records = records.join(heads, "file").filter(~(F.col("first") & (F.col("block") == F.col("head"))))
    return records.filter("record IS NOT NULL").select("file", "record")


def _joiner(longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What joins the lines of blocks: to whole records, the tail that the next block goes on with, and the head of lines
    that end a record of an earlier block. `first` marks the first record with text that begins in the block. Of a record
    of more than `longest` bytes the size remains."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, part, seen, size = None, False, "", False, 0
        open_pieces: list[bytes] = []
        rows: list[tuple] = []

        def close(ended: bool) -> None:
            """End the record that is open; `ended` says whether it ends in this block."""
            nonlocal seen, size
            if part and (part == "head" or size):
                text = b"\n".join(open_pieces).decode(errors="replace") if size <= longest else None
                blank = text is not None and not text.strip(" ")
                if part == "head":
                    rows.append((*now, "head", False, size, text))
                elif not blank:
                    rows.append((*now, "whole" if ended else "tail", not seen, size, text))
                    seen = True
            open_pieces.clear()
            size = 0

        def add(text: bytes) -> None:
            nonlocal size
            size += len(text) + 1
            if size <= longest:
                open_pieces.append(text)
            else:
                open_pieces.clear()

        for batch in batches:
            out = []
            for file, block, begin, end in _block_runs(batch):
                if now != (file, block):
                    if now is not None:
                        close(not state)
                    now, state, seen = (file, block), batch.column("start")[begin].as_py(), False
                    part = "head" if state else ""
                lines = batch.column("value").slice(begin, end - begin)
                after = _states_after(*_line_states(lines), state)
                starts = np.flatnonzero(~np.concatenate(([state], after[:-1])))
                bounds = [0, *starts.tolist()] if not len(starts) or starts[0] else starts.tolist()
                groups = pc.binary_join(
                    pa.ListArray.from_arrays(pa.array([*bounds, len(lines)], pa.int32()), lines.cast(pa.binary())), b"\n")
                if bounds[0] not in starts:
                    add(groups[0].as_py())
                    groups = groups.slice(1)
                if len(groups):
                    close(True)
                    part = "whole"
                    # all but the last group are over; the last may go on with the next batch
                    done = groups.slice(0, len(groups) - 1)
                    if len(done):
                        sizes = pc.binary_length(done).to_numpy()
                        text = pc.match_substring_regex(done, "[^ ]").to_numpy(zero_copy_only=False)
                        kept = np.flatnonzero(text & (sizes < longest))
                        first = np.zeros(len(kept), bool)
                        if len(kept) and not seen:
                            first[0] = seen = True
                        if rows:
                            out.append(_rows(rows))
                            rows = []
                        n = len(kept)
                        out.append(pa.RecordBatch.from_arrays(
                            [pa.array([file] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(["whole"] * n, pa.string()),
                             pa.array(first), pa.array(sizes[kept], pa.int64()), _text(done.take(pa.array(kept)))], names=_PIECES))
                    add(groups[-1].as_py())
                state = bool(after[-1])
            yield from out
            if rows:
                yield _rows(rows)
                rows = []
        if now is not None:
            close(not state)
            if rows:
                yield _rows(rows)

    return joined


_PIECES = ["file", "block", "part", "first", "size", "record"]


def _text(values: pa.Array) -> pa.Array:
    """The same bytes as strings; not looked at, as the lines were not."""
    return pa.Array.from_buffers(pa.string(), len(values), values.buffers(), offset=values.offset)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_PIECES)


def scan_csv(spark: SparkSession, path: str, quoted_newlines: bool | None = None) -> DataFrame:
    """All cells as text; missing tokens null; short rows padded, over-long rows dropped.

    Lines end in LF, CRLF or CR, also mixed. One text scan looks, in every file, for quotes left open at a line end and
    for the header. Files without open quotes are split and parsed line by line; the lines of the others are joined
    to records first, in as many tasks as they have blocks; a joined record of more than LONGEST_RECORD bytes is dropped
    as malformed. Parts of a folder may order their columns differently;
    parts with other columns are an error. `quoted_newlines` skips the check and takes the first header for all:
    True joins lines in every file, False in none.
    """
    names = read_header(spark, path)
    orders, some_open, all_open = {}, quoted_newlines, quoted_newlines
    parts = None
    if quoted_newlines is None:
        parts = _parts(spark, path)
        found = parts.filter("header IS NOT NULL").groupBy("header").agg(
            F.count(F.lit(1)).alias("files"), F.count_if("open").alias("open"), F.min("file").alias("file")
        ).limit(MOST_HEADERS + 1).collect()
        some_open = any(r.open for r in found)
        all_open = all(r.open == r.files for r in found)
        if len(found) > 1:
            names, orders = _column_orders(path, found)

    cells = [f"c{i}" for i in range(len(names))]
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in cells] + [T.StructField(RAW_RECORD, T.StringType())]
    )
    file = F.col("_metadata.file_path").alias("file")
    by_line = spark.read.schema(schema).options(header="true", **CSV_OPTIONS).csv(path)
    by_line = by_line.select(*cells, RAW_RECORD, file) if some_open or orders else by_line
    if some_open:
        # no more tasks, and files between steps, than the text is worth; blocks stay whole
        lines = _lines(spark, path).coalesce(max(1, math.ceil(total_bytes(spark, path) / TASK_BYTES)))
        if not all_open:
            # joined where the lines are, so that they stay in order
            lines = lines.join(F.broadcast(parts.filter("open").select("file")), "file", "left_semi")
        parsed = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), CSV_OPTIONS)
        joined = _records(lines).select("file", parsed.alias("r")).select("r.*", "file")
        rows = joined
        if not all_open:
            rows = by_line.join(parts.filter("open").select("file"), "file", "left_anti").unionByName(joined)
    else:
        rows = by_line
    if orders:
        rows = rows.join(parts.select("file", "header"), "file")

    raw = F.col(RAW_RECORD)
    width = F.regexp_count(F.regexp_replace(raw, QUOTED_FIELD, ""), F.lit(",")) + 1
    # Spark refuses a scan of the raw record alone, as in a bare count: always read one cell with it
    with_cell = F.coalesce(F.length(F.col(cells[0])), F.lit(0)) >= 0
    kept = rows.filter((raw.isNull() | ((width <= len(names)) & (F.trim(raw) != ""))) & with_cell)
    if len(names) == 1:
        kept = kept.filter(F.trim(F.col(cells[0])) != "")
    arranged = kept.select(*_arranged(cells, orders))
    return arranged.select(*[missing_to_null(c).alias(n) for c, n in zip(cells, names)])


def _column_orders(path: str, found: list) -> tuple[list[str], dict[str, list[int]]]:
    """The names of the first file, and for each header where it holds them."""
    if len(found) > MOST_HEADERS:
        raise ValueError(f"The files of {path} have more than {MOST_HEADERS} different headers")
    found = sorted(found, key=lambda r: r.file)
    names = file_header(next(csv.reader([found[0].header])))
    orders = {}
    for row in found:
        own = file_header(next(csv.reader([row.header])))
        if sorted(own) != sorted(names):
            raise ValueError(f"{row.file} has the columns {own}, {found[0].file} has {names}")
        orders[row.header] = [own.index(n) for n in names]
    return names, orders


def _arranged(cells: list[str], orders: dict[str, list[int]]) -> list[Column]:
    """The cells in the order of the names, whatever the order in their file."""
    if not orders:
        return [F.col(c) for c in cells]
    columns = []
    for i in range(len(cells)):
        column = None
        for header, places in orders.items():
            chosen = F.col(cells[places[i]])
            is_header = F.col("header") == header
            column = F.when(is_header, chosen) if column is None else column.when(is_header, chosen)
        columns.append(column.alias(cells[i]))
    return columns
