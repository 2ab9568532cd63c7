"""Records of files that Spark's own readers give to one task each: CSV with
quoted newlines, and JSON arrays.

The file is read as text in pieces (lines, or what lies between closing
braces), which Spark splits by block wherever the blocks fall. Whether a piece
ends a record depends on everything before it in the file, but only through a
small state: inside a quoted value or not, and (JSON) the depth of nesting.

* A piece's effect is a function of the state it starts in, computed by column
  expressions: where it ends when started outside (``end0``) and inside
  (``end1``) a quoted value, and the change of depth in either case.
* First pass, only over files in several blocks: the pieces of a block are
  composed into one function of the block. A window over the blocks of a file
  then gives the state each block starts in. Blocks that start other than
  between records are sent to the tasks: 32 bytes for a block of
  ``spark.sql.files.maxPartitionBytes``.
* Second pass: every block cuts its own records. Nothing is shuffled.
* A record that crosses a block boundary leaves a part in each block, at most
  two rows a block. They are gathered in a pass of their own and joined.

Files must not change while they are read. Pieces keep their order within a
block because a block is read by one task from front to back; no order between
blocks is relied on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.session import ship_package

# A record's end, middle and start in a block, in the order they lie there.
CLOSE, INSIDE, OPEN, WHOLE = 1, 2, 3, 0
EFFECTS = ["file", "block", "end0", "end1", "depth0", "depth1", "nested"]
BLOCK_SCHEMA = "file long, block long, end0 int, end1 int, depth0 long, depth1 long, nested boolean"
PART_SCHEMA = "file long, block long, part int, first boolean, record string"


def pieces(spark: SparkSession, path: str | list[str], separator: str, encoding: str) -> DataFrame:
    """(file, block, split, piece); ``split``: the block is not its whole file."""
    text = spark.read.option("lineSep", separator).text(path)
    value = F.col("value").cast("binary")
    if encoding.upper() in ("UTF-8", "UTF8"):
        value = F.make_valid_utf8(value.cast("string"))
    else:
        value = F.decode(value, encoding)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"),
                       (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("split"),
                       value.alias("piece"))


def with_csv_effects(lines: DataFrame, sep: str) -> DataFrame:
    """Effects of a line. A quote opens a value only at the start of a field;
    inside, two stand for one; what follows the closing quote up to the
    separator makes the value an unquoted one."""
    field, plain, quoted, closed = 0, 1, 2, 3

    def text(state: Column, part: Column) -> Column:
        rest = F.when(F.endswith(part, F.lit(sep)), field).otherwise(plain)
        return (F.when((state == quoted) | (part == ""), state)
                .when((state == closed) & (F.trim(part) == ""), closed).otherwise(rest))

    def quote(state: Column) -> Column:
        return F.when(state == quoted, closed).when(state == plain, plain).otherwise(quoted)

    def end(start: int) -> Column:
        parts = F.split("piece", '"', -1)
        last = F.aggregate(F.slice(parts, 2, F.size(parts)), text(F.lit(start), parts[0]),
                           lambda state, part: text(quote(state), part))
        return (F.when(F.instr("piece", '"') == 0, int(start == quoted))
                .otherwise((last == quoted).cast("int")))

    none = F.lit(0).cast("long")
    return lines.select("*", end(field).alias("end0"), end(quoted).alias("end1"), none.alias("depth0"),
                        none.alias("depth1"), F.lit(False).alias("nested"))


def with_json_effects(parts: DataFrame) -> DataFrame:
    """Effects of the text up to a closing brace, the brace included."""
    plain = F.when(F.instr("piece", "\\") == 0, F.col("piece")).otherwise(
        F.regexp_replace("piece", r"(?s)\\.", ""))

    def depth(outside: int) -> Column:
        """Change of depth if every second run, from this one, is not in a string."""
        text = F.array_join(F.filter("runs", lambda _, i: i % 2 == outside), "")
        count = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
        brace = ((F.size("runs") - 1) % 2 == outside).cast("int")
        return (count("[{") - count("]") - brace).cast("long")

    return (parts.withColumn("runs", F.split(plain, '"', -1))
            .select(*parts.columns, ((F.size("runs") - 1) % 2).alias("end0"), (F.size("runs") % 2).alias("end1"),
                    depth(0).alias("depth0"), depth(1).alias("depth1"),
                    F.col("piece").rlike(r"^[\s\uFEFF]*\[").alias("nested")))


def start_states(effects: DataFrame, arrays: bool) -> dict:
    """States in which blocks start, by (file, block), where that is not
    between two records; runs the first pass. With ``arrays`` the records of a
    file that begins with a bracket are one level down."""
    ship_package(effects.sparkSession)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("end"), "flips"))
    blocks = (effects.where("split").select(*EFFECTS).mapInArrow(_compose, BLOCK_SCHEMA)
              .withColumn("flips", F.sum(F.expr("int(end0 = 1 AND end1 = 0)")).over(order))
              .withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
              .withColumn("flipped", F.coalesce(F.lag("flips").over(order), F.lit(0))
                          - F.coalesce("fixed.flips", F.lit(0)))
              .withColumn("inside", (F.coalesce("fixed.end", F.lit(0)) + F.col("flipped")) % 2)
              .withColumn("change", F.expr("if(inside = 0, depth0, depth1)"))
              .withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
              .withColumn("base", F.first("nested").over(order).cast("int"))
              .withColumn("next", F.lead("block").over(order)))
    counted = blocks.groupBy().agg(
        F.count("*").alias("blocks"),
        F.collect_list(F.when(F.expr("block > 0 AND (inside <> 0 OR depth <> base)"),
                              F.struct("file", "block", "inside", "depth", "base"))).alias("states"),
        F.collect_list(F.when(F.col("next").isNull() & F.lit(arrays), F.struct("file", "block"))).alias("ends"),
        F.collect_set(F.when((F.col("base") == 0) & F.lit(arrays), F.col("file"))).alias("flat")).first()
    return {"several": counted["blocks"] > 0, "arrays": arrays, "flat": frozenset(counted["flat"]),
            "ends": frozenset((r.file, r.block) for r in counted["ends"]),
            "at": {(r.file, r.block): (r.inside, r.depth) for r in counted["states"]}}


def records(effects: DataFrame, separator: str, tail: str, states: dict) -> DataFrame:
    """(first, record): the records of the files; ``first`` marks a file's
    first. ``separator`` joins the pieces of a record, ``tail`` ends it."""
    ship_package(effects.sparkSession)

    def cut(parts: bool) -> DataFrame:
        return effects.where("split" if parts else "true").select(*EFFECTS, "split", "piece").mapInArrow(
            partial(_cut, states, separator, tail, parts), PART_SCHEMA)

    whole = cut(False).select("first", "record")
    if not states["several"]:
        return whole
    order = Window.partitionBy("file").orderBy("block", "part")
    crossing = (cut(True).withColumn("number", F.count_if(F.col("part") == OPEN).over(order))
                .groupBy("file", "number")
                .agg(F.max("first").alias("first"), F.array_join(F.transform(
                    F.array_sort(F.collect_list(F.struct("block", "part", "record"))),
                    lambda x: x["record"]), separator).alias("record")))
    return whole.unionByName(crossing.select("first", "record"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], slice]]:
    """Rows of one (file, block) at a time."""
    file, block = (batch.column(c).to_numpy() for c in range(2))
    new = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    cuts = [0, *new.tolist(), len(file)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield (int(file[start]), int(block[start])), slice(start, end)


def _states_after(end0: np.ndarray, end1: np.ndarray, start: int) -> np.ndarray:
    """Inside or not after each piece: the last piece whose end does not
    depend on its start decides, and then every piece that swaps the two."""
    at = np.maximum.accumulate(np.where(end0 == end1, np.arange(len(end0)), -1))
    swaps = np.cumsum((end0 == 1) & (end1 == 0))
    known = at >= 0
    return (np.where(known, end0[at], start) + swaps - np.where(known, swaps[at], 0)) % 2


def _follow(batch: pa.RecordBatch, rows: slice, state: int) -> tuple[np.ndarray, np.ndarray]:
    """State after each of the rows, and the change of depth so far."""
    end0, end1, depth0, depth1 = (batch.column(c).to_numpy()[rows] for c in range(2, 6))
    after = _states_after(end0, end1, state)
    before = np.concatenate([[state], after[:-1]])
    return after, np.cumsum(np.where(before == 0, depth0, depth1))


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: where it ends and its change of depth, by its start."""
    def result(at, ends, depths, nested) -> pa.RecordBatch:
        values = [*at, *ends, *depths, nested]
        kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], EFFECTS)

    at = None
    for batch in batches:
        for key, rows in _runs(batch):
            if key != at:
                if at is not None:
                    yield result(at, ends, depths, nested)
                at, ends, depths, nested = key, [0, 1], [0, 0], batch.column(6)[rows.start].as_py()
            for start in range(2):
                after, depth = _follow(batch, rows, ends[start])
                ends[start], depths[start] = int(after[-1]), depths[start] + int(depth[-1])
    if at is not None:
        yield result(at, ends, depths, nested)


class _Block:
    """Cuts one block. What is cut waits until the next piece shows that it
    was not the file's last: an array does not end with a closing brace, so
    one that does was broken off, and its last element stays without the brace."""

    def __init__(self, at: tuple[int, int], split: bool, nested: bool, states: dict):
        self.at, self.split, self.last = at, split, not split or at in states["ends"]
        self.base = int(states["arrays"] and (nested if at[1] == 0 else at[0] not in states["flat"]))
        self.state, self.depth = states["at"].get(at, (0, self.base if at[1] else 0))
        self.entered = at in states["at"]  # the block starts within a record
        self.first = at[1] == 0
        self.carry: list[str] = []
        self.ended = False  # the carry is a record
        self.whole: list[tuple[bool, pa.Array]] = []
        self.parts: list[tuple[int, bool, str]] = []

    def add(self, batch: pa.RecordBatch, rows: slice, separator: str, tail: str) -> None:
        if self.first and not tail and not self.carry:  # empty lines before a header
            while rows.start < rows.stop and batch.column("piece")[rows.start].as_py() in ("", "\r"):
                rows = slice(rows.start + 1, rows.stop)
            if rows.start == rows.stop:
                return
        after, change = _follow(batch, rows, self.state)
        ends = np.flatnonzero((after == 0) & (self.depth + change == self.base))
        self.state, self.depth = int(after[-1]), self.depth + int(change[-1])
        pieces = batch.column("piece").slice(rows.start, rows.stop - rows.start)
        if self.ended:
            self._emit(separator.join(self.carry) + tail)
        if not len(ends):
            self.carry += pieces.to_pylist()
            return
        head = ends[0] + 1
        self.carry += pieces.slice(0, head).to_pylist()
        self.ended = True
        if len(ends) > 1:
            self._emit(separator.join(self.carry) + tail)
            between = pieces.slice(head, ends[-2] + 1 - head)
            if len(between) > len(ends) - 2:  # some record has several pieces
                offsets = pa.array(np.concatenate([[0], ends[1:-1] + 1 - head]), pa.int32())
                between = pc.binary_join(pa.ListArray.from_arrays(offsets, between), separator)
            if len(between):
                self.whole.append((False, pc.binary_join_element_wise(between, tail, "") if tail else between))
            self.carry = pieces.slice(ends[-2] + 1, ends[-1] - ends[-2]).to_pylist()
            self.ended = True
        if ends[-1] + 1 < len(pieces):
            self._emit(separator.join(self.carry) + tail)
            self.carry = pieces.slice(ends[-1] + 1).to_pylist()

    def _emit(self, record: str) -> None:
        if self.entered:
            self.parts.append((CLOSE, self.first, record))
        else:
            self.whole.append((self.first, pa.array([record], pa.string())))
        self.entered = self.first = self.ended = False
        self.carry = []

    def close(self, separator: str, tail: str) -> None:
        if self.ended:
            broken = self.last and self.base == 1
            self._emit(separator.join(self.carry) + ("" if broken else tail))
        elif self.carry:
            record = separator.join(self.carry)
            if self.split:
                self.parts.append((INSIDE if self.entered else OPEN, self.first, record))
            else:
                self.whole.append((self.first, pa.array([record], pa.string())))
            self.carry = []

    def taken(self, parts: bool) -> Iterator[pa.RecordBatch]:
        """What has been cut since the last call: records, or parts of records."""
        found = ([(part, first, pa.array([record], pa.string())) for part, first, record in self.parts] if parts
                 else [(WHOLE, first, record) for first, record in self.whole])
        self.parts, self.whole = [], []
        for part, first, record in found:
            n = len(record)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, self.at[0])), pa.array(np.full(n, self.at[1])),
                 pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, first)), record.cast(pa.string())],
                ["file", "block", "part", "first", "record"])


def _cut(states: dict, separator: str, tail: str, parts: bool,
         batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one block, or (``parts``) the parts of the others."""
    block = None
    for batch in batches:
        for at, rows in _runs(batch):
            if block is None or block.at != at:
                if block is not None:
                    block.close(separator, tail)
                    yield from block.taken(parts)
                nested, split = (batch.column(c)[rows.start].as_py() for c in ("nested", "split"))
                block = _Block(at, split, nested, states)
            block.add(batch, rows, separator, tail)
            yield from block.taken(parts)
    if block is not None:
        block.close(separator, tail)
        yield from block.taken(parts)
