"""JSON arrays of records that are read in splits, however the file is laid out.

A landed file is one array, often one line. Spark's text reader splits a file at any separator, so it reads the file up to
each ``}``: that cuts one file into as many tasks as its size asks for. Whether a bracket counts, and how deep it is, depends on all
that comes before it. So a first pass sums up each split for both cases, that it begins inside a string or outside of one: the
parity of its quotes, how much deeper it ends, and how many closing brackets reach each depth. Running sums over these rows, one per split, give
every split its beginning and the number of records that end before it. A second pass cuts the records, numbered in the file. A
record over several splits is put together from its pieces; all others go on as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CUT = "}"
_BOM = "\ufeff".encode()
_QUOTE, _ESCAPE = 0x22, 0x5C
#: Bytes that may stand around the records.
_AROUND = np.zeros(256, bool)
_AROUND[list(b" \t\r\n,[]")] = True


class UnreadableDocument(ValueError):
    """A file that is not one array of records."""


def _quotes(data: np.ndarray) -> np.ndarray:
    """Where quotes begin or end a string: those after an even number of backslashes."""
    quotes = data == _QUOTE
    slashes = np.flatnonzero(data == _ESCAPE)
    if len(slashes):
        # The last of a run of backslashes escapes what follows if the run is odd.
        ends = np.flatnonzero(np.append(np.diff(slashes) > 1, True))
        lengths = np.diff(np.concatenate([[-1], ends]))
        after = slashes[ends[lengths % 2 == 1]] + 1
        quotes[after[after < len(data)]] = False
    return quotes


def _brackets(data: np.ndarray) -> np.ndarray:
    """1 for opening, -1 for closing brackets of either kind."""
    step = np.zeros(256, np.int8)
    step[list(b"{[")], step[list(b"}]")] = 1, -1
    return step[data]


@dataclass
class Summary:
    """A split as a whole, for both states (0 outside, 1 inside a string) it may begin in."""

    odd: int = 0
    deeper: list[int] = field(default_factory=lambda: [0, 0])
    closings: list[dict[int, int]] = field(default_factory=lambda: [{}, {}])

    def feed(self, data: bytes) -> None:
        chars = np.frombuffer(data, np.uint8)
        inside = (np.cumsum(_quotes(chars)) + self.odd) & 1
        step = _brackets(chars)
        for state in (0, 1):
            real = np.where(inside == state, step, 0)
            depth = self.deeper[state] + np.cumsum(real, dtype=np.int64)
            for reached, n in zip(*np.unique(depth[real < 0], return_counts=True)):
                self.closings[state][int(reached)] = self.closings[state].get(int(reached), 0) + int(n)
            self.deeper[state] = int(depth[-1]) if len(depth) else self.deeper[state]
        self.odd = int(inside[-1]) if len(inside) else self.odd


@dataclass
class Cutter:
    """Cuts records out of a split that begins at this depth, inside a string or not."""

    inside: int
    depth: int
    ordinal: int
    begins_whole: bool = True
    held: bytes = b""
    after_record: bool | None = None

    def __post_init__(self) -> None:
        self.begins_whole = self.depth < 2

    def feed(self, data: bytes) -> list[tuple[int, bool, bytes]]:
        """(ordinal, begins in this split, text) of the records that end in ``data``; what is left is held."""
        whole = self.held + data
        chars = np.frombuffer(data, np.uint8)
        inside = (np.cumsum(_quotes(chars)) + self.inside) & 1
        real = np.where(inside == 0, _brackets(chars), 0)
        depth = self.depth + np.cumsum(real, dtype=np.int64)
        ends = np.flatnonzero((real < 0) & (depth == 1))
        starts = np.flatnonzero((real > 0) & (depth == 2))
        around = (depth < 2) & ~((real < 0) & (depth == 1))
        if not _AROUND[chars[around]].all() or (depth[-1:] < 0).any():
            raise UnreadableDocument("unreadable JSON document, something else than records in an array")
        self._check_commas(np.flatnonzero(around & (chars == 0x2C)), starts, ends)
        shift = len(self.held)
        # The record that was open before ``data`` begins with what is held.
        opened = self.depth >= 2
        firsts = np.concatenate([[0], starts + shift]) if opened else starts + shift
        out = []
        for first, end in zip(firsts.tolist(), (ends + shift + 1).tolist()):
            out.append((self.ordinal, self.begins_whole, whole[first:end]))
            self.ordinal, self.begins_whole = self.ordinal + 1, True
        self.held = whole[int(firsts[len(ends)]) :] if len(firsts) > len(ends) else b""
        if len(depth):
            self.depth, self.inside = int(depth[-1]), int(inside[-1])
        return out

    def _check_commas(self, commas: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Records and commas take turns; at the beginning of a split what came before is not known."""
        marks = np.concatenate([commas, starts, ends])
        kinds = np.concatenate([np.full(len(commas), 0), np.full(len(starts), 1), np.full(len(ends), 2)])
        kinds = kinds[np.argsort(marks, kind="stable")]
        if self.after_record is not None:
            kinds = np.concatenate([[2 if self.after_record else 0], kinds])
        pairs = 3 * kinds[:-1] + kinds[1:]
        # A record after a record, two commas, or a comma inside the pair.
        if np.isin(pairs, [0, 2 * 3 + 1]).any():
            raise UnreadableDocument("unreadable JSON document, records must be parted by one comma each")
        outer = kinds[kinds != 1]
        if len(outer):
            self.after_record = bool(outer[-1] == 2)


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, part): the parts between closing braces, in order within each split of a file."""
    rows = spark.read.option("lineSep", CUT).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("part"))


def _runs(batch: pa.RecordBatch, last: tuple | None) -> Iterator[tuple[tuple, bool, int, bytes]]:
    """(split, it begins here, row, text) of the splits in a batch; each part but a file's first follows a brace."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    parts = batch.column("part").to_pylist()
    at = 0
    while at < len(parts):
        split, stop = (files[at], starts[at]), at + 1
        while stop < len(parts) and (files[stop], starts[stop]) == split:
            stop += 1
        text = CUT.join(parts[at:stop]).encode()
        begins = split != last
        if not begins or split[1] > 0:
            text = CUT.encode() + text
        elif text.startswith(_BOM):
            text = text[len(_BOM) :]
        yield split, begins, at, text
        last, at = split, stop


def _beginnings(fragments: DataFrame) -> DataFrame:
    """(file, start, inside, depth, ordinal, closed): the state each split begins in; ``closed``: arrays its file closes."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary = None, Summary()
        kind = pa.map_(pa.int64(), pa.int64())

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now[0]], pa.string()),
                    pa.array([now[1]], pa.int64()),
                    pa.array([summary.odd], pa.int64()),
                    *(pa.array([d], pa.int64()) for d in summary.deeper),
                    *(pa.array([list(c.items())], kind) for c in summary.closings),
                ],
                ["file", "start", "odd", "deeper0", "deeper1", "closings0", "closings1"],
            )

        for batch in batches:
            for split, begins, _, text in _runs(batch, now):
                if begins:
                    if now is not None:
                        yield row()
                    now, summary = split, Summary()
                summary.feed(text)
        if now is not None:
            yield row()

    splits = fragments.mapInArrow(
        summarise,
        "file string, start long, odd long, deeper0 long, deeper1 long, closings0 map<long,long>, closings1 map<long,long>",
    )
    # One row per split of a file.
    file = Window.partitionBy("file")
    before = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    reached = lambda depth: F.coalesce(F.try_element_at("closings", F.lit(depth) - F.col("depth")), F.lit(0))
    return (
        splits.withColumn("inside", total("odd") % 2)
        .withColumn("deeper", F.when(F.col("inside") == 0, F.col("deeper0")).otherwise(F.col("deeper1")))
        .withColumn("closings", F.when(F.col("inside") == 0, F.col("closings0")).otherwise(F.col("closings1")))
        .withColumn("depth", total("deeper"))
        .withColumns({"ordinal": total(reached(1)), "closed": F.sum(reached(0)).over(file)})
        .select("file", "start", "inside", "depth", "ordinal", "closed")
    )


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, ordinal, record): the text of every record of JSON-array files with its place in its file, from 0.

    Files are split by ``spark.sql.files.maxPartitionBytes``, also inside of lines. A file that is not one array of records, or
    is empty, stops the job. What is inside a record is left to the caller.
    """
    fragments = _fragments(spark, path)
    beginnings = _beginnings(fragments)
    # Four numbers per split of a file, read where the split is.
    known = fragments.join(F.broadcast(beginnings), ["file", "start"]).select("file", "start", "part", "inside", "depth", "ordinal", "closed")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cutter = None, None

        def rows(found: list[tuple[int, bool, bool, bytes]]) -> pa.RecordBatch:
            ordinals, begins, ends, texts = zip(*found) if found else ((),) * 4
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now[0]] * len(found), pa.string()),
                    pa.array(ordinals, pa.int64()),
                    pa.array([now[1]] * len(found), pa.int64()),
                    pa.array([a and b for a, b in zip(begins, ends)], pa.bool_()),
                    pa.array([t.decode() for t in texts], pa.string()),
                ],
                ["source_file", "ordinal", "start", "whole", "record"],
            )

        def rest() -> list[tuple[int, bool, bool, bytes]]:
            return [(cutter.ordinal, cutter.begins_whole, False, cutter.held)] if cutter.held else []

        for batch in batches:
            inside, depth, ordinal, closed = (batch.column(c).to_pylist() for c in ("inside", "depth", "ordinal", "closed"))
            for split, begins, row, text in _runs(batch, now):
                if begins:
                    if now is not None:
                        yield rows(rest())
                    if closed[row] != 1:
                        raise UnreadableDocument(f"unreadable JSON document, not one array: {split[0]}")
                    now, cutter = split, Cutter(inside[row], depth[row], ordinal[row])
                yield rows([(o, b, True, t) for o, b, t in cutter.feed(text)])
        if now is not None:
            yield rows(rest())

    pieces = known.mapInArrow(cut, "source_file string, ordinal long, start long, whole boolean, record string")
    # A record in several splits; each split holds the ends of two such records at most.
    parted = (
        pieces.where("NOT whole")
        .groupBy("source_file", "ordinal")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "record"))), lambda p: p["record"]), "").alias("record"))
    )
    # Files without a single byte have no split that could complain.
    n_files = len(set(fragments.inputFiles()))
    fewer = beginnings.agg(F.count_distinct("file").alias("n")).where(F.col("n") < n_files)
    refused = F.raise_error(F.concat(F.lit(f"unreadable JSON documents, files without content under {path}: "), (n_files - F.col("n")).cast("string"))).cast("string")
    nothing = fewer.where(refused.isNotNull()).select(F.lit("").alias("source_file"), F.lit(0).cast("long").alias("ordinal"), F.lit("").alias("record"))
    return pieces.where("whole").select("source_file", "ordinal", "record").unionByName(parted).unionByName(nothing)
