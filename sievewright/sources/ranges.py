"""Quoted CSV read by ranges of its files: records that hold line feeds, numbered in the order of the file, by many tasks.

Spark's reader takes one task for each file whose cells may hold line feeds, since only the quotes before a line tell
whether a record begins there.  Two passes over the lines do without: the first tells of every block of a file how it
would end, and how many records would begin in it, if it began outside quotes and if it began within; a scan over these few
rows settles how each block does begin and the numbers of its records; the second puts records together.  Only the pieces
of records that lie across blocks are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most characters of one record: a quote that is never closed is an error, not a record as long as the file.
LONGEST = 64 << 20

_CLOSING = re.compile(r'(?:[^"]|"")*+"')
_OPENING = re.compile(r',"')


def ends_within(line: str, within: bool) -> bool:
    """Whether a line, begun within quotes or outside, ends within: a quote opens at the begin of a cell alone, and closes where it is not doubled."""
    if '"' not in line:
        return within
    at = 0
    if not within and line[0] == '"':
        within, at = True, 1
    while True:
        if within:
            found = _CLOSING.match(line, at)
        else:
            found = _OPENING.search(line, at)
        if not found:
            return within
        within, at = not within, found.end()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Lines of one block after another; a block's lines may come in several parts."""
    for b in batches:
        at, values = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist())), b.column(2).to_pylist()
        begin = 0
        for i in range(1, len(at) + 1):
            if i == len(at) or at[i] != at[begin]:
                yield at[begin], values[begin:i]
                begin = i


def _begins(line: str, within: bool) -> bool:
    """Whether a record begins with this line; empty lines outside quotes are none."""
    return not within and line not in ("", "\r")


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block and, for both ways in which it may begin: whether it ends within quotes, and how many records begin."""
    state: dict[tuple[str, int], list] = {}
    for block, lines in _blocks(batches):
        s = state.setdefault(block, [False, 0, True, 0])
        for line in lines:
            for k in (0, 2):
                s[k + 1] += _begins(line, s[k])
                s[k] = ends_within(line, s[k])
    rows = [(f, b, *s) for (f, b), s in state.items()]
    cols = list(zip(*rows)) if rows else [[]] * 6
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["file", "block", "out_ends", "out_records", "in_ends", "in_records"])


def settle(surveyed: list) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """For each block: whether it begins within quotes, the index of the first record that begins in it, and that of the file's header, which is one less than its first record's."""
    out, following, last = {}, 0, None
    within, header, empty = False, -1, True
    for r in sorted(surveyed, key=lambda r: (r.file, r.block)):
        if r.file != last:
            last, within, empty = r.file, False, True
            header = following - 1
        here = r.in_records if within else r.out_records
        out[r.file, r.block] = (within, header if empty else following, header)
        following += here - (empty and here > 0)  # the header is no record
        empty = empty and not here
        within = r.in_ends if within else r.out_ends
    return out


def _records(begins: dict[tuple[str, int], tuple[bool, int, int]], longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, number, piece, within = None, [], -1, False, False
        size = 0
        out: list[tuple[int, bool, str, str, int, bool]] = []

        def leave() -> None:
            # whole: begun in this block and ended in it
            if held:
                out.append((number, not piece and not within, "\n".join(held), *block, number == begins[block][2]))

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["number", "whole", "value", "file", "block", "head"])

        for at, lines in _blocks(batches):
            if at != block:
                leave()
                block, held, size = at, [], 0
                within, following, _ = begins[at]
                number, piece = following - 1, within
            for line in lines:
                if not within:
                    leave()
                    held, size, piece = [], 0, False
                    if not _begins(line, False):
                        continue
                    number = following
                    following += 1
                held.append(line)
                size += len(line)
                if size > longest:
                    raise ValueError(f"{at[0]}: a record of over {longest} characters; a quote is not closed")
                within = ends_within(line, within)
            if len(out) >= 10_000:
                yield batch()
                out.clear()
        leave()
        yield batch()

    return run


def numbered_records(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """record_index and value, the raw text, of every record of the CSV files at ``path`` but their headers: indexes from 0 on without a gap, in the order of file names and then of lines."""
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    # a row for each block of a file: as many as tasks read it
    begins = settle(lines.mapInArrow(_survey, "file string, block long, out_ends boolean, out_records long, in_ends boolean, in_records long").collect())
    found = lines.mapInArrow(_records(begins, longest), "number long, whole boolean, value string, file string, block long, head boolean")
    whole = found.where("whole and not head").select("number", "value")
    # pieces: at most two for each block
    parts = F.array_sort(F.collect_list(F.struct("block", "value")))
    pieces = found.where("not whole and not head").groupBy("number").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return whole.unionByName(pieces).select(F.col("number").alias("record_index"), F.regexp_replace("value", "\r$", "").alias("value"))


def read_numbered_csv(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """The cells of :func:`sievewright.sources.files.read_csv` and ``record_index``, the place in the order of the files.

    Files have one header, the first one's.  Rows that lack cells have empty ones there; cells beyond the header are left out.
    """
    options = {"quote": '"', "escape": '"', "emptyValue": ""}
    names = spark.read.csv(path, header=True, multiLine=True, inferSchema=False, encoding="UTF-8", **options).columns
    places = [f"c{i}" for i in range(len(names))]
    cells = F.from_csv("value", ", ".join(f"{p} string" for p in places), {**options, "multiLine": "true", "mode": "PERMISSIVE"})
    rows = numbered_records(spark, path, longest).select("record_index", cells.alias("r"))
    return rows.select("record_index", *[F.coalesce(F.col(f"r.{p}"), F.lit("")).alias(n.lstrip("﻿")) for p, n in zip(places, names)])
