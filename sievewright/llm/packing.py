"""Op 5.  Harmonic packing of documents into fixed-capacity sequences.

Every document is cut into full sequences and, for its tail, into halves, quarters and eighths of the
capacity while they fit, and one rest.  A piece of length l belongs to the reciprocal class k = capacity // l,
whose lengths lie in (capacity/(k+1), capacity/k]; a bin of class k takes exactly k pieces.  The cuts lie on
the classes' upper ends, so their bins are filled without a gap, and the rest, below an eighth, falls into
classes that waste little.

Workers are the tasks that read the documents: nothing is shuffled, each task holds one open bin for each class
(at most capacity/8 + 4 bins), and when it ends it packs the pieces of its open bins together, longest first.
So a task pads about one sequence, whatever the classes.

Null and empty texts hold one token, the end id.  A special token's name in a text becomes its id, as ``tokenizers`` has it.  Equal rows are packed each for itself.  An empty table gives
no rows.  Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, slices
from .tokens import TextTokenizer

CAPACITY = 1024
END_ID = 0
#: Smallest share of the capacity, as a power of two, that a tail is cut at.
FINEST_CUT = 3

_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, harmonic_class int, padded_length long"


def cut(n: int, capacity: int = CAPACITY, finest: int = FINEST_CUT) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for i in range(1, finest + 1):
        part = capacity >> i
        if part and rest >= part:
            out.append(part)
            rest -= part
    return [*out, rest] if rest else out


class HarmonicPacker:
    """Bins of one worker.  ``add`` returns the bins that it completes, ``close`` the rest; a bin is a list of (piece, length, class)."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.open = capacity, {}

    def add(self, piece, length: int) -> list:
        k = self.capacity // length
        bin_ = self.open.setdefault(k, [])
        bin_.append((piece, length, k))
        return [self.open.pop(k)] if len(bin_) == k else []

    def close(self) -> list:
        """Pieces of open bins, longest first, each into the first bin that has room: their number is bounded by the classes."""
        bins: list[list] = []
        room: list[int] = []
        for item in sorted((x for b in self.open.values() for x in b), key=lambda x: -x[1]):
            for i, free in enumerate(room):
                if item[1] <= free:
                    bins[i].append(item)
                    room[i] -= item[1]
                    break
            else:
                bins.append([item])
                room.append(self.capacity - item[1])
        self.open = {}
        return bins


def padded(n: int, capacity: int) -> int:
    """Sequences are padded to the capacity, except those whose length is a power of two."""
    return n if n & (n - 1) == 0 else capacity


@lru_cache(2)
def _tokenizer(folder: str | None, literal: bool = False) -> TextTokenizer:
    return TextTokenizer(folder, literal=literal)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row for each piece: where it begins in its document, where in its sequence; with_ids adds its ids as little-endian uint32 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = _tokenizer(folder), HarmonicPacker(capacity)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        rows: list[tuple] = []
        out_schema = pa.schema([(n, pa.int32() if n == "harmonic_class" else pa.int64()) for n in (x.split()[0] for x in _SCHEMA.split(", "))] + ([("ids", pa.binary())] if with_ids else []))

        def emit(bins):
            nonlocal sequence
            for b in bins:
                at, size = 0, padded(sum(x[1] for x in b), capacity)
                for (doc, start, crc, total, raw), length, k in b:
                    rows.append((doc, start, length, crc, total, sequence, at, k, size, *([raw] if with_ids else [])))
                    at += length
                sequence += 1

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), out_schema)], schema=out_schema)
            rows.clear()
            return batch

        for batch in batches:
            for part in slices(batch):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = tokenizer(text)
                    total = len(ids) + 1
                    raw = memoryview(ids.astype("<u4").tobytes() + int(end_id).to_bytes(4, "little"))
                    start = 0
                    for length in cut(total, capacity):
                        own = raw[4 * start : 4 * (start + length)]
                        emit(packer.add((doc, start, zlib.crc32(own), total, bytes(own) if with_ids else None), length))
                        start += length
                if len(rows) >= 10_000:
                    yield flush()
        emit(packer.close())
        if rows:
            yield flush()

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, _SCHEMA + (", ids binary" if with_ids else ""))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
