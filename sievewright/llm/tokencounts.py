"""Op 1.  Token counts by separator scan.

Flat token files hold 16-bit little-endian ids of many documents, each followed by the separator, and nothing
else: no index, no lengths.  The scan cuts the files into blocks at fixed offsets, which need not be document
ends.  In each block one vectorised comparison finds the separators; the block reports how many it has, how
many tokens stand before the first and after the last, and the lengths of the documents that lie inside it.  A
prefix scan over the blocks' reports (counts, and tokens since the last separator) gives each block the ordinal
of its first document and the tokens it inherits, so documents that cross any number of blocks are stitched
without moving tokens.  The scan runs per file in a window over block reports, a few numbers for each block.

Null and empty texts are documents of no tokens.  Repeated rows count each for itself; an empty table gives no
rows.  A file's last document may lack its separator; it counts if it has tokens.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table, shared_dir, slices
from .packing import _tokenizer
from .tokens import SEPARATOR

BLOCK_TOKENS = 1 << 20


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", separator: int = SEPARATOR, vocabulary_folder: str | None = None) -> DataFrame:
    """Each task writes one flat file into ``folder``; returned (and to be written once) is which documents it holds, in order.

    A task writes under a name of its own attempt and the rows it returns carry that name, so a second attempt
    or a lost executor leaves at most a file that no row names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId() if task else 0:06d}-{uuid.uuid4().hex}.u16"
        tokenizer, ordinal, sink = _tokenizer(vocabulary_folder, literal=True), 0, None
        end = np.array([separator], "<u2").tobytes()
        for batch in batches:
            for part in slices(batch):
                if sink is None:
                    fs.create_dir(path, recursive=True)
                    sink = fs.open_output_stream(os.path.join(path, name))
                for text in part.column(1).to_pylist():
                    sink.write(tokenizer(text).astype("<u2").tobytes())
                    sink.write(end)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n))], ["doc_id", "file", "ordinal"])
                ordinal += n
        if sink is not None:
            sink.close()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, file string, ordinal long")


def token_blocks(spark: SparkSession, folder: str, files: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, block: the blocks of the files named in ``files.file``, from their sizes alone."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = fs.get_file_info([os.path.join(path, n) for n in names])
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([f.size // 2 for f in found], pa.int64())], ["file", "tokens"])

    sized = files.select("file").distinct().mapInArrow(sizes, "file string, tokens long")
    return sized.where("tokens > 0").select("file", F.explode(F.expr(f"sequence(0L, (tokens - 1) div {block_tokens})")).alias("block"))


def scan_blocks(folder: str, blocks: DataFrame, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The report of each block: separators, tokens before the first and after the last, and lengths between them (uint32 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        for batch in batches:
            for file, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(os.path.join(path, file)) as f:
                    ids = np.frombuffer(f.read_at(2 * block_tokens, 2 * block_tokens * block), "<u2")
                at = np.flatnonzero(ids == separator)
                first, last = (int(at[0]), len(ids) - 1 - int(at[-1])) if len(at) else (len(ids), len(ids))
                inside = (np.diff(at) - 1).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block]), pa.array([len(at)]), pa.array([first]), pa.array([last]), pa.array([inside], pa.binary())], ["file", "block", "separators", "head", "tail", "inside"])

    return blocks.mapInArrow(run, "file string, block long, separators long, head long, tail long, inside binary")


def stitch(reports: DataFrame) -> DataFrame:
    """file, ordinal, tokens of every document, by a prefix scan over the blocks of each file."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Tokens since the last separator before this block: the running sum of tails, less what it was at the last block with a separator.
    scan = reports.select("*", F.coalesce(F.sum("separators").over(before), F.lit(0)).alias("first_ordinal"))
    scan = scan.withColumn("group", F.col("first_ordinal"))
    # Blocks that share first_ordinal form a run after the last block with a separator; that block's own tail belongs to the run.
    last_tail = F.last(F.when(F.col("separators") > 0, F.col("tail")), ignorenulls=True).over(before)
    run = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = scan.withColumn("carried", F.coalesce(last_tail, F.lit(0)) + F.coalesce(F.sum(F.when(F.col("separators") == 0, F.col("tail"))).over(run), F.lit(0)))

    def run_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, n, head, inside, first, carried in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if n:
                    lengths = np.concatenate([[head + carried], np.frombuffer(inside, "<u4").astype(np.int64)])
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(np.arange(first, first + n)), pa.array(lengths)], ["file", "ordinal", "tokens"])

    whole = scan.select("file", "separators", "head", "inside", "first_ordinal", "carried").mapInArrow(run_out, "file string, ordinal long, tokens long")
    # A last document without its separator.
    open_end = scan.groupBy("file").agg(F.sum("separators").alias("ordinal"), F.max_by(F.when(F.col("separators") > 0, F.col("tail")).otherwise(F.col("tail") + F.col("carried")), "block").alias("tokens")).where("tokens > 0")
    return whole.unionByName(open_end)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id and tokens of every document, counted by scanning flat token files that are written for it."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    held = materialize(write_token_files(docs, folder, id_col, text_col), "token-order")
    reports = scan_blocks(folder, token_blocks(spark, folder, held, block_tokens), block_tokens=block_tokens)
    # merge: both sides have a row for each text; consecutive numbers shrink so much in the file that it would look small enough to broadcast
    return held.hint("merge").join(stitch(reports), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "tokens")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(read_table(spark, sf_dir, "documents"))
    return counts.select("doc_id", F.col("tokens").alias("n_tokens"))
