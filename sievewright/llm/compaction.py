"""Op 11.  Bin-packed compaction, executed.

A table is written as one Parquet file for each (day, lot, piece), sorted; then each day's small files are packed
first-fit, largest first, and every group of several becomes one file that replaces its sources.

First fit goes by a staircase: the running maximum over the groups' free rows never falls, so the earliest group with
room for a file is a binary search for the first value that reaches the file's size.  A group that has taken a file lowers
the staircase only up to the next step that a later group holds, and just this stretch is made anew.  Days are packed
apart from each other, by mapInPandas over files sorted within days; a task holds the groups of one day at a time, at
most four files a lot and, as a lot has over a 200th of all rows, some 800 in all.

Nothing that grows with the rows goes to the driver, into a broadcast or through one task: the number of lots is above one
only in days with a 200th of all rows or more, of which there are fewer than 200, and these are what is broadcast.
Files are written by one task each, which streams rows that are already sorted.  The swap follows a written plan and can be
repeated after a crash: new files are moved in under new names, then their sources are deleted.

Rows without a day are a day of their own (null in the result); a null id is dealt as an empty one, sorts first and is
written as nothing into the digest; null and undefined values count 0 cents.  Repeated rows stay; of rows with equal day
and id the other columns decide the order where they can be ordered.  Columns named like the parts of a path do not clash, the path's
names give way.  An empty table leaves an empty folder and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_folder, shared_dir

#: Shares of all rows that bound a lot, a small file and a group.
LOT_SHARE, SMALL_SHARE, GROUP_SHARE = 200, 750, 400
PIECES = 4
#: Stands for a missing day; timestamps do not reach it.
NO_DAY = -(2**31)
#: Plans of up to so many files are broadcast (their rows are six numbers), others are joined by a shuffle.
MOST_BROADCAST_FILES = 100_000
UNIT = ["day", "lot", "piece"]


def share(rows: int, x: int) -> int:
    return 1 + rows // x


class Staircase:
    """First fit into groups of ``capacity`` rows each."""

    def __init__(self, capacity: int):
        self.capacity, self.groups = capacity, 0
        self.free = np.zeros(16, np.int64)
        self.highest = np.zeros(16, np.int64)  # the most free rows in this group or an earlier one

    def place(self, size: int) -> int:
        """Number of the earliest group that takes the file; a new one if none does."""
        n = self.groups
        at = int(np.searchsorted(self.highest[:n], size))
        if at == n:
            if n == len(self.free):
                self.free, self.highest = np.append(self.free, np.zeros(n, np.int64)), np.append(self.highest, np.zeros(n, np.int64))
            self.free[n] = self.capacity - size
            self.highest[n] = max(self.free[n], self.highest[n - 1] if n else 0)
            self.groups += 1
            return n
        end = int(np.searchsorted(self.highest[:n], self.highest[at], "right"))
        self.free[at] -= size
        before = self.highest[at - 1] if at else 0
        self.highest[at:end] = np.maximum(before, np.maximum.accumulate(self.free[at:end]))
        return at


def pack_days(files: DataFrame, small: int, capacity: int) -> DataFrame:
    """(day, lot, piece, n_rows) of files to the same and (bin, place, bin_files, to_lot, to_piece): group within the day and place in it, files of the group, and its first file.

    Files of ``small`` rows or more are groups of themselves, without a bin.
    """

    columns = [*UNIT, "n_rows", "bin", "place", "bin_files", "to_lot", "to_piece"]

    def told(day: list[tuple]) -> pd.DataFrame:
        """Groups of one day's files, which come largest first."""
        stairs, bins = Staircase(capacity), []
        for r in day:
            at = stairs.place(r[3])
            if at == len(bins):
                bins.append([])
            bins[at].append(r)
        return pd.DataFrame([(*r, at, place, len(group), *group[0][1:3]) for at, group in enumerate(bins) for place, r in enumerate(group)], columns=columns)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        day: list[tuple] = []
        for frame in frames:
            for r in zip(*(frame[c].tolist() for c in columns[:4])):
                if day and r[0] != day[0][0]:
                    yield told(day)
                    day = []
                day.append(r)
        if day:
            yield told(day)

    ordered = files.where(F.col("n_rows") < small).repartition("day").sortWithinPartitions("day", F.desc("n_rows"), "lot", "piece")
    placed = ordered.select(*columns[:4]).mapInPandas(pack, ", ".join(f"{c} long" for c in columns))
    alone = [F.lit(None).cast("long").alias("bin"), F.lit(0).cast("long").alias("place"), F.lit(1).cast("long").alias("bin_files"), F.col("lot").alias("to_lot"), F.col("piece").alias("to_piece")]
    return placed.unionByName(files.where(F.col("n_rows") >= small).select(*columns[:4], *alone))


class Layout:
    """Where a compacted table lies: data files below ``data``, one folder for each day, lot and piece, beside the plan and what is staged."""

    def __init__(self, folder: str, table: DataFrame):
        self.base, self.data, self.plan, self.staged = folder, f"{folder}/data", f"{folder}/plan", f"{folder}/staged"
        mark = "unit_"
        while any(c.startswith(mark) for c in table.columns):
            mark += "x_"
        self.columns = table.columns
        self.parts = [mark + c for c in UNIT]
        self.schema = table.select(*[F.col(f"`{c}`") for c in table.columns], *[F.lit(0).cast("long").alias(p) for p in self.parts]).schema
        self.spark = table.sparkSession
        self._path = self.spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.data)

    def written_columns(self) -> list[str]:
        """Names as they stand in the files."""
        names = self.spark.read.option("mergeSchema", "true").parquet(self.data).columns
        return [c for c in names if c not in self.parts]

    def file(self, path: str):
        return self._fs, self._path(path)

    def unit(self, root: str, day: int, lot: int, piece: int) -> str:
        return root + "".join(f"/{c}={v}" for c, v in zip(self.parts, (day, lot, piece)))


def day_number(ts: Column, kind: str) -> Column:
    """Whole days since 1970: of the wall clock for times without a zone, in UTC for others."""
    whole = F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)) if kind == "timestamp" else F.unix_date(ts.cast("date"))
    return F.coalesce(whole.cast("long"), F.lit(NO_DAY).cast("long"))


def write_units(table: DataFrame, layout: Layout, ts_col: str, id_col: str) -> int:
    """Write one sorted file for each day, lot and piece; returns the number of rows."""
    kind = dict(table.dtypes)[ts_col]
    day = day_number(F.col(f"`{ts_col}`"), "timestamp" if kind == "timestamp" else kind)
    counts = table.select(day.alias(layout.parts[0])).groupBy(layout.parts[0]).agg(F.count("*").alias("rows"))
    rows = counts.agg(F.sum("rows").alias("n")).first().n or 0
    if not rows:
        return 0
    lot_rows = share(rows, LOT_SHARE)
    busy = counts.where(F.col("rows") >= lot_rows).select(layout.parts[0], (1 + F.floor(F.col("rows") / lot_rows)).alias("rows"))
    lots = F.create_map(*[F.lit(x) for r in busy.collect() for x in (r[0], r[1])])  # fewer than LOT_SHARE days can have so many rows
    h = F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    d, lot, piece = (F.col(c) for c in layout.parts)
    number = F.coalesce(F.try_element_at(lots.cast("map<bigint,bigint>"), d), F.lit(1)) if rows >= lot_rows else F.lit(1)
    ties = [F.col(f"`{f.name}`") for f in table.schema.fields if f.name not in (ts_col, id_col) and f.dataType.typeName() not in ("map", "variant", "array", "struct")]
    units = table.withColumn(layout.parts[0], day)
    units = units.withColumn(layout.parts[1], (F.floor(h / 16) % number).cast("long")).withColumn(layout.parts[2], F.least(h % PIECES, F.floor(h / PIECES) % PIECES).cast("long"))
    ordered = units.repartition(d, lot, piece).sortWithinPartitions(d, lot, piece, F.col(f"`{ts_col}`"), F.col(f"`{id_col}`"), *ties)
    ordered.write.partitionBy(*layout.parts).parquet(layout.data)
    return rows


def compact(layout: Layout, small: int, capacity: int) -> None:
    """Pack the files of ``layout`` and put each group of several into one, in the order in which they joined."""
    spark, (d, lot, piece) = layout.spark, layout.parts
    files = layout.read().groupBy(*layout.parts).agg(F.count("*").alias("n_rows")).withColumnsRenamed(dict(zip(layout.parts, UNIT)))
    pack_days(files, small, capacity).write.mode("overwrite").parquet(layout.plan)
    plan = spark.read.parquet(layout.plan)
    moved = plan.where("bin_files > 1").select(F.col("day").alias(d), F.col("lot").alias(lot), F.col("piece").alias(piece), "place", "to_lot", "to_piece")
    if (n := moved.count()) == 0:
        return
    marks = {c: f"{layout.parts[0]}_{c}" for c in ("place", "to_lot", "to_piece", "row")}
    moved = moved.withColumnsRenamed(marks)
    source = layout.read().withColumn(marks["row"], F.col("_metadata.row_index")).join(F.broadcast(moved) if n <= MOST_BROADCAST_FILES else moved, layout.parts)
    rows = source.select(*[F.col(f"`{c}`") for c in layout.columns], d, F.col(marks["to_lot"]).alias(lot), F.col(marks["to_piece"]).alias(piece), marks["place"], marks["row"])
    # rows of one target are together and in order; two numbers beside the table's columns are left out of the files
    ordered = rows.repartition(d, lot, piece).sortWithinPartitions(d, lot, piece, marks["place"], marks["row"]).drop(marks["place"], marks["row"])
    ordered.write.mode("overwrite").partitionBy(*layout.parts).parquet(layout.staged)
    swap(layout)


def swap(layout: Layout) -> None:
    """Move staged files in and delete their sources.  May be repeated: what is moved or deleted already is passed over."""
    spark = layout.spark
    plan = spark.read.parquet(layout.plan).where("bin_files > 1").select(*UNIT, "place", "to_lot", "to_piece")
    for r in plan.orderBy("day", "to_lot", "to_piece", "place").toLocalIterator():
        fs, target = layout.file(layout.unit(layout.data, r.day, r.to_lot, r.to_piece))
        _, staged = layout.file(layout.unit(layout.staged, r.day, r.to_lot, r.to_piece))
        if r.place == 0:
            # sources of the target's own folder are told from the new file by its name
            new = [s.getPath() for s in fs.listStatus(staged) if s.getPath().getName().startswith("part-")] if fs.exists(staged) else []
            for path in new:
                fs.rename(path, layout.file(f"{target}/compact-{path.getName()}")[1])
            names = [s.getPath() for s in fs.listStatus(target)]
            if any(p.getName().startswith("compact-") for p in names):
                for p in names:
                    if not p.getName().startswith("compact-"):
                        fs.delete(p, False)
        else:
            fs.delete(layout.file(layout.unit(layout.data, r.day, r.lot, r.piece))[1], True)
    drop_folder(spark, layout.staged)


def file_digests(rows: DataFrame, keys: list[str], order: str, id_col: str) -> DataFrame:
    """(keys, ids_sha256): sha256 of the comma-joined ids in the order of each file; a task streams its files one after the other."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, state = None, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in unit], pa.array([state.hexdigest()])], [*keys, "ids_sha256"])

        for batch in batches:
            if not batch.num_rows:
                continue
            units = np.stack([batch.column(i).to_numpy() for i in range(len(keys))])
            cuts = [0, *(np.flatnonzero((units[:, 1:] != units[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            ids = batch.column(len(keys)).to_pylist()
            for a, b in zip(cuts, cuts[1:]):
                here = tuple(units[:, a].tolist())
                text = ",".join(["" if x is None else x for x in ids[a:b]])
                if here != unit:
                    if unit is not None:
                        yield told()
                    unit, state = here, hashlib.sha256(text.encode())
                else:
                    state.update(("," + text).encode())
        if unit is not None:
            yield told()

    ordered = rows.select(*keys, F.col(f"`{id_col}`").cast("string").alias("id"), F.col(order).alias("at")).repartition(*keys).sortWithinPartitions(*keys, "at").drop("at")
    return ordered.mapInArrow(digest, ", ".join(f"{k} long" for k in keys) + ", ids_sha256 string")


def describe(layout: Layout, id_col: str, value_col: str) -> DataFrame:
    """A row for each final file, read from the files themselves and the plan."""
    rows = layout.read().select(*[F.col(p).alias(u) for p, u in zip(layout.parts, UNIT)], F.col(f"`{id_col}`").alias("id"), F.col(f"`{value_col}`").alias("v"), F.col("_metadata.row_index").alias("at"), F.col("_metadata.file_path").alias("path"))
    cents = F.floor(100 * F.col("v") + 0.5)
    sums = rows.groupBy(*UNIT, "path").agg(F.count("*").alias("n_rows"), F.min("id").alias("min_click_id"), F.max("id").alias("max_click_id"), F.coalesce(F.sum(F.when(F.isnan("v"), 0).otherwise(cents)), F.lit(0)).cast("long").alias("cents"))
    digests = file_digests(rows, UNIT, "at", "id")
    plan = layout.spark.read.parquet(layout.plan)
    # a group has no more members than its day has files, some 800
    sources = plan.groupBy("day", F.col("to_lot").alias("lot"), F.col("to_piece").alias("piece")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "lot", "piece"))), lambda s: F.concat(s["lot"].cast("string"), F.lit("-"), s["piece"].cast("string"))), ",").alias("sources"), (F.count("*") > 1).alias("rewritten"))
    out = sums.join(digests, UNIT).join(sources, UNIT)
    return out.select(F.when(F.col("day") != NO_DAY, F.col("day")).alias("day"), "lot", "piece", "n_rows", "min_click_id", "max_click_id", "cents", "sources", "ids_sha256", F.lit(",".join(layout.written_columns())).alias("columns"), "path", "rewritten")


def compacted(table: DataFrame, ts_col: str, id_col: str, value_col: str, folder: str | None = None) -> DataFrame:
    """Write ``table`` into a new folder, compact it there, and describe the files that are left."""
    spark = table.sparkSession
    layout = Layout(folder or f"{shared_dir(spark)}/compaction-{uuid.uuid4().hex}", table)
    rows = write_units(table, layout, ts_col, id_col)
    if not rows:
        fs, p = layout.file(layout.data)
        fs.mkdirs(p)
        return spark.createDataFrame([], "day long, lot long, piece long, n_rows long, min_click_id long, max_click_id long, cents long, sources string, ids_sha256 string, columns string, path string, rewritten boolean")
    compact(layout, share(rows, SMALL_SHARE), share(rows, GROUP_SHARE))
    return describe(layout, id_col, value_col)


def op11_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks as one file for each day, lot and piece under the shared folder, then compacted there."""
    return compacted(spark.read.parquet(f"{sf_dir}/clicks.parquet"), "arrived_at", "click_id", "value")
