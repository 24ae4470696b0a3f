"""What the operators of this subpackage share: the shared folder, Arrow slices and folds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy kernel call handles; a longer single text is handled alone.
SLICE_BYTES = 1_000_000
SLICE_DOCS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session that names none, as in tests, gets a temporary one; on a cluster a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sievewright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str, level: int = 3, page_bytes: int = 1 << 20) -> DataFrame:
    """Write ``df`` as Parquet (zstd of the given level, pages of about so many bytes, each compressed by itself) into the shared folder and return it read back: this cuts lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).option("parquet.page.size", str(page_bytes)).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._sievewright_path = path
    return back


def drop_materialized(*frames: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing will read again."""
    for df in frames:
        drop_folder(df.sparkSession, getattr(df, "_sievewright_path", None))


def drop_folder(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % n, F.lit(0)).cast("int")


def bound_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Arrow batches of at most so many rows and bytes: texts are long, and a batch stands in the JVM and in Python at once."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is not None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array (null: empty) and the offset of each text, then of the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", most_bytes: int = SLICE_BYTES, most_docs: int = SLICE_DOCS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no part holds over ``most_bytes`` of text (a single longer text stands alone) or ``most_docs`` rows."""
    if not batch.num_rows:
        return
    _, off = buffers(batch.column(batch.schema.get_field_index(column)))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(off, off[begin] + most_bytes, "right")) - 1
        end = min(max(end, begin + 1), begin + most_docs, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


# --- words and hashes of byte buffers -------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_PINV = np.uint64(pow(int(_P), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_P, _PINV)):
            a = np.full(n + n // 4 + 1, base, np.uint64)
            a[0] = 1
            _POWERS[i] = np.multiply.accumulate(a)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hashes (mod 2**64) of a buffer; :func:`span_hash` reads any span from them."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [begin, end): equal for equal bytes wherever they stand."""
    _, down = _powers(len(prefix))
    return mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word ``[^\\x20\\x09-\\x0D]+``, and for each text the index of its first word, then of the end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    b = np.flatnonzero(begin)
    return b, np.flatnonzero(end) + 1, np.searchsorted(b, off)
