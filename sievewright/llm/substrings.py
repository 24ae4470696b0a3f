"""Op 9.  Exact removal of repeated substrings, by blockwise suffix sorting.

Every byte covered by a 100-byte string that also starts earlier (smaller id, or earlier in the same text) goes.
Sorting all suffixes of the corpus at once would ship each of them; instead the suffixes of a 100-byte string are put
into the bucket of an anchor that the string itself names: its 24-byte gram of least hash.  Equal strings have the same
anchor at the same place, so each bucket can be sorted alone.  Neighbouring strings with one anchor travel as one run.

1.  Runs with equal bytes: all but the earliest are repeats as a whole, found by 64-bit hashes of the runs; a task
    already settles those that it meets again itself, so an often repeated passage sends a row for each task, not for
    each text.
2.  Anchors with several different runs: their bytes are gathered once for each different run, and one bucket of
    anchors is sorted at a time into the order of its suffixes.  Long ties are resolved by ranks computed before: cover
    samples, the positions of a difference cover modulo 13 counted from the anchor, are ranked by their next 94 bytes;
    a suffix is ordered by its first 13 bytes, then by the rank of its first cover sample, then by its last 13 bytes.
    Neighbours in that order that are equal are repeats.  A bucket's memory is bounded by its rows.
3.  Anchors with over ``hot_rows`` different runs (edges of passages that very many texts share) are never gathered
    into one bucket: their strings are aggregated one by one under 128-bit hashes, with the same result.

Counting cover positions from the anchor instead of from the text's begin makes equal strings of different texts
hit the same samples, which a position-based cover cannot when the text is split over machines.

Null and empty texts have no bytes and lose none.  Rows that repeat an id and its text are the same document; rows that
share an id but not the text are documents of their own, in the order of a hash of their texts (within a document starts
carry the number of the text, times ``APART``).  Rows without an id are returned as they are.  Texts under 100 bytes are
kept.  Ties do not occur: of equal strings the one that starts first stays.  Only the id and text columns are read,
whatever the names of others.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import buffers, drop_materialized, materialize, mix, prefix_hash, read_table, slices, span_hash

LENGTH, GRAM = 100, 24
#: A perfect difference cover: every residue modulo 13 is a difference of two of its members (fixed values).
COVER, MODULUS = (0, 1, 3, 9), 13
SAMPLE = LENGTH - 6  # from any residue the next cover position is at most 5 bytes on
HOT_ROWS = 20_000
#: Texts that share an id lie so far apart in its numbering of starts.
APART = 1 << 40
#: Up to so many ids with several texts are sent to the texts; more meet them by a shuffle.
MOST_BROADCAST_IDS = 100_000
BUCKET_ROWS = 4000
_NEXT_COVER = np.array([next(d for d in range(MODULUS) if (r + d) % MODULUS in COVER) for r in range(MODULUS)])


def runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Maximal runs of windows with one anchor: begin in the buffer, windows, anchor's place in the run, hash of the anchor and of the run's bytes, text index."""
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    h = span_hash(prefix, at, at + gram)
    v = (h >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)  # a slice has under 2**31 bytes, as Arrow's strings do
    width, least, have = length - gram + 1, v, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(v) - width + 1], least[width - have : len(v) - have + 1])
    anchor = (least & np.uint64((1 << 32) - 1)).astype(np.int64)
    p = np.arange(len(anchor))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(anchor)]
    valid = p + length <= off[1:][doc]
    p, doc, anchor = p[valid], doc[valid], anchor[valid]
    if not len(p):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    new = np.ones(len(p), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(p)))
    begin, a, doc = p[first], anchor[first], doc[first]
    place = a - begin
    whole = mix(span_hash(prefix, begin, begin + n - 1 + length) ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return begin, n, place, h[a], whole, doc


def numbered_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, base and rest (the other columns): base is 0, or for ids with several texts the number of the text in order of its hash, times APART."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col])
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), rest.alias("rest"))
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    hashed = named.where("doc_id is not null").select("doc_id", h.alias("h"))
    several = materialize(hashed.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("doc_id"), "several")
    n = several.count()
    if not n:
        drop_materialized(several)
        return named.select("doc_id", "text", F.lit(0).cast("long").alias("base"), "rest")
    ids = F.broadcast(several) if n <= MOST_BROADCAST_IDS else several  # a checked size
    order = Window.partitionBy("doc_id").orderBy("h")
    ranks = hashed.join(ids, "doc_id", "left_semi").distinct().select("doc_id", "h", ((F.row_number().over(order) - 1).cast("long") * APART).alias("base"))
    ranks = materialize(ranks, "several-ranks")
    ranks = F.broadcast(ranks) if ranks.count() <= MOST_BROADCAST_IDS else ranks  # a checked size
    return named.withColumn("h", h).join(ranks, ["doc_id", "h"], "left").select("doc_id", "text", F.coalesce("base", F.lit(0).cast("long")).alias("base"), "rest")


def run_table(texts: DataFrame, most_seen: int = 200_000) -> DataFrame:
    """The runs of texts (doc_id, text, base); later: the run repeats an earlier one of the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, int]] = {}
        for batch in batches:
            for part in slices(batch, most_docs=4096):
                data, off = buffers(part.column(1))
                begin, n, place, anchor, whole, doc = runs(data, off)
                start = begin - off[:-1][doc] + part.column(2).to_numpy()[doc]
                own = part.column(0).to_numpy()[doc]
                later = np.zeros(len(own), bool)
                for i, (w, d, s) in enumerate(zip(whole.tolist(), own.tolist(), start.tolist())):
                    old = seen.get(w)
                    if old is None or (d, s) <= old:
                        seen[w] = (d, s)
                    else:
                        later[i] = True
                if len(seen) > most_seen:  # keep the runs that may come again soon; a run that is forgotten is sent once more
                    seen = dict(list(seen.items())[most_seen // 2 :])
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(start), pa.array((n << 8 | place).astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(later)], ["doc_id", "start", "meta", "anchor", "run", "later"])

    return texts.where("doc_id is not null").select("doc_id", "text", "base").mapInArrow(run, "doc_id long, start long, meta int, anchor long, run long, later boolean")


def gather(texts: DataFrame) -> DataFrame:
    """Bytes of the runs listed in ``runs`` of each text (doc_id, text, base, runs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: list[tuple] = []
                data, off = buffers(part.column(1))
                for i, (doc, base, listed) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3).to_pylist())):
                    for r in listed:
                        a = off[i] + r["start"] - base
                        out.append((r["anchor"], doc, r["start"], r["meta"], data[a : min(a + (r["meta"] >> 8) - 1 + LENGTH, off[i + 1])].tobytes(), r["rows"]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["anchor", "doc_id", "start", "meta", "bytes", "rows"])

    return texts.mapInArrow(run, "anchor long, doc_id long, start long, meta int, bytes binary, rows long")


def _words(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Rows of n bytes at the given places, as one void column."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, n)[at]).view(np.dtype((np.void, n))).ravel()


def suffix_order(anchor: np.ndarray, place: np.ndarray, n: np.ndarray, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row and offset of every 100-byte suffix of a bucket's runs, in order of anchor, place and bytes, and whether it differs from its neighbour before.

    Cover samples are ranked first, each by its next 94 bytes; suffixes of one anchor and place that share their first 13
    bytes have their first cover sample equally far on, so its rank settles all that follows but the last 13 bytes.
    """
    base = np.cumsum(size) - size
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    inside = j + LENGTH <= size[row]
    row, j = row[inside], j[inside]
    at, step = base[row] + j, _NEXT_COVER[(j - place[row]) % MODULUS]
    sample, back = np.unique(at + step, return_inverse=True)
    _, rank = np.unique(_words(data, sample, SAMPLE), return_inverse=True)
    key = np.empty(len(at), [("anchor", ">u8"), ("place", ">i8"), ("head", "V13"), ("rank", ">i8"), ("tail", "V13")])
    key["anchor"], key["place"], key["rank"] = anchor.view(np.uint64)[row], place[row] - j, rank[back]
    key["head"], key["tail"] = _words(data, at, MODULUS), _words(data, at + LENGTH - MODULUS, MODULUS)
    flat = key.view(np.dtype((np.void, key.itemsize)))  # big-endian numbers: the order of bytes is the order of keys
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    return row[order], j[order], order, new


def sort_bucket(anchor: np.ndarray, doc: np.ndarray, start: np.ndarray, meta: np.ndarray, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(id, start) of every suffix in a bucket whose first 100 bytes also start earlier in it."""
    data, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(b) for b in raw])
    row, j, _, new = suffix_order(anchor, meta & 255, meta >> 8, data, size)
    d, s, group = doc[row], start[row] + j, np.cumsum(new) - 1
    order = np.lexsort((s, d, group))  # groups of equal suffixes, each from its earliest on
    d, s, group = d[order], s[order], group[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    lead = np.repeat(first, np.diff(np.append(first, len(group))))
    later = (d != d[lead]) | (s != s[lead])
    return d[later], s[later]


def _as_runs(d: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d)) - 1
    return d[first], s[first], s[last] - s[first] + 1


def sort_buckets(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, start, n: runs of windows that repeat earlier ones.  Rows come grouped by anchor; whole groups fill one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts)
            cols = [t.column(c).to_numpy() for c in ("anchor", "doc_id", "start", "meta")]
            d, s = sort_bucket(*cols, t.column("bytes").to_pylist())
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _as_runs(d, s)], ["doc_id", "start", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, bucket_rows):
                part = batch.slice(at, bucket_rows)
                if held and sum(p.num_rows for p in held) >= bucket_rows:
                    last = held[-1].column(0)[held[-1].num_rows - 1].as_py()
                    a = part.column(0).to_numpy()
                    same = int(np.argmax(a != last)) if (a != last).any() else len(a)
                    if same:
                        held.append(part.slice(0, same))
                    if same < len(a):
                        yield settle(held)
                        held = [part.slice(same)]
                else:
                    held.append(part)
        if held:
            yield settle(held)

    return rows.mapInArrow(run, "doc_id long, start long, n long")


def single_windows(rows: DataFrame) -> DataFrame:
    """Windows of hot anchors one by one, under 128 bits of hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BUCKET_ROWS):
                part = batch.slice(begin, BUCKET_ROWS)
                raw = part.column(4).to_pylist()
                data, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(b) for b in raw])
                n, base = part.column(3).to_numpy() >> 8, np.cumsum(size) - size
                row = np.repeat(np.arange(len(n)), n)
                j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                row, j = row[j + LENGTH <= size[row]], j[j + LENGTH <= size[row]]
                p, at = prefix_hash(data), base[row] + j
                one, two = span_hash(p, at, at + LENGTH), mix(span_hash(p, at, at + 61) * np.uint64(3) + span_hash(p, at + 39, at + LENGTH))
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(part.column(1).to_numpy()[row]), pa.array(part.column(2).to_numpy()[row] + j)], ["h1", "h2", "doc_id", "start"])

    return rows.mapInArrow(run, "h1 long, h2 long, doc_id long, start long")


def repeated_runs(texts: DataFrame, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, start, n of the windows that repeat earlier ones, written; the tables on the way are deleted."""
    table = materialize(run_table(texts), "runs")
    seen = table.where("not later")
    # every different run with its earliest place, added up before the shuffle; then the different runs of every anchor
    different = materialize(seen.groupBy("anchor", "run").agg(F.min(F.struct("doc_id", "start", "meta")).alias("lead"), F.count(F.lit(1)).alias("c")), "different")
    mixed = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    found = materialize(different.join(mixed, "anchor").select("anchor", "lead.doc_id", "lead.start", "lead.meta", "rows"), "found")
    again = seen.join(different.where("c > 1").select("anchor", "run", "lead"), ["anchor", "run"]).where("lead.doc_id <> doc_id or lead.start <> start")
    n = F.expr("cast(shiftright(meta, 8) as long)").alias("n")
    whole = materialize(again.select("doc_id", "start", n).unionByName(table.where("later").select("doc_id", "start", n)), "whole")
    drop_materialized(table, different)
    open_ = found.groupBy("doc_id", F.expr(f"start div {APART} * {APART}").alias("base")).agg(F.collect_list(F.struct("anchor", "start", "meta", "rows")).alias("runs"))
    gathered = materialize(gather(texts.where("doc_id is not null").join(open_, ["doc_id", "base"]).select("doc_id", "text", "base", "runs")), "gathered")
    cold = gathered.where(F.col("rows") <= hot_rows).repartition("anchor").sortWithinPartitions("anchor")
    settled = sort_buckets(cold, bucket_rows)
    hot = single_windows(gathered.where(F.col("rows") > hot_rows))
    leads = hot.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start")).alias("lead"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    late = hot.join(leads, ["h1", "h2"]).where("lead.doc_id <> doc_id or lead.start <> start").select("doc_id", "start", F.lit(1).cast("long").alias("n"))
    out = materialize(whole.unionByName(settled).unionByName(late), "repeats")
    drop_materialized(found, gathered, whole)
    return out


def kept_parts(raw: np.ndarray, start: np.ndarray, n: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, int, int]:
    """Bytes that stay, how many go, and in how many maximal spans."""
    mark = np.zeros(len(raw) + 1, np.int32)
    np.add.at(mark, np.minimum(start, len(raw)), 1)
    np.add.at(mark, np.minimum(start + n - 1 + length, len(raw)), -1)
    gone = np.cumsum(mark[:-1]) > 0
    spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
    return raw[~gone], int(gone.sum()), spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS, as_col: str = "cut") -> DataFrame:
    """The rows given with a struct ``as_col`` (no column of that name may be given): n_bytes, n_removed, n_spans, kept_sha256 and kept, the text that stays, null where nothing goes (bytes that a cut leaves of a character are left out of it)."""
    texts = numbered_texts(docs, id_col, text_col)
    late = repeated_runs(texts, hot_rows)
    # rows without an id meet no other and are dealt by their texts
    key = F.coalesce("doc_id", F.xxhash64("text"))
    per_text = late.groupBy("doc_id", F.expr(f"start div {APART} * {APART}").alias("base")).agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    per_text = per_text.select(F.col("doc_id").alias("key"), F.lit(True).alias("named"), "base", "starts", "ns")
    keyed = texts.select("rest", "text", "base", key.alias("key"), F.col("doc_id").isNotNull().alias("named"))
    found = keyed.join(per_text, ["key", "named", "base"], "left").select("rest", "text", "base", "starts", "ns")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = buffers(part.column(1))
                rows = []
                for i, (base, starts, ns) in enumerate(zip(part.column(2).to_pylist(), part.column(3), part.column(4))):
                    own = data[off[i] : off[i + 1]]
                    kept, gone, spans = kept_parts(own, starts.values.to_numpy() - base if starts.is_valid else none, ns.values.to_numpy() if ns.is_valid else none)
                    raw = kept.tobytes()
                    rows.append((len(own), gone, spans, hashlib.sha256(raw).hexdigest(), raw.decode("utf-8", "ignore") if gone else None))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)], ["rest", "text", "cut"])

    rest = found.schema["rest"].dataType
    shape = StructType([StructField("rest", rest), StructField("text", StringType()), StructField("cut", StructType([StructField(n, StringType() if t == pa.string() else LongType()) for n, t in zip(names, kinds)]))])
    out = found.mapInArrow(run, shape)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in docs.columns], F.col("cut").alias(as_col))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(F.col("doc_id").cast("long").alias("doc_id"), "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256")
