"""Op 12.  Fingerprints of texts by a randomised edit embedding.

A walker reads a text while a clock ticks.  At every tick it writes down the character under it, and a shared random bit, drawn
for the tick and the character, tells whether it moves on.  Two texts that differ by a few edits are walked alike
again soon after each of them, so edit distance becomes Hamming distance between what was written.  For a character the walker waits
until its next tick with a bit of one, so a table of waiting times (character class by clock, the clock modulo 4096)
leads from each character to the next in one step.  Many texts walk at once, a column of characters at a time;
when few are left, these walk on alone.

Bits of what was written are sampled at 256 shared ticks.  A text of n characters is walked in about 2n ticks; each sample
takes, of an endless random list of record ticks of its own, the last one below 2n.  So samples spread evenly over texts of any
length, whole texts are seen, and texts of nearly the same length share nearly all ticks.  A sample is four bits of a hash of tick
and character, a hex digit of the fingerprint.  The likeness of two fingerprints is the share of equal digits, less what chance gives.

Near texts are found by bands: digits of several samples are a join key, texts that share one are candidates, and
these are verified by all their digits.

Null texts are empty texts, whose fingerprints are equal.  The next text is that of the next row in descending order of id
(rows without an id last), then of a hash of the text; after the last comes the first, and a single row follows itself.  Rows that repeat an id are rows
of their own.  Texts of any length are walked whole.  Columns other than id and text do not matter.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, mix, read_table, slices

SAMPLES, BAND, BANDS = 256, 4, 64
#: Clock period, classes of characters, and the walks below which each goes on alone.
PERIOD, CLASSES, FEW = 4096, 512, 64
#: No text is walked for so many ticks.
FARTHEST = 1 << 40
LEAST = 0.8
#: Bytes of text that walk together.
SLICE_BYTES = 2_500_000
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _waits() -> np.ndarray:
    """Ticks that a walker spends on a character of a class when it arrives at a tick (modulo PERIOD)."""
    bits = np.random.default_rng(12).integers(0, 2, (CLASSES, PERIOD), dtype=np.int64)
    out = np.zeros((CLASSES, 2 * PERIOD), np.int64)
    ahead = np.full(CLASSES, PERIOD)
    for t in range(2 * PERIOD - 1, -1, -1):  # twice around, so that the last ticks see the first
        ahead = np.where(bits[:, t % PERIOD] == 1, 1, ahead + 1)
        out[:, t] = ahead
    return np.ascontiguousarray(out[:, :PERIOD])


class Embedding:
    """Walks and samples; made anew in each task from fixed seeds."""

    def __init__(self):
        self.waits = _waits().ravel()
        self.lists = [row.tolist() for row in self.waits.reshape(CLASSES, PERIOD)]
        random = np.random.default_rng(29)
        self.salt = random.integers(0, 2**63, SAMPLES, dtype=np.uint64)
        # record ticks of each sample: the next record after t lies beyond s with probability t / s
        records = [np.zeros(SAMPLES, np.int64)]
        while records[-1].min() < FARTHEST:
            records.append(np.minimum((records[-1] + 1) / random.random(SAMPLES) + 1, 4 * FARTHEST).astype(np.int64))
        self.records = np.stack(records, 1)

    def ticks(self, horizon: np.ndarray) -> np.ndarray:
        """(text, sample): the last record tick below each horizon (0 for none)."""
        return np.stack([r[np.searchsorted(r, np.maximum(horizon, 1)) - 1] for r in self.records], 1)

    def walk(self, kinds: np.ndarray, off: np.ndarray, clock: np.ndarray) -> np.ndarray:
        """The tick at which each character is first written; ``kinds`` holds class numbers, ``clock`` the first tick of each text."""
        out = np.zeros(len(kinds), np.int64)
        sizes = np.diff(off)
        order = np.argsort(-sizes, kind="stable")
        begin, now = off[:-1][order], clock[order].copy()
        base = kinds * PERIOD
        reach = np.searchsorted(-sizes[order], -np.arange(1, (sizes.max() if len(sizes) else 0) + 1), "right")  # texts that have an i-th character
        walking = int(np.searchsorted(-reach, -FEW, "left")) if len(reach) else 0
        waits = self.waits
        for i, k in enumerate(reach[:walking].tolist()):
            at, t = begin[:k] + i, now[:k]
            out[at] = t
            t += waits[base[at] + (t & (PERIOD - 1))]
        for k in range(int(reach[walking]) if walking < len(reach) else 0):
            a, b, t, found = int(begin[k]) + walking, int(begin[k] + sizes[order[k]]), int(now[k]), []
            for kind in kinds[a:b].tolist():
                found.append(t)
                t += self.lists[kind][t & (PERIOD - 1)]
            out[a:b], now[k] = found, t
        ends = np.zeros(len(sizes), np.int64)
        ends[order] = now
        return out, ends

    def digits(self, points: np.ndarray, first: np.ndarray, off: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(text, sample): hex digits of the fingerprints; ``first`` holds first ticks as of :meth:`walk`."""
        n = np.diff(off)
        ticks = self.ticks(2 * n)
        # first ticks rise within a text; moved apart by text they can be searched all at once
        span = int(max(ends.max(initial=0), ticks.max(initial=0))) + 1
        shift = np.arange(len(n), dtype=np.int64) * span
        at = np.searchsorted(first + np.repeat(shift, n), (ticks + shift[:, None]).ravel(), "right").reshape(ticks.shape) - 1
        inside = (ticks < ends[:, None]) & (n[:, None] > 0)
        c = np.where(inside, points[np.clip(at, 0, max(len(points) - 1, 0))] + 1 if len(points) else 0, 0)  # 0 is written when the text is at its end
        return (mix(c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ticks.astype(np.uint64) + self.salt[None]) >> np.uint64(60)).astype(np.uint8)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), off


def _kinds(points: np.ndarray) -> np.ndarray:
    return points % CLASSES


def fingerprints(texts: list[str], e: Embedding) -> tuple[np.ndarray, tuple]:
    """Digits of whole texts, and what was walked."""
    points, off = _points(texts)
    first, ends = e.walk(_kinds(points), off, np.zeros(len(texts), np.int64))
    return e.digits(points, first, off, ends), (points, off, first, ends)


def edited(texts: list[str], ahead: list[str], walked: tuple, e: Embedding) -> tuple[list[str], np.ndarray]:
    """Texts whose last third gave way to the begin of the next, and their digits; the part that stays is not walked again."""
    points, off, first, ends = walked
    n = np.diff(off)[: len(texts)]
    cut = n - n // 3
    new = [t[:k] + a[: len(t) - k] for t, k, a in zip(texts, cut.tolist(), ahead)]
    tails = [t[k:] for t, k in zip(new, cut.tolist())]
    tail_points, tail_off = _points(tails)
    # the tick at which the walker leaves what stays
    safe = np.minimum(off[:-1][: len(texts)] + cut, max(len(first) - 1, 0))
    clock = np.where(cut < n, first[safe] if len(first) else 0, ends[: len(texts)])
    tail_first, tail_ends = e.walk(_kinds(tail_points), tail_off, clock)
    keep = np.concatenate([np.arange(a, a + k) for a, k in zip(off[:-1].tolist(), cut.tolist())]) if len(texts) else np.zeros(0, np.int64)
    size = cut + np.diff(tail_off)
    new_off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(size, out=new_off[1:])
    both_points, both_first = np.zeros(new_off[-1], np.int64), np.zeros(new_off[-1], np.int64)
    column = np.arange(new_off[-1]) - np.repeat(new_off[:-1], size)
    head = column < np.repeat(cut, size)
    both_points[head], both_first[head] = points[keep], first[keep]
    both_points[~head], both_first[~head] = tail_points, tail_first
    return new, e.digits(both_points, both_first, new_off, tail_ends)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal digits, less a sixteenth that chance gives (0 to 1), row by row."""
    return np.maximum(0.0, ((a == b).mean(-1) - 1 / 16) / (1 - 1 / 16))


def _told(digits: np.ndarray) -> list[str]:
    return [r.tobytes().decode() for r in _HEX[digits]]


def _answers(ids: list, texts: list[str], ahead: list[str], e: Embedding, chained: bool) -> pa.RecordBatch:
    """Rows of SCHEMA.  chained: ``ahead`` is ``texts`` from the second on and one more, so each text is walked once."""
    m = len(ids)
    own, walked = fingerprints(texts + ahead[-1:] if chained else texts + ahead, e)
    following = own[1:] if chained else own[m:]
    new, changed = edited(texts, ahead, walked, e)
    own = own[:m]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new]), pa.array(_told(own)), pa.array(_told(changed)), pa.array(likeness(own, changed)), pa.array(likeness(own, following))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SCHEMA for every row: its fingerprint, that of its edited text, and how like they and the next text's are.

    Rows are sorted by ranges of ids; each task answers its rows but the last and keeps aside the begin and the end of its
    range, and these few are joined by the numbers of their ranges.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    order = [F.desc_nulls_last("id"), F.desc("hash")]  # what is sampled for the ranges is two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, held, first = Embedding(), TaskContext.get().partitionId(), None, None
        none = pa.array([None], pa.string())

        def aside(which: str, row: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), pa.array([0], pa.int64()), *[none] * 3, *[pa.array([None], pa.float64())] * 2, pa.array([which]), pa.array([row[1]]), pa.array([part], pa.int64())], names)

        for batch in batches:
            for piece in slices(batch, most_bytes=SLICE_BYTES, most_docs=1000):
                got = list(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()))
                if first is None:
                    first = got[0]
                    yield aside("first", first)
                got = [held, *got] if held is not None else got
                held = got.pop()
                if got:
                    texts = [t for _, t in got]
                    out = _answers([i for i, _ in got], texts, [*texts[1:], held[1]], e, True)
                    empty = pa.nulls(len(got), pa.string())
                    yield pa.RecordBatch.from_arrays([*out.columns, empty, empty, pa.array([part] * len(got), pa.int64())], names)
        if held is not None:
            yield aside("last", held)

    names = [*[c.split()[0] for c in SCHEMA.split(", ")], "which", "text", "part"]
    done = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("text")).drop("hash").mapInArrow(run, f"{SCHEMA}, which string, text string, part long"), "edits")
    kept = done.where("which is not null")
    numbers = sorted(r.part for r in kept.where("which = 'first'").select("part").collect())  # one for each task
    if not numbers:
        return done.select(*names[:-3])
    after = F.create_map(*[F.lit(x) for a, b in zip(numbers, numbers[1:] + numbers[:1]) for x in (a, b)])
    last = kept.where("which = 'last'").select("doc_id", "text", after[F.col("part")].alias("part"))
    ends = last.join(kept.where("which = 'first'").select("part", F.col("text").alias("ahead")), "part").select("doc_id", "text", "ahead")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Embedding()
        for batch in batches:
            for i, text, ahead in zip(*(c.to_pylist() for c in batch.columns)):
                yield _answers([i], [text], [ahead], e, False)

    return done.where("which is null").select(*names[:-3]).unionByName(ends.mapInArrow(finish, SCHEMA))


def bands(fingerprint: str = "fingerprint") -> Column:
    """Join keys of a fingerprint: BANDS keys of BAND digits each, with the number of the band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.concat_ws(":", k, F.col(fingerprint).substr(k * BAND + 1, F.lit(BAND))))


def equal_share(a: str, b: str) -> Column:
    """:func:`likeness` as an expression."""
    same = F.aggregate(F.sequence(F.lit(1), F.lit(SAMPLES)), F.lit(0), lambda s, k: s + (F.col(a).substr(k, F.lit(1)) == F.col(b).substr(k, F.lit(1))).cast("int"))
    return F.greatest(F.lit(0.0), (same / SAMPLES - 1 / 16) / (1 - 1 / 16))


def search(fingerprints_: DataFrame, queries: DataFrame, least: float = LEAST) -> DataFrame:
    """(fingerprint, near, likeness): pairs of a query's fingerprint and another different one that share a band and are alike.

    Both tables have a column ``fingerprint``.  Equal fingerprints, as copies have them, are taken once; whoever wants the
    documents joins them by fingerprint.  Each pair meets in the first band that it shares, so that pairs come out once.
    At a likeness of 0.8 a band agrees with a probability of 0.43, all 64 differ with one of 10**-15.
    """
    def banded(df: DataFrame, name: str) -> DataFrame:
        return df.select("fingerprint").distinct().withColumn("band", F.explode(bands())).withColumnRenamed("fingerprint", name)

    met = banded(queries, "fingerprint").join(banded(fingerprints_, "near"), "band").where("fingerprint != near")
    first = F.array_min(F.zip_with(bands("fingerprint"), bands("near"), lambda a, b: F.when(a == b, a)))
    return met.where(F.col("band") == first).select("fingerprint", "near", equal_share("fingerprint", "near").alias("likeness")).where(F.col("likeness") >= least)


def op12_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return against_next(read_table(spark, sf_dir, "documents"))
