"""Op 10.  Language-model scores by deleted interpolation.

Tokens are words in lower case and one end per text.  The model mixes maximum-likelihood estimates over words:
w3 P(word | word2 word1) + w2 P(word | word1) + w1 P(word), the last with one added to each count, so that a word never
seen has a share.  The weights depend on the bucket (binary logarithm) of how often the context was seen: of two words if
they were seen together, else of one.  They are learned by expectation-maximisation on a deleted fold (one learning text
in seven) against estimates from the other folds; the scores then use the counts of all learning texts.

Counts of words, word bigrams and word trigrams are exact, cover all learning texts, grow with the corpus and stay
distributed.  They reach the texts without a table of all n-grams anywhere: each task writes its texts in chunks to the
shared folder; each chunk sends its different n-grams once, cut by ranges of their keys, to be added up, and gets back
the totals in the same order.  A common n-gram sends one number for each chunk, whatever its count.

All words never seen count as one type, as in the base score, so ``score`` is the probability of a text in which they
are written as one mark.  Null and empty texts are one end token.  Repeated rows count as often as they stand there.  Rows
without an id are learning rows.  Ties do not occur.  Texts of any length are read whole, one longer than a chunk in a chunk of its
own.  With no learning text all counts are zero.  Only the id and text columns are read, whatever the names of others.  An
empty table gives no rows.  Words are told apart by 64-bit hashes, n-grams by 56-bit ones.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, drop_materialized, fold, materialize, mix, prefix_hash, read_table, shared_dir, slices, span_hash, words
from .tokencounts import _filesystem

CHUNK_BYTES = 20_000_000
#: Ratios of the higher orders to the lowest go to the driver on a logarithmic grid: its step, and steps on either side.
GRID, REACH = 0.05, 160
#: Buckets of contexts of one word, then as many of two.
BUCKETS = 32
EM_ROUNDS = 60

#: Hashes of the end and the start of a text, which no word has but by chance.
END_HASH, START_HASH = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
_STEP = np.uint64(0x9E3779B97F4A7C15)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """56-bit keys of word hashes in a row."""
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for x in parts:
        h = mix(h * _STEP + x)
    return h >> np.uint64(8)


def _pack(x: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest needs; the first byte says how many."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([width]) + np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    out = np.zeros(((len(b) - 1) // b[0], 8), np.uint8)
    out[:, : b[0]] = np.frombuffer(b, np.uint8, offset=1).reshape(-1, b[0])
    return out.reshape(-1).view("<u8").astype(np.int64)


def _distinct(h: np.ndarray, weights: tuple[np.ndarray, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Different keys in order, the place of each given one among them, and sums of the weights."""
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    back = np.empty(len(h), np.int64)
    back[order] = np.cumsum(new) - 1
    u = s[new]
    return u, back, [np.bincount(back, w, len(u)).astype(np.int64) for w in weights]


class Chunk:
    """Tokens of a chunk's texts, each text closed by END, as word hashes with the keys of their word n-grams."""

    def __init__(self, table: pa.Table):
        hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for piece in table.to_batches():
            for s in slices(piece):
                data, off = buffers(s.column(1))
                data = _LOWER[data]
                begin, end, first = words(data, off)
                if len(begin):
                    hashes.append(span_hash(prefix_hash(data), begin, end))
                sizes.append(np.diff(first))
        self.n = np.concatenate(sizes) + 1
        self.last = np.cumsum(self.n) - 1
        self.first = self.last - self.n + 1
        self.seq = np.full(int(self.n.sum()), END_HASH, np.uint64)
        inside = np.ones(len(self.seq), bool)
        inside[self.last] = False
        self.seq[inside] = np.concatenate(hashes)
        self.learn = np.repeat(~table.column(2).to_numpy(), self.n)
        self.deleted = np.repeat(table.column(3).to_numpy(), self.n) & self.learn

    def before(self, x: np.ndarray, start: int | np.ndarray) -> np.ndarray:
        """What stands one place before, and ``start`` at the first token of each text."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.first] = start
        return out

    def keys(self, order: int) -> np.ndarray:
        one = self.before(self.seq, START_HASH) if order > 1 else None
        if order == 1:
            return _mixed(self.seq)
        return _mixed(one, self.seq) if order == 2 else _mixed(self.before(one, START_HASH), one, self.seq)


def _read_chunk(folder: str, chunk: int) -> pa.Table:
    fs, path = _filesystem(folder)
    with fs.open_input_stream(os.path.join(path, f"{chunk:016x}.arrow")) as f, pa.ipc.open_stream(f) as reader:
        return reader.read_all()


def chunk_table(docs: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Writes (doc_id, text, held_out, deleted) in chunks into ``folder``; rows: the chunks.  A chunk that a lost attempt left is named by no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        fs, path = _filesystem(folder)

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            chunk = uuid.uuid4().int >> 65
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(os.path.join(path, f"{chunk:016x}.arrow")) as out, pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=9))) as w:
                w.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([chunk])], ["chunk"])

        for batch in batches:
            for part in slices(batch):
                held.append(part)
                size += part.nbytes
                if size >= chunk_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    named = docs.select(F.col("doc_id"), F.col("text"), F.col("held_out"), F.col("deleted"))
    return named.mapInArrow(run, "chunk long")


def word_counts(chunks: DataFrame, folder: str, parts: int) -> DataFrame:
    """Exact counts of word n-grams of orders one to three over all learning texts, and within the deleted fold.

    Each chunk sends its different n-grams, in order of their keys, to the part that owns their range of keys; a part
    adds up what all chunks sent and sends each chunk its n-grams' totals in the same order.  Rows of order 0
    hold a part's share of :class:`Totals`.
    """
    shift = 56 - (parts.bit_length() - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                c = Chunk(_read_chunk(folder, chunk))
                for order in (1, 2, 3):
                    u, _, (n, d) = _distinct(c.keys(order), (c.learn, c.deleted))
                    cut = np.searchsorted(u, np.arange(parts + 1, dtype=np.uint64) << np.uint64(shift))
                    full = np.flatnonzero(np.diff(cut))
                    spans = [(slice(cut[p], cut[p + 1]), p) for p in full.tolist()]
                    cols = [full, np.full(len(full), chunk), np.full(len(full), order), [_pack(np.diff(u[s], prepend=np.uint64(p << shift))) for s, p in spans], [_pack(n[s]) for s, _ in spans], [_pack(d[s]) for s, _ in spans]]
                    for at in range(0, len(full), 64):
                        yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 64], t) for x, t in zip(cols, (pa.int32(), pa.int64(), pa.int8(), pa.binary(), pa.binary(), pa.binary()))], ["part", "chunk", "ord", "keys", "n", "d"])

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part, orders, rows = key[0].as_py(), table.column("ord").to_numpy(), []
        for order in (1, 2, 3):
            own = table.filter(pa.array(orders == order))
            if not own.num_rows:
                continue
            keys = [np.cumsum(_unpack(k)) + (part << shift) for k in own.column("keys").to_pylist()]
            u, back, (n, d) = _distinct(np.concatenate(keys), tuple(np.concatenate([_unpack(x) for x in own.column(c).to_pylist()]) for c in ("n", "d")))
            at = 0
            for chunk, k in zip(own.column("chunk").to_pylist(), keys):
                where = back[at : at + len(k)]
                at += len(k)
                rows.append((chunk, order, part, _pack(n[where]), _pack(d[where])))
            if order == 1:
                rows.append((-1, 0, part, *_part_totals(u, n, d)))
        types = (pa.int64(), pa.int8(), pa.int32(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["chunk", "ord", "part", "n", "d"])

    sent = chunks.select("chunk").mapInArrow(send, "part int, chunk long, ord byte, keys binary, n binary, d binary")
    return sent.groupBy("part").applyInArrow(add, "chunk long, ord byte, part int, n binary, d binary")


def _part_totals(u: np.ndarray, n: np.ndarray, d: np.ndarray) -> tuple[bytes, bytes]:
    """Of a part's words: tokens, types and texts; all, and without the deleted fold."""
    end = u == int(_mixed(np.array([END_HASH]))[0])
    return tuple(_pack(np.array([int(x.sum()), int((x > 0).sum()), int(x[end].sum())])) for x in (n, n - d))


class Totals:
    """Learning tokens, different ones, and texts."""

    def __init__(self, tokens: int, types: int, texts: int):
        self.tokens, self.types, self.texts = tokens, types, texts

    def base(self, n1: np.ndarray) -> np.ndarray:
        """Shares of words seen n1 times, one added to each count; over all types and one unseen they sum to one."""
        return (n1 + 1) / (self.tokens + self.types + 1)


def totals(counts: DataFrame) -> tuple[Totals, Totals]:
    """Over all learning texts, and without the deleted fold: six numbers from each part."""
    got = counts.where("ord = 0").select("n", "d").toArrow()
    return tuple(Totals(*sum((_unpack(x) for x in got.column(i).to_pylist()), np.zeros(3, np.int64)).tolist()) for i in (0, 1))


def _by_place(table: pa.Table, order: int, column: str) -> np.ndarray:
    """Totals that the parts sent back for a chunk's different n-grams, in order of keys."""
    own = table.filter(pa.array(table.column("ord").to_numpy() == order))
    rows = own.column(column).to_pylist()
    return np.concatenate([_unpack(rows[i]) for i in np.argsort(own.column("part").to_numpy())])


def _learn(weights: np.ndarray, bucket: np.ndarray, q3: np.ndarray, q2: np.ndarray, n: np.ndarray, rounds: int = EM_ROUNDS) -> None:
    """Expectation-maximisation over held-out counts: ratios of the higher orders to the lowest, on a logarithmic grid."""
    r = np.stack([np.where(q3 <= -REACH, 0.0, 10.0 ** (GRID * q3)), np.where(q2 <= -REACH, 0.0, 10.0 ** (GRID * q2)), np.ones(len(n))], 1)
    for b in np.unique(bucket):
        x, m = r[bucket == b], n[bucket == b].astype(np.float64)
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = x * w
            share /= share.sum(1, keepdims=True)
            w = (share * m[:, None]).sum(0) + 1e-3
            w /= w.sum()
        weights[b] = w


def _codes(bucket: np.ndarray, p3: np.ndarray, p2: np.ndarray, p1: np.ndarray) -> np.ndarray:
    q = [np.clip(np.round(np.log10(np.maximum(p, 1e-300) / np.maximum(p1, 1e-290)) / GRID), -REACH, REACH).astype(np.int64) + REACH for p in (p3, p2)]
    return (bucket * (2 * REACH + 1) + q[0]) * (2 * REACH + 1) + q[1]


class WordInterpolation:
    """Shares of what followed a context, mixed with those of shorter contexts by how often it was seen."""

    def __init__(self, sums: Totals):
        self.sums, self.weights = sums, np.tile([0.3, 0.3, 0.4], (2 * BUCKETS, 1))

    def settle(self) -> None:
        """No weight on orders whose context was never seen, so that probabilities sum to one."""
        self.weights[:BUCKETS, 0] = 0
        self.weights[0, 1] = 0
        self.weights /= self.weights.sum(1, keepdims=True)

    def terms(self, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray, t2: np.ndarray, t3: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bucket and the estimates of orders three, two and one, from counts of n-grams and of their contexts."""
        log = lambda t: np.minimum(BUCKETS - 1, np.log2(np.maximum(t, 1)).astype(np.int64))
        b = np.where(t3 > 0, BUCKETS + log(t3), log(t2 + 1))
        return b, n3 / np.maximum(t3, 1), n2 / np.maximum(t2, 1), self.sums.base(n1)

    def probabilities(self, *counts: np.ndarray) -> np.ndarray:
        b, p3, p2, p1 = self.terms(*counts)
        w = self.weights[b]
        return w[:, 0] * p3 + w[:, 1] * p2 + w[:, 2] * p1


def _evidence(c: Chunk, table: pa.Table, texts: int, kept: bool, chosen: np.ndarray | slice) -> tuple[np.ndarray, ...]:
    """Counts of word, bigram, trigram and of their contexts at the chosen tokens; kept: without the deleted fold."""
    n = {}
    for order in (1, 2, 3):
        _, back, _ = _distinct(c.keys(order))
        x = _by_place(table, order, "n")
        n[order] = (x - _by_place(table, order, "d") if kept else x)[back]
    return n[1][chosen], n[2][chosen], n[3][chosen], c.before(n[1], texts)[chosen], c.before(n[2], texts)[chosen]


def word_ratios(counts: DataFrame, folder: str, model: WordInterpolation) -> tuple[np.ndarray, ...]:
    """bucket, q3, q2, n over the deleted fold: at most 2 BUCKETS x (2 REACH + 1)^2 rows."""
    shared, side = counts.sparkSession.sparkContext.broadcast(model), 2 * REACH + 1

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        c, m = Chunk(_read_chunk(folder, key[0].as_py())), shared.value
        u, n = np.unique(_codes(*m.terms(*_evidence(c, table, m.sums.texts, True, np.flatnonzero(c.deleted)))), return_counts=True)
        return pa.Table.from_arrays([pa.array(u, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    got = counts.where("ord > 0").groupBy("chunk").applyInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    code, n = got.column(0).to_numpy(), got.column(1).to_numpy()
    return code // side // side, code // side % side - REACH, code % side - REACH, n


def score_texts(counts: DataFrame, folder: str, model: WordInterpolation) -> DataFrame:
    shared = counts.sparkSession.sparkContext.broadcast(model)
    names = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        texts, m = _read_chunk(folder, key[0].as_py()), shared.value
        c = Chunk(texts)
        found = _evidence(c, table, m.sums.texts, False, slice(None))
        known, base, score = (np.add.reduceat(x, c.first) for x in ((found[0] > 0).astype(np.int64), np.log10(m.sums.base(found[0])), np.log10(m.probabilities(*found))))
        cols = [texts.column(0), texts.column(2), pa.array(c.n), pa.array(known), pa.array(np.full(len(c.n), m.sums.tokens)), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(cols, [x.split()[0] for x in names.split(", ")])

    return counts.where("ord > 0").groupBy("chunk").applyInArrow(run, names)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out_mod: int = 7, held_out_is: int = 2, deleted_is: int = 4, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, str, WordInterpolation]:
    """Counts, the folder of chunks and the model of all rows but those held out (crc32 of the id modulo ``held_out_mod``)."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/chunks-{uuid.uuid4().hex}"
    f = fold(id_col, held_out_mod)
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), (f == held_out_is).alias("held_out"), (f == deleted_is).alias("deleted"))
    chunks = materialize(chunk_table(named, folder, chunk_bytes), "chunks")
    n = chunks.count()
    parts = max(64, 1 << max(0, (n - 1) // 2).bit_length())
    counts = materialize(word_counts(chunks.repartition(max(1, n)), folder, parts), "word-counts")
    drop_materialized(chunks)
    full, kept = (WordInterpolation(t) for t in totals(counts))
    _learn(kept.weights, *word_ratios(counts, folder, kept))
    kept.settle()
    full.weights = kept.weights
    return counts, folder, full


def score_documents(docs: DataFrame, **options) -> DataFrame:
    """Scores of all rows under a model of those that are not held out; options as of :func:`fit`."""
    return score_texts(*fit(docs, **options))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
