"""Op 7.  Toxicity scores behind noisy-channel deobfuscation.

A text's tokens (and runs of single characters set apart by blanks or marks) that carry digits or marks among
letters, or a letter three times in a row, are observed through a noisy channel: letters were written as
look-alikes, set apart, or repeated.  Viterbi decoding over the lattice of what each character may stand for
picks the likeliest letters under a character trigram model counted over all learning texts.  All other tokens
have one path only and pass as they are.  Restored words and their first letters are features of a logistic
model; features are words that the toxic label makes clearly likelier, weights are fitted on labelled rows.

The classifier is fitted on at most ``most_labelled`` labelled rows (default 20000, taken by hash of the id);
the character model covers every learning row.  Features are all words and beginnings that stand in three toxic texts of
that sample or more and are clearly likelier there.  Null and empty texts get the score of a text without evidence.
A document labelled twice counts as toxic if either label says so.  Without labels every score is 0.  Rows that repeat
an id, or have none, are scored each for itself; equal texts get equal scores.  Of equally likely spellings the last in the
alphabet is taken.  Texts, tokens and spaced runs of any length are decoded whole.  An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, drop_materialized, fold, materialize, read_table, slices

MOST_LABELLED = 20_000
#: Labelled texts that a feature must stand in with a toxic label, and the least log odds.
LEAST_TOXIC, LEAST_ODDS = 3, 1.5
THRESHOLD = 0.3

#: What a written character may stand for, besides itself (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = frozenset(" .-_*·~^'\"#/\\,:;")
COST_LOOKALIKE, COST_SEPARATOR, COST_REPEAT, COST_DOUBLE, COST_TWICE = 0.5, 0.3, 0.4, 1.0, 6.0

#: Single characters set apart by one to five marks or blanks.  A mark is no character of a run, so a run can be parted in one way only and is found in one pass.
SPACED = re.compile(r"(?<!\S)[^\s.\-_*·](?:[ .\-_*·]{1,5}[^\s.\-_*·]){3,}(?!\S)")
ODD = re.compile(r"(?=.*[^\W\d_])(?:.*[0-9@$!|+(<€£¡*.\-_·~^#])|.*([^\W\d_])\1\1", re.S)
EDGE = "\"'.,;:!?()[]{}<>%&#*|-_/\\`~"

#: Symbols of the character model: 0 for anything between words, a to z, one for every letter byte beyond ASCII.
SYMBOLS = 28
_CODE = np.zeros(256, np.int32)
for _i in range(26):
    _CODE[[65 + _i, 97 + _i]] = _i + 1
_CODE[0x80:] = 27


def _symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of symbol trigrams within each text over all rows; SYMBOLS**3 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for part in slices(batch):
                data, off = buffers(part.column(0))
                if len(data) > 2:
                    c = _CODE[data]
                    inside = np.ones(len(data) - 2, bool)  # trigrams that would cross into the next text
                    for k in (1, 2):
                        cross = off[1:-1] - k
                        inside[cross[(cross >= 0) & (cross < len(inside))]] = False
                    total += np.bincount(((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:])[inside], minlength=SYMBOLS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    out = np.zeros(SYMBOLS**3)
    for r in docs.select(F.col(text_col).alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r.code] = r.n
    return out


def character_model(trigrams: np.ndarray) -> list:
    """log P(c | two before), trigram estimates smoothed by bigram ones and those by symbol shares."""
    t = trigrams.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (t.sum((0, 1)) + 1) / (t.sum() + SYMBOLS)
    b = t.sum(0)
    two = (b + 5 * one) / (b.sum(1, keepdims=True) + 5)
    return np.log((t + 5 * two[None]) / (t.sum(2, keepdims=True) + 5)).tolist()


def decode(token: str, model: list, boundaries: bool = False) -> str:
    """The likeliest letters behind a written token, by Viterbi decoding of its lattice.

    A state is the last two letters put out; each keeps its best path only, as a chain of back pointers, so that the
    work is linear in the token's length.  With ``boundaries`` a separator may also stand for the end of a word (a blank).
    """
    paths: dict = {(0, 0, ""): (0.0, None)}
    low = token.lower()
    for at, c in enumerate(low):
        long_run = c * 3 in low[max(0, at - 2) : at + 3]
        options = [(x, COST_LOOKALIKE) for x in LOOKALIKES.get(c, "")]
        if c.isalpha():
            options.append((c, 0.0))
        drop = COST_SEPARATOR if c in SEPARATORS or (c in LOOKALIKES and not c.isdigit()) else 12.0 if not c.isalpha() else None
        new: dict = {}
        for (a, b, last), (score, text) in paths.items():
            moves = [(a, b, last, score - drop, text)] if drop is not None else []
            if boundaries and c in SEPARATORS and last not in ("", " "):
                moves.append((b, 0, " ", score - (0.0 if c == " " else COST_SEPARATOR) + model[a][b][0], (text, " ")))
            for x, cost in options:
                if x == last:  # one more of the same letter: a repeat, or truly double
                    moves.append((a, b, last, score - (COST_REPEAT if long_run else COST_TWICE), text))
                    cost += COST_DOUBLE if long_run else 0.0
                s = _symbol(x)
                moves.append((b, s, x, score - cost + model[a][b][s], (text, x)))
            for a2, b2, x, v, string in moves:
                if (a2, b2, x) not in new or v > new[a2, b2, x][0]:
                    new[a2, b2, x] = (v, string)
        paths = new or paths
    return max(((v + (model[a][b][0] if x != " " else 0.0), _spell(s)) for (a, b, x), (v, s) in paths.items()), key=lambda x: (x[0], x[1]))[1]


def _spell(chain: tuple | None) -> str:
    out = []
    while chain is not None:
        chain, x = chain
        out.append(x)
    return "".join(reversed(out))


def _features(word: str) -> tuple[str, ...]:
    if len(word) < 3 or not word.isalpha():
        return ()
    return ("w:" + word, *(f"{n}:" + word[:n] for n in (4, 5) if len(word) > n))


def features_of(token: str, model: list, longest: int = 64) -> tuple[str, ...]:
    """The restored word and its first four and five letters; a token of over ``longest`` characters may hold several words."""
    core = token.strip(EDGE) if not ODD.match(token) else token
    if ODD.match(core):
        trimmed = core.strip("\"'.,;:?()[]{}<>%&#*|-_/\\`~ ").rstrip("!")
        if trimmed and not ODD.match(trimmed):
            return _features(trimmed.lower())
        if len(core) > longest:
            return tuple(f for w in dict.fromkeys((decode(core, model), *decode(core, model, True).split())) for f in _features(w))
        return _features(decode(core, model))
    return _features(core.lower())


_GAP = re.compile(r"[ .\-_*·]+")


def features_of_run(run: str, model: list) -> tuple[str, ...]:
    """Of single characters set apart: what they spell as one word, and as words parted at some of the gaps (wide ones sooner)."""
    if not any(c.isalpha() for c in run):
        return ()
    whole = decode(_GAP.sub(".", run), model)
    parted = decode(_GAP.sub(lambda m: " " if len(m.group()) > 1 else ".", run), model, True).split()
    return tuple(f for w in dict.fromkeys((whole, *parted)) for f in _features(w))


class Restorer:
    """Tokens of a text to features, with a bounded memory of those seen."""

    def __init__(self, model: list, keep: dict[str, int] | None = None, most: int = 400_000):
        self.model, self.keep, self.most, self.seen = model, keep, most, {}

    def token(self, token: str) -> tuple:
        found = features_of(token, self.model)
        if self.keep is not None:
            found = tuple(self.keep[f] for f in found if f in self.keep)
        if len(self.seen) >= self.most:
            self.seen.clear()
        self.seen[token] = found
        return found

    def __call__(self, text: str | None) -> list:
        """Features of the text's different tokens."""
        out: list = []
        if not text:
            return out
        seen, token = self.seen, self.token
        for t in set(text.split()):
            f = seen.get(t)
            if f is None:
                f = token(t)
            if f:
                out.extend(f)
        for m in SPACED.finditer(text):
            f = features_of_run(m.group(), self.model)
            out.extend((self.keep[x] for x in f if x in self.keep) if self.keep is not None else f)
        return out


class ToxicityModel:
    def __init__(self, characters: list, features: dict[str, int], weights: np.ndarray, bias: float):
        self.characters, self.features, self.weights, self.bias = characters, features, weights, bias

    def restorer(self) -> Restorer:
        return Restorer(self.characters, self.features)

    def score(self, found: list[int]) -> float:
        z = self.bias + float(sum(self.weights[i] * math.log2(1 + n) for i, n in _tally(found).items()))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _tally(found: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i in found:
        out[i] = out.get(i, 0) + 1
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_labelled: int = MOST_LABELLED) -> ToxicityModel | None:
    """Learn from rows whose fold is not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where((fold(id_col, 4) != 2) & F.col("text").isNotNull())
    characters = character_model(trigram_counts(rows))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (fold(id_col, 4) != 2))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = known.count()
    if not n:
        return None
    h = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    # a filter that leaves about as many as wanted, then those of least hash: the same rows however they are dealt
    sample = known.where(h <= int(min(1.0, 1.05 * most_labelled / n) * (1 << 30))).orderBy(h, "doc_id").limit(most_labelled)
    labelled = materialize(rows.join(F.broadcast(sample), "doc_id"), "labelled")  # at most most_labelled rows of two numbers

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(characters)
        total: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for f in set(restore(text)):
                    total.setdefault(f, [0, 0])[1 if y else 0] += 1
            if len(total) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())], ["f", "neg", "pos"])
                total = {}
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())], ["f", "neg", "pos"])

    counts = labelled.mapInArrow(tokens, "f string, neg long, pos long").groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    sizes = {r.y > 0: r["count"] for r in labelled.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect()}
    neg_all, pos_all = sizes.get(False, 0), sizes.get(True, 0)
    if not pos_all or not neg_all:
        drop_materialized(labelled)
        return ToxicityModel(characters, {}, np.zeros(0), 30.0 if pos_all else -30.0)
    odds = F.log((F.col("pos") + 0.5) / (pos_all + 1)) - F.log((F.col("neg") + 0.5) / (neg_all + 1))
    chosen = sorted(r.f for r in counts.where((F.col("pos") >= LEAST_TOXIC) & (odds > LEAST_ODDS)).select("f").collect())  # bounded by the sample's words
    index = {f: i for i, f in enumerate(chosen)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(characters, index)
        for batch in batches:
            found = [restore(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "y", "found"])

    data = sorted(labelled.mapInArrow(sparse, "doc_id long, y int, found array<int>").collect(), key=lambda r: (r.doc_id, r.y, r.found))
    drop_materialized(labelled)
    row = np.array([i for i, r in enumerate(data) for _ in _tally(r.found)], np.int64)
    col = np.array([f for r in data for f in _tally(r.found)], np.int64)
    val = np.array([math.log2(1 + n) for r in data for n in _tally(r.found).values()])
    y = np.array([1.0 if r.y else 0.0 for r in data])
    w, b = np.zeros(len(index)), math.log(pos_all / neg_all)
    gw, gb = np.full(len(index), 1e-6), 1e-6
    for _ in range(400):  # AdaGrad on the full, bounded sample
        z = b + np.bincount(row, val * w[col], len(y)) if len(row) else np.full(len(y), b)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        d, db = (np.bincount(col, val * e[row], len(w)) if len(row) else np.zeros(len(w))) + 1e-5 * w, e.sum()
        gw, gb = gw + d * d, gb + db * db
        w, b = w - 0.3 * d / np.sqrt(gw), b - 0.1 * db / math.sqrt(gb)
    return ToxicityModel(characters, index, w, float(b))


def score(docs: DataFrame, model: ToxicityModel | None, text_col: str = "text", score_col: str = "tox_score") -> DataFrame:
    """All columns of the input and the score; a like-named input column is replaced."""
    kept = [c for c in docs.columns if c != score_col]
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = model.restorer() if model else None
        for batch in batches:
            for part in slices(batch, text_col):
                s = [model.score(restore(t)) if model else 0.0 for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], [*part.schema.names, score_col])

    from pyspark.sql.types import DoubleType, StructField, StructType

    given = docs.select(*[F.col(f"`{c}`") for c in kept])
    return given.mapInArrow(run, StructType([*given.schema.fields, StructField(score_col, DoubleType())]))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold("doc_id", 4) == 2).alias("held_out")), model)
    return scored.select("doc_id", "held_out", F.col("tox_score").alias("score"), (F.col("tox_score") >= THRESHOLD).cast("int").alias("predicted"))
