"""Op 2.  Language identification by the nearest of several centroids per language.

Texts become TF-IDF vectors of hashed byte trigrams, of length one.  Document frequencies are counted over all
learning rows.  Centroids come from spherical k-means within each language, on a sample of at most
``most_rows`` learning rows, about ``most_rows / languages`` for each language, taken by hash of the id, of the 1000 commonest
languages at most (the documented bounds; 4000 rows by default).  A text gets the language of the centroid of highest cosine.  A text
farther from that centroid than nearly all that formed it is marked ``rejected``; it keeps its nearest language.

Null texts and texts without a letter are ``und`` with score 0.  Equal texts get equal results, ties go to the
alphabetically first language.  Texts of any length are counted whole, one that is longer than a slice alone.  Rows that
repeat an id, and rows without one (which are learning rows), count each for itself.  Only the id, text and language
columns are read, whatever the names of others.  An empty table gives no rows; with no learning row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ngrams
from .common import buffers, fold, read_table, slices

CENTROIDS = 4
MOST_ROWS = 4000
#: Labels beyond the commonest so many are not learned.
MOST_LABELS = 1000
TEMPERATURE = 0.02
#: Share of the learning sample that may lie beyond the rejection distance.
REJECT_SHARE = 0.002


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, over all rows; what reaches the driver is one row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(ngrams.DIMS + 1, np.int64)
        for batch in batches:
            for part in slices(batch):
                df[:-1] += (ngrams.counts(*buffers(part.column(0)), letters=True) > 0).sum(0)
                df[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], ["dim", "n"])

    df = np.zeros(ngrams.DIMS + 1)
    for r in docs.select(F.col(text_col).alias("text")).mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        df[r.dim] = r.n
    return df[:-1], int(df[-1])


def label_sizes(docs: DataFrame, label: str, most: int = MOST_LABELS) -> dict[str, int]:
    """Rows of each label, of the ``most`` commonest (ties: by name)."""
    return {r[0]: r[1] for r in docs.groupBy(label).count().orderBy(F.desc("count"), label).limit(most).collect()}


def bounded_sample(docs: DataFrame, label: str, key: str, most_rows: int, sizes: dict[str, int] | None = None) -> DataFrame:
    """At most most_rows rows, as many of each label where there are; a filter by hash of ``key``, then those of least hash."""
    sizes = label_sizes(docs, label) if sizes is None else sizes
    if not sizes:
        return docs.limit(0)
    each, h = max(1.0, most_rows / len(sizes)), F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30))
    share = F.element_at(F.create_map(*[F.lit(x) for value, n in sizes.items() for x in (value, float(min(1.0, each / n)))]), F.col(label))
    # the order makes the choice the same however rows are dealt
    return docs.where(h < share * (1 << 30)).orderBy(h, key, label).limit(most_rows)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k centroids of unit rows, started by farthest points; deterministic."""
    start = x.mean(0)
    centers = [x[int(np.argmax(x @ start))]]
    while len(centers) < min(k, len(x)):
        near = np.max(x @ np.stack(centers).T, 1)
        if near.min() > 1 - 1e-6:
            break
        centers.append(x[int(np.argmin(near))])
    c = np.stack(centers)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]
    return c.astype(np.float32)


class CentroidModel:
    def __init__(self, languages: list[str], owner: np.ndarray, centers: np.ndarray, idf: np.ndarray, least: np.ndarray):
        self.languages, self.owner, self.centers, self.idf, self.least = languages, owner, centers, idf, least

    def predict(self, tf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cosine and whether rejected, for rows of counts."""
        cos = ngrams.weigh(tf, self.idf) @ self.centers.T
        best = np.argmax(cos, 1)
        top = cos[np.arange(len(cos)), best]
        by_language = np.stack([cos[:, self.owner == i].max(1) for i in range(len(self.languages))], 1)
        score = 1 / np.exp((by_language - top[:, None]) / TEMPERATURE).sum(1)
        return [self.languages[i] for i in self.owner[best]], score.astype(np.float64), top.astype(np.float64), top < self.least[best]


def fit(learning: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", centroids: int = CENTROIDS, most_rows: int = MOST_ROWS) -> CentroidModel | None:
    rows = learning.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    df, n = document_frequencies(rows)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tf = np.minimum(ngrams.counts(*buffers(part.column(1)), letters=True), 65535).astype("<u2")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([t.tobytes() for t in tf], pa.binary())], ["doc_id", "lang", "tf"])

    sample = sorted(bounded_sample(rows, "lang", "doc_id", most_rows).mapInArrow(run, "doc_id long, lang string, tf binary").collect(), key=lambda r: (r.lang, r.doc_id is not None, r.doc_id or 0))
    if not sample:
        return None
    x = ngrams.weigh(np.stack([np.frombuffer(r.tf, "<u2") for r in sample]).astype(np.float32), idf)
    langs = np.array([r.lang for r in sample])
    languages = sorted(set(langs.tolist()))
    owner, centers, least = [], [], []
    for i, lang in enumerate(languages):
        own = x[langs == lang]
        c = spherical_kmeans(own, centroids)
        cos = own @ c.T
        nearest = np.argmax(cos, 1)
        for j in range(len(c)):
            held = cos[nearest == j, j]
            owner.append(i)
            centers.append(c[j])
            least.append(np.quantile(held, REJECT_SHARE) - 0.05 if len(held) else 0.0)
    return CentroidModel(languages, np.array(owner), np.stack(centers), idf, np.array(least))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predict(docs: DataFrame, model: CentroidModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine, rejected for every row."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, off = buffers(part.column(1))
                n = part.num_rows
                if model is None:
                    lang, score, top, rejected = ["und"] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
                else:
                    lang, score, top, rejected = model.predict(ngrams.counts(data, off, letters=True))
                    seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
                    for i in np.flatnonzero(seen[off[1:]] == seen[off[:-1]]):
                        if not has_letter(part.column(1)[int(i)].as_py()):
                            lang[i], score[i], top[i], rejected[i] = "und", 0.0, 0.0, True
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(lang), pa.array(score), pa.array(top), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "cosine", "rejected"])

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), (fold(id_col, 4) == 2).alias("held_out"))
    return named.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, cosine double, rejected boolean")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs.where(fold("doc_id", 4) != 2)))
