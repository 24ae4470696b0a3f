"""Exact cosine neighbours: every pair of groups is multiplied once, in blocks; each row keeps its best k of a group, and those are merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of products, and of a group, which a task holds twice.
BLOCK, GROUP = 1024, 16_384
#: What products in single precision may differ by from exact ones, for vectors of unit length.
SLACK = 1e-4


class _Best:
    """The k best of each row so far: similarity, then the lower key."""

    def __init__(self, rows: int, k: int):
        self.k, self.s, self.j = k, np.full((rows, k), -np.inf), np.full((rows, k), np.iinfo(np.int64).max)

    def add(self, row: np.ndarray, j: np.ndarray, s: np.ndarray) -> None:
        """Candidates by row, in any order; a pair comes once."""
        rows = np.unique(row)
        at = np.concatenate([row, np.repeat(rows, self.k)])
        all_s, all_j = np.concatenate([s, self.s[rows].ravel()]), np.concatenate([j, self.j[rows].ravel()])
        order = np.lexsort((all_j, -all_s, at))
        at = at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        order, at, place = order[place < self.k], at[place < self.k], place[place < self.k]
        self.s[at, place], self.j[at, place] = all_s[order], all_j[order]


def _offer(best: _Best, at: int, near: np.ndarray, x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, lowest: np.ndarray) -> None:
    """Gives the rows from ``at`` on what of a block (products in single precision) can be among their best, by exact products."""
    row, col = np.nonzero(near >= lowest[:, None])
    apart = i[row] != j[col]
    row, col = row[apart], col[apart]
    if len(row):
        best.add(at + row, j[col], np.round(np.einsum("ij,ij->i", x[row], y[col]), 9))


def _lowest(best: _Best, at: int, near: np.ndarray) -> np.ndarray:
    """From what product on a column can be among a row's best: its k-th so far, or the k+1-th of this block (a row may meet itself)."""
    k = best.k + 1
    held = best.s[at : at + len(near), -1]
    if near.shape[1] > k and np.isneginf(held).any():
        held = np.maximum(held, np.partition(near, near.shape[1] - k, axis=1)[:, -k])
    return held - SLACK


def nearest(vectors: DataFrame, key: str, vector: str, k: int, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """i, j, similarity: the k most similar other rows of each; ties go to the lower key.  Zero vectors have none.

    All pairs are compared: products in single precision leave out what cannot be among a row's best, the others are taken
    again in double precision.  Rows are dealt over groups by hash, and a task holds two groups.
    """
    groups = max(1, -(-vectors.count() // group))
    groups = max(groups, min(vectors.sparkSession.sparkContext.defaultParallelism, groups * group // (2 * block)))
    part = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")
    rows = vectors.where(F.col(vector).isNotNull()).select(part.alias("g"), F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v"))
    # a pair of groups is one task's work, and each of them is met by all
    pairs = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda o: F.struct(F.least("g", o).alias("p"), F.greatest("g", o).alias("q")))
    met = rows.select("g", "k", "v", F.explode(pairs).alias("at")).select("at.p", "at.q", (F.col("g") == F.col("at.q")).alias("right"), "k", "v")

    def of_pair(table: pa.Table) -> pa.Table:
        def unit(of: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            keys, v = of.column("k").to_numpy(), of.column("v").combine_chunks()
            x = v.flatten().to_numpy().reshape(len(keys), -1) if len(keys) else np.zeros((0, 1))
            n = np.linalg.norm(x, axis=1)
            ok = (n > 0) & np.isfinite(n)
            return keys[ok], x[ok] / n[ok][:, None]

        right = table.column("right").to_numpy()
        same = table.column("p")[0].as_py() == table.column("q")[0].as_py()
        j, y = unit(table.filter(pa.array(right)))
        i, x = (j, y) if same else unit(table.filter(pa.array(~right)))
        x4, y4 = x.astype(np.float32), y.astype(np.float32)
        ours, theirs = _Best(len(i), k), _Best(len(j), k)
        for a in range(0, len(i), block):
            for b in range(0, len(j), 4 * block):
                r, c = slice(a, a + block), slice(b, b + 4 * block)
                near = x4[r] @ y4[c].T
                _offer(ours, a, near, x[r], y[c], i[r], j[c], _lowest(ours, a, near))
                if not same:
                    back = np.ascontiguousarray(near.T)
                    _offer(theirs, b, back, y[c], x[r], j[c], i[r], _lowest(theirs, b, back))
        out = [(keys, best) for keys, best in ((i, ours), (j, theirs))[: 1 if same else 2]]
        found = [(keys[at], best.j[at, place], best.s[at, place]) for keys, best in out for at, place in [np.nonzero(~np.isneginf(best.s))]]
        return pa.table([np.concatenate(c) for c in zip(*found)], ["i", "j", "similarity"])

    found = met.groupBy("p", "q").applyInArrow(of_pair, "i long, j long, similarity double")
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("similarity"), "j"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def earlier_candidates(neighbours: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Of each row's neighbours the most similar earlier one, and whether it reaches the threshold."""
    best = neighbours.where("j < i").groupBy("i").agg(F.max(F.struct("similarity", (-F.col("j")).alias("m"))).alias("b"))
    return best.select(F.col("i").alias("vec_id"), (-F.col("b.m")).alias("neighbour"), F.round("b.similarity", 6).alias("similarity"), (F.col("b.similarity") >= threshold).alias("is_candidate"))
