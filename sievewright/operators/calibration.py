"""Probability quality, temperature and sigmoid calibration, and the decision behind them.

Frames hold ``p`` (an array of probabilities or logits by class) and ``y`` (the index of the true class, from 0).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TINY = 2.2250738585072014e-308
LOWEST, HIGHEST = 1e-3, 100.0


def softmax(logits: Column, temperature: Column | float = 1.0) -> Column:
    """Probabilities of logits divided by the temperature."""
    t = F.lit(temperature) if isinstance(temperature, float) else temperature
    e = F.transform(logits, lambda x: F.exp((x - F.array_max(logits)) / t))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def brier(p: Column, y: Column) -> Column:
    """Squared errors of one row, summed over the classes."""
    return F.aggregate(F.transform(p, lambda x, i: F.pow(x - F.when(i == y, 1.0).otherwise(0.0), 2)), F.lit(0.0), lambda a, b: a + b)


def log_loss(p: Column, y: Column) -> Column:
    return -F.log(F.greatest(F.get(p, y), F.lit(TINY)))


def probability_scores(rows: DataFrame, digits: int = 6) -> DataFrame:
    """One row: records, mean Brier score and mean log loss."""
    return rows.agg(F.count(F.lit(1)).alias("records"), F.round(F.avg(brier(F.col("p"), F.col("y"))), digits).alias("brier"), F.round(F.avg(log_loss(F.col("p"), F.col("y"))), digits).alias("log_loss"))


def invalid_probabilities(rows: DataFrame, classes: int, tolerance: float = 1e-6) -> DataFrame:
    """Rows whose p is null, of another length, outside [0, 1], not a number, or does not sum to one."""
    total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
    ok = (F.size("p") == classes) & F.forall("p", lambda x: x.isNotNull() & ~F.isnan(x) & x.between(0.0, 1.0)) & (F.abs(total - 1) <= tolerance)
    return rows.where(~F.coalesce(ok, F.lit(False)))


def _logit_loss(t: float) -> Column:
    logits, top = F.col("p"), F.array_max("p")
    return F.log(F.aggregate(logits, F.lit(0.0), lambda a, x: a + F.exp((x - top) / t))) - (F.get(logits, F.col("y")) - top) / t


def fit_temperature(rows: DataFrame, rounds: int = 5, points: int = 25) -> float:
    """The temperature of least mean log loss in [0.001, 100].

    Instead of a search that runs a job for each guess, one job scores a logarithmic grid of guesses, and the next
    refines the grid around the best: the loss has one minimum in 1 / temperature.
    """
    low, high = math.log(LOWEST), math.log(HIGHEST)
    best = 0.0
    for _ in range(rounds):
        grid = np.linspace(low, high, points)
        found = rows.agg(*[F.avg(_logit_loss(float(t))) for t in np.exp(grid)]).first()
        if found[0] is None:
            return 1.0
        at = int(np.argmin(found))
        best, low, high = grid[at], grid[max(0, at - 1)], grid[min(points - 1, at + 1)]
    return float(math.exp(best))


def fit_sigmoid(rows: DataFrame, rounds: int = 30) -> list[tuple[float, float]]:
    """For each class (a, b) of 1 / (1 + exp(a * s + b)), by Newton steps; a step is one aggregation for all classes.

    Targets are Platt's (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), which keep separable classes finite.
    """
    each = rows.select(F.posexplode("p").alias("k", "s"), "y").select("k", "s", (F.col("k") == F.col("y")).alias("own")).persist()
    size = {r.k: (r.n1, r.n0) for r in each.groupBy("k").agg(F.count_if("own").alias("n1"), F.count_if(~F.col("own")).alias("n0")).collect()}
    ab = {k: (0.0, math.log((n0 + 1) / (n1 + 1))) for k, (n1, n0) in size.items()}
    try:
        for _ in range(rounds):
            pick = lambda v: F.element_at(F.create_map(*[F.lit(x) for k in sorted(ab) for x in (k, float(v(k)))]), F.col("k"))  # noqa: B023, E731
            q = 1 / (1 + F.exp(pick(lambda k: ab[k][0]) * F.col("s") + pick(lambda k: ab[k][1])))
            t = F.when(F.col("own"), pick(lambda k: (size[k][0] + 1) / (size[k][0] + 2))).otherwise(pick(lambda k: 1 / (size[k][1] + 2)))
            d, h, s = t - q, q * (1 - q), F.col("s")
            sums = each.groupBy("k").agg(F.sum(d * s).alias("ga"), F.sum(d).alias("gb"), F.sum(h * s * s).alias("haa"), F.sum(h * s).alias("hab"), F.sum(h).alias("hbb")).collect()
            moved = 0.0
            for r in sums:
                step = np.linalg.solve(np.array([[r.haa, r.hab], [r.hab, r.hbb]]) + 1e-9 * np.eye(2), np.array([r.ga, r.gb]))
                step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
                ab[r.k] = (ab[r.k][0] - step[0], ab[r.k][1] - step[1])
                moved = max(moved, float(np.abs(step).max()))
            if moved < 1e-8:
                break
    finally:
        each.unpersist()
    return [ab[k] for k in sorted(ab)]


def apply_sigmoid(scores: Column, ab: list[tuple[float, float]]) -> Column:
    """Calibrated scores, divided by their sum."""
    a, b = (F.array(*[F.lit(float(x[i])) for x in ab]) for i in (0, 1))
    q = F.transform(scores, lambda s, i: 1 / (1 + F.exp(F.get(a, i) * s + F.get(b, i))))
    return F.transform(q, lambda x: x / F.aggregate(q, F.lit(0.0), lambda u, v: u + v))


def keeps_decisions(rows: DataFrame, before: str, after: str) -> bool:
    """Whether no row's likeliest class changed."""
    best = lambda c: F.array_position(F.col(c), F.array_max(c))
    return rows.where(best(before) != best(after)).limit(1).count() == 0


def choose_calibration(before: dict[str, float], after: dict[str, float]) -> bool:
    """Calibration is taken if the log loss falls and at least two of log loss, Brier score and ECE do."""
    better = {k: after[k] < before[k] for k in ("log_loss", "brier", "ece")}
    return better["log_loss"] and sum(better.values()) >= 2


def decide(p: Column, threshold: float) -> Column:
    """accepted if the likeliest class has the threshold's probability or more, else needs_review."""
    return F.when(F.array_max(p) >= threshold, "accepted").otherwise("needs_review")


def decide_by_policy(p: Column, policy: dict) -> Column:
    """:func:`decide` with the threshold of a stored policy (status and threshold, as threshold selection gives them); refuses one that has selected none."""
    if policy.get("status") != "selected" or policy.get("threshold") is None:
        raise ValueError(f"no threshold is selected: {policy.get('status')}")
    return decide(p, float(policy["threshold"]))
