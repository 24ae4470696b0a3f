"""Evaluation over a fixed order of classes, alignment of predictions, errors, confidence, benchmarks and cost."""

from __future__ import annotations

import math
import statistics
import time
from collections.abc import Callable, Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators.classification import mcnemar
from sievewright.operators.comparison import paired_bootstrap


def scaffold(spark, classes: list[str]) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(classes)], "label string, place int")


def frozen_scores(predictions: DataFrame, classes: list[str]) -> DataFrame:
    """label, support, precision, recall, f1 of every class of the order, zero where undefined; a label outside is an error when collected."""
    cells = predictions.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    a = cells.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"), hit.alias("hit"))
    p = cells.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("called"))
    j = F.broadcast(scaffold(predictions.sparkSession, classes)).join(a, "label", "left").join(p, "label", "left").na.fill(0, ["support", "hit", "called"])  # the classes
    over = lambda x, y: F.when(y > 0, x / y).otherwise(0.0)
    f1 = over(2.0 * F.col("hit"), F.col("support") + F.col("called"))
    return j.select("label", "place", "support", over(F.col("hit"), F.col("called")).alias("precision"), over(F.col("hit"), F.col("support")).alias("recall"), f1.alias("f1"), "hit")


def summary_scores(scores: DataFrame) -> DataFrame:
    """One row: accuracy, macro means over all classes of the order, and F1 weighted by support."""
    macro = [F.round(F.avg(c), 6).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    total = F.sum("support")
    return scores.agg(total.alias("records"), F.round(F.sum("hit") / total, 6).alias("accuracy"), *macro, F.round(F.sum(F.col("f1") * F.col("support")) / total, 6).alias("weighted_f1"))


def confusion_scaffold(predictions: DataFrame, classes: list[str]) -> DataFrame:
    """actual, predicted, records for all pairs of classes, zeros included."""
    s = scaffold(predictions.sparkSession, classes)
    every = s.select(F.col("label").alias("actual")).crossJoin(s.select(F.col("label").alias("predicted")))  # classes squared
    return every.join(predictions.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("records")), ["actual", "predicted"], "left").na.fill(0, ["records"])


def check_unique(rows: DataFrame, key: str) -> DataFrame:
    twice = rows.groupBy(key).count().where(f"count > 1 or {key} is null").limit(1).count()
    if twice:
        raise ValueError(f"{key} is missing or not unique")
    return rows


def align(records: DataFrame, predictions: DataFrame, key: str, label: str = "label") -> DataFrame:
    """key, actual, predicted: predictions on exactly the records given, with the same true labels, or an error."""
    check_unique(records, key)
    check_unique(predictions, key)
    j = records.select(key, F.col(label).alias("actual"), F.lit(1).alias("_a")).join(predictions.select(key, F.col("actual").alias("_actual"), "predicted", F.lit(1).alias("_b")), key, "full")
    wrong = j.agg(F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("members"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("actual").eqNullSafe(F.col("_actual"))).alias("labels"), F.count_if(F.col("_b").isNotNull() & F.col("predicted").isNull()).alias("blank")).first()
    if wrong.members or wrong.labels or wrong.blank:
        raise ValueError(f"predictions do not fit the records: {wrong.members} without a partner, {wrong.labels} with another label, {wrong.blank} without a prediction")
    return j.where("_a = 1 and _b = 1").select(key, "actual", "predicted")


def subset(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of the ids; an id without a row is an error."""
    out, want = rows.join(ids.select(key).distinct(), key, "left_semi"), ids.select(key).distinct()
    if want.join(rows, key, "left_anti").limit(1).count():
        raise ValueError("not every id asked for has a row")
    return out


def errors(predictions: DataFrame, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Every wrong prediction with its text; it is a false negative of its actual class and a false positive of the predicted one."""
    wrong = predictions.where(F.col("actual") != F.col("predicted"))
    return wrong.join(texts.select(key, text), key).select(key, "actual", "predicted", F.col("actual").alias("false_negative_class"), F.col("predicted").alias("false_positive_class"), text)


def class_errors(found: DataFrame, label: str, kind: str) -> DataFrame:
    if kind not in ("false_positive", "false_negative"):
        raise ValueError("kind must be false_positive or false_negative")
    return found.where(F.col(f"{kind}_class") == label)


CATEGORY = "CASE WHEN actual = predicted THEN 'only_a_right' WHEN actual = predicted_b THEN 'only_b_right' ELSE 'both_wrong' END"


def disagreements(pairs: DataFrame, key: str) -> DataFrame:
    """Rows (actual, predicted, predicted_b) on which two models differ, with who is right."""
    return pairs.where("predicted <> predicted_b").select(key, "actual", "predicted", "predicted_b", F.expr(CATEGORY).alias("category"))


def minority(distribution: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every smallest class with its records, false negatives and false positives."""
    least = distribution.agg(F.min("records").alias("least"))
    small = distribution.join(F.broadcast(least), F.col("records") == F.col("least")).select("label", "records")  # one row
    wrong = predictions.where("actual <> predicted")
    fn, fp = (wrong.groupBy(F.col(c).alias("label")).agg(F.count(F.lit(1)).alias(n)) for c, n in (("actual", "false_negatives"), ("predicted", "false_positives")))
    return small.join(fn, "label", "left").join(fp, "label", "left").na.fill(0, ["false_negatives", "false_positives"])


def imbalance_analysis(scores: DataFrame, counts: DataFrame) -> DataFrame:
    """label, records, share, role (majority, minority: ties by name) and whether its recall is below the macro recall."""
    t = counts.agg(F.sum("records").alias("n"), F.max_by("label", F.struct("records", F.expr("transform(split(label, ''), c -> -ascii(c))"))).alias("top"), F.min_by("label", F.struct("records", "label")).alias("low"))
    macro = scores.agg(F.avg("recall").alias("macro"))
    j = counts.join(F.broadcast(t)).join(F.broadcast(macro)).join(scores.select("label", "recall"), "label")  # one row each
    role = F.when(F.col("label") == F.col("top"), "majority").when(F.col("label") == F.col("low"), "minority").otherwise("")
    return j.select("label", "records", F.round(F.col("records") / F.col("n"), 6).alias("share"), role.alias("role"), (F.col("recall") < F.col("macro")).alias("below_macro_recall"))


def balanced_weights(labels: Iterable[str], classes: list[str]) -> dict[str, float]:
    """N / (K * n) for each class of the order, from counts of labels (a mapping) or labels; unknown and missing classes are errors."""
    counts = dict(labels) if isinstance(labels, dict) else {c: n for c, n in zip(*np.unique(list(labels), return_counts=True))}
    if len(classes) < 2 or len(set(classes)) != len(classes):
        raise ValueError("the class order needs two different classes or more")
    unknown, missing = sorted(set(counts) - set(classes)), [c for c in classes if not counts.get(c)]
    if unknown or missing:
        raise ValueError(f"unknown classes {unknown}, missing classes {missing}")
    total = sum(counts.values())
    return {c: total / (len(classes) * counts[c]) for c in classes}


def confidence_summary(rows: DataFrame, pair: tuple[str, str] | None = None, high: float = 0.9) -> DataFrame:
    """One row for all and one for each actual class: records, mean confidence of all, right and wrong ones, sure errors, and mix-ups of the pair of classes."""
    ok = F.col("actual") == F.col("predicted")
    mixed = F.col("actual").isin(*pair) & F.col("predicted").isin(*pair) & ~ok if pair else F.lit(False)
    sums = {
        "records": F.count(F.lit(1)), "n": F.count("confidence"), "s": F.sum("confidence"), "n_right": F.count(F.when(ok, F.col("confidence"))), "s_right": F.sum(F.when(ok, F.col("confidence"))),
        "n_wrong": F.count(F.when(~ok, F.col("confidence"))), "s_wrong": F.sum(F.when(~ok, F.col("confidence"))), "sure_errors": F.count_if(~ok & (F.col("confidence") >= high)), "mixed_up": F.count_if(mixed),
    }
    t = with_all(rows.groupBy("actual").agg(*[v.alias(k) for k, v in sums.items()]), "actual", list(sums))
    mean = lambda k: F.round(F.try_divide(f"s{k}", f"n{k}"), 6).alias(f"mean{k}")
    return t.select(F.col("actual").alias("label"), "records", mean(""), mean("_right"), mean("_wrong"), "sure_errors", "mixed_up")


def with_all(sums: DataFrame, level: str, names: list[str]) -> DataFrame:
    """Sums by a level, and their total under the name all: only rows that are already added up are taken twice."""
    t = sums.rollup(level).agg(F.grouping(level).alias("_total"), *[F.sum(n).alias(n) for n in names])
    return t.select(F.when(F.col("_total") == 1, F.lit("all")).otherwise(F.col(level)).alias(level), *names)


def threshold_by_class(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """threshold, label: records, accepted, coverage and accepted errors of every actual class and of all; 0.0 is always there."""
    if len(set(thresholds)) != len(thresholds) or sorted(thresholds) != list(thresholds) or any(not 0 <= t <= 1 for t in thresholds):
        raise ValueError("thresholds must be different, rising, and within 0 and 1")
    grid = sorted({0.0, *thresholds})
    ok = F.col("actual") == F.col("predicted")
    sums = {"records": F.count(F.lit(1))}
    for i, t in enumerate(grid):
        took = F.col("confidence") >= t
        sums |= {f"a{i}": F.count_if(took), f"e{i}": F.count_if(took & ~ok)}
    t = with_all(rows.groupBy("actual").agg(*[v.alias(k) for k, v in sums.items()]), "actual", list(sums))
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("threshold"), F.col(f"a{i}").alias("accepted"), F.col(f"e{i}").alias("accepted_errors")) for i, x in enumerate(grid)])).alias("x")
    return t.select(F.col("actual").alias("label"), "records", each).select("x.threshold", "label", "records", "x.accepted", F.round(F.col("x.accepted") / F.col("records"), 6).alias("coverage"), "x.accepted_errors")


def feature_overlap(a: list[tuple], b: list[tuple]) -> dict[tuple[str, str], dict[str, list[str]]]:
    """Of two models' top terms (class, sign, term, weight): those shared and those of one alone, by class and sign."""
    group = lambda rows: {(c, s): {t for x, y, t, _ in rows if (x, y) == (c, s)} for c, s, _, _ in rows}
    x, y = group(a), group(b)
    return {k: {"shared": sorted(x.get(k, set()) & y.get(k, set())), "only_a": sorted(x.get(k, set()) - y.get(k, set())), "only_b": sorted(y.get(k, set()) - x.get(k, set()))} for k in sorted({*x, *y})}


# --- benchmarks and cost -----------------------------------------------------------------------------------


def measure(infer: Callable[[list], object], records: list, batch_sizes: tuple[int, ...] = (1, 8, 32), warm_up: int = 2, rounds: int = 10, clock: Callable[[], float] = time.perf_counter) -> list[dict]:
    """Seconds of ``infer`` over the records in batches: median and 95th percentile of a batch, and records a second."""
    if not records or min(batch_sizes) < 1 or rounds < 1:
        raise ValueError("a benchmark needs records, batches and rounds")
    out = []
    for size in batch_sizes:
        batches, took = [records[i : i + size] for i in range(0, len(records), size)], []
        for _ in range(warm_up):
            infer(batches[0])
        for _ in range(rounds):
            for b in batches:
                began = clock()
                infer(b)
                took.append(clock() - began)
        out.append({"batch_size": size, "p50_ms": 1000 * statistics.median(took), "p95_ms": 1000 * float(np.percentile(took, 95)), "records_per_second": rounds * len(records) / max(sum(took), 1e-12)})
    return out


def cost(records_per_second: float, hourly_rate: float | None) -> dict[str, float] | None:
    """What a record, a thousand and a million cost at full use; none without a rate."""
    if hourly_rate is None:
        return None
    if not (math.isfinite(records_per_second) and records_per_second > 0 and math.isfinite(hourly_rate) and hourly_rate >= 0):
        raise ValueError("throughput must be positive and the rate not negative")
    one = hourly_rate / (records_per_second * 3600)
    return {"hourly_rate": hourly_rate, "utilization": 1.0, "per_record": one, "per_1000": 1e3 * one, "per_1000000": 1e6 * one}


def stored_bytes(paths: Iterable[str | Path]) -> dict:
    """Bytes of the files under the paths, each file once."""
    found = {}
    for p in map(Path, paths):
        if not p.exists():
            raise FileNotFoundError(f"nothing to size at {p}")
        found |= {str(f.resolve()): f.stat().st_size for f in ([p] if p.is_file() else p.rglob("*")) if f.is_file()}
    return {"files": dict(sorted(found.items())), "total_bytes": sum(found.values())}


def benchmark_summary(measured: dict[str, list[dict]] | None, names: list[str]) -> dict[str, dict]:
    """The single-record row of every model; nulls where nothing was measured."""
    keys = ("p50_ms", "p95_ms", "records_per_second")
    one = {n: next((m for m in (measured or {}).get(n, []) if m["batch_size"] == 1), {}) for n in names}
    return {n: {k: one[n].get(k) for k in keys} for n in names}


def final_comparison(pairs: dict[str, DataFrame], classes: list[str], measured: dict[str, list[dict]] | None = None) -> dict:
    """Models (key, actual, predicted over the same records): scores, paired tests of every two, and the best by macro F1 (ties: by name)."""
    scores = {n: summary_scores(frozen_scores(p, classes)).first().asDict() for n, p in sorted(pairs.items())}
    tests = []
    names = sorted(pairs)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            key = pairs[a].columns[0]
            j = pairs[a].join(pairs[b].select(key, F.col("predicted").alias("predicted_b")), key)
            one, other, p = mcnemar(j.select((F.col("actual") == F.col("predicted")).alias("a_correct"), (F.col("actual") == F.col("predicted_b")).alias("b_correct")))
            tests.append({"a": a, "b": b, "only_a": one, "only_b": other, "p_value": p, "significant": p < 0.05, **paired_bootstrap(j, classes)})
    best = max(names, key=lambda n: (scores[n]["macro_f1"], [-ord(c) for c in n])) if names else None
    return {"scores": scores, "pairs": tests, "benchmark": benchmark_summary(measured, names), "recommended": best}
