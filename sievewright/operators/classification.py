"""Audit, splits, features, metrics and calibration over labelled records."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate(part: Column, total: Column, digits: int = 6) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(part.cast("double") / total, digits))


def class_distribution(records: DataFrame, label: str) -> DataFrame:
    counts = records.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("records"))
    total = counts.agg(F.sum("records").alias("total"))
    return counts.join(F.broadcast(total)).select("label", "records", rate(F.col("records"), F.col("total")).alias("share"))  # one row


def imbalance(distribution: DataFrame) -> DataFrame:
    ratio = F.max("records").cast("double") / F.min("records")
    severity = F.when(F.count(F.lit(1)) < 2, "n/a").when(ratio < 2, "none").when(ratio < 5, "mild").when(ratio < 20, "moderate").otherwise("severe")
    return distribution.agg(F.count(F.lit(1)).alias("classes"), F.round(ratio, 6).alias("ratio"), severity.alias("severity"))


def length_statistics(records: DataFrame, text: str, words: Column) -> DataFrame:
    """Nearest-rank percentiles of characters and words."""
    both = records.select(F.length(text).cast("long").alias("characters"), words.cast("long").alias("words"))
    aggs = []
    for c in both.columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.round(F.avg(c), 6).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max"), F.median(c).alias(f"{c}_median")]
        aggs += [F.expr(f"percentile_disc({p}) within group (order by {c})").cast("long").alias(f"{c}_p{int(p * 100)}") for p in (0.9, 0.95, 0.99)]
    return both.agg(*aggs)


def split_order(seed: int, key: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256)


def stratified_split(records: DataFrame, label: str, key: str, seed: int = 42, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """Adds split: within each class, records in hash order; floor(n * train) train, floor(n * validation) validation, rest test.

    Records without a label are a class of their own.  Instead of numbering a class's rows in one task, rows are numbered within 4096 hash ranges, whose sizes give the offsets.
    """
    hashed = records.withColumn("_order", split_order(seed, key)).withColumn("_bin", F.substring("_order", 1, 3))
    sizes = hashed.groupBy(label, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(label, "_bin", F.coalesce(F.sum("_n").over(Window.partitionBy(label).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(label)).alias("_total"))
    ranked = hashed.withColumn("_r", F.row_number().over(Window.partitionBy(label, "_bin").orderBy("_order"))).join(offsets.withColumnsRenamed({label: "_label", "_bin": "_of"}), F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bin") == F.col("_of")))
    at = F.col("_before") + F.col("_r")
    first, second = F.floor(F.col("_total") * train), F.floor(F.col("_total") * validation)
    return ranked.withColumn("split", F.when(at <= first, "train").when(at <= first + second, "validation").otherwise("test")).select(*records.columns, "split")


def class_weights(records: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    c = records.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("records"))
    t = c.agg(F.sum("records").alias("n"), F.count(F.lit(1)).alias("k"))
    return c.join(F.broadcast(t)).select("label", "records", F.round(F.col("n") / (F.col("k") * F.col("records")), 6).alias("weight"))  # one row


def confusion(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("records"))


def per_class(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class that is actual or predicted; zero where undefined."""
    a = matrix.groupBy(F.col("actual").alias("label")).agg(F.sum("records").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("records")).otherwise(0)).alias("hit"))
    p = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum("records").alias("called"))
    j = a.join(p, "label", "full").na.fill(0, ["support", "hit", "called"])
    precision = F.when(F.col("called") > 0, F.col("hit") / F.col("called")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(0.0)
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    return j.select("label", "support", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def confusion_pairs(matrix: DataFrame) -> DataFrame:
    support = matrix.groupBy("actual").agg(F.sum("records").alias("support"))
    off = matrix.where("actual <> predicted and records > 0").join(support, "actual")
    return off.select("actual", "predicted", "records", rate(F.col("records"), F.col("support")).alias("share"))


def reliability_bins(confident: DataFrame, bins: int = 10) -> DataFrame:
    """Equal bins of confidence, closed on the left, the last on both sides; empty bins stay."""
    spark = confident.sparkSession
    b = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    got = confident.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("records"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.round(F.avg(F.col("correct").cast("double")), 6).alias("accuracy"))
    return spark.range(bins).select(F.col("id").cast("int").alias("bin")).join(got, "bin", "left").na.fill(0, ["records"])


def expected_calibration_error(binned: DataFrame) -> DataFrame:
    gap = F.abs(F.coalesce(F.col("mean_confidence") - F.col("accuracy"), F.lit(0.0)))
    return binned.agg(F.round(F.sum(F.col("records") * gap) / F.sum("records"), 5).alias("ece"))


def threshold_sweep(confident: DataFrame, thresholds: list[float]) -> DataFrame:
    """Coverage and accuracy of what is accepted at each threshold; accuracy is null where nothing is."""
    each = F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold")
    t = confident.select(each, F.col("confidence") >= 0, "confidence", "correct")
    acc, total = F.count_if(F.col("confidence") >= F.col("threshold")), F.count(F.lit(1))
    good = F.count_if((F.col("confidence") >= F.col("threshold")) & F.col("correct"))
    return t.groupBy("threshold").agg(acc.alias("accepted"), F.round(acc / total, 6).alias("coverage"), F.when(acc > 0, F.round(good / acc, 6)).alias("accuracy"))


def select_threshold(sweep: DataFrame, target: float) -> DataFrame:
    """Of thresholds that reach the target accuracy, that of most coverage; ties by accuracy, then the lowest."""
    return sweep.where(F.col("accuracy") >= target).orderBy(F.desc("coverage"), F.desc("accuracy"), "threshold").limit(1)


def mcnemar(pair: DataFrame) -> tuple[int, int, float]:
    """Discordant counts and the exact two-sided p-value."""
    r = pair.agg(F.count_if(F.col("a_correct") & ~F.col("b_correct")), F.count_if(~F.col("a_correct") & F.col("b_correct"))).first()
    n, k = r[0] + r[1], min(r[0], r[1])
    tail = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) - n * math.log(2)) for i in range(k + 1))
    return r[0], r[1], min(1.0, 2 * tail)
