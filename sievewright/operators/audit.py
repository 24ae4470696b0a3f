"""Audit of a labelled dataset: task, warnings, readiness, token lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievewright.functions.markup import casefold
from sievewright.functions.text import ACCOUNT, CARD, EMAIL, IP, PHONE, URL, utrim, word_count
from sievewright.operators.classification import class_distribution, imbalance

LENGTHS = (64, 128, 256, 512)
RARE, SHORT_WORDS = 10, 3
#: What a text may consist of and still say nothing: mask names only.
PLACEHOLDERS = rf"^(?:\s|{'|'.join((EMAIL, PHONE, CARD, IP, ACCOUNT, URL))})+$"


def task_type(records: DataFrame, label: str) -> DataFrame:
    """One row: two different labels are binary, more multiclass, fewer not supervised."""
    n = F.countDistinct(label)
    return records.agg(n.alias("classes"), F.when(n == 2, "binary").when(n > 2, "multiclass").otherwise("not_supervised").alias("task_type"))


def length_coverage(lengths: DataFrame, length: str = "tokens", limits: tuple[int, ...] = LENGTHS) -> DataFrame:
    """max_length, records within it and their share."""
    each = F.explode(F.array(*[F.lit(n) for n in limits])).alias("max_length")
    t = lengths.select(each, F.col(length).alias("n")).groupBy("max_length").agg(F.count_if(F.col("n") <= F.col("max_length")).alias("within"), F.count(F.lit(1)).alias("records"))
    return t.select("max_length", "within", F.round(F.col("within") / F.col("records"), 6).alias("share"))


def choose_length(coverage: DataFrame, share: float = 0.95, limits: tuple[int, ...] = LENGTHS[1:]) -> int:
    """The least limit that covers the share, else the largest."""
    found = coverage.where(F.col("max_length").isin(*limits) & (F.col("share") >= share)).agg(F.min("max_length")).first()[0]
    return found if found is not None else max(limits)


def linear_percentiles(rows: DataFrame, column: str, shares: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Interpolated percentiles, one column each."""
    return rows.agg(*[F.round(F.percentile(column, F.lit(p)), 6).alias(f"p{int(round(p * 100))}") for p in shares])


def label_state(label: Column, many: bool = False) -> Column:
    """missing, blank or valid; of lists (``many``) also invalid, where blank and other labels are mixed."""
    if not many:
        return F.when(label.isNull(), "missing").when(utrim(label) == "", "blank").otherwise("valid")
    blank = lambda x: x.isNull() | (utrim(x) == "")
    return F.when(label.isNull() | (F.size(label) == 0), "missing").when(F.forall(label, blank), "blank").when(F.exists(label, blank), "invalid").otherwise("valid")


def usable(records: DataFrame, label: str, many: bool = False) -> DataFrame:
    return records.where(label_state(F.col(label), many) == "valid")


def multilabel_distribution(records: DataFrame, label: str) -> DataFrame:
    """label, records, share of usable records (shares may add up to more than one)."""
    kept = usable(records, label, True)
    total = kept.agg(F.count(F.lit(1)).alias("total"))
    n = kept.select(F.explode(F.array_distinct(label)).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("records"))
    return n.join(F.broadcast(total)).select("label", "records", F.round(F.col("records") / F.col("total"), 6).alias("share"))  # one row


#: What each field of a record may be used for (fixed values): input, target, metadata, or never.
FIELD_POLICY = {"subject": "input", "message": "input", "ticket_type": "target", "queue": "target", "priority": "target", "language": "metadata", "source_version": "metadata", "tags": "metadata", "language_detection": "metadata", "leakage_check": "metadata", "answer": "never"}


def check_audit_config(inputs: list[str], target: str) -> None:
    if not inputs or len(set(inputs)) != len(inputs) or any(FIELD_POLICY.get(c) != "input" for c in inputs):
        raise ValueError("inputs must be different fields among subject and message")
    if target in inputs or FIELD_POLICY.get(target) != "target":
        raise ValueError(f"{target} cannot be a target")


def field_policy(columns: list[str], target: str) -> list[dict]:
    """Every field with its use and, of targets other than the chosen one and of fields never to be seen, the risk."""
    use = lambda c: "target" if c == target else FIELD_POLICY.get(c, "metadata")
    risk = {"target": "may stand in for the target", "never": "written after the fact"}
    return [{"field": c, "use": use(c), "risk": None if c == target else risk.get(use(c))} for c in sorted(columns)]


def duplicate_groups(records: DataFrame, key: str, text: str, label: str, groups: int = 10, ids: int = 5) -> DataFrame:
    """Texts of two labelled records or more: records, conflicting, and the first ids of the first groups as examples (null beyond)."""
    t = records.where(F.col(label).isNotNull()).select(F.sha2(text, 256).alias("digest"), F.col(key).alias("id"), F.col(label).alias("label"))
    g = t.groupBy("digest").agg(F.count(F.lit(1)).alias("records"), (F.min("label") != F.max("label")).alias("conflicting"), F.min("id").alias("first")).where("records > 1")
    shown = g.orderBy("first").limit(groups).select("digest")
    at = F.row_number().over(Window.partitionBy("digest").orderBy("id"))
    examples = t.join(F.broadcast(shown), "digest").withColumn("r", at).where(F.col("r") <= ids).groupBy("digest").agg(F.array_sort(F.collect_list("id")).alias("examples"))  # at most ``groups`` rows
    return g.join(F.broadcast(examples), "digest", "left")


def audit(records: DataFrame, label: str, text: str) -> dict:
    """Counts, distribution, warnings (codes in order) and readiness.  The label may be a list: then classes are its members, conflicts differ as sets, and the task is multilabel."""
    many = isinstance(records.schema[label].dataType, T.ArrayType)
    t = records.select(F.col(label).cast("array<string>" if many else "string").alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("state", label_state(F.col("label"), many))
    kept = t.where("state = 'valid'")
    empty = utrim(F.col("text")) == ""
    counts = t.agg(
        F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("state") == s).alias(s) for s in ("missing", "blank", "invalid", "valid")],
        F.count_if(empty).alias("empty"), F.count_if(~empty & (word_count(F.col("text")) < SHORT_WORDS)).alias("short"), F.count_if(~empty & F.col("text").rlike(PLACEHOLDERS)).alias("placeholder_only"),
    ).first().asDict()
    distribution = multilabel_distribution(t, "label") if many else class_distribution(kept, "label")
    classes = [r.asDict() for r in distribution.orderBy(F.desc("records"), "label").collect()]
    severity = imbalance(distribution).first()
    names = kept.select(F.explode("label").alias("label") if many else F.col("label")).distinct()
    key = F.to_json(F.array_sort(F.array_distinct("label"))) if many else F.col("label")
    alike = names.groupBy(F.regexp_replace(casefold(utrim(F.col("label"))), r"(?U)\s+", " ")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
    conflicting = kept.groupBy(F.sha2("text", 256)).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo <> hi").count()
    rare = [c["label"] for c in classes if c["records"] < RARE]
    found = {
        "missing_labels": counts["missing"], "blank_labels": counts["blank"], "invalid_labels": counts["invalid"], "labels_alike": alike, "rare_classes": len(rare), "imbalance": int(severity.severity in ("moderate", "severe")),
        "empty_inputs": counts["empty"], "short_inputs": counts["short"], "placeholder_only_inputs": counts["placeholder_only"], "conflicting_labels": conflicting,
    }
    warnings = sorted(k for k, v in found.items() if v)
    readiness = "NOT_READY" if len(classes) < 2 else "READY_WITH_WARNINGS" if warnings else "READY"
    kind = "multilabel" if many and classes else "binary" if len(classes) == 2 else "multiclass" if len(classes) > 2 else "not_supervised"
    return {"counts": counts, "task_type": kind, "classes": classes, "imbalance": {"ratio": severity.ratio, "severity": severity.severity}, "rare_classes": rare, "warnings": warnings, "readiness": readiness}


def audit_markdown(result: dict) -> str:
    lines = ["# Dataset audit", "", f"Readiness: {result['readiness']}", f"Task: {result['task_type']}", f"Imbalance: {result['imbalance']['severity']}", "", "| class | records | share |", "| --- | --- | --- |"]
    lines += [f"| {str(c['label']).replace('|', chr(92) + '|')} | {c['records']} | {c['share']:.6f} |" for c in result["classes"]]
    lines += ["", "Warnings: " + (", ".join(result["warnings"]) or "none"), ""]
    return "\n".join(lines)
