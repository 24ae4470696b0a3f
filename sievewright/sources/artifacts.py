"""Readers and writers of what the workflows leave: JSON lines, documents, splits, predictions, models."""

from __future__ import annotations

import io
import json

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import manifests
from sievewright.sources import storage

ACCEPTED = "record_index long, subject string, message string, ticket_type string, queue string, priority string, language string, source_version int, tags array<string>"
CLASSIFIED = "record_id string, text string, label string"
TOKENS = "record_id string, input_ids array<int>, attention_mask array<int>, label int"
PREDICTIONS = "record_id string, actual string, predicted string, scores array<double>"


class ArtifactError(ValueError):
    """A stored table or document is not what its contract says."""


def read_lines(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines, blank ones skipped; a line that is no such object, or lacks a required field, is an error that tells where."""
    t = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at")).where(F.trim("value") != "")
    parsed = t.select("at", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    wrong = F.col("r").isNull() | F.col("r._bad").isNotNull()
    for c in required:
        wrong = wrong | F.col(f"r.{c}").isNull()
    first = parsed.where(wrong).agg(F.min("at").alias("at")).first().at
    if first is not None:
        raise ArtifactError(f"{path}: line {first % (1 << 33) + 1} of part {first >> 33} is not a valid record")
    return parsed.select("r.*").drop("_bad")


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, ACCEPTED, ("message", "ticket_type", "queue", "priority", "language", "source_version"))


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path, CLASSIFIED, ("record_id", "text"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    t = read_lines(spark, path, TOKENS, ("record_id", "input_ids", "attention_mask", "label"))
    if t.where("size(input_ids) <> size(attention_mask) or exists(attention_mask, x -> x not in (0, 1))").limit(1).count():
        raise ArtifactError(f"{path}: ids and masks do not belong together")
    return t


def read_predictions(spark: SparkSession, path: str, fallback: str | None = None) -> DataFrame:
    """Predictions at ``path``, or at ``fallback`` where there are none."""
    from pyspark.errors import AnalysisException

    try:
        return read_lines(spark, path, PREDICTIONS, ("record_id", "actual", "predicted"))
    except AnalysisException:
        if fallback is None:
            raise
        return read_lines(spark, fallback, PREDICTIONS, ("record_id", "actual", "predicted"))


def read_document(path: str, required: tuple[str, ...] = ()) -> dict:
    """A JSON object that has the required keys."""
    try:
        value = json.loads(storage.read_text(path))
    except json.JSONDecodeError as e:
        raise ArtifactError(f"{path}: no JSON, line {e.lineno}") from e
    if not isinstance(value, dict) or (lacks := [k for k in required if k not in value]):
        raise ArtifactError(f"{path}: not an object" if not isinstance(value, dict) else f"{path}: lacks {lacks}")
    return value


def read_dataset_manifest(path: str) -> dict:
    return read_document(path, ("dataset_version", "created_at", "sources", "config", "content", "pipeline_version"))


def read_quality_report(path: str) -> dict:
    return read_document(path, ("dataset", "validation", "preprocessing", "pii", "duplicates", "language", "leakage", "version"))


def write_split(split: DataFrame, folder: str, key: str, label: str, seed: int, ratios: dict[str, float], dataset_version: str, order: str | None = None) -> dict:
    """The parts by folder and their manifest, with a digest of each part's ids, and of their order where a column tells it; read back and checked, and only then put in place of what was there."""
    with storage.together(folder) as staged:
        split.write.partitionBy("split").parquet(f"{staged}/parts")
        manifest = manifests.split_manifest(split, label, seed, ratios, dataset_version, key, order)
        manifests.write_json(manifest, f"{staged}/split_manifest.json")
        read_split(split.sparkSession, staged, key, label)
    return manifest


def read_split(spark: SparkSession, folder: str, key: str, label: str) -> DataFrame:
    """A frozen split: its parts must have the sizes, classes, ids and order that the manifest tells."""
    storage.recover(folder)
    manifest = read_document(f"{folder}/split_manifest.json", ("split_version", "seed", "ratios", "sizes", "classes", "ids", "dataset_version"))
    back = spark.read.parquet(f"{folder}/parts")
    now = manifests.split_manifest(back, label, manifest["seed"], manifest["ratios"], manifest["dataset_version"], key, manifest.get("order_column"))
    if now != manifest:
        raise ArtifactError(f"{folder}: the parts differ from their manifest in {[k for k in now if now[k] != manifest.get(k)]}")
    return back


def write_model(model, folder: str, parents: dict[str, str] | None = None) -> dict:
    """Coefficients as numbers, names, settings and the versions of what it was trained on as JSON; the name follows from the content."""
    numbers = io.BytesIO()
    np.savez_compressed(numbers, coefficients=model.coefficients, intercepts=model.intercepts)
    names = sorted(model.terms, key=model.terms.get)
    made_of = {"loss": model.loss, "classes": model.classes, "terms": names, "sums": [round(float(x), 9) for x in model.coefficients.sum(1)], **({"parents": parents} if parents else {})}
    document = {"model_version": manifests.named("model", made_of), **made_of}
    with storage.together(folder) as staged:
        storage.write_bytes(numbers.getvalue(), f"{staged}/model.npz")
        manifests.write_json(document, f"{staged}/model.json")
    return document


def read_model(folder: str, loss: str | None = None):
    from sievewright.operators.linear import LinearModel

    storage.recover(folder)
    d = read_document(f"{folder}/model.json", ("model_version", "loss", "classes", "terms"))
    with np.load(io.BytesIO(storage.read_bytes(f"{folder}/model.npz"))) as z:
        coefficients, intercepts = z["coefficients"], z["intercepts"]
    if (loss and d["loss"] != loss) or coefficients.shape != (len(d["classes"]), len(d["terms"])) or not np.isfinite(coefficients).all():
        raise ArtifactError(f"{folder}: not a fitted {loss or 'linear'} model")
    return LinearModel(d["loss"], d["classes"], {t: i for i, t in enumerate(d["terms"])}, coefficients, intercepts)
