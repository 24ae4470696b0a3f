"""What was made of what: versions of dataset, split, features and models, checked before anything is trained or compared.

A version follows from content, so two runs over the same records give the same one, and a table of other records another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.operators import features as X
from sievewright.operators import linear as M
from sievewright.operators import manifests as D
from sievewright.operators import splits as S
from sievewright.plans import experiments as W
from sievewright.sources import artifacts as A

#: What a split, its features and a model name of their parents.
CHAIN = ("dataset_version", "split_version", "feature_version")


class LineageError(ValueError):
    """Two artifacts do not come from the same data."""


def dataset_version(records: DataFrame, columns: list[str]) -> str:
    """Of the records' content in these columns, whatever their order; equal records count by their number."""
    each = records.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_n"))
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col("_n").alias("n")), {"ignoreNullFields": "false"}), 256)
    found = D.id_digests(each.select(F.lit("all").alias("part"), content.alias("h")), "h", "part")
    return D.named("ds", {"columns": len(columns), "records": found})


def of_split(manifest: dict) -> dict[str, str]:
    return {k: manifest[k] for k in CHAIN[:2]}


def check(split: dict, features: dict, models: dict[str, dict] | None = None) -> dict[str, str]:
    """The versions that all share: a split's manifest, features' metadata and models' documents by name; LineageError tells the first that comes from elsewhere.

    Models must also know the split's classes, and all the same ones in the same order.
    """
    want = {**of_split(split), "feature_version": features["feature_version"]}
    parents = features.get("parents") or {}
    for k in CHAIN[:2]:
        if parents.get(k) != want[k]:
            raise LineageError(f"the features are of {k} {parents.get(k)}, the split is {want[k]}")
    classes = sorted({c for part in split["classes"].values() for c in part})
    for name, d in (models or {}).items():
        parents = d.get("parents") or {}
        for k in CHAIN:
            if parents.get(k) != want[k]:
                raise LineageError(f"{name} was trained on {k} {parents.get(k)}, not {want[k]}")
        if d["classes"] != classes:
            raise LineageError(f"{name} has the classes {d['classes']}, the split {classes}")
    return want


def freeze(records: DataFrame, folder: str, key: str = "record_id", text: str = "text", label: str = "label", seed: int = 42, min_df: int = 2, order: str | None = None) -> dict[str, str]:
    """Split and features of labelled records, written under ``folder``/split and ``folder``/features, each with its parents."""
    given = list(dict.fromkeys([key, text, label, *([order] if order else [])]))
    data = records.select(*given).where(F.col(label).isNotNull() & F.col(text).isNotNull())
    split = S.checked_split(data, label, key, seed)
    S.validate(data, split, key, label)
    manifest = A.write_split(split, f"{folder}/split", key, label, seed, {"train": 0.7, "validation": 0.15}, dataset_version(data, given), order)
    p = W.prepare(data, key, text, label, seed, min_df, split.withColumnsRenamed({text: "text", label: "label"}))
    try:
        metadata = X.write_features(f"{folder}/features", p.vocabulary, p.weights, {"ngrams": [1, 2], "min_df": min_df, "text": text, "label": label}, of_split(manifest))
    finally:
        W.release(p)
    return check(manifest, metadata)


def thaw(spark, folder: str, key: str = "record_id") -> W.Prepared:
    """What :func:`freeze` wrote, ready to train on: its parts as their manifest tells, of one lineage, and its features equal to what its texts give again.

    The vocabulary is fitted again on the training part and every part transformed again; a number that differs by over
    1e-12, or a row that one side lacks, is an error.
    """
    manifest = A.read_document(f"{folder}/split/split_manifest.json", ("split_version", "dataset_version", "classes"))
    vocabulary, weights, metadata = X.read_features(spark, f"{folder}/features", S.PARTS)
    check(manifest, metadata)
    text, label = (metadata["config"][k] for k in ("text", "label"))
    split = A.read_split(spark, f"{folder}/split", key, label).withColumnsRenamed({text: "text", label: "label"})
    p = W.prepare(split, key, min_df=metadata["config"]["min_df"], split=split)
    try:
        X.check_equal(vocabulary, p.vocabulary, ["term"], ("df", "idf"))
        for part in S.PARTS:
            X.check_equal(weights[part], p.weights[part], [key, "term"], ("weight",))
    except BaseException:
        W.release(p)
        raise
    return p


def read_models(folder: str, names: tuple[str, ...]) -> dict[str, dict]:
    return {n: A.read_document(f"{folder}/{n}/model.json", ("model_version", "loss", "classes", "terms")) for n in names}


def comparable(folder: str, models: str, names: tuple[str, ...] = tuple(W.LOSSES)) -> dict[str, M.LinearModel]:
    """Stored models that may be compared: all of the split and features under ``folder``."""
    split = A.read_document(f"{folder}/split/split_manifest.json", ("split_version", "dataset_version", "classes"))
    check(split, A.read_document(f"{folder}/features/feature_metadata.json", ("feature_version", "config", "entries")), read_models(models, names))
    return {n: A.read_model(f"{models}/{n}", W.LOSSES[n]) for n in names}
