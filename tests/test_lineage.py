"""Frozen inputs are what their manifests tell and what their texts give; artifacts of other data are refused."""

import json
import random

import pytest
from pyspark.sql import functions as F

from sievewright.operators import features as X
from sievewright.operators import manifests as D
from sievewright.plans import experiments as W
from sievewright.plans import lineage as V
from sievewright.sources import artifacts as A

WORDS = {"a": "server down crash error", "b": "please install access account"}


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(1)
    rows = [(f"r{i:03d}", " ".join(rng.choices(WORDS["ab"[i % 2]].split(), k=6)), "ab"[i % 2], i) for i in range(60)]
    return spark.createDataFrame(rows, "record_id string, text string, label string, place long").persist()


@pytest.fixture(scope="module")
def frozen(records, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("frozen"))
    return folder, V.freeze(records, folder, order="place")


def test_versions_follow_from_content(spark, records):
    columns = ["record_id", "text", "label"]
    one = V.dataset_version(records, columns)
    assert one == V.dataset_version(records.repartition(7), columns) and one.startswith("ds_")
    other = {
        V.dataset_version(records.withColumn("text", F.when(F.col("place") == 3, "other").otherwise(F.col("text"))), columns),
        V.dataset_version(records.unionByName(records.where("place = 3")), columns),
        V.dataset_version(records.where("place <> 3"), columns),
        V.dataset_version(records.withColumn("label", F.when(F.col("place") != 3, F.col("label"))), columns),
        V.dataset_version(records.limit(0), columns),
    }
    assert one not in other and len(other) == 5


def test_frozen_inputs_are_trained_on(spark, frozen, tmp_path):
    folder, versions = frozen
    p = V.thaw(spark, folder)
    for name in W.LOSSES:
        W.run_baseline(p, name, str(tmp_path), parents=versions)
    W.release(p)
    assert set(V.comparable(folder, str(tmp_path))) == set(W.LOSSES)
    document = json.loads((tmp_path / "linear_svm/model.json").read_text())
    assert document["parents"] == versions
    D.write_json({**document, "parents": {**versions, "split_version": "split_other"}}, str(tmp_path / "linear_svm/model.json"))
    with pytest.raises(V.LineageError, match="linear_svm was trained on split_version split_other"):
        V.comparable(folder, str(tmp_path))
    D.write_json({**document, "classes": ["b", "a"]}, str(tmp_path / "linear_svm/model.json"))
    with pytest.raises(V.LineageError, match="classes"):
        V.comparable(folder, str(tmp_path))


def test_features_of_another_split_are_refused(records, frozen, tmp_path):
    folder, versions = frozen
    other = V.freeze(records, str(tmp_path), seed=7)
    assert other["split_version"] != versions["split_version"] and other["dataset_version"] != versions["dataset_version"]
    split = A.read_document(f"{folder}/split/split_manifest.json")
    for features in (A.read_document(f"{tmp_path}/features/feature_metadata.json"), {"feature_version": "features_1"}):
        with pytest.raises(V.LineageError, match="dataset_version"):
            V.check(split, features)


def test_a_changed_weight_and_a_reordered_part_are_found(spark, records, frozen, tmp_path):
    folder = str(tmp_path)
    V.freeze(records, folder, order="place")
    stored = spark.read.parquet(f"{folder}/features/test").toPandas()
    at = stored.sort_values(["record_id", "term"]).index[0]
    for change in (3e-12, 0.0):
        odd = stored.copy()
        odd.loc[at, "weight"] += change
        spark.createDataFrame(odd).write.mode("overwrite").parquet(f"{folder}/features/test")
        if change:
            with pytest.raises(ValueError, match="differs from its inputs"):
                V.thaw(spark, folder)
    W.release(V.thaw(spark, folder))
    parts = spark.createDataFrame(spark.read.parquet(f"{folder}/split/parts").toPandas())
    ids = parts.where("split = 'train'").orderBy("place").select("place").limit(2).toPandas()["place"].tolist()
    swapped = parts.withColumn("place", F.when(F.col("place") == ids[0], ids[1]).when(F.col("place") == ids[1], ids[0]).otherwise(F.col("place")))
    swapped.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/split/parts")
    with pytest.raises(A.ArtifactError, match="order"):
        V.thaw(spark, folder)


def test_differences_on_both_sides(spark):
    t = lambda rows: spark.createDataFrame(rows, "k string, v double")
    a, b = t([("same", 1.0), ("off", 1.0), ("left", 1.0), ("null", None), ("one", None)]), t([("same", 1.0 + 1e-13), ("off", 1.1), ("right", 1.0), ("null", None), ("one", 0.0)])
    assert sorted(r.k for r in X.differences(a, b, ["k"], ("v",)).collect()) == ["left", "off", "one", "right"]
    X.check_equal(a, a, ["k"], ("v",))
