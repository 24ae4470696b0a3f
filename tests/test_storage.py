"""Sets of outputs take their places together, whenever a writer dies; documents and models on any file system."""

import hashlib
import json

import numpy as np
import pytest

from sievewright.operators import linear as M
from sievewright.operators import manifests
from sievewright.operators import splits as S
from sievewright.plans import curation
from sievewright.sources import artifacts as A
from sievewright.sources import storage


def names(folder):
    return sorted(p.name for p in folder.iterdir())


def put(folder, **texts):
    with storage.together(str(folder)) as staged:
        for k, v in texts.items():
            storage.write_text(v, f"{staged}/{k}")


def contents(folder):
    return {p.name: p.read_text() for p in folder.iterdir() if p.is_file()}


def test_small_files(spark, tmp_path):
    for path in (str(tmp_path / "d/é x.bin"), f"file://{tmp_path}/d/b.bin"):
        storage.write_bytes(bytes(range(256)), path)
        storage.write_bytes(bytes(range(255, -1, -1)), path)
        assert storage.read_bytes(path) == bytes(range(255, -1, -1)) and storage.exists(path)
        assert storage.sha256(path) == hashlib.sha256(bytes(range(255, -1, -1))).hexdigest()
    assert names(tmp_path / "d") == ["b.bin", "é x.bin"]
    storage.write_text("", str(tmp_path / "empty"))
    assert storage.read_text(str(tmp_path / "empty")) == ""
    with pytest.raises(FileNotFoundError):
        storage.read_bytes(str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        manifests.file_digest(str(tmp_path / "none"))
    (tmp_path / "t.json").write_text("{")
    with pytest.raises(A.ArtifactError, match="line 1"):
        A.read_document(str(tmp_path / "t.json"))


def test_outputs_take_their_places_together(spark, tmp_path):
    (tmp_path / "other").write_text("stays")
    put(tmp_path, a="1", b="1")
    assert contents(tmp_path) == {"other": "stays", "a": "1", "b": "1"}
    put(tmp_path, b="2", c="2")
    assert contents(tmp_path) == {"other": "stays", "a": "1", "b": "2", "c": "2"}
    with pytest.raises(ZeroDivisionError):
        with storage.together(str(tmp_path)) as staged:
            storage.write_text("3", f"{staged}/a")
            1 / 0
    assert contents(tmp_path) == {"other": "stays", "a": "1", "b": "2", "c": "2"} and names(tmp_path) == ["a", "b", "c", "other"]


def test_a_writer_that_dies_leaves_a_whole_set(spark, tmp_path, monkeypatch):
    put(tmp_path, a="old", b="old", c="old")
    dying = storage.together(str(tmp_path))  # never ended, as if the process were gone
    storage.write_text("lost", f"{dying.__enter__()}/a")
    storage.recover(str(tmp_path))
    assert contents(tmp_path) == {"a": "old", "b": "old", "c": "old"}
    with monkeypatch.context() as m:  # gone just after the journal, and after one or two of the moves
        for moved in (0, 1, 2):
            m.setattr(storage, "recover", lambda folder: None)
            put(tmp_path, a=f"new{moved}", b=f"new{moved}", c=f"new{moved}")
            m.undo()
            told = json.loads((tmp_path / storage.JOURNAL).read_text())
            assert told["outputs"] == ["a", "b", "c"]
            for n in told["outputs"][:moved]:
                (tmp_path / told["staged"] / n).replace(tmp_path / n)
            storage.recover(str(tmp_path))
            assert contents(tmp_path) == dict.fromkeys("abc", f"new{moved}")
            storage.recover(str(tmp_path))
    assert contents(tmp_path) == dict.fromkeys("abc", "new2")


def test_folders_of_spark_are_moved_whole(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"r{i:03d}", f"text {i}", "ab"[i % 2]) for i in range(60)], "record_id string, text string, label string")
    folder = str(tmp_path / "s")
    split = S.checked_split(rows, "label", "record_id")
    first = A.write_split(split, folder, "record_id", "label", 42, {"train": 0.7}, "ds_1")
    with monkeypatch.context() as m:
        m.setattr(storage, "recover", lambda f: None)
        second = A.write_split(split.where("record_id <> 'r005'"), folder, "record_id", "label", 42, {"train": 0.7}, "ds_1")
    assert json.loads((tmp_path / "s/split_manifest.json").read_text()) == first
    assert A.read_split(spark, folder, "record_id", "label").count() == 59 and json.loads((tmp_path / "s/split_manifest.json").read_text()) == second
    with pytest.raises(ValueError):  # a table that does not pass its check takes no place
        A.write_split(split.where("1 = 0"), folder, "record_id", "label", 42, {"train": float("nan")}, "ds_1")
    assert A.read_split(spark, folder, "record_id", "label").count() == 59 and not [n for n in names(tmp_path / "s") if n.startswith("_")]


def test_models_and_curated_sets(spark, tmp_path):
    model = M.LinearModel(M.LOGISTIC, ["a", "b"], {"x": 0, "y": 1, "z": 2}, np.arange(6.0).reshape(2, 3), np.zeros(2))
    A.write_model(model, f"file://{tmp_path}/m")
    back = A.read_model(str(tmp_path / "m"), M.LOGISTIC)
    assert (back.coefficients == model.coefficients).all() and back.terms == model.terms and names(tmp_path / "m") == ["model.json", "model.npz"]
    source = spark.createDataFrame([(0, "s", "some text here", "Request", "IT", "high", "en", "1")], "record_index long, subject string, body string, type string, queue string, priority string, language string, version string")
    for _ in range(2):
        curation.write(curation.curate(source), str(tmp_path / "c"))
        assert names(tmp_path / "c") == ["accepted.jsonl", "data_quality_report.json", "dataset_manifest.json", "rejected.jsonl"]
        assert A.read_quality_report(str(tmp_path / "c/data_quality_report.json"))["dataset"]["accepted"] == 1
        assert A.read_accepted(spark, str(tmp_path / "c/accepted.jsonl")).count() == 1
