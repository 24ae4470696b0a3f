"""Linear models, calibration, comparison, manifests, audit and the curation of files, against plain versions."""

import hashlib
import json
import math
from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.__main__ import main
from sievewright.operators import audit, calibration, comparison, linear, manifests
from sievewright.plans import curation


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    x = rng.random((60, 5)) * (rng.random((60, 5)) < 0.6)
    y = (x @ rng.normal(size=(5, 3)) + 0.3 * rng.normal(size=(60, 3))).argmax(1)
    return x, y


@pytest.mark.parametrize("loss", [linear.LOGISTIC, linear.SQUARED_HINGE])
def test_linear_models_reach_the_minimum(spark, rows, loss):
    x, y = rows
    weights = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(60) for j in range(5) if x[i, j]], "id long, term string, weight double")
    labels = spark.createDataFrame([(i, f"c{y[i]}") for i in range(60)], "id long, label string")
    terms = linear.number_terms(weights)
    data = linear.sparse_rows(weights, labels, "id", "label", terms)
    model = linear.fit(data, terms, loss, c=2.0, class_weight={"c1": 1.5}, tolerance=1e-5)
    sample = np.where(y == 1, 1.5, 1.0)

    def objective(w):
        w = w.reshape(3, 6)
        z = x @ w[:, :5].T + w[:, 5]
        if loss == linear.LOGISTIC:
            each = np.log(np.exp(z).sum(1)) - z[np.arange(60), y]
            return 2 * (sample * each).sum() + (w[:, :5] ** 2).sum() / 2
        sign = np.where(np.arange(3)[None, :] == y[:, None], 1, -1)
        return 2 * (sample * (np.maximum(0, 1 - sign * z) ** 2).sum(1)).sum() + (w**2).sum() / 2

    at = np.concatenate([model.coefficients, model.intercepts[:, None]], 1).ravel()
    best, rng = objective(at), np.random.default_rng(1)
    assert all(objective(at + 1e-2 * rng.normal(size=18)) > best - 1e-8 for _ in range(200))
    numeric = [(objective(at + 1e-5 * e) - objective(at - 1e-5 * e)) / 2e-5 for e in np.eye(18)]
    assert np.abs(numeric).max() < 1e-3
    got = {r.id: r for r in linear.predict(data, model, "id").collect()}
    z = x @ model.coefficients.T + model.intercepts
    assert len(got) == 60 and all(got[i].predicted == f"c{z[i].argmax()}" for i in range(60))
    assert loss != linear.LOGISTIC or all(abs(sum(r.scores) - 1) < 1e-9 for r in got.values())
    assert {s for _, s, _, _ in linear.top_terms(model, 2)} <= {"positive", "negative"}
    with pytest.raises(linear.NotConverged):
        linear.fit(data, terms, loss, most_rounds=1, tolerance=1e-9)
    with pytest.raises(ValueError):
        linear.fit(data.where("label = 'c1'"), terms, loss)


def test_temperature_and_sigmoid(spark):
    rng = np.random.default_rng(4)
    z = 3 * rng.normal(size=(300, 3))
    p = linear.softmax(z / 2.5)
    y = np.array([rng.choice(3, p=q) for q in p])
    frame = spark.createDataFrame([(z[i].tolist(), int(y[i])) for i in range(300)], "p array<double>, y int")
    got = calibration.fit_temperature(frame)
    nll = lambda t: -np.log(linear.softmax(z / t)[np.arange(300), y]).mean()
    assert nll(got) <= min(nll(t) for t in np.linspace(0.5, 8, 2000)) + 1e-6
    ab = calibration.fit_sigmoid(frame)
    for k, (a, b) in enumerate(ab):
        n1 = int((y == k).sum())
        t = np.where(y == k, (n1 + 1) / (n1 + 2), 1 / (300 - n1 + 2))
        q = 1 / (1 + np.exp(a * z[:, k] + b))
        assert abs(((t - q) * z[:, k]).sum()) < 1e-4 and abs((t - q).sum()) < 1e-4
    done = frame.select("y", "p", calibration.apply_sigmoid(F.col("p"), ab).alias("q"))
    assert calibration.invalid_probabilities(done.select(F.col("q").alias("p")), 3).count() == 0
    assert calibration.keeps_decisions(frame.select("p", calibration.softmax(F.col("p"), 2.0).alias("q")), "p", "q")
    bad = spark.createDataFrame([([0.5, 0.6],), ([1.0],), (None,), ([float("nan"), 1.0],), ([0.5, None],), ([-0.1, 1.1],), ([0.25, 0.75],)], "p array<double>")
    assert calibration.invalid_probabilities(bad, 2).count() == 6
    assert calibration.fit_temperature(frame.where("y > 9")) == 1.0
    one = {"log_loss": 1.0, "brier": 0.5, "ece": 0.1}
    assert calibration.choose_calibration(one, {"log_loss": 0.9, "brier": 0.6, "ece": 0.05}) and not calibration.choose_calibration(one, {"log_loss": 1.1, "brier": 0.4, "ece": 0.05})


def test_bootstrap_equals_resampled_rows(spark):
    rng = np.random.default_rng(0)
    y, a, b = rng.integers(0, 3, (3, 400))
    a, b = np.where(rng.random(400) < 0.7, y, a), np.where(rng.random(400) < 0.5, y, b)
    frame = spark.createDataFrame([(f"{i}", f"{j}", f"{k}") for i, j, k in zip(y, a, b)], "actual string, predicted string, predicted_b string")
    got = comparison.paired_bootstrap(frame, ["0", "1", "2"])

    def f1(p, at):
        return np.mean([2 * ((p == c) & (y == c))[at].sum() / ((p == c)[at].sum() + (y == c)[at].sum()) for c in range(3)])

    gaps = [f1(a, at) - f1(b, at) for at in rng.integers(0, 400, (1500, 400))]
    every = np.arange(400)
    assert abs(got["difference"] - (f1(a, every) - f1(b, every))) < 1e-9
    assert abs(got["low"] - np.quantile(gaps, 0.025)) < 0.015 and abs(got["high"] - np.quantile(gaps, 0.975)) < 0.015
    assert comparison.paired_bootstrap(frame.limit(0), ["0", "1", "2"])["low"] == 0.0


def test_canonical_json_and_manifests(tmp_path):
    assert manifests.canonical_json({"b": {2, 1}, "a": "é", "t": datetime(2024, 1, 2, tzinfo=UTC)}) == '{"a":"é","b":[1,2],"t":"2024-01-02T00:00:00.000000Z"}'
    for wrong in (float("nan"), datetime(2024, 1, 2), object(), {"é": 1, "é": 2}, {1: 2}):
        with pytest.raises((ValueError, TypeError)):
            manifests.canonical_json(wrong)
    (tmp_path / "a.bin").write_bytes(b"x" * 3_000_000)
    source = manifests.file_digest(str(tmp_path / "a.bin"))
    assert source == {"name": "a.bin", "sha256": hashlib.sha256(b"x" * 3_000_000).hexdigest()}
    one = manifests.dataset_manifest([source], {"k": 1}, {"n": 3}, "1", datetime(2024, 1, 1, tzinfo=UTC))
    two = manifests.dataset_manifest([source], {"k": 1}, {"n": 3}, "1", datetime(2025, 1, 1, tzinfo=UTC))
    assert one["dataset_version"] == two["dataset_version"] and [k for k, v in manifests.manifest_changes(one, two).items() if v] == ["created_at_changed"]
    manifests.write_json(one, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text()) == one and sorted(p.name for p in tmp_path.iterdir()) == ["a.bin", "m.json"]


def test_tree_digest_depends_on_order_alone(spark):
    rows = [(i, f"{i}") for i in range(3000)]
    d = lambda r: manifests.tree_digest(spark.createDataFrame(r, "i long, h string").repartition(5), "i", F.col("h")).first()
    assert d(rows) == d(rows[::-1]) and d(rows).records == 3000
    assert d(rows)[1] != d([(i, f"{(i + 1) % 3000}") for i in range(3000)])[1]
    assert manifests.tree_digest(spark.createDataFrame([], "i long, h string"), "i", F.col("h")).first().records == 0


def test_audit(spark):
    rows = [("a", "one two three four"), ("A ", "one two three four"), ("b", ""), ("b", "short"), (None, "x y z w"), (" ", "x y z w"), ("b", "<EMAIL> <URL>")] + [("b", f"some words in row {i}") for i in range(3)]
    got = audit.audit(spark.createDataFrame(rows, "label string, text string"), "label", "text")
    assert got["warnings"] == sorted(["missing_labels", "blank_labels", "labels_alike", "rare_classes", "imbalance", "empty_inputs", "short_inputs", "placeholder_only_inputs", "conflicting_labels"])
    assert got["readiness"] == "READY_WITH_WARNINGS" and got["task_type"] == "multiclass" and "| b | 6 |" in audit.audit_markdown(got)
    assert audit.audit(spark.createDataFrame([], "label string, text string"), "label", "text")["readiness"] == "NOT_READY"


def test_curation_of_a_file_by_command(spark, tmp_path):
    head = "subject,body,answer,type,queue,priority,language,version,tag_1"
    lines = [
        '"Hi","Call (212) 555-0100\nplease and thank you for the help with this",secret,Request,IT,high,en,52,x',
        '"Hi","Call (212) 555-0199\nplease and thank you for the help with this",,Request,IT,high,en,52,',
        ",<b> </b>,,Request,IT,low,en,1,", ",text here,,Request,IT,urgent,en,1,",
    ]
    (tmp_path / "t.csv").write_text("\n".join([head, *lines]) + "\n")
    assert main(["curate", str(tmp_path / "t.csv"), str(tmp_path / "out")]) == 0
    accepted = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out/accepted.jsonl")).collect()]
    assert [r["message"] for r in sorted(accepted, key=lambda r: r["record_index"])] == ["Call <PHONE>\nplease and thank you for the help with this"] * 2
    checks = {r["record_index"]: r["leakage_check"] for r in accepted}
    assert checks[0]["issues"] == [{"type": "FUTURE_FIELD", "field": "answer"}] and checks[0]["status"] == "warning" and checks[1]["status"] == "clean"
    assert checks[1]["grouping"]["exact_duplicate_group_id"] == 0 and checks[0]["grouping"]["exact_duplicate_group_id"] is None and checks[1]["unchecked_fields"] == []
    rejected = {r["record_index"]: r for r in (json.loads(x.value) for x in spark.read.text(str(tmp_path / "out/rejected.jsonl")).collect())}
    assert rejected[2]["reason"] == "EMPTY_MESSAGE" and rejected[3]["errors"] == ["priority:literal_error"] and "text here" not in json.dumps(rejected)
    report = json.loads((tmp_path / "out/data_quality_report.json").read_text())
    assert report["dataset"] == {"accepted": 2, "acceptance_rate": 0.5, "records": 4, "rejected": 2} and report["pii"]["entities"] == {"phone": 2} and report["duplicates"]["exact"]["duplicates"] == 1
    assert report["validation"]["path"] == {"message": 1, "priority": 1} and report["leakage"]["field"] == {"answer": 1} and report["version"]["dataset_version"].startswith("ds_")
    name = json.loads((tmp_path / "out/dataset_manifest.json").read_text())["dataset_version"]
    again = curation.curate_file(spark, str(tmp_path / "t.csv"))
    assert name == again.manifest["dataset_version"] and math.isclose(len(name), 15)


def test_audit_of_lists(spark):
    rows = [(["a", "b"], "one two three"), (["b", "a", "a"], "one two three"), (["a"], "one two three"), (["a", " "], "four five six"), ([""], "x y z"), ([], "x y z"), (None, "x y z"), (["A"], "seven eight nine")]
    got = audit.audit(spark.createDataFrame(rows, "label array<string>, text string"), "label", "text")
    assert [got["counts"][s] for s in ("missing", "blank", "invalid", "valid")] == [2, 1, 1, 4] and got["task_type"] == "multilabel"
    assert {c["label"]: (c["records"], c["share"]) for c in got["classes"]} == {"a": (3, 0.75), "b": (2, 0.5), "A": (1, 0.25)}
    assert {"invalid_labels", "blank_labels", "labels_alike", "conflicting_labels", "missing_labels"} <= set(got["warnings"])
    same = audit.audit(spark.createDataFrame(rows[:2], "label array<string>, text string"), "label", "text")
    assert "conflicting_labels" not in same["warnings"]
    none = audit.audit(spark.createDataFrame([], "label array<string>, text string"), "label", "text")
    assert (none["task_type"], none["readiness"]) == ("not_supervised", "NOT_READY")


def test_two_classes_mirror(spark, rows):
    x, y = rows
    y = np.minimum(y, 1)
    weights = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(60) for j in range(5) if x[i, j]], "id long, term string, weight double")
    labels = spark.createDataFrame([(i, f"c{y[i]}") for i in range(60)], "id long, label string")
    terms = linear.number_terms(weights)
    data = linear.sparse_rows(weights, labels, "id", "label", terms)
    model = linear.fit(data, terms, linear.SQUARED_HINGE, class_weight={"c0": 1.5}, tolerance=1e-6)
    sample, sign = np.where(y == 0, 1.5, 1.0), np.where(y == 1, 1, -1)

    def objective(w):
        return (sample * np.maximum(0, 1 - sign * (x @ w[:5] + w[5])) ** 2).sum() + (w**2).sum() / 2

    at = np.append(model.coefficients[1], model.intercepts[1])
    numeric = [(objective(at + 1e-5 * e) - objective(at - 1e-5 * e)) / 2e-5 for e in np.eye(6)]
    assert np.abs(numeric).max() < 1e-4
    got = linear.predict(data, model, "id").collect()
    assert len(got) == 60 and all(r.scores[0] == -r.scores[1] and r.predicted == ("c1" if r.scores[1] > 0 else "c0") for r in got)


def test_newton_solves_problems_apart_in_few_products():
    curve = np.array([np.linspace(1, 5000, 40), np.linspace(1, 2, 40)])  # one steep problem, one flat
    want, products = np.arange(80.0).reshape(2, 40) / 80, [0]

    def product(_, v):
        products[0] += 1
        return curve * v

    x = linear.newton(lambda x: ((curve * (x - want) ** 2).sum(1) / 2, curve * (x - want)), product, np.zeros((2, 40)), 1e-8, 20)
    assert np.abs(x - want).max() < 1e-8 and products[0] <= 200


def test_neighbours_over_many_groups_equal_brute_force(spark):
    from sievewright.operators import neighbours

    random = np.random.default_rng(5)
    v = random.normal(size=(230, 8)).round(1)
    v[100:130] = v[:30]  # equal vectors: ties
    v[7] = 0
    u = v / np.where((n := np.linalg.norm(v, axis=1)) > 0, n, np.nan)[:, None]
    s = np.round(u @ u.T, 9)
    want = {(i, j) for i in range(230) if i != 7 for j in sorted((j for j in range(230) if j not in (i, 7)), key=lambda j: (-s[i, j], j))[:4]}
    frame = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>")
    found = neighbours.nearest(frame, "id", "v", 4, block=16, group=40)
    assert {(r.i, r.j) for r in found.collect()} == want


@pytest.mark.parametrize("loss", [linear.LOGISTIC, linear.SQUARED_HINGE])
def test_fit_of_terms_equals_fit_and_holds_no_vocabulary(spark, rows, loss, monkeypatch):
    x, y = rows
    weights = spark.createDataFrame([(i, f"t{j}", float(x[i, j])) for i in range(60) for j in range(5) if x[i, j] and i != 7], "id long, term string, weight double")
    labels = spark.createDataFrame([(i, f"c{y[i]}") for i in range(60)] + [(60, None)], "id long, label string")  # row 7 has no weight
    terms = linear.number_terms(weights)
    want = linear.fit(linear.sparse_rows(weights, labels, "id", "label", terms), terms, loss, class_weight={"c1": 1.5}, tolerance=1e-7)
    products, plain = [], linear.multiply
    monkeypatch.setattr(linear, "multiply", lambda blocks, v: products.append(1) or plain(blocks, v))
    monkeypatch.setattr(linear, "MOST_COEFFICIENTS", 1)
    monkeypatch.setattr(linear, "BLOCK_WEIGHTS", 7)  # terms stay whole
    got = linear.fit_terms(weights, labels, "id", loss=loss, class_weight={"c1": 1.5}, tolerance=1e-7)
    table = {r.term: r.coefficients for r in got.coefficients.collect()}
    assert got.classes == want.classes and table.keys() == terms.keys() and len(products) < 60
    assert np.abs(np.array([table[t] for t in sorted(terms, key=terms.get)]).T - want.coefficients).max() < 1e-6
    assert np.abs(got.intercepts - want.intercepts).max() < 1e-6
    found = {r.id: r for r in linear.predict_terms(weights, labels, got, "id").collect()}
    x = np.where(np.arange(60)[:, None] == 7, 0, x)
    z = x @ want.coefficients.T + want.intercepts
    scores = linear.softmax(z) if loss == linear.LOGISTIC else z
    assert len(found) == 61 and np.abs(np.array([found[i].scores for i in range(60)]) - scores).max() < 1e-5
    assert all(found[i].predicted == f"c{z[i].argmax()}" for i in range(60))


@pytest.mark.parametrize("name", ["logistic_regression", "linear_svm"])
def test_model_queries_hold_no_vocabulary_on_the_driver(spark, name, monkeypatch):
    from sievewright.plans import queries

    monkeypatch.setattr(linear, "MOST_COEFFICIENTS", 100)
    d = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, d).collect()
    held = queries.parts(spark, d).where("split <> 'train'")
    assert sorted((r.doc_id, r.split, r.label) for r in got) == sorted((r.doc_id, r.split, r.label) for r in held.collect())
    assert sum(r.label == r.predicted for r in got) > len(got) / 4
