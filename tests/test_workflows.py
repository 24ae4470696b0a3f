"""Splits, features, alignment, experiments, tokens, stored artifacts and the command line, on small tables."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.__main__ import main
from sievewright.functions import text as T
from sievewright.operators import evaluation as E
from sievewright.operators import features as X
from sievewright.operators import leakage as G
from sievewright.operators import linear as M
from sievewright.operators import manifests as D
from sievewright.operators import splits as S
from sievewright.operators import tokens as K
from sievewright.plans import curation
from sievewright.plans import experiments as W
from sievewright.sources import artifacts as A
from sievewright.sources import files

TOPICS = {"Incident": "server down error crash outage", "Request": "please access account license install", "Problem": "slow recurring cause leak memory"}


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        label = list(TOPICS)[i % 3]
        other = rng.choice(list(TOPICS))
        words = rng.choices(TOPICS[label].split(), k=6) + rng.choices(TOPICS[other].split(), k=2) + rng.choices("the and with from about".split(), k=4)
        rng.shuffle(words)
        rows.append((f"r{i:03d}", " ".join(words), label))
    return spark.createDataFrame(rows, "record_id string, text string, label string").persist()


@pytest.fixture(scope="module")
def prepared(records):
    p = W.prepare(records, "record_id")
    yield p
    W.release(p)


def test_split_checks(spark, records):
    good = S.checked_split(records, "label", "record_id")
    assert S.validate(records, good, "record_id", "label")["sizes"] == {"train": 105, "validation": 21, "test": 24}
    broken = {
        "extra": good.unionByName(spark.createDataFrame([("x", "t", "Request", "test")], good.schema)),
        "missing": good.where("record_id <> 'r001'"),
        "overlap": good.unionByName(good.where("record_id = 'r001'").withColumn("split", F.when(F.col("split") == "test", "train").otherwise("test"))),
        "assigned twice": good.unionByName(good.where("record_id = 'r001'")),
    }
    for what, s in broken.items():
        with pytest.raises(S.SplitError, match=what):
            S.validate(records, s, "record_id", "label")
    with pytest.raises(S.SplitError, match="share"):
        S.validate(records, records.withColumn("split", F.when(F.col("label") == "Request", "test").otherwise("train")), "record_id", "label")
    with pytest.raises(S.SplitError, match="dataset"):
        S.validate(records, good, "record_id", "label", versions=("ds_1", "ds_2"))
    with pytest.raises(S.SplitError):
        S.checked_split(records.limit(4), "label", "record_id")
    r = S.random_split(records, "record_id")
    assert {x["split"]: x["count"] for x in r.groupBy("split").count().collect()} == {"train": 105, "validation": 22, "test": 23}
    assert S.validate(records, r, "record_id", "label", stratified=False)["sizes"]["test"] == 23
    assert S.overlap(r.where("split = 'train'"), r.where("split = 'test'"), "record_id").count() == 0


def test_frozen_split_is_read_back_and_checked(spark, records, tmp_path):
    split = S.checked_split(records, "label", "record_id")
    m = A.write_split(split, str(tmp_path / "s"), "record_id", "label", 42, {"train": 0.7, "validation": 0.15}, "ds_1")
    assert m["split_version"].startswith("split_") and A.read_split(spark, str(tmp_path / "s"), "record_id", "label").count() == 150
    split.where("record_id <> 'r005'").write.mode("overwrite").partitionBy("split").parquet(str(tmp_path / "s/parts"))
    with pytest.raises(A.ArtifactError, match="ids"):
        A.read_split(spark, str(tmp_path / "s"), "record_id", "label")
    a, b = (D.id_digests(split.repartition(n), "record_id", "split") for n in (1, 7))
    assert a == b


def test_vocabulary_comes_from_training_alone(spark, prepared, tmp_path):
    train = prepared.split.where("split = 'train'").collect()
    counts = {}
    for r in train:
        w = r.text.split()
        for t in {*w, *map(" ".join, zip(w, w[1:]))}:
            counts[t] = counts.get(t, 0) + 1
    want = {t: np.log((1 + len(train)) / (1 + n)) + 1 for t, n in counts.items() if n >= 2}
    got = {r.term: r.idf for r in prepared.vocabulary.collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)
    lengths = prepared.weights["test"].groupBy("record_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert all(abs(r.n - 1) < 1e-9 for r in lengths.collect())
    X.write_features(str(tmp_path), prepared.vocabulary, prepared.weights, {"min_df": 2})
    vocabulary, back, meta = X.read_features(spark, str(tmp_path), ("train", "test"))
    assert vocabulary.count() == len(want) and meta["feature_version"].startswith("features_") and back["test"].count() == prepared.weights["test"].count()
    with pytest.raises(ValueError):
        X.fit_vocabulary(prepared.weights["test"], 1, 0)


def test_nearest_training_records_whatever_is_common(prepared):
    p = prepared
    vectors = {s: {} for s in ("train", "test")}
    for s in vectors:
        for r in p.weights[s].collect():
            vectors[s].setdefault(r.record_id, {})[r.term] = r.weight
    for common in (0.05, 0.0):
        old, X_rows = X.nearest_training(p.weights["test"], p.weights["train"], "record_id", common), {}
        X_rows = {r.record_id: (r.nearest, r.cosine) for r in old.collect()}
        for i, v in vectors["test"].items():
            best = min((-round(sum(x * u.get(t, 0) for t, x in v.items()), 6), j) for j, u in vectors["train"].items())
            assert X_rows[i][0] == best[1] and abs(X_rows[i][1] + best[0]) < 2e-6


def test_baseline_is_stored_and_predicts_the_same(prepared, tmp_path):
    r = W.run_baseline(prepared, "logistic_regression", str(tmp_path))
    assert r["metrics"]["test"]["macro_f1"] > 0.8 and set(r["metrics"]["test"]["per_class"]) == set(TOPICS)
    assert json.loads((tmp_path / "logistic_regression/metrics.json").read_text())["model_version"] == r["model_version"]
    model = A.read_model(str(tmp_path / "logistic_regression"), M.LOGISTIC)
    texts = {x.record_id: x.text for x in prepared.split.where("split = 'test'").collect()}
    idf = {x.term: x.idf for x in prepared.vocabulary.collect()}
    got = dict(zip(texts, W.local_scorer(model, idf)(list(texts.values()))))
    assert got == {x.record_id: x.predicted for x in r["predictions"]["test"].collect()}
    with pytest.raises(A.ArtifactError):
        A.read_model(str(tmp_path / "logistic_regression"), M.SQUARED_HINGE)


def test_distributed_fit_equals_local(prepared, monkeypatch):
    local = M.fit(prepared.rows["train"], prepared.terms, M.LOGISTIC)
    for first, block in ((0, 250_000), (1, 300), (16, 100)):  # from nothing, from a part of the rows, from several blocks
        monkeypatch.setattr(M, "FIRST_BLOCKS", first)
        monkeypatch.setattr(M, "BLOCK_WEIGHTS", block)
        monkeypatch.setattr(M, "STRETCH", 37 + block)
        far = M.fit(prepared.rows["train"], prepared.terms, M.LOGISTIC, tolerance=1e-3)
        assert np.abs(local.coefficients - far.coefficients).max() < 0.01
    monkeypatch.setattr(M, "MOST_COEFFICIENTS", 10)
    with pytest.raises(ValueError, match="min_df"):
        M.fit(prepared.rows["train"], prepared.terms, M.LOGISTIC)


def test_comparison_weighting_calibration_and_thresholds(prepared):
    p = prepared
    a, b = (W.run_baseline(p, n) for n in W.LOSSES)
    pairs = W.paired(a["predictions"]["test"], b["predictions"]["test"], "record_id")
    assert pairs.count() == 24 and W.select_model([a, b]) in W.LOSSES
    assert W.near_duplicate_scores(p, pairs).where("bucket = 'all'").first().records == 24
    w = W.run_weighting(p, "linear_svm")
    assert w["selected"] == ("balanced" if w["change"]["macro_f1"] > 0 else "none")
    for n, r in (("logistic_regression", a), ("linear_svm", b)):
        c = W.run_calibration(r["predictions"]["validation"], "record_id", p.classes, n == "logistic_regression")
        assert 1e-3 <= c["temperature"] <= 100 and c["rows"].count() == 12 and (n == "logistic_regression" or c["selected"] == "calibrated")
        t = W.run_thresholds(c, [0.5, 0.9], 0.5)
        assert t["status"] == "selected" and t["sweep"].count() == 3 and W.run_thresholds(c, [0.5])["status"] == "pending"
    f = E.final_comparison({n: r["predictions"]["test"] for n, r in (("lr", a), ("svm", b))}, p.classes, {"lr": [{"batch_size": 1, "p50_ms": 1.0, "p95_ms": 2.0, "records_per_second": 3.0}]})
    assert f["recommended"] in ("lr", "svm") and f["pairs"][0]["low"] <= f["pairs"][0]["high"] and f["benchmark"]["svm"]["p50_ms"] is None and f["benchmark"]["lr"]["p95_ms"] == 2.0
    text = W.markdown("T", {"scores": f["scores"], "list": [1.5], "one": {"a|b": None}, "word": "x"})
    assert "| lr |" in text and "- 1.500000" in text


def test_alignment_is_strict(spark):
    r = spark.createDataFrame([(1, "a"), (2, "b")], "id int, label string")
    p = lambda rows: spark.createDataFrame(rows, "id int, actual string, predicted string")
    assert E.align(r, p([(1, "a", "b"), (2, "b", "b")]), "id").count() == 2
    for wrong in ([(1, "a", "a")], [(1, "a", "a"), (2, "a", "b")], [(1, "a", "a"), (2, "b", None)], [(1, "a", "a"), (1, "a", "a"), (2, "b", "b")], [(1, "a", "a"), (2, "b", "b"), (3, "a", "a")]):
        with pytest.raises(ValueError):
            E.align(r, p(wrong), "id").count()
    with pytest.raises(ValueError):
        E.subset(r, spark.createDataFrame([(9,)], "id int"), "id")
    for classes, labels in ((["a"], ["a"]), (["a", "b"], ["a", "c"]), (["a", "b"], ["a"])):
        with pytest.raises(ValueError):
            E.balanced_weights(labels, classes)
    assert E.balanced_weights(["a", "a", "a", "b"], ["b", "a"]) == {"b": 2.0, "a": 4 / 6}
    top = [("x", "positive", "t1", 1.0), ("x", "positive", "t2", 0.5)], [("x", "positive", "t2", 1.0), ("x", "negative", "t3", -1.0)]
    assert E.feature_overlap(*top)["x", "positive"] == {"shared": ["t2"], "only_a": ["t1"], "only_b": []}


def test_timing_cost_and_sizes(tmp_path):
    ticks = iter(range(1000))
    rows = E.measure(lambda b: None, list(range(8)), (1, 4), 1, 2, clock=lambda: next(ticks))
    assert rows[0]["p50_ms"] == 1000.0 and rows[0]["records_per_second"] == 1.0 and rows[1]["records_per_second"] == 4.0
    (tmp_path / "a").write_bytes(b"xyz")
    assert E.stored_bytes([tmp_path, tmp_path / "a"])["total_bytes"] == 3 and E.cost(10, None) is None
    for bad in ((0, 1.0), (1.0, -1.0), (float("nan"), 1.0)):
        with pytest.raises(ValueError):
            E.cost(*bad)
    with pytest.raises(FileNotFoundError):
        E.stored_bytes([tmp_path / "b"])


def test_tokens(spark, records, tmp_path):
    labels = K.LabelMapping(sorted(TOPICS))
    t = K.tokenize(records, labels, max_length=10)
    K.check_alignment(records, t, labels, 10)
    assert t.where("size(input_ids) <> 10 or n_tokens <> 14 or size(attention_mask) <> 10").count() == 0 and labels.decode(labels.encode("Request")) == "Request"
    with pytest.raises(ValueError):
        K.check_alignment(records, t.limit(100), labels, 10)
    with pytest.raises(ValueError):
        K.check_tokenizer(lambda texts: [[] for _ in texts])
    m = K.write_dataset(str(tmp_path), {"train": t}, labels, 10, "words", "split_1")
    assert m["sizes"] == {"train": 150} and m["dataset_version"].startswith("tokens_")


def test_lines_tell_where_they_are_wrong(spark, tmp_path):
    path = tmp_path / "p.jsonl"
    path.write_text('{"record_id": "1", "actual": "a", "predicted": "b"}\n\n{"record_id": "2"}\n')
    with pytest.raises(A.ArtifactError, match="line 3"):
        A.read_predictions(spark, str(path))
    path.write_text('{"record_id": "1", "actual": "a", "predicted": "b"}\nnonsense\n')
    with pytest.raises(A.ArtifactError, match="line 2"):
        A.read_predictions(spark, str(path))
    path.write_text('{"record_id": "1", "actual": "a", "predicted": "b", "scores": [0.5]}\n\n')
    assert A.read_predictions(spark, str(tmp_path / "none.jsonl"), str(path)).first().scores == [0.5]
    with pytest.raises(A.ArtifactError, match="lacks"):
        (tmp_path / "d.json").write_text("{}")
        A.read_dataset_manifest(str(tmp_path / "d.json"))


def test_json_types_are_checked(spark, tmp_path):
    rows = [{"body": 5, "type": "Change", "queue": "q", "priority": "low", "language": "en", "version": 3}, {"body": "m", "type": "Change", "queue": "q", "priority": "low", "language": "en", "version": True}, {"body": "m", "type": ["x"], "queue": "q", "priority": "low", "language": "en", "version": [1]}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    from sievewright.operators import records as R

    got = [r.errors for r in R.schema_errors(R.map_records(files.read_json(spark, str(tmp_path / "a.json"), curation.SOURCE_COLUMNS))).collect()]
    assert got == [["message:string_type"], [], ["ticket_type:string_type", "source_version:int_type"]]
    assert files.load_records(spark, str(tmp_path / "a.json"), curation.SOURCE_COLUMNS).count() == 3


def test_semantic_duplicates_in_curation(spark):
    body = ["the server is down", "the server is down", "the server was down", "please install", "a license"]
    rows = [(i, None, b, "Incident", "IT", "high", "en", "1", "x" if i == 3 else "") for i, b in enumerate(body)]
    source = spark.createDataFrame(rows, "record_index long, subject string, body string, type string, queue string, priority string, language string, version string, answer string")
    encode = lambda c: F.transform(F.array(*[F.lit(w) for w in "server down was please install license a".split()]), lambda w: F.when(F.contains(c, w), 1.0).otherwise(0.01))
    t, _ = curation.annotate(source, curation.CurationConfig(semantic=curation.SemanticConfig(encode, 0.7)))
    got = {r.record_index: r for r in t.collect()}
    assert got[1].duplicate_of == 0 and got[1].semantic_status == "skipped_exact_duplicate" and got[2].semantic_of == 0 and got[3].semantic_status == "unique"
    assert got[2].leakage.grouping.semantic_duplicate_group_id == 0 and got[3].leakage.status == "warning"
    for bad in (2, True):
        with pytest.raises(ValueError):
            curation.SemanticConfig(encode, bad)
    with pytest.raises(curation.CurationError):
        curation.annotate(source, curation.CurationConfig(semantic=curation.SemanticConfig(lambda c: F.array(F.lit(0.0), F.lit(0.0)))))


def test_leakage_links_must_point_back(spark):
    t = spark.createDataFrame([(0, None), (1, 0), (2, 5)], "record_index long, d long")
    got = [r.leakage for r in G.check(t, exact="d").orderBy("record_index").collect()]
    assert [g.status for g in got] == ["clean", "clean", "failed"] and got[2].targets is None and got[1].unchecked_fields == ["answer"]
    lists = spark.createDataFrame([(0, [1])], "record_index long, g array<int>")
    assert G.check(lists, G.LeakageConfig((), (), (), ("g",))).first().leakage.status == "failed"
    with pytest.raises(ValueError):
        G.LeakageConfig((" ",))


def test_sequential_digest(spark):
    a = D.sequential_digest(spark.createDataFrame([(2, "b"), (1, "a")], "i int, t string"), "i", F.col("t"))
    b = D.sequential_digest(spark.createDataFrame([(1, "a"), (2, "b")], "i int, t string"), "i", F.col("t"))
    assert a == b and a["records"] == 2


def test_text_joins(spark):
    df = spark.createDataFrame([(" s ", " m "), (None, "m"), ("", " ")], "s string, m string")
    got = df.select(T.joined_text(F.col("s"), F.col("m")), T.semantic_text(F.col("s"), F.col("m")), T.language_text(F.col("s"), F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("s\n\nm", " s \n m ", " s \n m "), ("m", "\nm", "m"), ("", "\n ", " ")]


def test_commands(records, tmp_path):
    source, out = str(tmp_path / "r"), str(tmp_path / "out")
    records.write.parquet(source)
    for command in (["split"], ["features"], ["train"], ["weighting", "analyze"], ["calibration", "report", "--target", "0.5"], ["benchmark", "check"], ["benchmark", "run", "--hourly-rate", "1"], ["compare"], ["tokenize", "run"]):
        extra = command[1:] if command[0] not in ("weighting", "calibration", "benchmark", "tokenize") else command[2:]
        step = [command[1]] if command[0] in ("weighting", "calibration", "benchmark", "tokenize") else []
        assert main([command[0], *step, source, f"{out}/{command[0] if command[0] != 'benchmark' else 'train'}", *extra]) == 0
    assert json.loads((tmp_path / "out/train/benchmark.json").read_text())["timings"][0]["per_1000"] > 0
    assert "Final comparison" in (tmp_path / "out/compare/final_comparison.md").read_text()
