"""Command line: python -m sievewright COMMAND ...

curate SOURCE OUT; audit, split, features, train, weighting, calibration, benchmark, compare and tokenize read a Parquet
table of labelled records (--key, --text, --label) and write into a folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

STEPS = {
    "weighting": ("analyze", "classical", "compare"),
    "calibration": ("audit", "analyze", "generate-predictions", "fit", "thresholds", "compare", "report"),
    "benchmark": ("check", "run", "report"),
    "tokenize": ("run", "validate-only"),
}
MODELS = ("logistic_regression", "linear_svm")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sievewright")
    commands = top.add_subparsers(dest="command", required=True)
    what = {
        "curate": "CSV or JSON source to curated records", "audit": "audit of labelled records", "split": "stratified split, stored and checked", "features": "TF-IDF of a split", "train": "both linear models",
        "weighting": "class weights: analysis, models, comparison", "calibration": "temperature and thresholds", "benchmark": "timing and cost of stored models", "compare": "final comparison of both models", "tokenize": "token ids for sequence models",
    }
    for name, text in what.items():
        c = commands.add_parser(name, help=text)
        if name in STEPS:
            c.add_argument("step", choices=STEPS[name])
        c.add_argument("source")
        c.add_argument("out")
        if name != "curate":
            c.add_argument("--key", default="record_id")
            c.add_argument("--text", default="text")
            c.add_argument("--label", default="label")
            c.add_argument("--seed", type=int, default=42)
        if name == "calibration":
            c.add_argument("--target", type=float)
            c.add_argument("--threshold", type=float, action="append", default=[])
        if name == "benchmark":
            c.add_argument("--hourly-rate", type=float)
            c.add_argument("--records", type=int, default=64)
        if name == "tokenize":
            c.add_argument("--max-length", type=int, default=256)
            c.add_argument("--vocabulary", help="WordPiece vocabulary: a tokeniser's JSON file, or a text file with a piece a line")
    return top


def _tidy(value):
    """Results without frames and models, as they are written."""
    if isinstance(value, dict):
        return {str(k): _tidy(v) for k, v in value.items() if k not in ("model", "predictions", "rows")}
    if isinstance(value, DataFrame):
        return [r.asDict(recursive=True) for r in value.orderBy(*value.columns[:2]).collect()]  # results of classes and thresholds
    return [_tidy(v) for v in value] if isinstance(value, (list, tuple)) else value


def _write(folder: str, name: str, title: str, result: dict) -> None:
    from sievewright.operators import manifests
    from sievewright.plans.experiments import markdown

    tidy = _tidy(result)
    manifests.write_json(tidy, f"{folder}/{name}.json")
    manifests.write_text(markdown(title, tidy), f"{folder}/{name}.md")


def main(argv: list[str] | None = None) -> int:
    given = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"sievewright {given.command}").getOrCreate()
    if given.command == "curate":
        from sievewright.plans import curation

        curation.write(curation.curate_file(spark, given.source), given.out)
        return 0
    records = spark.read.parquet(given.source)
    globals()[f"run_{given.command}"](spark, records, given)
    return 0


def run_audit(spark, records, given) -> None:
    from sievewright.operators import audit, manifests

    result = audit.audit(records, given.label, given.text)
    manifests.write_json(result, f"{given.out}/audit.json")
    manifests.write_text(audit.audit_markdown(result), f"{given.out}/audit.md")


def run_split(spark, records, given) -> None:
    from sievewright.operators import splits
    from sievewright.plans import lineage
    from sievewright.sources import artifacts

    split = splits.checked_split(records, given.label, given.key, given.seed)
    splits.validate(records, split, given.key, given.label)
    artifacts.write_split(split, given.out, given.key, given.label, given.seed, {"train": 0.7, "validation": 0.15}, lineage.dataset_version(records, [given.key, given.text, given.label]))


def _split_versions(records, split, given, label: str) -> dict[str, str]:
    """Versions of the records and of their split, as the artifacts made of them name their parents."""
    from sievewright.operators import manifests
    from sievewright.plans import lineage

    made_of = lineage.dataset_version(records, [given.key, given.text, given.label])
    return lineage.of_split(manifests.split_manifest(split, label, given.seed, {"train": 0.7, "validation": 0.15}, made_of, given.key))


def _prepared(records, given):
    from sievewright.plans import experiments

    return experiments.prepare(records, given.key, given.text, given.label, given.seed)


def run_features(spark, records, given) -> None:
    from sievewright.operators import features

    p = _prepared(records, given)
    features.write_features(given.out, p.vocabulary, p.weights, {"ngrams": [1, 2], "min_df": 2, "seed": given.seed}, _split_versions(records, p.split, given, "label"))
    features.read_features(spark, given.out, tuple(p.weights))


def run_train(spark, records, given) -> None:
    from sievewright.operators import manifests
    from sievewright.plans import experiments

    p = _prepared(records, given)
    parents = _split_versions(records, p.split, given, "label")
    results = [experiments.run_baseline(p, n, given.out, parents=parents) for n in MODELS]
    manifests.write_json({"idf": {r.term: r.idf for r in p.vocabulary.collect()}}, f"{given.out}/scorer.json")  # the size of a model
    _write(given.out, "baseline", "Baseline models", {r["name"]: r["metrics"]["validation"] | {"train_seconds": r["train_seconds"]} for r in results} | {"selected": experiments.select_model(results)})


def run_weighting(spark, records, given) -> None:
    from sievewright.operators import classification, evaluation
    from sievewright.plans import experiments

    p = _prepared(records, given)
    if given.step == "analyze":
        counts = classification.class_distribution(p.split.where("split = 'train'"), "label").select("label", "records")
        plain = experiments.run_baseline(p, MODELS[0])
        scores = evaluation.frozen_scores(plain["predictions"]["validation"], p.classes)
        _write(given.out, "class_imbalance", "Class imbalance", {"classes": evaluation.imbalance_analysis(scores, counts), "weights": classification.class_weights(p.split.where("split = 'train'"), "label")})
        return
    names = MODELS if given.step == "compare" else MODELS[:1]
    results = {n: experiments.run_weighting(p, n) for n in names}
    _write(given.out, f"weighting_{given.step}", "Class weighting", {n: {**r["change"], "selected": r["selected"]} for n, r in results.items()})


def run_calibration(spark, records, given) -> None:
    from pyspark.sql import functions as F

    from sievewright.operators import calibration, evaluation
    from sievewright.plans import experiments

    p = _prepared(records, given)
    base = {n: experiments.run_baseline(p, n, given.out if given.step == "generate-predictions" else None) for n in MODELS}
    valid = {n: r["predictions"]["validation"] for n, r in base.items()}
    if given.step == "generate-predictions":
        return
    if given.step == "audit":
        bad = calibration.invalid_probabilities(valid[MODELS[0]].select(F.col("scores").alias("p")), len(p.classes)).count()
        held = p.split.where("split = 'validation'")
        _write(given.out, "prediction_audit", "Prediction audit", {n: {"records": evaluation.align(held, v, p.key).count(), "invalid_probabilities": bad if n == MODELS[0] else None} for n, v in valid.items()})
        return
    if given.step == "analyze":
        _write(given.out, "confidence", "Confidence before calibration", {"classes": evaluation.confidence_summary(valid[MODELS[0]].where("confidence is not null"))})
        return
    fitted = {n: experiments.run_calibration(v, p.key, p.classes, n == MODELS[0], given.seed) for n, v in valid.items()}
    told = {n: {"temperature": r["temperature"], "selected": r["selected"], **{f"{k}_after": v for k, v in r["after"].items()}, **({f"{k}_before": v for k, v in r["before"].items()} if r["before"] else {})} for n, r in fitted.items()}
    if given.step in ("fit", "compare"):
        _write(given.out, f"calibration_{given.step}", "Calibration", told)
        return
    found = {n: experiments.run_thresholds(r, sorted(given.threshold or [0.5, 0.6, 0.7, 0.8, 0.9]), given.target) for n, r in fitted.items()}
    policies = {n: {"status": t["status"], "threshold": t["threshold"], "calibration": fitted[n]["selected"]} for n, t in found.items()}
    _write(given.out, "thresholds" if given.step == "thresholds" else "calibration_report", "Thresholds and policies", {"policies": policies, **({"calibration": told} if given.step == "report" else {}), **{f"sweep {n}": t["sweep"] for n, t in found.items()}})


def run_benchmark(spark, records, given) -> None:
    from sievewright.operators import evaluation
    from sievewright.plans import experiments
    from sievewright.sources import artifacts, storage

    models = {n: artifacts.read_model(f"{given.out}/{n}") for n in MODELS if storage.exists(f"{given.out}/{n}/model.json")}
    if given.step == "check" or not models:
        if not models:
            raise FileNotFoundError(f"no stored models under {given.out}; run train first")
        return
    texts = [r[0] or "" for r in records.select(given.text).limit(given.records).collect()]
    features = artifacts.read_document(f"{given.out}/scorer.json") if storage.exists(f"{given.out}/scorer.json") else {}
    measured = {n: evaluation.measure(experiments.local_scorer(m, features.get("idf", {})), texts) for n, m in models.items()}
    sizes = {n: evaluation.stored_bytes([f"{given.out}/{n}/model.npz", f"{given.out}/{n}/model.json"])["total_bytes"] for n in models}
    rows = [{"model": n, **m, "bytes": sizes[n], **{k: v for k, v in (evaluation.cost(m["records_per_second"], given.hourly_rate) or {}).items() if k == "per_1000"}} for n, ms in measured.items() for m in ms]
    _write(given.out, "benchmark", "Text to label on one core", {"timings": rows})


def run_compare(spark, records, given) -> None:
    from sievewright.operators import evaluation
    from sievewright.plans import experiments

    p = _prepared(records, given)
    test = {n: experiments.run_baseline(p, n)["predictions"]["test"] for n in MODELS}
    _write(given.out, "final_comparison", "Final comparison", evaluation.final_comparison(test, p.classes))


def run_tokenize(spark, records, given) -> None:
    from sievewright.operators import splits, subwords, tokens

    records = records.where(f"`{given.label}` is not null")
    labels = tokens.LabelMapping(sorted(r[0] for r in records.select(given.label).distinct().collect()))
    options = {"max_length": given.max_length, "key": given.key, "text": given.text, "label": given.label}
    if given.vocabulary:
        pieces = (subwords.read_json if given.vocabulary.endswith(".json") else subwords.read_lines)(spark, given.vocabulary)
        t = subwords.tokenize(records, labels, pieces, *subwords.special_ids(pieces), **options)
    else:
        t = tokens.tokenize(records, labels, **options)
    tokens.check_alignment(records, t, labels, given.max_length, given.key, given.label)
    if given.step == "run":
        whole = splits.checked_split(records, given.label, given.key, given.seed)
        split = whole.select(given.key, "split")
        parts = {s: t.join(split.where(f"split = '{s}'").select(given.key), given.key) for s in splits.PARTS}
        tokens.write_dataset(given.out, parts, labels, given.max_length, given.vocabulary or "words", _split_versions(records, whole, given, given.label)["split_version"])


if __name__ == "__main__":
    raise SystemExit(main())
