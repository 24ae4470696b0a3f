"""Summaries at two levels: the total is made of sums that are already added up, nulls and absent values included."""

import pytest
from pyspark.sql import functions as F

from sievewright.operators import comparison as V
from sievewright.operators import evaluation as E

ROWS = [("a", "a", 0.9, "x"), ("a", "b", 0.95, "x"), ("b", "b", None, "y"), ("b", "a", 0.2, None), ("c", "c", 0.5, "y"), (None, "a", 0.7, "y"), ("a", "a", 0.5, "y")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "actual string, predicted string, confidence double, bucket string").persist()


def levels(key):
    """Every row under all and under its own level."""
    out = {}
    for r in ROWS:
        for level in ("all", key(r)):
            out.setdefault(level, []).append(r)
    return out


def test_confidence_by_class(rows):
    mean = lambda v: round(sum(v) / len(v), 6) if v else None
    want = {}
    for level, rs in levels(lambda r: r[0]).items():
        have = [r for r in rs if r[2] is not None]
        right, wrong = ([r[2] for r in have if r[0] is not None and (r[0] == r[1]) is k] for k in (True, False))
        want[level] = (len(rs), mean([r[2] for r in have]), mean(right), mean(wrong), sum(r[2] >= 0.9 for r in have if r[0] is not None and r[0] != r[1]), sum({r[0], r[1]} == {"a", "b"} for r in rs))
    got = {r.label: tuple(r)[1:] for r in E.confidence_summary(rows, ("a", "b")).collect()}
    assert got == want
    assert E.confidence_summary(rows.limit(0)).count() == 0


def test_thresholds_by_class(rows):
    want = set()
    for level, rs in levels(lambda r: r[0]).items():
        for t in (0.0, 0.5, 0.9):
            took = [r for r in rs if r[2] is not None and r[2] >= t]
            want.add((t, level, len(rs), len(took), round(len(took) / len(rs), 6), sum(r[0] is not None and r[0] != r[1] for r in took)))
    assert {tuple(r) for r in E.threshold_by_class(rows, [0.5, 0.9]).collect()} == want


def test_scores_by_bucket(rows):
    known = rows.where("actual is not null and bucket is not null")
    got = {r.bucket: (r.records, r.accuracy) for r in V.bucket_scores(known).collect()}
    assert got == {"all": (5, 0.8), "x": (2, 0.5), "y": (3, 1.0)}


def test_rows_are_not_multiplied(rows):
    for t in (E.confidence_summary(rows), E.threshold_by_class(rows, [0.5]), V.bucket_scores(rows.where("bucket is not null"))):
        plan = t._jdf.queryExecution().optimizedPlan().toString().split("\n")
        first = max(i for i, line in enumerate(plan) if "Aggregate" in line)  # the lowest, which reads the rows
        assert any("Expand" in line for line in plan[:first]) and not any("Expand" in line or "Generate" in line for line in plan[first:])
