"""Quoted CSV by ranges equals the read by one task, whatever the size of the ranges."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sievewright.sources import files
from sievewright.sources import ranges as R

ODD = ["", "plain", "two\nlines", 'say ""hi""', "a,b", "\n\n", "\r\n", "é\n漢字", "x" * 300, ' "', "1", '","', '"\n"', "tab\tand  spaces ", "\\", "'"]


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    spark.conf.set("spark.sql.files.openCostInBytes", "0")

    def to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield to
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write(path, rows, seed=0):
    rng = random.Random(seed)
    out = io.StringIO()
    for r in rows:
        csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator="\n").writerow(r)
        if rng.random() < 0.1:
            out.write("\n")  # a blank line is no record
    path.write_text(out.getvalue(), encoding="utf-8", newline="")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a",\n', max_size=6), min_size=2, max_size=3), min_size=1, max_size=6), st.booleans())
def test_lines_by_their_quotes(rows, every):
    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL if every else csv.QUOTE_MINIMAL, lineterminator="\n").writerows(rows)
    records, within = [], False
    for line in out.getvalue().split("\n")[:-1]:
        if within:
            records[-1] += "\n" + line
        elif line:
            records.append(line)
        within = R.ends_within(line, within)
    assert not within and [next(csv.reader(io.StringIO(r, newline=""))) for r in records] == [r for r in rows]


def test_equals_the_read_by_one_task(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    rows = [["subject", "body", "answer"], *[[rng.choice(ODD) or f"n{i}", rng.choice(ODD), str(i)] for i in range(400)]]
    write(tmp_path / "a.csv", rows)
    want = [(i, *r) for i, r in enumerate(rows[1:])]
    small_ranges(1 << 30)
    one = [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert [r[1:] for r in want] == one
    for n in (97, 700, 5000, 1 << 30):
        small_ranges(n)
        got = R.read_numbered_csv(spark, str(tmp_path / "a.csv"))
        assert got.columns == ["record_index", "subject", "body", "answer"]
        assert sorted(map(tuple, got.collect())) == want
    small_ranges(700)
    assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20  # tasks


def test_several_files_marks_and_odd_rows(spark, tmp_path, small_ranges):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "1.csv").write_text('﻿a,"b\nc"\r\n1,"x\r\ny"\r\n\r\n2\r\n3,z,more\r\n', encoding="utf-8", newline="")
    (folder / "2.csv").write_text('a,"b\nc"\n4,"un""quoted"\n5,in "the" middle', encoding="utf-8", newline="")
    (folder / "3.csv").write_text('a,"b\nc"\n', encoding="utf-8", newline="")
    for n in (3, 17, 1 << 30):
        small_ranges(n)
        got = R.read_numbered_csv(spark, str(folder))
        assert got.columns == ["record_index", "a", "b\nc"]
        assert sorted(map(tuple, got.collect())) == [(0, "1", "x\r\ny"), (1, "2", ""), (2, "3", "z"), (3, "4", 'un"quoted'), (4, "5", 'in "the" middle')]
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert R.read_numbered_csv(spark, str(tmp_path / "empty.csv")).collect() == []
    (tmp_path / "open.csv").write_text('a,b\n1,"' + "never closed\n" * 100)
    with pytest.raises(Exception, match="not closed"):
        R.read_numbered_csv(spark, str(tmp_path / "open.csv"), longest=500).collect()


def test_arrays_are_numbered_by_place(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": "x"}, {"a": 2}, {"b": "y"}]')
    got = files.numbered(spark, str(tmp_path / "a.json"), ["a"])
    assert [(r.record_index, r.a) for r in got.orderBy("record_index").collect()] == [(0, "x"), (1, "2"), (2, None)]
