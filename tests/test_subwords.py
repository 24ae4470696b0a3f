"""Subword ids against the same rule of an installed tokeniser library, and odd rows."""

import pytest

from sievewright.operators import subwords as W
from sievewright.operators import tokens as K

PIECES = ["[UNK]", "[CLS]", "[SEP]", *"abcdehilnoprstu", *(f"##{c}" for c in "abcdehilnoprstu"), "res", "rest", "resta", "##tar", "##art", "##ed", "print", "##er", "ü", "##ü", ".", "!"]
IDS = {p: i for i, p in enumerate(PIECES)}
LABELS = K.LabelMapping(["x", "y"])
TEXTS = [
    (1, "Restarted the printer. Restart!", "x"), (2, None, "y"), (3, "", "x"), (4, "  \t\n ", "y"), (5, "a" * 100 + " " + "a" * 101, "x"), (6, "aqa printer über Ü", "y"),
    (7, "printer " * 3000, "x"), (8, "restarted restarted", "x"), (9, "restarted restarted", "y"), (10, "a-b_c #5", "x"), (11, "b" * 200_000, "y"),
]
KIND = "record_id int, text string, label string"


def by_library(texts, room):
    from tokenizers import Tokenizer
    from tokenizers.models import WordPiece
    from tokenizers.pre_tokenizers import Split
    from tokenizers import Regex

    t = Tokenizer(WordPiece(IDS, unk_token="[UNK]", max_input_chars_per_word=W.LONGEST_WORD))
    t.pre_tokenizer = Split(Regex(r"[\p{L}\p{N}]+|[^\p{Z}\p{C}\p{L}\p{N}]"), "removed", invert=True)
    out = []
    for text in texts:
        ids = t.encode((text or "").lower(), add_special_tokens=False).ids
        out.append(([1, *ids[:room], 2], len(ids) + 2))
    return out


@pytest.mark.parametrize("common", [1, 20_000])
def test_equals_library(spark, common):
    rows = spark.createDataFrame(TEXTS, KIND)
    t = W.tokenize(rows, LABELS, W.from_pieces(spark, IDS), 0, 1, 2, 40, common=common)
    K.check_alignment(rows, t, LABELS, 40)
    got = {r.record_id: (r.input_ids, r.n_tokens) for r in t.collect()}
    assert got == dict(zip([r[0] for r in TEXTS], by_library([r[1] for r in TEXTS], 38)))
    assert got[2] == ([1, 2], 2) and got[11] == ([1, 0, 2], 3)


def test_empty_table_and_no_specials(spark):
    pieces = W.from_pieces(spark, IDS)
    assert W.tokenize(spark.createDataFrame([], KIND), LABELS, pieces, 0).count() == 0
    r = W.tokenize(spark.createDataFrame([(1, "rest printer", "y")], KIND), LABELS, pieces, 0, max_length=2).first()
    assert r.input_ids == [IDS["rest"], IDS["print"]] and r.attention_mask == [1, 1] and r.n_tokens == 3 and r.label == 1


@pytest.mark.parametrize("rows", [[(1, "a", "x"), (1, "b", "x")], [(1, "a", None)], [(None, "a", "x")], [(1, "a", "z")]])
def test_refused_records(spark, rows):
    with pytest.raises(Exception, match="several records|unknown label"):
        W.tokenize(spark.createDataFrame(rows, KIND), LABELS, W.from_pieces(spark, IDS), 0).collect()


def test_vocabularies(spark, tmp_path):
    import json

    (tmp_path / "vocab.txt").write_text("\n".join(PIECES) + "\n")
    (tmp_path / "t.json").write_text(json.dumps({"model": {"type": "WordPiece", "vocab": IDS, "continuing_subword_prefix": "##"}}))
    (tmp_path / "other.json").write_text(json.dumps({"model": {"type": "BPE", "vocab": IDS}}))
    want = sorted(W.from_pieces(spark, IDS).collect())
    assert sorted(W.read_lines(spark, f"{tmp_path}/vocab.txt").collect()) == want == sorted(W.read_json(spark, f"{tmp_path}/t.json").collect())
    assert W.special_ids(W.read_json(spark, f"{tmp_path}/t.json")) == [0, 1, 2]
    with pytest.raises(ValueError, match="lacks"):
        W.special_ids(W.from_pieces(spark, {"a": 0}))
    with pytest.raises(ValueError, match="BPE"):
        W.read_json(spark, f"{tmp_path}/other.json")
    with pytest.raises(ValueError, match="once"):
        W.cut(spark.createDataFrame([("a",)], "word string"), W.from_pieces(spark, IDS).union(W.from_pieces(spark, {"a": 99})), 0)
    with pytest.raises(ValueError, match="room"):
        W.tokenize(spark.createDataFrame([], KIND), LABELS, W.from_pieces(spark, IDS), 0, 1, 2, 1)


def test_command(tmp_path, spark):
    from sievewright.__main__ import main

    (tmp_path / "vocab.txt").write_text("\n".join(PIECES))
    rows = [(i, "restarted printer" if i % 2 else "rest", "xy"[i % 2]) for i in range(20)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/in")
    assert main(["tokenize", "run", f"{tmp_path}/in", f"{tmp_path}/out", "--vocabulary", f"{tmp_path}/vocab.txt"]) == 0
    kept = [r for part in ("train", "validation", "test") for r in spark.read.parquet(f"{tmp_path}/out/{part}").collect()]
    assert len(kept) == 20 and {tuple(r.input_ids) for r in kept if r.record_id % 2 == 0} == {(1, IDS["rest"], 2)}


def test_words_beyond_the_cut_are_not_collected(spark):
    """Collecting sorts rows beyond memory: a text's words after max_length are summed by hash alone."""
    t = W.tokenize(spark.createDataFrame(TEXTS, KIND), LABELS, W.from_pieces(spark, IDS), 0, 1, 2, 40, common=2)
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(CASE WHEN (pos" not in plan
    assert {r.record_id: r.n_tokens for r in t.collect()} == {i: n for (i, _, _), (_, n) in zip(TEXTS, by_library([x[1] for x in TEXTS], 38))}
