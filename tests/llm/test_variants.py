"""Spelling variants against a comparison of all words."""

import collections
import random
import re
import zlib

import pytest

from sievewright.llm import variants

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(rows):
    n = collections.Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    by = {w: [u for u in n if near(w, u)] for w in n}
    form = {}
    for w, found in by.items():
        best = min(found, key=lambda u: (-n[u], u), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(by[w]), n[form[w]] if form[w] else None)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = ["planteur", "Ölfarben", "seltsame", "naïveté", "réservé", "conversation", "aaaaaaaa", "stressed", "desserts", "abcdefg", "bacdefg", "gfedcba"]
    words = list(base)
    for w in base * 12:  # one or two edits away
        for _ in range(rng.randint(1, 2)):
            k = rng.randrange(len(w) + 1)
            w = w[:k] + rng.choice(["", "e", "é", "×"]) + w[k + rng.randint(0, 1) :]
        words.append(w)
    out = []
    for i in range(300):
        weights = [240 if w in base[:4] else 24 if w in base else 1 + 14 * (k % 9 == 0) for k, w in enumerate(words)]
        text = " ".join(rng.choices(words, weights, k=60))
        out.append((i, text.upper() if i % 7 == 0 else text.replace(" ", rng.choice([" ", ", ", "9", "_", "\n"]))))
    out += [(3, "planteur planteur"), (3, None), (4, ""), (None, "planteur seltsame seltsamx seltsamx"), (None, None), (5, "a" * 30000 + " " + "a" * 30000 + " " + "a" * 29999 + " " + "a" * 29999), out[7], out[7], (9, "ſſſſſſſſſ ĀĀĀĀĀĀĀĀ ŁŁŁŁŁŁŁŁŁ")]
    return out


@pytest.fixture(scope="module")
def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, word string, n int, run string").repartition(3)
    counts = variants.materialize(variants.word_counts(variants.mangled(variants.letter_runs(docs))), "t")
    return variants.roots(variants.materialize(variants.forms(counts), "t")).collect()


def test_equals_all_pairs(found, rows):
    want = plain(rows)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found} == want
    assert len(found) == len(want)
    # chains, additions, removals and exchanges occur
    assert any(f is not None and r != f for f, r, *_ in want.values())
    assert {len(w) - len(v[0]) for w, v in want.items() if v[0]} == {-1, 0, 1}


def test_anagrams_do_not_meet(spark):
    rng = random.Random(2)
    words = set()
    while len(words) < 1500:
        w = list("abcdefgh")
        rng.shuffle(w)
        words.add("".join(w))
    words = sorted(words | {w[:3] + "x" + w[4:] for w in list(words)[:40]})
    counts = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in variants.near_words(counts).collect()}
    changed = [w for w in words if "x" in w]
    assert got == {p for a in changed for b in words if near(a, b) for p in ((a, b), (b, a))}


def test_long_chain_of_forms(spark):
    words = [("aaaaaaaa", 2), ("aaaaaaab", 20), ("aaaaaabb", 200), ("aaaaabbb", 2000), ("aaaabbbb", 20000), ("aaabbbbb", 200000)]
    got = {r.word: r.root for r in variants.roots(variants.materialize(variants.forms(spark.createDataFrame(words, "word string, n long")), "t")).collect()}
    assert got == {w: "aaabbbbb" for w, _ in words}


def test_no_words(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    counts = variants.word_counts(variants.mangled(variants.letter_runs(docs)))
    assert variants.roots(variants.materialize(variants.forms(counts), "t")).count() == 0
