"""Edit fingerprints against a walk of one tick at a time, and the search by bands against all pairs."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from sievewright.llm import edits

from .test_operators import prose


def plain_digits(text, e):
    """A walker that ticks: writes the character under it, moves on where the shared bit says so."""
    bits = np.random.default_rng(12).integers(0, 2, (edits.CLASSES, edits.PERIOD), dtype=np.int64)
    written, at = [], 0
    while at < len(text):
        written.append(text[at])
        at += int(bits[ord(text[at]) % edits.CLASSES][len(written) - 1 & edits.PERIOD - 1])
    ticks = [max((t for t in row if t < max(2 * len(text), 1)), default=0) for row in e.records.tolist()]
    out = []
    for k, t in enumerate(ticks):
        c = ord(written[t]) + 1 if t < len(written) else 0
        x = (c * 0x9E3779B97F4A7C15 + t + int(e.salt[k])) % 2**64
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
        out.append((x ^ x >> 31) >> 60)
    return "".join("0123456789abcdef"[v] for v in out)


def alike(a, b):
    return max(0.0, (sum(x == y for x, y in zip(a, b)) / edits.SAMPLES - 1 / 16) / (15 / 16))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    out = [(i * 3, prose(rng, rng.randint(1, 150))) for i in range(90)]
    copy = out[4][1]
    out += [(1000, copy), (1001, copy), (-5, copy + " x"), (7, None), (8, ""), (10, "a"), (11, "é漢🙂" * 9), (3, prose(rng, 30)), (3, prose(rng, 9)), (3, out[1][1]), (None, "no id"), (None, None), (400, "a" * 9000), (401, prose(rng, 6000))]
    return out


@pytest.fixture(scope="module")
def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, part string, which int").repartition(5)
    return edits.against_next(docs).collect()


def test_equals_plain(found, rows):
    e = edits.Embedding()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, np.int64(np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)))), reverse=True)
    want = []
    for k, (i, t) in enumerate(order):
        ahead = order[(k + 1) % len(order)][1]
        new = t[: len(t) - len(t) // 3] + ahead[: len(t) // 3]
        a, b, c = plain_digits(t, e), plain_digits(new, e), plain_digits(ahead, e)
        want.append((str(i), len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, round(alike(a, b), 9), round(alike(a, c), 9)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in found]
    assert sorted(got) == sorted(want)
    told = {}
    for (i, t), r in zip(order, want):
        assert told.setdefault(t, r[3]) == r[3]


def test_edited_texts_are_nearer_than_next_ones(found):
    long = [r for r in found if r.n_chars >= 60 and r.doc_id not in (3, 400, 1001, 1000, -5, None)]  # those stand before their copies
    assert np.median([r.near_edited for r in long]) > 0.5 and np.median([r.near_next for r in long]) < 0.15
    assert sum(r.near_edited > r.near_next for r in long) >= 0.99 * len(long)


def test_few_edits_keep_likeness():
    rng = random.Random(4)
    e = edits.Embedding()
    texts = [prose(rng, 200) for _ in range(40)]
    changed = []
    for t in texts:
        for _ in range(3):
            k = rng.randrange(len(t))
            t = t[:k] + rng.choice(["", "q", t[k] + "e"]) + t[k + 1 :]
        changed.append(t)
    a, b = edits.fingerprints(texts, e)[0], edits.fingerprints(changed, e)[0]
    assert np.median(edits.likeness(a, b)) > 0.8
    assert np.quantile(edits.likeness(a, np.roll(a, 1, 0)), 0.9) < 0.2


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, "text number %d" % i) for i in range(n)], "doc_id long, text string")
    got = {r.doc_id: r for r in edits.against_next(docs).collect()}
    assert set(got) == set(range(n))
    if n == 1:
        assert got[0].near_next == 1.0 and got[0].edited_sha256 == hashlib.sha256(b"text numbtext").hexdigest()
    if n == 2:
        assert got[0].near_next == got[1].near_next


def test_search_finds_all_alike(spark):
    rng = random.Random(6)
    e = edits.Embedding()
    base = [prose(rng, 80) for _ in range(25)]
    texts = list(base)
    for t in base:
        for m in (1, 2, 4):
            u = t
            for _ in range(m):
                k = rng.randrange(len(u))
                u = u[:k] + "z" + u[k + rng.randint(0, 1) :]
            texts.append(u)
    texts += base[:5]
    told = edits._told(edits.fingerprints(texts, e)[0])
    all_ = spark.createDataFrame([(t,) for t in told], "fingerprint string").repartition(3)
    queries = spark.createDataFrame([(t,) for t in told[:50]], "fingerprint string")
    got = {(r.fingerprint, r.near): round(r.likeness, 9) for r in edits.search(all_, queries).collect()}
    want = {(a, b): round(alike(a, b), 9) for a in set(told[:50]) for b in set(told) if a != b and alike(a, b) >= edits.LEAST}
    assert got == want and len(want) > 30
    assert edits.search(all_, queries).count() == len(want)
