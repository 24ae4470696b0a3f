"""The ten operators on small tables: brute force, round trips, held-out rows, and odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from sievewright.llm import dedup, language, lm, media, mixing, packing, quality, substrings, tokencounts, toxicity
from sievewright.llm.common import bound_batches
from sievewright.llm.tokens import TextTokenizer

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, bands int, start string, held_out string, kept int, rank string"
SYLLABLES = "ba co di fu ge ha ji ko lu me no pi ra so tu ve".split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = [prose(rng, rng.randint(1, 260)) for _ in range(110)]
    passage = prose(rng, 60)
    for i in range(12):
        out.append(prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 40))
    for i in range(10):
        w = out[i].split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [out[5], out[5], out[40], None, None, "", " \n\t ", "a", "a b c", "é" * 120, "x " * 400, prose(rng, 9000), "\x1c odd   blanks \x85", "<|endoftext|> <mask> 漢字 text"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    bound_batches(spark)
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", "s1", None][i % 3], len(t or ""), "d", 1, "s", "h", 2, "r") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark, texts):
    return spark.createDataFrame([(i, i % 5 != 0 and 1 or 0, i % 4 == 0 and 1 or 0) for i, _ in texts] + [(0, 1, 1), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def exact_library():
    """The library as it comes, with nothing set on it."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))


def test_token_counts_by_brute_force_and_block_size(docs, texts):
    t = TextTokenizer()
    for block in (1 << 20, 7, 64):
        got = by_id(tokencounts.count_tokens(docs, block_tokens=block))
        assert {i: r.tokens for i, r in got.items()} == {i: len(t(x)) for i, x in texts}


def test_token_file_without_last_separator(spark, tmp_path):
    np.array([5, 6, 50256, 7, 50256, 50256, 8, 9, 9], "<u2").tofile(tmp_path / "a.u16")
    np.array([50256], "<u2").tofile(tmp_path / "b.u16")
    files = spark.createDataFrame([("a.u16",), ("b.u16",)], "file string")
    for block in (1, 2, 3, 100):
        r = tokencounts.scan_blocks(str(tmp_path), tokencounts.token_blocks(spark, str(tmp_path), files, block), block_tokens=block)
        got = sorted((x.file, x.ordinal, x.tokens) for x in tokencounts.stitch(r).collect())
        assert got == [("a.u16", 0, 2), ("a.u16", 1, 1), ("a.u16", 2, 0), ("a.u16", 3, 3), ("b.u16", 0, 0)]


def test_tokens_equal_the_exact_library(texts):
    t, rng = TextTokenizer(), random.Random(1)
    for _, x in texts:
        assert t(x).tolist() == (t.exact.encode(x or "", add_special_tokens=False).ids)
    for _ in range(300):
        x = "".join(rng.choice("ab Z9'éß!?.,  \n\t  漢\x85\x1c#") for _ in range(rng.randint(0, 40)))
        assert t(x).tolist() == t.exact.encode(x, add_special_tokens=False).ids
    default, special = exact_library(), TextTokenizer(literal=False)
    for x in [x or "" for _, x in texts] + ["<|endoftext|>", "a<|endoftext|>b c", "<|endoftext", "é<|endoftext|>漢"]:
        assert special(x).tolist() == default.encode(x, add_special_tokens=False).ids
        assert 50256 not in t(x)
    assert 50256 in special("a<|endoftext|>b")


def test_language(spark, docs, empty):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        lang = ["aa", "bb"][i % 2]
        rows.append((i, " ".join(rng.choice(["the", "then", "hen"] if lang == "aa" else ["und", "der", "und?"]) for _ in range(30)), lang))
    rows += [(900, None, "aa"), (901, "123 !!", "bb"), (902, "", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    from sievewright.llm.common import fold

    got = by_id(language.predict(d, language.fit(d.where(fold("doc_id", 4) != 2))))
    assert all(got[i].lang_pred == ["aa", "bb"][i % 2] and 0.5 < got[i].score <= 1 for i in range(400))
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert got[0].held_out == (zlib.crc32(b"0") % 4 == 2)
    assert language.predict(empty, language.fit(empty)).count() == 0
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_media_round_trip(docs, texts, empty):
    got = by_id(media.decode_media(media.encode_media(docs)))
    for i, t in texts:
        b = (t or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        assert (got[i].n_bytes, got[i].payload_bytes, got[i].payload_sha256, got[i].tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        wide = media.unpack_pcm(got[i].pcm)
        samples = {"mulaw": 1, "alaw": 1}.get(got[i].feature.split(";")[0])
        assert len(wide) == 2 * (len(p) if samples else len(p) // 64 * 121) and media.pack_pcm(wide) == got[i].pcm
    assert media.decode_media(media.encode_media(empty)).count() == 0
    stored = {r.doc_id: r for r in media.encode_media(docs).collect()}
    assert {media.parse(r.media)[0] for r in stored.values()} == set(media.CODECS)


def test_codecs_against_plain_formulas():
    assert media.MULAW[0xFF] == 0 and media.MULAW[0x00] == -32124 and media.MULAW[0x80] == 32124
    assert media.ALAW[0xD5] == 8 and media.ALAW[0x55] == -8 and media.ALAW[0xAA] == 32256
    rng = np.random.default_rng(0)
    blocks = rng.integers(0, 256, (5, 64), dtype=np.uint8)
    for block, got in zip(blocks, media.decode_ima(blocks)):
        value, index, want = int(np.int16(int(block[0]) | int(block[1]) << 8 if block[1] < 128 else (int(block[0]) | int(block[1]) << 8) - 65536)), min(int(block[2]), 88), []
        want.append(value)
        for byte in block[4:].tolist():
            for n in (byte & 15, byte >> 4):
                step = int(media.STEPS[index])
                diff = (step >> 3) + (step if n & 4 else 0) + (step >> 1 if n & 2 else 0) + (step >> 2 if n & 1 else 0)
                value = max(-32768, min(32767, value - diff if n & 8 else value + diff))
                index = max(0, min(88, index + (-1 if n & 7 < 4 else 2 * (n & 7) - 6)))
                want.append(value)
        assert got.tolist() == want


def statistics(t):
    w = [x.decode() for x in WORD.findall((t or "").encode())]
    c = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if c[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum((t or "").count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_statistics_and_verdicts(spark, docs, texts, empty):
    stats = quality.text_statistics(docs)
    got = by_id(quality.judge(stats, quality.fit_mcd(stats)))
    for i, t in texts:
        r = got[i]
        want = statistics(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 2 * want[4] > want[0]) and (not r.base_failed or not r.kept)
    e = quality.text_statistics(empty)
    assert quality.judge(e, quality.fit_mcd(e)).count() == 0
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(80, 300)), "en", "s") for i in range(150)] + [(1000 + i, " ".join(w + "%%%" for w in prose(rng, 150).split()), "en", "s") for i in range(20)]
    s = quality.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    v = by_id(quality.judge(s, quality.fit_mcd(s)))
    assert all(r.kept == (i < 1000) for i, r in v.items())


def test_packing(docs, texts, empty):
    t = exact_library()
    rows = packing.pack_documents(docs, with_ids=True).collect()
    own = collections.defaultdict(list)
    seq = collections.defaultdict(list)
    for r in rows:
        own[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    for i, x in texts:
        ids = t.encode(x or "", add_special_tokens=False).ids + [0]
        got = []
        for r in sorted(own[i], key=lambda r: r.start):
            assert r.start == len(got) and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(r.ids)
            got += np.frombuffer(r.ids, "<u4").tolist()
        assert got == ids
    pad = total = 0
    for v in seq.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        total += at
        pad += packing.padded(at, 1024) - at
    assert pad <= 3 * 1024  # one open sequence for each of three tasks
    assert packing.pack_documents(empty).count() == 0
    p = packing.HarmonicPacker(12)
    assert [len(b) for x in range(9) for b in p.add(x, 4)] == [3, 3, 3] and p.close() == []


def union_find(pairs, ids):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_near_duplicates(docs, texts, empty):
    got = by_id(dedup.near_duplicate_classes(docs))
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := WORD.findall((t or "").encode())) else set() for i, t in texts}
    ids = [i for i, _ in texts]
    given = dict(texts)
    pairs = [(a, b) for a in ids for b in ids if a < b and given[a] is not None and (given[a] == given[b] or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])))]
    assert {i: r.class_id for i, r in got.items()} == union_find(pairs, ids)
    assert dedup.near_duplicate_classes(empty).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    e = rng.integers(0, 2**63, 80).astype(np.uint64)
    w = np.stack([rng.uniform(0.2, 3, 80), rng.uniform(0.2, 3, 80)])
    w[1, :30] = w[0, :30]
    s = dedup.dart_signatures(np.repeat([0, 1], 80), np.tile(e, 2), w.ravel(), 2, 2000)
    want = np.minimum(*w).sum() / np.maximum(*w).sum()
    assert abs((s[0] == s[1]).mean() - want) < 0.05


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)]
    got = {r.id: r.label for r in dedup.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(edges, {x for e in edges for x in e})
    assert got == want


def test_toxicity_restores_and_scores(spark, docs, labels, empty):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(600):
        bad = i % 5 == 0
        w = prose(rng, 40).split()
        if bad:
            w[7] = ["grumpkin", "vexhound"][i // 5 % 2]
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(bad)))
    hidden = ["gr0mpk1n gruuuumpkin", "v3xh0und", "g r u m p k i n here", "v.e.x.h.o.u.n.d"]
    rows += [(1000 + i, prose(rng, 20) + " " + h + " " + prose(rng, 20)) for i, h in enumerate(hidden)]
    rows += [(2000, None), (2001, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(d, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    got = by_id(toxicity.score(d, model))
    assert all((got[i].tox_score >= 0.3) == (i % 5 == 0) for i in range(600))
    assert all(got[1000 + i].tox_score >= 0.3 for i in range(len(hidden)))
    assert got[2000].tox_score < 0.3 and got[2001].tox_score < 0.3
    odd = toxicity.score(docs, toxicity.fit(docs, labels))
    assert odd.count() == docs.count() and odd.columns == [*docs.columns, "tox_score"]
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0
    assert toxicity.fit(docs, labels.limit(0)) is None


def test_mixing_meets_targets(spark, docs, labels, empty):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([1, 1, 1], 500)
    m = spark.createDataFrame([(i, int(rng.integers(1, 900)), x.tolist()) for i, x in enumerate(p)], "doc_id long, tokens long, posterior array<double>")
    names = ["a", "b", "c"]
    rates = mixing.fit_rates(m, names, {"a": 0.5, "b": 0.3, "c": 0.2}, total=200_000.0)
    out = mixing.apply_rates(m, rates).collect()
    have = sum(np.array(r.posterior) * r.tokens * r.rate for r in out)
    assert rates.report["miss"] < 0.01 and np.allclose(have, [100_000, 60_000, 40_000], rtol=0.02) and min(r.rate for r in out) >= 0
    # without replacement rates lie in [0, 1] and meet the shares
    rates = mixing.fit_rates(m, names, {"a": 0.5, "b": 0.3, "c": 0.2}, replacement=False)
    out = mixing.apply_rates(m, rates).collect()
    have = sum(np.array(r.posterior) * r.tokens * r.rate for r in out)
    assert np.allclose(have / have.sum(), [0.5, 0.3, 0.2], atol=0.003) and all(0 <= r.rate <= 1 and r.copies in (0, 1) for r in out)
    assert have.sum() > 0.5 * sum(r.tokens for r in out)
    with pytest.warns(UserWarning, match="misses its targets"):
        assert mixing.fit_rates(m.limit(1), names, {"a": 0.5, "b": 0.3, "c": 0.2}).report["miss"] > 0.01
    model = mixing.fit(docs, mixing.label_domains(labels))
    assert sorted(model.domains) == model.domains and mixing.memberships(docs, model).count() == docs.count()
    none = mixing.memberships(empty, model)
    assert mixing.apply_rates(none, mixing.fit_rates(none, model.domains, mixing.TARGETS)).count() == 0
    assert mixing.fit(empty, mixing.label_domains(labels)).domains == ["all"]
    assert mixing.fit(docs, mixing.label_domains(labels).limit(0)).domains == ["all"]


@pytest.mark.parametrize("hot", [20_000, 1])
def test_repeated_substrings(docs, texts, empty, hot):
    seen, want = set(), {}
    for i, t in texts:
        b = (t or "").encode()
        mark = np.zeros(len(b) + 1, int)
        for p in range(len(b) - 99):
            if (w := b[p : p + 100]) in seen:
                mark[p] += 1
                mark[p + 100] -= 1
            seen.add(w)
        gone = np.cumsum(mark[:-1]) > 0
        spans = sum(bool(g) and not h for g, h in zip(gone, [False, *gone[:-1]]))
        want[i] = int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
    out = substrings.remove_repeats(docs, hot_rows=hot)
    assert out.columns == [*docs.columns, "cut"]
    rows = out.collect()
    assert {r.doc_id: (r.cut.n_removed, r.cut.n_spans, r.cut.kept_sha256) for r in rows} == want
    given = dict(texts)
    assert all(r.text == given[r.doc_id] and (r.cut.kept is None) == (r.cut.n_removed == 0) for r in rows)
    assert substrings.remove_repeats(empty).count() == 0


def test_language_model(docs, texts, empty):
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*WORD.findall((t or "").encode().translate(low)), None] for i, t in texts}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for chunk in (24_000_000, 3000):
        got = by_id(lm.score_documents(docs, chunk_bytes=chunk))
        assert len(got) == len(texts)
        for i, ws in tokens.items():
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
            assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 and r.score < 0
    assert sum(got[i].score for i in got if held[i]) > sum(got[i].base_score for i in got if held[i])
    assert lm.score_documents(empty).count() == 0


def test_rows_without_id_and_repeated_rows(spark):
    rng = random.Random(8)
    a, b = prose(rng, 90), prose(rng, 120)
    d = spark.createDataFrame([(1, a, "en", "s"), (1, a, "en", "s"), (2, b, None, None), (None, a, "en", "s"), (None, None, None, None), (7, a, "en", None)], "doc_id long, text string, lang string, source string")
    assert media.decode_media(media.encode_media(d)).count() == 6
    assert language.predict(d, language.fit(d)).count() == 6
    s = quality.text_statistics(d)
    assert quality.judge(s, quality.fit_mcd(s)).count() == 6
    assert tokencounts.count_tokens(d).count() == 6
    classes = dedup.near_duplicate_classes(d).collect()
    assert len(classes) == 6 and {r.class_id for r in classes if r.doc_id in (1, 7)} == {1}
    assert sorted((r.doc_id or 0, r.cut.n_removed) for r in substrings.remove_repeats(d).collect()) == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 0), (7, len(a))]
    assert lm.score_documents(d).count() == 6


def test_language_model_knows_word_pairs(spark):
    # every word is rare and of the same frequency, so classes tell nothing: only word n-grams know which follows which
    rng = random.Random(12)
    vocabulary = [prose(rng, 1) + str(i) for i in range(4000)]
    chains = [rng.sample(vocabulary, 12) for _ in range(400)]
    rows = [(i, " ".join(w for c in rng.sample(chains, 6) for w in c)) for i in range(900)]
    seen = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2]
    given = dict(rows)
    mixed = [(i + 10_000, " ".join(rng.sample(given[i].split(), 72))) for i in range(900) if zlib.crc32(str(i + 10_000).encode()) % 7 == 2]
    got = by_id(lm.score_documents(spark.createDataFrame(rows + mixed, "doc_id long, text string"), chunk_bytes=30_000))
    a = np.mean([got[i].score / got[i].n_tokens for i in seen])
    b = np.mean([got[i].score / got[i].n_tokens for i, _ in mixed])
    assert got[seen[0]].held_out and a > b + 1.5 and a > -1.0


def test_word_probabilities_sum_to_one():
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 30, 50)
    counts[0] = 0  # the type never seen
    m = lm.WordInterpolation(lm.Totals(int(counts.sum()), int((counts > 0).sum()), 4))
    counts = np.append(counts[counts > 0], 0)
    m.weights = rng.dirichlet(np.ones(3), 2 * lm.BUCKETS)
    m.settle()
    k = len(counts)
    for t3, t2 in ((0, 0), (0, 7), (5, 7), (300, 900)):
        n3, n2 = rng.multinomial(t3, np.ones(k) / k), rng.multinomial(t2, np.ones(k) / k)
        assert abs(m.probabilities(counts, n2, n3, np.full(k, t2), np.full(k, t3)).sum() - 1) < 1e-9
    x = np.array([0, 5, 2**40, 2**56 - 1])
    assert lm._unpack(lm._pack(x)).tolist() == x.tolist() and lm._unpack(lm._pack(x[:0])).tolist() == []


def test_components_of_long_chains_with_shuffled_ids(spark):
    rng = random.Random(7)
    ids = rng.sample(range(10**6), 900)
    near = rng.sample(range(10**6, 2 * 10**6), 300)
    edges = list(zip(ids, ids[1:])) + [(near[i], near[j]) for i in range(300) for j in range(i + 1, min(300, i + 4))] + [(5 * 10**6, 5 * 10**6)]
    got = {r.id: r.label for r in dedup.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: min(ids) for i in ids} | {i: min(near) for i in near} | {5 * 10**6: 5 * 10**6}
    with pytest.raises(RuntimeError):
        dedup.connected_components(spark.createDataFrame(edges, "a long, b long"), most_rounds=1)


def test_near_duplicates_whose_shingles_repeat_differently(spark):
    rng = random.Random(17)
    rows = []
    for i in range(30):
        w = prose(rng, 30).split()
        rows += [(4 * i, " ".join(w)), (4 * i + 1, " ".join(w * 20))]
        p = prose(rng, 104).split()
        rows += [(4 * i + 2, " ".join(p)), (4 * i + 3, " ".join(p + p[:34] * 9))]
    got = by_id(dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r.class_id for i, r in got.items()} == {i: i - i % 2 for i, _ in rows}


def test_whole_sets_are_compared_whatever_their_sketches_say(spark):
    rng = np.random.default_rng(2)
    rows = []
    while len(rows) < 3:  # 800 of 1000 in common, but under 0.72 of the bins
        h = np.unique(rng.integers(0, 2**64, 1000, dtype=np.uint64))
        x, y = np.sort(h[rng.permutation(1000)[:900]]), h
        y = np.sort(np.concatenate([x[rng.permutation(900)[:800]], np.setdiff1d(h, x)]))
        a, b = dedup.sketch(x, 8), dedup.sketch(y, 8)
        if len(np.intersect1d(a, b)) < 0.72 * max(len(a), len(b)):
            rows.append((900, 900, a.tolist(), b.tolist(), (x >> np.uint64(33)).astype(np.int32).tolist(), (y >> np.uint64(33)).astype(np.int32).tolist()))
    d = spark.createDataFrame(rows, "n1 long, n2 long, sketch1 array<int>, sketch2 array<int>, fine1 array<int>, fine2 array<int>")
    assert d.where(dedup.sketches_agree()).count() == 3


def test_toxicity_restores_long_tokens_and_spaced_sentences():
    rng = random.Random(6)
    plain = [("the you here now are not what with " + w + " all of them ").split() for w in ("grumpkin", "vexhound")]
    text = " ".join(w for _ in range(3000) for w in rng.sample(plain[0] + plain[1], 6)).encode()
    c = toxicity._CODE[np.frombuffer(text, np.uint8)]
    model = toxicity.character_model(np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3).astype(float))
    found = lambda t: set(toxicity.Restorer(model)(t))
    assert "w:grumpkin" in found("gr" + "u" * 80 + "mpkin") and "w:vexhound" in found("v" + "." * 70 + "exh0und")
    assert "w:grumpkin" in found("/".join(["what", "you", "grumpk1n"] * 6))
    spaced = lambda words: " ".join(" ".join(w) for w in words)
    assert "w:grumpkin" in found(spaced(["you", "grumpkin"])) and "w:grumpkin" in found("  ".join(" ".join(w) for w in ["you", "grumpkin", "here"]))
    assert {"w:grumpkin", "w:vexhound"} <= found(spaced(["you", "are", "not", "grumpkin", "here", "now", "vexhound"] * 12))


def test_media_query_stores_the_pcm(spark, tmp_path, monkeypatch):
    stored, write = {}, media.materialize
    monkeypatch.setattr(media, "materialize", lambda df, name, *how: stored.setdefault(name, write(df, name, *how)))
    spark.createDataFrame([(1, "some text " * 30), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = media.op3_media_columns(spark, str(tmp_path))
    pcm = by_id(stored["pcm"])
    assert "pcm" not in out.columns
    wide = {i: media.unpack_pcm(r.pcm).astype("<i2").tobytes() for i, r in pcm.items()}
    assert {i: (len(w), str(zlib.crc32(w))) for i, w in wide.items()} == {i: (r.pcm_bytes, r.feature.split("=")[-1]) for i, r in by_id(out).items()}
    rng = np.random.default_rng(3)
    for n in (2, 10, 500):  # any samples, not only those that the filter makes
        x = rng.integers(-32768, 32768, n).astype(np.int16)
        assert media.unpack_pcm(media.pack_pcm(x)).tolist() == x.tolist()
