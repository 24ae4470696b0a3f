"""Op 8.  Mixing sources to target weights by soft membership.

A softmax classifier over hashed n-grams, fitted on the labelled table, gives every document a posterior over
domains.  Document rates make the expected domain totals, sum of rate * tokens * posterior, equal to the targets: starting
from one, a projected gradient descent on the squared misses moves all rates at once and projects them onto r >= 0, or
onto [0, 1] where documents are drawn without replacement.  A rate depends on the document only through its posterior, so
a task replays the (few, short) residuals met so far instead of storing rates; each step is one aggregation that
brings one number per domain to the driver.  The step is scaled by the inverse of the domains' token-weighted Gram matrix.

With replacement the mixture's total is given (by default what keeps the largest target's domain whole), and a document
gets floor(rate + u) copies, u from a hash of its id: right on average, the same at every run.  Without replacement the
total is free: rates meet the target *shares*, so feasible rates always exist and those near one are found, and a document
has one copy at most.  The report tells the totals reached and the miss (the sum of absolute misses over the
total); a descent that does not settle within ``steps`` steps, or misses targets that it could meet, warns and says so.

The classifier is fitted on at most ``most_labelled`` labelled rows (default 4000, by hash of the id) of at most
``language.MOST_LABELS`` domains; totals cover all documents.  Null and empty texts have no tokens: they count nothing, and
their rate follows from their posterior.  Documents without labels are the rule.  Without labelled rows, or without
documents that have them, there is one domain.  Rows that repeat an id count each for itself and get the same rate.  Rows
without an id are drawn by the hash of null.  Equal posteriors: the first domain by name is the likeliest.  Only the id and
text columns are read, whatever the names of others.  Texts of any length are counted whole.  An empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ngrams
from .common import buffers, materialize, read_table, slices, words
from .language import bounded_sample, label_sizes

MOST_LABELLED = 4000
#: Target shares of tokens by domain; domains are quality and toxic of the labelled table.
TARGETS = {"q1t0": 0.84, "q0t0": 0.06, "q1t1": 0.09, "q0t1": 0.01}
STEPS = 60
#: Miss at which the descent ends, and above which an end is reported as a failure.
CLOSE, TOLERANCE = 1e-4, 0.01


class DomainModel:
    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posteriors(self, tf: np.ndarray) -> np.ndarray:
        z = ngrams.weigh(tf, np.ones(tf.shape[1], np.float32)) @ self.weights + self.bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def label_domains(labels: DataFrame) -> DataFrame:
    """doc_id and domain of the labelled table; a document labelled twice counts by its lowest quality and highest toxic."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg(F.concat(F.lit("q"), F.min("quality"), F.lit("t"), F.max("toxic")).alias("domain"))


def label_qualities(labels: DataFrame) -> DataFrame:
    """doc_id and domain by quality alone, q0 or q1; a document labelled twice counts by its lowest."""
    known = labels.where("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg(F.concat(F.lit("q"), F.min("quality")).alias("domain"))


def fit(docs: DataFrame, domains: DataFrame, most_labelled: int = MOST_LABELLED, rounds: int = 200) -> DomainModel:
    """A softmax model; classes are weighted by their true shares, which the spread sample would hide."""
    one = DomainModel(["all"], np.zeros((ngrams.DIMS, 1), np.float32), np.zeros(1, np.float32))
    sizes = label_sizes(domains, "domain")
    names = sorted(sizes)
    if not names:
        return one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tf = np.minimum(ngrams.counts(*buffers(part.column(1))), 65535).astype("<u2")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([t.tobytes() for t in tf], pa.binary())], ["doc_id", "domain", "tf"])

    sample = F.broadcast(bounded_sample(domains, "domain", "doc_id", most_labelled, sizes))  # at most most_labelled rows
    rows = docs.select("doc_id", "text").join(sample, "doc_id").mapInArrow(run, "doc_id long, domain string, tf binary").collect()
    if not rows:
        return one
    rows = sorted(rows, key=lambda r: (r.doc_id, r.tf))
    x = ngrams.weigh(np.stack([np.frombuffer(r.tf, "<u2") for r in rows]).astype(np.float32), np.ones(ngrams.DIMS, np.float32))
    y = np.array([names.index(r.domain) for r in rows])
    seen = np.bincount(y, minlength=len(names))
    share = np.array([sizes[n] for n in names]) / sum(sizes.values())
    weight = (share / np.maximum(seen, 1))[y].astype(np.float32)
    hot = np.eye(len(names), dtype=np.float32)[y]
    w, b = np.zeros((ngrams.DIMS, len(names)), np.float32), np.log(share).astype(np.float32)
    g = np.full_like(w, 1e-8)
    gb = np.full_like(b, 1e-8)
    before = np.inf
    for i in range(rounds):  # AdaGrad on the full, bounded sample
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        if i % 20 == 19:
            loss = float(-(weight * np.log(np.maximum(p[np.arange(len(y)), y], 1e-30))).sum())
            if before - loss < 1e-3 * abs(before):
                break
            before = loss
        e = (p - hot) * weight[:, None]
        d, db = x.T @ e + 1e-6 * w, e.sum(0)
        g, gb = g + d * d, gb + db * db
        w, b = w - 0.3 * d / np.sqrt(g), b - 0.1 * db / np.sqrt(gb)
    return DomainModel(names, w, b)


def memberships(docs: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tokens (words) and the posteriors over ``model.domains``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, off = buffers(part.column(1))
                p = model.posteriors(ngrams.counts(data, off)).astype(np.float64)
                p = np.round(p / p.sum(1, keepdims=True), 9)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(words(data, off)[2])), pa.array(list(p), pa.list_(pa.float64()))], ["doc_id", "tokens", "posterior"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, tokens long, posterior array<double>")


def replay(p: np.ndarray, moves: list[np.ndarray], most: float = np.inf) -> np.ndarray:
    """Rates after the moves met so far: each goes down the gradient, then is projected onto [0, most]."""
    r = np.ones(len(p))
    for m in moves:
        r = np.clip(r - p @ m, 0.0, most)
    return r


def _posteriors(batch: pa.RecordBatch, at: int, k: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


class Rates:
    """What fit_rates found: rates follow from posteriors alone."""

    def __init__(self, domains: list[str], moves: list[np.ndarray], offset: np.ndarray, most: float, report: dict):
        self.domains, self.moves, self.offset, self.most, self.report = domains, moves, offset, most, report

    def __call__(self, p: np.ndarray) -> np.ndarray:
        return replay(p - self.offset, self.moves, self.most)


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None, replacement: bool = True, steps: int = STEPS) -> Rates:
    """The rates that bring expected totals to the targets (shares of the mixture by domain; domains without one get none).

    total: tokens of the mixture; None takes as many as keep the largest target's domain whole.  Without replacement it is
    not used: the descent is on sum of rate * tokens * (posterior - shares), which is zero when the shares are met.
    Each step reads the members once and brings len(domains) sums (the first also a Gram matrix) to the driver.
    """
    k = len(domains)
    share = np.array([targets.get(d, 0.0) for d in domains])
    share = share / share.sum() if share.sum() > 0 else np.full(k, 1 / k)
    offset, most = (np.zeros(k), np.inf) if replacement else (share, 1.0)

    def sums(moves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((k, k + 1))
            for b in batches:
                if b.num_rows:
                    t, p = b.column(0).to_numpy().astype(np.float64), _posteriors(b, 1, k)
                    q = p - offset
                    out[:, 0] += p.T @ (replay(q, moves, most) * t)
                    out[:, 1:] += q.T @ (q * t[:, None])
            at = np.arange(k * (k + 1))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out.ravel())], ["at", "v"])

        got = np.zeros(k * (k + 1))
        for r in members.select("tokens", "posterior").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
            got[r["at"]] = r.v
        return got.reshape(k, k + 1)[:, 0], got.reshape(k, k + 1)[:, 1:]

    have, gram = sums([])
    lead = int(np.argmax(share))
    total = have[lead] / share[lead] if total is None else total
    goal = lambda now: share * (total if replacement else now.sum())
    scale = np.linalg.pinv(gram + 1e-9 * np.trace(gram) * np.eye(k))
    moves: list[np.ndarray] = []
    now, best = have, (np.inf, [], have)
    for _ in range(steps):
        miss = float(np.abs(now - goal(now)).sum() / max(goal(now).sum(), 1e-9))
        if miss < best[0]:
            best = (miss, list(moves), now)
        if miss < CLOSE or not have.sum():
            break
        moves.append(np.round(scale @ (now - goal(now)), 9))
        now, _ = sums(moves)
    miss, moves, now = best
    report = {"domains": domains, "available": have.tolist(), "goal": goal(now).tolist(), "reached": now.tolist(), "miss": miss, "steps": len(moves)}
    if miss > TOLERANCE and have.sum():
        warnings.warn(f"mixing misses its targets by {miss:.3f} of the total: {report}", stacklevel=2)
    return Rates(domains, moves, offset, most, report)


def apply_rates(members: DataFrame, rates: Rates) -> DataFrame:
    """Adds rate, copies (without replacement one at most) and the likeliest domain."""
    domains, most = rates.domains, rates.most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                p = _posteriors(b, 2, len(domains))
                rate, top = np.round(rates(p), 6), np.argmax(p, 1)
                copies = np.minimum(np.floor(rate + b.column(3).to_numpy()), most).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(rate), pa.array(copies), pa.array([domains[i] for i in top])], ["doc_id", "tokens", "posterior", "rate", "copies", "domain"])

    u = (F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)).alias("u")
    return members.select("doc_id", "tokens", "posterior", u).mapInArrow(run, "doc_id long, tokens long, posterior array<double>, rate double, copies long, domain string")


def keep_drawn(docs: DataFrame, model: DomainModel, rates: Rates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows given, without those that the rates leave out: a row stays if its rate and the hash of its id, as a share, add up to one."""
    at, names = docs.columns.index(text_col), docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("rest"), F.col(f"`{text_col}`").alias("text"), (F.pmod(F.xxhash64(f"`{id_col}`", F.lit(8)), F.lit(1 << 30)) / float(1 << 30)).alias("u"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                p = model.posteriors(ngrams.counts(*buffers(part.column(1)))).astype(np.float64)
                p = np.round(p / p.sum(1, keepdims=True), 9)
                keep = np.floor(np.round(rates(p), 6) + part.column(2).to_numpy()) >= 1
                yield part.select(["rest", "text"]).filter(pa.array(keep))

    drawn = packed.mapInArrow(run, packed.drop("u").schema)
    return drawn.select(*[F.col("text").alias(c) if i == at else F.col(f"rest.`{c}`") for i, c in enumerate(names)])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and copies of all documents; domain_goal and domain_reached are the tokens wanted and expected of the row's likeliest domain."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, label_domains(read_table(spark, sf_dir, "labels")))
    members = materialize(memberships(docs, model), "members")
    rates = fit_rates(members, model.domains, TARGETS)
    out = apply_rates(members, rates)
    p = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)]
    told = [F.element_at(F.create_map(*[F.lit(x) for d, v in zip(model.domains, rates.report[n]) for x in (d, round(float(v), 3))]), F.col("domain")).alias(f"domain_{n}") for n in ("goal", "reached")]
    return out.select("doc_id", "tokens", "domain", *p, "rate", "copies", *told)
