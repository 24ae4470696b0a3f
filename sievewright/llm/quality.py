"""Op 4 [native].  Quality rules and robust multivariate outliers.

Everything here is DataFrame expressions.  Five statistics of each text (length, word length, symbols, repeated
lines, repeated word triples), put on a log scale, get a minimum-covariance-determinant estimate for each
language and source: deterministic starts (mean and covariance; median and median absolute deviation), then
concentration steps that keep the nearest 75 % of a group's rows and estimate from those, until no group's determinant
changes.  One step is one aggregation: rows are binned by distance (bins a hundredth apart on a log scale), every bin
carries its count, sums and cross sums, and a running count over the bins of a group (a fixed number of bins at most) finds
the share to keep; the bin at its edge, and so rows of equal distance there, is kept whole.  Of the two starts the one of
the smaller determinant stays.  Five variances and ten covariances need rows: a group below ``least_rows`` rows that pass the
base rule is estimated with its whole language, a language below that with all rows.  Texts beyond ``cutoff`` (squared
Mahalanobis distance) are rejected.

Null and empty texts have no words, so they fail the base rule.  Null languages and sources form their own
group.  Rows that repeat an id, or have none, are judged each for itself; equal rows get equal verdicts.  Texts of any length
are read whole.  An empty table gives no rows.  No input column but those named is read, whatever the names of others.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, read_table

KEEP_SHARE = 0.75
#: chi-square quantile of five degrees at KEEP_SHARE, to scale the estimate to the normal model.
CHI2_KEEP = 6.626
#: chi-square quantile of five degrees at 1 - 1e-7.
CUTOFF = 40.9
LEAST_ROWS = 60
#: Steps end when no log determinant moves by more than SETTLED; after MOST_STEPS a warning says that one still does.
MOST_STEPS, SETTLED = 12, 0.02
BINS = 100
#: Least standard deviations: statistics that are zero for most texts must not make tiny amounts look far.
FLOORS = (0.30, 0.08, 0.45, 0.45, 0.06)
#: Above this many groups the estimates are joined by a shuffle instead of a broadcast (a group's estimate has under 400 bytes).
MOST_BROADCAST_GROUPS = 20_000
DIM = 5

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of every row.

    Repeated triples: the hash of each three-word window is packed with its position into one long, the longs
    are sorted, and neighbours of equal hash whose words are equal too are repeats.
    """
    t = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    blanks = " \t\n\x0b\x0c\r"
    t = t.select(
        "doc_id", "lang", "source",
        F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)).alias("w"),
        F.length(F.translate("text", blanks, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"),
    )
    t = t.withColumns({"n_words": F.size("w").cast("long"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}).drop("lines")
    t = t.withColumn("bits", F.length(F.bin("n_words")))
    t = t.withColumn(
        "packed",
        F.expr("case when n_words < 3 then array() else sort_array(transform(sequence(0L, n_words - 3), i -> shiftleft(xxhash64(get(w, int(i)), get(w, int(i) + 1), get(w, int(i) + 2)), bits) | i)) end"),
    )
    same = "shiftrightunsigned(x, bits) = shiftrightunsigned(get(packed, j {0} 1), bits) and " + " and ".join(f"get(w, int(x & (shiftleft(1L, bits) - 1)) + {k}) = get(w, int(get(packed, j {{0}} 1) & (shiftleft(1L, bits) - 1)) + {k})" for k in range(3))
    t = t.withColumn(
        "at",
        F.expr(f"sort_array(transform(filter(packed, (x, j) -> coalesce({same.format('-')}, false) or coalesce({same.format('+')}, false)), x -> x & (shiftleft(1L, bits) - 1)))"),
    )
    t = t.withColumn("n_repeat_words", F.expr("aggregate(transform(at, (p, j) -> least(3L, coalesce(get(at, j + 1) - p, 3L))), 0L, (a, x) -> a + x)"))
    t = t.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    # written at once: filters pushed into these nested expressions would copy them many times over
    return materialize(t.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), "quality")


def transformed() -> list[Column]:
    """The five statistics on a log scale, as expressions."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("n_words")), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log1p(100.0 * F.col("n_symbols") / n), F.log1p(F.col("n_dup_lines").cast("double")), F.sqrt(F.col("n_repeat_words") / n) / 2,
    ]


_X = [f"x{i}" for i in range(DIM)]
_PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]
_KEY = ["level", "lang", "source"]


def _moments() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s_{x}") for x in _X], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q_{i}_{j}") for i, j in _PAIRS]]


def _estimate(sums: DataFrame, keys: list[str], scale: Column | None = None) -> DataFrame:
    """Means and the Cholesky factor of the floored covariance, from counts, sums and cross sums."""
    out = sums
    for i in range(DIM):
        out = out.withColumn(f"m{i}", F.col(f"s_x{i}") / F.col("n"))
    cov = {(i, j): F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in _PAIRS}
    k = scale if scale is not None else F.lit(1.0)
    out = out.withColumns({f"c{i}_{j}": (F.greatest(c, F.lit(0.0)) * k + FLOORS[i] ** 2 if i == j else c * k) for (i, j), c in cov.items()})
    return _cholesky(out, keys)


def _cholesky(cov: DataFrame, keys: list[str]) -> DataFrame:
    out = cov
    for i, j in _PAIRS:
        inner = F.col(f"c{i}_{j}")
        for k in range(j):
            inner = inner - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(inner, F.lit(1e-9))) if i == j else inner / F.col(f"l{j}_{j}"))
    return out.select(*keys, *[f"m{i}" for i in range(DIM)], *[f"l{i}_{j}" for i, j in _PAIRS], sum((F.log(F.col(f"l{i}_{i}")) for i in range(DIM)), F.lit(0.0)).alias("logdet"))


def distance() -> Column:
    """Squared Mahalanobis distance, by forward substitution with the factor."""
    z: list[Column] = []
    for i in range(DIM):
        d = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            d = d - F.col(f"l{i}_{k}") * z[k]
        z.append(d / F.col(f"l{i}_{i}"))
    return sum((v * v for v in z[1:]), z[0] * z[0])


def _with(rows: DataFrame, estimates: DataFrame, keys: list[str], groups: int) -> DataFrame:
    return rows.join(F.broadcast(estimates) if groups <= MOST_BROADCAST_GROUPS else estimates, keys)


def needed_groups(stats: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """level, lang and source of the groups whose estimates some row uses.

    level 2: language and source; 1: language; 0: all.
    """
    lang, source = F.coalesce("lang", F.lit("\0")).alias("lang"), F.coalesce("source", F.lit("\0")).alias("source")
    sizes = materialize(stats.groupBy(lang, source).agg(F.count_if(~F.col("base_failed")).alias("n")), "group-sizes")
    languages = sizes.groupBy("lang").agg(F.sum("n").alias("n"), F.min("n").alias("least"))
    level = lambda v, rows, *names: rows.select(F.lit(v).alias("level"), *[F.col(c) if c in names else F.lit("").alias(c) for c in ("lang", "source")])
    two = level(2, sizes.where(F.col("n") >= least_rows), "lang", "source")
    one = level(1, languages.where((F.col("n") >= least_rows) & (F.col("least") < least_rows)), "lang")
    zero = level(0, languages.where(F.col("n") < least_rows)).distinct()
    out = materialize(two.unionByName(one).unionByName(zero), "groups")
    drop_materialized(sizes)
    return out


def fit_mcd(stats: DataFrame, least_rows: int = LEAST_ROWS, most_steps: int = MOST_STEPS) -> DataFrame:
    """level, lang, source and the estimate of every group of :func:`needed_groups`."""
    needed = needed_groups(stats, least_rows)
    groups = needed.count()
    base = stats.where(~F.col("base_failed")).select(F.coalesce("lang", F.lit("\0")).alias("lang"), F.coalesce("source", F.lit("\0")).alias("source"), *[c.alias(x) for c, x in zip(transformed(), _X)])
    e = F.lit("")
    levels = F.explode(F.array(*[F.struct(F.lit(v).alias("level"), a.alias("lang"), b.alias("source")) for v, a, b in ((2, F.col("lang"), F.col("source")), (1, F.col("lang"), e), (0, e, e))]))
    rows = _with(base.select(levels.alias("k"), *_X).select("k.*", *_X), needed, _KEY, groups)
    sums = materialize(rows.groupBy(*_KEY).agg(*_moments(), *[F.percentile_approx(x, F.lit(0.5), F.lit(1000)).alias(f"med_{x}") for x in _X]), "mcd-start")
    mean = _estimate(sums, _KEY).withColumn("start", F.lit(0))
    near = _with(rows, sums.select(*_KEY, *[f"med_{x}" for x in _X]), _KEY, groups)
    spread = near.groupBy(*_KEY).agg(*[F.first(f"med_{x}").alias(f"m{i}") for i, x in enumerate(_X)], *[F.percentile_approx(F.abs(F.col(x) - F.col(f"med_{x}")), F.lit(0.5), F.lit(1000)).alias(f"d{i}") for i, x in enumerate(_X)])
    robust = _cholesky(spread.withColumns({f"c{i}_{j}": (F.pow(1.4826 * F.col(f"d{i}"), F.lit(2)) + FLOORS[i] ** 2 if i == j else F.lit(0.0)) for i, j in _PAIRS}), _KEY).withColumn("start", F.lit(1))
    now = materialize(mean.unionByName(robust), "mcd")
    drop_materialized(sums)
    keys = [*_KEY, "start"]

    def concentrate(estimates: DataFrame, last: bool) -> DataFrame:
        binned = _with(rows, estimates, _KEY, 2 * groups).withColumn("bin", F.least(F.floor(F.log1p(distance()) * BINS), F.lit(100 * BINS)).cast("int"))
        by_bin = binned.groupBy(*keys, "bin").agg(*_moments())
        run, whole = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
        kept = by_bin.withColumns({"before": F.coalesce(F.sum("n").over(run), F.lit(0)), "all": F.sum("n").over(whole)}).where(F.col("before") < KEEP_SHARE * F.col("all"))
        merged = kept.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in [*[f"s_{x}" for x in _X], *[f"q_{i}_{j}" for i, j in _PAIRS]]], F.max("bin").alias("edge"))
        return materialize(_estimate(merged, keys, F.greatest(F.lit(1.0), F.expm1((F.col("edge") + 1) / BINS) / CHI2_KEEP) if last else F.lit(1.0)), "mcd")

    for _ in range(most_steps):
        new = concentrate(now, False)
        moved = new.join(now.select(*keys, F.col("logdet").alias("old")), keys).agg(F.max(F.abs(F.col("logdet") - F.col("old")))).first()[0]
        drop_materialized(now)
        now = new
        if moved is None or moved <= SETTLED:
            break
    else:
        warnings.warn(f"concentration steps have not settled: a log determinant still moves by {moved:.2e}", stacklevel=2)
    best = now.withColumn("r", F.row_number().over(Window.partitionBy(*_KEY).orderBy("logdet", "start"))).where("r = 1").select(*now.columns)
    # the estimate of the better start, scaled to the normal model
    best = materialize(best, "mcd")
    out = concentrate(best, True).drop("start", "logdet")
    drop_materialized(now, best)
    return out


def judge(stats: DataFrame, estimates: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Adds distance2 (by the finest estimate that the row's group has) and kept."""
    groups = estimates.count()
    rows = stats.withColumns({x: c for x, c in zip(_X, transformed())}).withColumns({"g_lang": F.coalesce("lang", F.lit("\0")), "g_source": F.coalesce("source", F.lit("\0"))})
    at = lambda v: estimates.where(F.col("level") == v)
    pack = F.struct(*[c for c in estimates.columns if c not in _KEY])
    two = at(2).select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), pack.alias("e2"))
    one = at(1).select(F.col("lang").alias("g_lang"), pack.alias("e1"))
    zero = at(0).select(pack.alias("e0"))
    hint = (lambda d: F.broadcast(d)) if groups <= MOST_BROADCAST_GROUPS else (lambda d: d)
    rows = rows.join(hint(two), ["g_lang", "g_source"], "left").join(hint(one), ["g_lang"], "left").join(F.broadcast(zero), F.lit(True), "left")  # zero: one row
    rows = rows.withColumn("e", F.coalesce("e2", "e1", "e0")).select(*stats.columns, *_X, "e.*")
    rows = rows.withColumn("distance2", F.round(distance(), 6))
    return rows.select(*stats.columns, "distance2", (~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= cutoff)).alias("kept"))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = text_statistics(read_table(spark, sf_dir, "documents"))
    out = judge(stats, fit_mcd(stats))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")
