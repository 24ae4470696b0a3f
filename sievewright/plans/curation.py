"""Curation of source records from file to files: map, validate, normalise, mask, mark duplicates, language and leakage, then write.

Nothing but invalid and empty records is removed; everything else only annotates.  Accepted and rejected records part
right after validation, so that no later join sees the rejected ones; accepted records are cached for report and manifest.
Indexes are those of the source throughout.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import text as T
from sievewright.functions.languages import character_backend
from sievewright.functions.markup import visible
from sievewright.operators import language as L
from sievewright.operators import leakage as G
from sievewright.operators import manifests as M
from sievewright.operators import neighbours as N
from sievewright.operators import records as R
from sievewright.sources import storage
from sievewright.sources.files import numbered
from sievewright.sources.sinks import json_lines

VERSION = "1"
SOURCE_COLUMNS = ["subject", "body", "answer", "type", "queue", "priority", "language", "version", *[f"tag_{i}" for i in range(1, 9)]]


class CurationError(RuntimeError):
    """A stage failed as a whole; records that are merely bad are rejected instead."""


@dataclass(frozen=True)
class SemanticConfig:
    """Cosine from which an earlier neighbour makes a record a candidate, among how many nearest ones, and the encoder.

    encode: semantic text column to an array<double> column (a pandas UDF, say).
    """

    encode: Callable[[Column], Column]
    threshold: float = 0.85
    neighbours: int = 5

    def __post_init__(self):
        if isinstance(self.threshold, bool) or not -1 <= self.threshold <= 1:
            raise ValueError("the threshold must lie within -1 and 1")
        if isinstance(self.neighbours, bool) or not isinstance(self.neighbours, int) or self.neighbours < 1:
            raise ValueError("neighbours must be a whole number from 1 on")


@dataclass(frozen=True)
class CurationConfig:
    leakage: G.LeakageConfig = G.LeakageConfig()
    detect_language: bool = True
    language_backend: Callable[[Column], Column] = character_backend
    semantic: SemanticConfig | None = None
    columns: tuple[str, ...] = tuple(SOURCE_COLUMNS)

    def snapshot(self) -> dict:
        """What of the settings decides about the records."""
        semantic = {"threshold": self.semantic.threshold, "neighbours": self.semantic.neighbours} if self.semantic else None
        return {"semantic": semantic, "language": {"least_letters": L.LEAST_LETTERS, "least_confidence": L.LEAST_CONFIDENCE} if self.detect_language else None, "leakage": self.leakage}


@dataclass
class Curated:
    accepted: DataFrame
    rejected: DataFrame
    report: dict = field(default_factory=dict)
    manifest: dict = field(default_factory=dict)


def routed(source: DataFrame) -> DataFrame:
    """All records (``record_index`` given) mapped, with their source, errors and the reason of a rejection."""
    mapped = R.map_records(source.withColumn("record_index", F.col("record_index").cast("long")), keep_source=True)
    return R.route(mapped, shown=visible("message"))


def preprocess(accepted: DataFrame) -> DataFrame:
    """Adds the cleaned and masked fields and what was masked; an absent subject stays absent."""
    clean = lambda c: T.normalize_native(T.markup_to_text(c))
    t = accepted.withColumns({"subject_clean": clean("subject"), "message_clean": clean("message")})
    t = t.withColumns({"subject_masked": T.mask_pii(F.col("subject_clean")), "message_masked": T.mask_pii(F.col("message_clean"))})
    both = lambda k: F.concat_ws("\n", F.coalesce(F.col(f"subject_{k}"), F.lit("")), F.coalesce(F.col(f"message_{k}"), F.lit("")))
    return t.withColumns({"pii": T.mask_counts(both("clean"), both("masked")), "fingerprint": T.fingerprint(F.col("subject_masked"), F.col("message_masked"))})


def change_counts() -> list:
    """What normalisation and masking changed, for :func:`preprocess`'s result: counts by step over both fields, to be observed while the rows pass."""
    by = [T.changes(F.col(c), F.col(f"{c}_clean"), F.col(f"{c}_masked")) for c in ("subject", "message")]
    both = [F.sum(by[0][k] + by[1][k]).alias({"changed": "fields_changed", "masked": "fields_masked"}.get(k, k)) for k in by[0]]
    return [F.count(F.lit(1)).alias("records"), F.sum(F.greatest(by[0]["changed"], by[1]["changed"])).alias("records_changed"), *both]


def semantic_links(records: DataFrame, config: SemanticConfig, index: str = "record_index") -> DataFrame:
    """index, status and semantic_of: the most similar earlier record among the nearest ones over all that are no exact duplicates, where it reaches the threshold."""
    alone = records.where("duplicate_of is null").select(F.col(index).alias("i"), config.encode(T.semantic_text(F.col("subject_masked"), F.col("message_masked"))).alias("v"))
    if alone.where("aggregate(v, 0D, (a, x) -> a + x * x) = 0D").limit(1).count():
        raise CurationError("the encoder gave a vector of length zero")
    best = N.earlier_candidates(N.nearest(alone, "i", "v", config.neighbours), config.threshold).where("is_candidate")
    j = records.join(best.select(F.col("vec_id").alias(index), F.col("neighbour").alias("semantic_of"), F.col("similarity").alias("semantic_similarity")), index, "left")
    status = F.when(F.col("duplicate_of").isNotNull(), "skipped_exact_duplicate").when(F.col("semantic_of").isNotNull(), "candidate").otherwise("unique")
    return j.withColumn("semantic_status", status)


def annotate(source: DataFrame, config: CurationConfig = CurationConfig()) -> tuple[DataFrame, DataFrame]:
    """Accepted records with masked fields, duplicate links, language and leakage; and rejected ones as routed."""
    all_ = routed(source)
    t = R.exact_duplicates(preprocess(all_.where("reason is null")))
    if config.semantic:
        t = semantic_links(t, config.semantic)
    else:
        t = t.withColumns({"semantic_of": F.lit(None).cast("long"), "semantic_similarity": F.lit(None).cast("double"), "semantic_status": F.lit(None).cast("string")})
    if config.detect_language:
        t = L.detect(t, T.language_text(F.col("subject_masked"), F.col("message_masked")), config.language_backend)
    else:
        t = t.withColumns({"status": F.lit(None).cast("string"), "language_detected": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    ticket = {n: v for n, v in G.fields_of(t).items() if n in R.FIELDS}
    # fields of the source count as they were given, unmasked
    t = G.check(t, config.leakage, exact="duplicate_of", semantic="semantic_of", fields={**ticket, **G.fields_of(t, "source")})
    return t, all_.where("reason is not null")


def counted(rows: DataFrame, *keys: str) -> dict:
    """Sums of the last column by the others, keys sorted; the keys are names of types, codes or fields, so few."""
    out: dict = {}
    for r in sorted(rows.collect(), key=lambda r: tuple(str(x) for x in r[:-1])):
        at = out
        for k in r[:-2]:
            at = at.setdefault(str(k), {})
        at[str(r[-2])] = r[-1]
    return out


def report(accepted: DataFrame, rejected: DataFrame, versions: dict | None = None, preprocessing: dict | None = None) -> dict:
    """The quality report: one aggregation for the scalars, one for each map of counts."""
    one = accepted.agg(
        F.count(F.lit(1)).alias("accepted"), F.count_if(F.size("pii") > 0).alias("records_with_pii"), F.count("duplicate_of").alias("duplicates"), F.countDistinct("duplicate_of").alias("originals"),
        F.count("semantic_of").alias("candidates"), F.countDistinct("semantic_of").alias("semantic_originals"), F.count_if(F.col("semantic_status") == "skipped_exact_duplicate").alias("skipped"),
        F.count_if((F.col("status") == "uncertain") & F.col("confidence").isNotNull()).alias("low_confidence"), F.count_if(F.col("status") == "failed").alias("failed"),
    ).first().asDict()
    n_rejected = rejected.count()
    total, checks = one["accepted"] + n_rejected, max(1, one["accepted"])
    pii = counted(accepted.select(F.explode("pii").alias("k", "n")).groupBy("k").agg(F.sum("n")))
    languages = counted(accepted.groupBy(F.coalesce("language_detected", F.lit("unknown"))).count()) if accepted.where("status is not null").limit(1).count() else {}
    leaks = counted(G.summary(accepted))
    rate = lambda a, b: round(a / b, 6) if b else 0.0
    return {
        "dataset": {"records": total, "accepted": one["accepted"], "rejected": n_rejected, "acceptance_rate": rate(one["accepted"], total)},
        "validation": {k: v for k, v in {"reason": {}, "type": {}, "path": {}, **counted(R.validation_counts(rejected))}.items()},
        "preprocessing": preprocessing or {"limitation": "what normalisation changed is not counted"},
        "pii": {"records_with_pii": one["records_with_pii"], "entities": pii, "total_masked": sum(pii.values())},
        "duplicates": {
            "exact": {"evaluated": one["accepted"], "duplicates": one["duplicates"], "originals": one["originals"], "rate": rate(one["duplicates"], checks)},
            "semantic": {"evaluated": one["accepted"] - one["skipped"], "candidates": one["candidates"], "originals": one["semantic_originals"], "skipped": one["skipped"]},
        },
        "language": {"detected": languages, "shares": {k: rate(v, one["accepted"]) for k, v in languages.items()}, "low_confidence": one["low_confidence"], "failed": one["failed"]},
        "leakage": {k: leaks.get(k, {}) for k in ("status", "type", "field")},
        "version": versions or {},
    }


def accepted_view(t: DataFrame) -> DataFrame:
    """Accepted records as they are stored."""
    return t.select(
        "record_index", F.col("subject_masked").alias("subject"), F.col("message_masked").alias("message"), "ticket_type", "queue", "priority", "language", R.whole_number(F.col("source_version")).alias("source_version"), "tags",
        F.when(F.col("status").isNotNull(), F.struct(F.col("language_detected").alias("language"), "confidence", "status")).alias("language_detection"), F.col("leakage").alias("leakage_check"),
    )


def curate(source: DataFrame, config: CurationConfig = CurationConfig(), sources: list[dict[str, str]] | None = None) -> Curated:
    """Records with a ``record_index`` to accepted and rejected records, report and manifest."""
    t, rejected = annotate(source, config)
    seen = Observation("preprocessing")
    t = t.observe(seen, *change_counts()).persist()  # counted on the pass that fills the cache
    try:
        accepted = accepted_view(t)
        content = M.tree_digest(accepted, "record_index", F.sha2(F.to_json(F.struct(*sorted(c for c in accepted.columns if c != "record_index")), {"ignoreNullFields": "false"}), 256)).first().asDict()
        manifest = M.dataset_manifest(sources or [], M.canonical(config.snapshot()), content, VERSION)
        changed = {k: v or 0 for k, v in seen.get.items()}
        found = report(t, rejected, {k: manifest[k] for k in ("dataset_version", "pipeline_version")}, changed)
    finally:
        t.unpersist()
    return Curated(accepted, R.rejected_view(rejected), found, manifest)


def curate_file(spark: SparkSession, path: str, config: CurationConfig = CurationConfig()) -> Curated:
    """A CSV or JSON file; rows are numbered in the order of the file."""
    try:
        return curate(numbered(spark, path, list(config.columns)), config, [M.file_digest(path)])
    except (OSError, ValueError, CurationError):
        raise
    except Exception as e:
        raise CurationError(f"curation of {path} failed") from e


def write(result: Curated, folder: str) -> None:
    """accepted and rejected as JSON lines (folders), manifest and report as JSON files, all four put in place together; other files in the folder stay."""
    with storage.together(folder) as staged:
        json_lines(result.accepted).write.text(f"{staged}/accepted.jsonl")
        json_lines(result.rejected).write.text(f"{staged}/rejected.jsonl")
        M.write_json(result.manifest, f"{staged}/dataset_manifest.json")
        M.write_json(result.report, f"{staged}/data_quality_report.json")
