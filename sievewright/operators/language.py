"""Language policy over a pluggable backend; the default counts stop words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent words by language (fixed values).
STOP_WORDS = {
    "de": ["der", "die", "und", "den", "von", "das", "mit", "des", "im", "ein", "nicht"],
    "en": ["the", "of", "and", "to", "that", "is", "was", "for", "with", "be", "by", "this"],
    "es": ["el", "los", "del", "las", "por", "con", "una", "para", "y", "al"],
    "fr": ["le", "les", "et", "dans", "du", "par", "au", "ou", "sur", "pour", "un"],
}
LEAST_LETTERS, LEAST_CONFIDENCE = 4, 0.80


def stop_word_backend(text: Column) -> Column:
    """Language and confidence: the language of most stop words (ties: the first by name), and its share of all of them."""
    low = F.lower(text)
    hits = F.array(*[F.struct(F.regexp_count(low, F.lit(f"(?<![a-z])(?:{'|'.join(w)})(?![a-z])")).alias("hits"), F.lit(-i).alias("order"), F.lit(code).alias("code")) for i, (code, w) in enumerate(sorted(STOP_WORDS.items()))])

    def choose(h: Column) -> Column:
        best, total = F.array_max(h), F.aggregate(h, F.lit(0), lambda a, x: a + x["hits"])
        return F.when(total > 0, F.struct(best["code"].alias("language"), F.round(best["hits"] / total, 9).alias("confidence")))

    return F.transform(F.array(hits), choose)[0]  # bound to a variable: counted once


def valid_prediction(p: Column) -> Column:
    """The prediction if its language is two letters and its confidence a number from 0 to 1, else null."""
    ok = p["language"].rlike("^[a-z]{2}$") & ~F.isnan(p["confidence"]) & p["confidence"].between(0.0, 1.0)
    return F.when(ok, p)


def detect(records: DataFrame, text: str | Column, backend=stop_word_backend) -> DataFrame:
    """Adds language_detected, confidence and detection status: detected, uncertain or failed.

    backend: text column to a struct of language and confidence; null, or what is no valid prediction, is a failure.
    """
    c = F.col(text) if isinstance(text, str) else text
    t = records.withColumn("_text", c).withColumn("_letters", F.length(F.regexp_replace(F.coalesce(F.col("_text"), F.lit("")), r"[^\p{L}]+", "")))
    t = t.withColumn("_p", valid_prediction(backend(F.col("_text"))))
    short, none = F.col("_letters") < LEAST_LETTERS, F.col("_p").isNull()
    status = F.when(short, "uncertain").when(none, "failed").when(F.col("_p.confidence") < LEAST_CONFIDENCE, "uncertain").otherwise("detected")
    t = t.withColumn("status", status).withColumn("language_detected", F.when(F.col("status") == "detected", F.col("_p.language")))
    return t.withColumn("confidence", F.when(~short & ~none, F.round("_p.confidence", 9))).drop("_letters", "_p", "_text")


def summary(detected: DataFrame) -> DataFrame:
    """language, records, share (of all), uncertain and failed: unknown holds both."""
    total = detected.agg(F.count(F.lit(1)).alias("n"))
    g = detected.groupBy(F.coalesce("language_detected", F.lit("unknown")).alias("language")).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("status") == "uncertain").alias("uncertain"), F.count_if(F.col("status") == "failed").alias("failed"))
    return g.join(F.broadcast(total)).select("language", "records", F.round(F.col("records") / F.col("n"), 6).alias("share"), "uncertain", "failed")  # one row
