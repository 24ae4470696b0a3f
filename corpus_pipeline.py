"""A corpus pipeline over ``documents``: toxicity, near duplicates, repeated passages, mixing, packing.

Every stage's result is written as Parquet into the shared folder and read again as the next stage's input.  All but
the last return the columns of ``documents``, whatever other columns there are and however they are named.

Rows that repeat an id with different texts are judged each by its own text; rows that repeat id and text are one document
from the second stage on.  Rows without an id pass the second and third stage as they are.  Null and empty texts are
neither toxic nor repeats; mixing draws them by their posterior.  Texts of any length are read whole.  Ties (equal scores,
equal posteriors) are settled as the operators state.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import dedup, mixing, packing, substrings, toxicity
from sievewright.llm.common import drop_materialized, materialize, read_table

#: Shares of tokens that mixing leaves to texts of good and of poor quality.
TARGETS = {"q1": 0.93, "q0": 0.07}


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that no column has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    score = _unused(docs, "tox_score")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < toxicity.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of least id stays; of that id's equal rows one."""
    return dedup.one_of_each_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that stand earlier in the corpus are cut; a document that this leaves without a word goes."""
    cut = _unused(docs, "cut")
    part = lambda c: F.col(f"`{cut}`.{c}")
    out = substrings.remove_repeats(docs, as_col=cut).where((part("n_removed") == 0) | part("kept").rlike(r"[^\x20\x09-\x0D]"))
    changed = part("n_removed") > 0
    new = {"text": F.when(changed, part("kept")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length(part("kept")).cast("long")).otherwise(F.col("n_chars"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn, without replacement, at the rates that bring good and poor quality to their target shares of tokens.

    Domains are those that can still occur after the first stage, so they go by quality alone.  Rates stay one for
    documents of good quality as far as the shares allow; a miss over the tolerance is warned of.
    """
    model = mixing.fit(docs, mixing.label_qualities(read_table(spark, sf_dir, "labels")))
    if len(model.domains) < 2:
        return docs
    members = materialize(mixing.memberships(docs, model), "members")
    rates = mixing.fit_rates(members, model.domains, TARGETS, replacement=False)
    drop_materialized(members)
    return mixing.keep_drawn(docs, model, rates)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
#: Viterbi decoding, signatures, suffix sorting and fitted rates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_materialized(docs)  # the stage before; the table given has no path of ours
        docs = done
    return docs
