"""Subword ids by greedy longest match over a given vocabulary.  Distinct words are cut once, by joins with the pieces, and joined back.

A vocabulary is a table (piece, continues, id): whether a piece stands at a word's begin or goes on inside it.  None is trained here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators.tokens import LabelMapping

#: Runs of letters and digits; any other visible character alone.
WORD = r"[\p{L}\p{N}]+|[^\p{Z}\p{C}\p{L}\p{N}]"
#: Longer words are unknown as a whole.
LONGEST_WORD = 100
#: Vocabularies up to this many pieces are broadcast.
BROADCAST_PIECES = 300_000
#: So many of the commonest words travel to the texts; only rarer ones are joined by a shuffle.
COMMON_WORDS = 20_000

VOCABULARY = "piece string, continues boolean, id int"


def words(text: Column) -> Column:
    """Lower-cased words of a text in order; none of a null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def from_pieces(spark: SparkSession, pieces: dict[str, int], prefix: str = "##") -> DataFrame:
    """A vocabulary of pieces whose continuations are written with a prefix."""
    rows = [(p.removeprefix(prefix), p.startswith(prefix) and p != prefix, i) for p, i in pieces.items()]
    if any(not p for p, _, _ in rows):
        raise ValueError("a vocabulary holds an empty piece")
    return spark.createDataFrame(rows, VOCABULARY)


def read_lines(spark: SparkSession, path: str, prefix: str = "##") -> DataFrame:
    """A vocabulary from a text file with a piece a line, whose ids are the numbers of the lines."""
    lines = spark.read.text(path, wholetext=True).first()[0].split("\n")
    return from_pieces(spark, {p.rstrip("\r"): i for i, p in enumerate(lines) if p.strip("\r")}, prefix)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary from a tokeniser's JSON file whose model is WordPiece."""
    model = json.loads(spark.read.text(path, wholetext=True).first()[0])["model"]
    if model.get("type") != "WordPiece":
        raise ValueError(f"{path} holds a model of type {model.get('type')!r}, not of WordPiece")
    return from_pieces(spark, model["vocab"], model["continuing_subword_prefix"])


def special_ids(vocabulary: DataFrame, names: tuple[str, ...] = ("[UNK]", "[CLS]", "[SEP]")) -> list[int]:
    """Ids of the pieces for unknown words, start and end, which no word holds whole."""
    found = {r.piece: r.id for r in vocabulary.where(F.col("piece").isin(*names)).collect()}
    if missing := [n for n in names if n not in found]:
        raise ValueError(f"the vocabulary lacks {', '.join(missing)}")
    return [found[n] for n in names]


def cut(distinct: DataFrame, vocabulary: DataFrame, unknown: int, longest_word: int = LONGEST_WORD) -> DataFrame:
    """Adds ids to distinct words (column word, others are kept): at each place the longest piece that fits; ``[unknown]`` where none fits or the word is too long.

    All substrings no longer than the longest piece meet the vocabulary in one join; the walk over the pieces found is an
    expression.  A word has at most ``longest_word`` times that many substrings.
    """
    one = vocabulary.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("piece", "continues").alias("k"), F.max(F.length("piece")).alias("longest")).first()
    if not one.n or one.n != one.k:
        raise ValueError("a vocabulary needs pieces, each of them once")
    fits = F.length("word") <= longest_word
    at = F.explode(F.sequence(F.lit(1), F.when(fits, F.length("word")).otherwise(1)))
    ends = F.explode(F.sequence(F.lit(1), F.when(fits, F.least(F.lit(one.longest), F.length("word") - F.col("at") + 1)).otherwise(1)))
    starts = distinct.select("*", at.alias("at"))
    parts = starts.select("*", ends.alias("length")).withColumn("piece", F.when(fits, F.substring("word", F.col("at"), F.col("length")))).withColumn("continues", F.col("at") > 1)
    known = F.broadcast(vocabulary) if one.n <= BROADCAST_PIECES else vocabulary
    piece = F.when(F.col("id").isNotNull(), F.struct("at", (-F.length("piece")).alias("minus"), "id"))
    # most parts are no pieces; a word's first character stays in any case, so that no word is lost
    met = parts.join(known, ["piece", "continues"], "left").where("id is not null or (at = 1 and length = 1)")
    found = met.groupBy(*distinct.columns).agg(F.sort_array(F.collect_list(piece)).alias("found"))
    begin = F.struct(F.lit(1).alias("next"), F.array().cast("array<int>").alias("ids"))

    def step(state: Column, piece: Column) -> Column:
        taken = F.struct((piece["at"] - piece["minus"]).alias("next"), F.concat(state["ids"], F.array(piece["id"])).alias("ids"))
        return F.when(piece["at"] == state["next"], taken).otherwise(state)  # longest first, so a place is taken once

    walk = F.aggregate("found", begin, step)
    return found.select(*distinct.columns, walk.alias("walk")).select(*distinct.columns, F.when(F.col("walk.next") == F.length("word") + 1, F.col("walk.ids")).otherwise(F.array(F.lit(unknown))).alias("ids"))


def tokenize(
    records: DataFrame, labels: LabelMapping, vocabulary: DataFrame, unknown: int, start: int | None = None, end: int | None = None, max_length: int = 256,
    key: str = "record_id", text: str = "text", label: str = "label", common: int = COMMON_WORDS,
) -> DataFrame:
    """key, input_ids, attention_mask, label id and n_tokens before the cut; no padding.  Start and end stay where a text is cut to max_length.

    Null and empty texts hold start and end alone.  Keys are unique and not null and labels known, or the job fails.  The ``common``
    commonest words are broadcast, so no hot word is shuffled; a text's task holds max_length words of it at most.
    """
    if isinstance(max_length, bool) or not isinstance(max_length, int) or max_length < 1:
        raise ValueError("max_length must be a whole number from 1 on")
    specials = (start is not None) + (end is not None)
    if max_length < specials:
        raise ValueError("max_length leaves no room for start and end")
    cut_at = lambda w: F.when(F.length(w) <= LONGEST_WORD, w)  # noqa: E731  (a longer word is unknown, so it is not shuffled)
    rows = records.select(F.col(key).alias("key"), F.col(label).alias("label"), F.transform(words(F.col(text)), cut_at).alias("words"))
    # outer, so that no filter is derived that would search each text twice
    occurring = rows.select("key", F.posexplode_outer("words").alias("pos", "word")).where("pos is not null")
    counted = occurring.where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    cut_words = cut(counted, vocabulary, unknown)
    often = cut_words.orderBy(F.desc("n"), "word").limit(common)

    def met(part: Column) -> DataFrame:
        """key, pos and ids of the words of a part of each text."""
        found = rows.select("key", F.posexplode_outer(part).alias("pos", "word")).where("pos is not null").join(F.broadcast(often.select("word", "ids")), "word", "left")  # ``common`` rows at most
        apart = found.where("word is not null and ids is null").drop("ids").join(cut_words.select("word", "ids"), "word")
        return found.where("word is null or ids is not null").withColumn("ids", F.coalesce("ids", F.array(F.lit(unknown)))).unionByName(apart)

    # each word gives an id, so words from max_length on are beyond the cut: they are summed by hash, and only those before are collected, which sorts them
    near = met(F.slice("words", 1, max_length)).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("near"), F.sum(F.size("ids")).alias("n_near"))
    far = met(F.slice("words", F.lit(max_length + 1), F.greatest(F.size("words"), F.lit(0)))).groupBy("key").agg(F.sum(F.size("ids")).alias("n_far"))
    whole = near.join(far, "key", "left").select("key", "near", (F.col("n_near") + F.coalesce("n_far", F.lit(0))).alias("n"))
    heads = rows.groupBy("key").agg(F.first("label").alias("label"), F.count(F.lit(1)).alias("rows"))
    empty = F.array().cast("array<int>")
    before, after = (F.array(F.lit(x)) if x is not None else empty for x in (start, end))
    kept = F.concat(before, F.slice(F.coalesce(F.flatten("near.ids"), empty), 1, max_length - specials), after)
    n_tokens = (F.coalesce("n", F.lit(0)) + specials).cast("int")
    numbers = F.create_map(*[F.lit(x) for c, i in labels.ids.items() for x in (c, i)])
    number = F.coalesce(F.try_element_at(numbers, F.col("label")), F.raise_error(F.concat(F.lit("unknown label "), F.coalesce("label", F.lit("null")))).cast("int"))
    once = F.when((F.col("rows") == 1) & F.col("key").isNotNull(), F.col("key")).otherwise(F.raise_error(F.lit("a key is null or stands at several records")).cast(records.schema[key].dataType))
    out = heads.join(whole, "key", "left").select(once.alias(key), kept.alias("input_ids"), number.alias("label"), n_tokens.alias("n_tokens"))
    return out.select(key, "input_ids", F.transform("input_ids", lambda _: F.lit(1)).alias("attention_mask"), "label", "n_tokens")
