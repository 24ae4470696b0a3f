"""Op 13.  Spelling variants by anagram hashing.

A word's key is the sum of the fifth powers of its code points, so that anagrams share a key.  A word of one letter more
has the shorter one's key plus that letter's value; words that differ by an exchange have keys that differ by the
exchange value.  Both are found by one equality join: every word brings its own key and, for each of its different
letters, the key without that letter.  Own key against a key less a letter finds additions and removals; two keys
less different letters find exchanges.  Then the order of letters is verified.

One edit leaves the first half or the last half of the shared letters in place, so a row's join key also holds one of
these halves: anagrams by the thousand do not meet, and no pair of one edit is lost.  A pair that shares both halves
counts on the first side only, so that pairs come out once without a distinct.

A word's form is its near word of most occurrences (ties: the least in code point order), if that has ``ratio`` times as
many as the word itself.  Occurrences grow by that factor with each step, which bounds the length of a chain of forms and
the rounds of pointer doubling that lead from each word to its root.

Null and empty texts hold no words.  Rows that repeat an id, or have none, count each for itself (no id is written as
nothing before the colon).  Texts and runs of letters of any length are taken whole; keys are sums modulo a prime, so
that no run is too long for them (equal keys of other letters are told apart when the letters are compared).  Columns of
the input other than id and text do not matter.  An empty table gives no words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, FEWEST, RATIO = 7, 2, 10
#: One run in so many loses a letter (the query's contract).
EVERY = 31
#: Keys are sums modulo this prime.
PRIME = 2_305_843_009_213_693_951
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(id, run): every maximal run of at least ``shortest`` letters, A to Z lower-cased."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]{{{shortest},}})"), F.lit(1))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))


def mangled(runs: DataFrame, every: int = EVERY, shortest: int = SHORTEST) -> DataFrame:
    """(word): the runs, one in ``every`` (by crc32 of id and run) without one of its letters; those then too short are left out."""
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    return runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= shortest)


def word_counts(words: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of words that occur ``fewest`` times or more; counted on the map side first."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= fewest)


def _value(letter: Column) -> Column:
    c = F.ascii(letter).cast("long")
    return c * c * c * c * c


def anagram_key(word: Column) -> Column:
    """Sum of the fifth powers of the code points, modulo PRIME."""
    return F.aggregate(F.split(word, "", -1), F.lit(0).cast("long"), lambda s, x: (s + _value(x)) % PRIME)


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n, near, near_n): pairs of words that one inserted, deleted or replaced letter parts, in both directions."""
    whole = counts.select("word", "n", anagram_key(F.col("word")).alias("key"), F.char_length("word").alias("m"))
    letters = F.array_distinct(F.split("word", "", -1))
    less = whole.select("word", "n", "key", "m", F.explode(letters).alias("letter")).where(F.col("letter") != "")
    less = less.select("word", "n", F.pmod(F.col("key") - _value(F.col("letter")), F.lit(PRIME)).alias("key"), (F.col("m") - 1).alias("m"))
    half = F.floor((F.col("m") + 1) / 2).cast("int")

    def dealt(df: DataFrame) -> DataFrame:
        """(at, word, n): a row for each half; key, length and half in one number, whose last bit is the side.  Different ones that share a number are told apart when letters are compared."""
        parts = F.array(F.substring("word", F.lit(1), half), F.expr("right(word, int(floor((m + 1) / 2)))"))
        rows = df.select("word", "n", "key", "m", F.posexplode(parts).alias("side", "part"))
        return rows.select(F.xxhash64("key", "m", "part").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("side").cast("long")).alias("at"), "word", "n").repartition("at")

    # dealt out once: the same exchange serves both sides of the one join and a side of the other
    short, full = dealt(less), dealt(whole)
    other = ["at", F.col("word").alias("near"), F.col("n").alias("near_n")]
    shared = F.floor(F.char_length("word") / 2).cast("int")  # letters of a half, from the length of the one that has lost a letter
    first = F.col("at").bitwiseAND(F.lit(1)) == 0
    apart = F.substring("word", F.lit(1), shared) != F.substring("near", F.lit(1), shared)
    met = short.join(short.select(*other), "at").where(F.col("word") < F.col("near")).unionByName(short.join(full.select(*other), "at"))
    pairs = met.where((first | apart) & (F.levenshtein("word", "near", 1) == 1))
    both = F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def forms(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) for all words."""
    best = near_words(counts).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    found = counts.join(best, "word", "left")
    likely = -F.col("best.less") >= ratio * F.col("n")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Adds root: where the chain of forms ends.  ``found`` is read several times and should be a written table."""
    steps = found.where("form is not null").select("word", F.col("form").alias("root"))
    most = found.agg(F.max("n").alias("n")).first().n or 1
    longest = int(math.log(most, ratio)) + 1  # each form has at least ``ratio`` times the occurrences
    for _ in range(math.ceil(math.log2(longest + 1))):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialize(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
    return found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counts = materialize(word_counts(mangled(letter_runs(docs))), "variants-counts")
    found = materialize(forms(counts), "variants-forms")
    return roots(found).select("word", "form", "root", "n", "n_near", "form_n")
