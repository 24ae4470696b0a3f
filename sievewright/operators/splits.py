"""Splits of labelled records: by hash order over all or within classes, in halves, and the checks that a split must pass."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievewright.operators.classification import split_order, stratified_split

PARTS = ("train", "validation", "test")
LEAST_PER_CLASS = 3


class SplitError(ValueError):
    """A split is not complete, disjoint, or as large as its settings say."""


def sizes(total: int, train: float = 0.7, validation: float = 0.15) -> tuple[int, int, int]:
    a, b = math.floor(total * train), math.floor(total * validation)
    return a, b, total - a - b


def numbered(records: DataFrame, key: str, seed: int, within: list[str] | None = None, bins: int = 3) -> DataFrame:
    """Adds ``_at``, the place from 1 on in hash order (within ``within``); rows are numbered in hash ranges, not in one task."""
    by = list(within or [])
    hashed = records.withColumn("_order", split_order(seed, key)).withColumn("_bin", F.substring("_order", 1, bins))
    counts = hashed.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bin", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*by, "_bin").orderBy("_order", key))
    same = F.col("_bin") == F.col("_of")
    for c in by:  # records without a value belong together, too
        same = same & F.col(c).eqNullSafe(F.col(f"_own_{c}"))
    offsets = offsets.withColumnsRenamed({"_bin": "_of", **{c: f"_own_{c}" for c in by}})
    return hashed.withColumn("_r", rank).join(offsets, same).select(*records.columns, (F.col("_before") + F.col("_r")).alias("_at"))


def random_split(records: DataFrame, key: str, seed: int = 42, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """Adds split, by hash order over all records."""
    a, b, _ = sizes(records.count(), train, validation)
    return numbered(records, key, seed).withColumn("split", F.when(F.col("_at") <= a, "train").when(F.col("_at") <= a + b, "validation").otherwise("test")).drop("_at")


def checked_split(records: DataFrame, label: str, key: str, seed: int = 42, train: float = 0.7, validation: float = 0.15) -> DataFrame:
    """A stratified split of records that allow one: three of each class, and each part as many records as there are classes."""
    counts = {r[0]: r[1] for r in records.groupBy(label).count().collect()}
    small = sorted(str(c) for c, n in counts.items() if n < LEAST_PER_CLASS)
    if small:
        raise SplitError(f"classes of under {LEAST_PER_CLASS} records cannot be stratified: {small}")
    if any(n < len(counts) for n in sizes(sum(counts.values()), train, validation)):
        raise SplitError("each part needs as many records as there are classes")
    return stratified_split(records, label, key, seed, train, validation)


def halves(records: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Adds half: calibration or threshold, within each class by hash order; an odd class gives its last record to the second."""
    n = records.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    at = numbered(records, key, seed, [label]).join(F.broadcast(n), F.col(label).eqNullSafe(F.col("_label")))  # one row for each class
    return at.select(*records.columns, F.when(F.col("_at") <= F.floor(F.col("_n") / 2), "calibration").otherwise("threshold").alias("half"))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def integrity(records: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """One row: records, assigned, and how many are repeated in the input, assigned twice, in several parts, missing, extra."""
    given = records.groupBy(key).agg(F.count(F.lit(1)).alias("given"))
    put = split.groupBy(key).agg(F.count(F.lit(1)).alias("put"), F.countDistinct("split").alias("parts"))
    j = given.join(put, key, "full").na.fill(0, ["given", "put", "parts"])
    return j.agg(
        F.coalesce(F.sum("given"), F.lit(0)).alias("records"), F.coalesce(F.sum("put"), F.lit(0)).alias("assigned"), F.count_if(F.col("given") > 1).alias("repeated"),
        F.count_if(F.col("put") > 1).alias("assigned_twice"), F.count_if(F.col("parts") > 1).alias("overlap"),
        F.count_if((F.col("given") > 0) & (F.col("put") == 0)).alias("missing"), F.count_if((F.col("given") == 0) & (F.col("put") > 0)).alias("extra"),
    )


def proportions(split: DataFrame, label: str) -> DataFrame:
    """split, label, share, overall, deviation and whether it is within two records of the part's size; absent classes have share 0."""
    n = split.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    part = n.groupBy("split").agg(F.sum("n").alias("size"))
    whole = n.groupBy(label).agg(F.sum("n").alias("all"))
    every = part.join(F.broadcast(whole)).join(n, ["split", label], "left").na.fill(0, ["n"])  # parts x classes
    total = part.agg(F.sum("size").alias("total"))
    t = every.join(F.broadcast(total))  # one row
    share, overall = F.col("n") / F.col("size"), F.col("all") / F.col("total")
    ok = (F.abs(share - overall) <= 2 / F.col("size")) & (F.col("n") > 0)
    return t.select("split", F.col(label).alias("label"), F.round(share, 6).alias("share"), F.round(overall, 6).alias("overall"), F.round(share - overall, 6).alias("deviation"), ok.alias("within"))


def validate(records: DataFrame, split: DataFrame, key: str, label: str, train: float = 0.7, validation: float = 0.15, stratified: bool = True, versions: tuple[str, str] | None = None) -> dict:
    """The report of a good split; SplitError tells the first thing that is wrong.  versions: of the settings, and expected."""
    if versions and versions[0] != versions[1]:
        raise SplitError(f"the settings are for dataset {versions[0]}, not {versions[1]}")
    r = integrity(records, split, key).first().asDict()
    if not r["records"]:
        raise SplitError("there are no records")
    for what in ("repeated", "overlap", "assigned_twice", "missing", "extra"):
        if r[what]:
            raise SplitError(f"{r[what]} records are {what.replace('_', ' ')}")
    counts = {x["split"]: x["count"] for x in split.groupBy("split").count().collect()}
    got = tuple(counts.get(p, 0) for p in PARTS)
    if split.where(F.col(label).isNull()).limit(1).count():
        raise SplitError("every record needs a label")
    if stratified:
        wrong = proportions(split, label).where("not within").orderBy("split", "label").first()
        if wrong:
            raise SplitError(f"class {wrong.label} has a share of {wrong.share} in {wrong['split']}, {wrong.overall} overall")
    elif got != sizes(r["records"], train, validation):
        raise SplitError(f"parts have {got} records, not {sizes(r['records'], train, validation)}")
    return {**r, "sizes": dict(zip(PARTS, got))}


def seeded_sample(records: DataFrame, key: str, order: str, n: int, seed: int = 42) -> DataFrame:
    """n records, the same at every run, in their own order; all where there are no more."""
    if n < 1:
        raise ValueError("a sample needs a positive size")
    return records.orderBy(split_order(seed, key), key).limit(n).orderBy(order)


def id_lists(split: DataFrame, key: str, order: str) -> DataFrame:
    """split and its keys in the order of ``order``, in chunks of 10,000 so that no row grows with the data."""
    ranked = split.withColumn("_c", F.expr(f"cast({order} div 10000 as long)"))
    return ranked.groupBy("split", F.col("_c").alias("chunk")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k")))), lambda x: x["k"]).alias("keys"))
