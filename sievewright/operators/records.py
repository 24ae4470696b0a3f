"""Mapping, validation and routing of source records to tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.functions.text import replace_found, utrim
from sievewright.operators.leakage import fields_of, populated

PRIORITIES = ("low", "medium", "high")
RENAMES = {"body": "message", "type": "ticket_type", "version": "source_version"}


FIELDS = ("subject", "message", "ticket_type", "queue", "priority", "language", "source_version", "tags")
#: Adds no column where a reader knows no types; else the JSON type of every value that is not text.
TYPES = "_types"


def map_records(source: DataFrame, tags: int = 8, keep_source: bool = False) -> DataFrame:
    """Canonical columns of source records; absent ones are null, blank subjects become null, tags keep order and repeats.

    keep_source: also ``source``, a struct of all columns given.
    """
    have = set(source.columns)
    take = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    subject = take("subject")
    collected = F.array(*[take(f"tag_{i}").cast("string") for i in range(1, tags + 1)])
    out = {
        "subject": F.when(utrim(subject) == "", None).otherwise(subject),
        **{new: take(old) for old, new in RENAMES.items()},
        **{c: take(c) for c in ("queue", "priority", "language")},
        "tags": F.filter(collected, lambda x: x.isNotNull() & ~F.lower(utrim(x)).isin("", "nan")),
    }
    kept = [c for c in source.columns if c in ("record_index", TYPES)]
    raw = [F.struct(*[F.col(f"`{c}`") for c in source.columns if c not in ("record_index", TYPES)]).alias("source")] if keep_source else []
    return source.select(*kept, *[v.alias(k) for k, v in out.items()], *raw)


def whole_digits(c: Column) -> Column:
    """Digits, signed digits, digits set off by underscores and integral decimals as the shortest decimal text of that number, of any length; else null."""
    t = F.regexp_replace(utrim(c.cast("string")), r"^([+-]?[0-9]+)\.0+$", "$1")
    t = F.when(t.rlike(r"^[+-]?[0-9]+(?:_[0-9]+)*$"), F.replace(t, F.lit("_")))
    t = F.regexp_replace(F.regexp_replace(t, r"^\+", ""), r"^(-?)0+(?=[0-9])", "$1")
    return F.when(t == "-0", "0").otherwise(t)


def whole_number(c: Column) -> Column:
    """The number of :func:`whole_digits` as a decimal; one of over 38 digits is null, though no error."""
    return whole_digits(c).try_cast("decimal(38,0)")


def schema_errors(records: DataFrame) -> DataFrame:
    """Adds ``errors``: every field's error as field:code, in field order.

    Where the reader tells JSON types, a text field that holds something else is a string_type error, and a version that is
    no number, text or truth value an int_type error.
    """
    typed = TYPES in records.columns
    source_of = {new: old for old, new in RENAMES.items()}
    kind = lambda c: F.get_json_object(TYPES, f"$.{source_of.get(c, c)}") if typed else F.lit(None).cast("string")
    other = lambda c, *allowed: F.coalesce(~kind(c).isin("STRING", "VOID", *allowed), F.lit(False))
    text = lambda c, null=False: F.when(other(c) if null else F.col(c).isNull() | other(c), F.lit(f"{c}:string_type"))
    checks = [text("subject", null=True), *[text(c) for c in ("message", "ticket_type", "queue")]]
    checks.append(F.when(F.col("priority").isNull() | ~F.col("priority").isin(*PRIORITIES) | other("priority"), F.lit("priority:literal_error")))
    checks.append(text("language"))
    version = F.when(kind("source_version") == "BOOLEAN", F.lit("1")).otherwise(F.col("source_version"))
    container = F.coalesce(kind("source_version").rlike("^(ARRAY|OBJECT)"), F.lit(False))
    fraction = version.rlike(r"^[+-]?\d+\.\d*[1-9]\d*$") & F.coalesce(kind("source_version") != "STRING", F.lit(False))
    checks.append(F.when(version.isNull() | container, F.lit("source_version:int_type")).when(fraction, F.lit("source_version:int_from_float")).when(whole_digits(version).isNull(), F.lit("source_version:int_parsing")))
    return records.withColumn("errors", F.filter(F.array(*checks), lambda x: x.isNotNull()))


def route(records: DataFrame, shown=None) -> DataFrame:
    """Adds ``reason``: SCHEMA_VALIDATION, then EMPTY_MESSAGE, else null.  shown: the text that counts for emptiness."""
    shown = shown if shown is not None else F.col("message")
    return schema_errors(records).withColumn("reason", F.when(F.size("errors") > 0, "SCHEMA_VALIDATION").when(utrim(shown) == "", "EMPTY_MESSAGE"))


def error_details(routed: DataFrame) -> DataFrame:
    """One row for each error of rejected records: index, reason, loc (the field's path) and type; a reason without errors is one row of its own."""
    e = F.explode(F.when(F.size("errors") > 0, F.col("errors")).otherwise(F.array(F.concat(F.lit("message:"), F.lower("reason")))))
    t = routed.where("reason is not null").select("record_index", "reason", e.alias("e"))
    return t.select("record_index", "reason", F.split("e", ":")[0].alias("loc"), F.split("e", ":")[1].alias("type"))


def validation_counts(routed: DataFrame) -> DataFrame:
    """section, name, events: records by reason, errors by type and by path."""
    d = error_details(routed)
    by_reason = routed.where("reason is not null").select(F.lit("reason").alias("section"), F.col("reason").alias("name"))
    return by_reason.unionByName(d.select(F.lit("type").alias("section"), F.col("type").alias("name"))).unionByName(d.select(F.lit("path").alias("section"), F.col("loc").alias("name"))).groupBy("section", "name").agg(F.count(F.lit(1)).alias("events"))


def rejected_view(routed: DataFrame) -> DataFrame:
    """Rejected records without any of their values: index, names of populated fields, reason and error codes."""
    known = {n: v for n, v in fields_of(routed).items() if n in FIELDS}
    present = F.array_compact(F.array(*[F.when(populated(*known[c]), F.lit(c)) for c in sorted(known)]))
    return routed.where("reason is not null").select("record_index", present.alias("present_canonical_fields"), "reason", "errors")


def exact_duplicates(records: DataFrame, key: str = "fingerprint", index: str = "record_index") -> DataFrame:
    """Adds duplicate_of, the first index with the same key; null for the first.

    A map-side minimum per key, of which only keys of several records come back to them; where very many records share a
    key, the adaptive plan splits the join.
    """
    first = records.groupBy(key).agg(F.min(index).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return records.join(first, key, "left").withColumn("duplicate_of", F.when(F.col("_first") < F.col(index), F.col("_first"))).drop("_first")


def _json_text(c: Column) -> Column:
    """A JSON string in ASCII: other characters as escapes of four lower-case hex digits, by UTF-16 unit; null stays null in JSON."""
    plain = F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"})
    value = F.replace(F.substring(plain, F.lit(6), F.length(plain) - 6), F.lit("\x7f"), F.lit("\\u007f"))
    escapes = r"(?<!\\)(?:\\\\)*\\u[0-9A-F]{4}"
    return F.transform(F.array(value), lambda v: F.when(v.contains("\\u"), replace_found(v, escapes, F.lower)).otherwise(v))[0]


def content_json(records: DataFrame) -> Column:
    """The eight canonical fields as one JSON text: keys in alphabetical order, a blank after colons and commas, ASCII only."""
    version = F.coalesce(whole_digits(F.col("source_version")), F.lit("null"))
    tags = F.concat(F.lit("["), F.array_join(F.transform("tags", _json_text), ", "), F.lit("]"))
    shown = {c: _json_text(F.col(c).cast("string")) for c in FIELDS if c not in ("source_version", "tags")} | {"source_version": version, "tags": F.coalesce(tags, F.lit("null"))}
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{c}": '), shown[c]) for c in sorted(shown)]), F.lit("}"))


def record_ids(records: DataFrame, index: str = "record_index", stretch: int = 65536) -> DataFrame:
    """Adds record_id, a digest of a record's content; the n-th repeat of the same content gets :n.

    Repeats are numbered within stretches of indexes whose sizes give the offsets, so that content that very many records
    share is no one task.
    """
    t = records.withColumns({"_digest": F.sha2(content_json(records), 256), "_stretch": F.floor(F.col(index) / stretch)})
    sizes = t.groupBy("_digest", "_stretch").agg(F.count(F.lit(1)).alias("_here"))
    before = Window.partitionBy("_digest").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_digest", "_stretch", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_digest", "_stretch").orderBy(index)) - 1
    n = F.col("_at") + F.col("_before")
    t = t.withColumn("_at", at).join(offsets, ["_digest", "_stretch"])
    return t.withColumn("record_id", F.concat(F.lit("record:"), "_digest", F.when(n > 0, F.concat(F.lit(":"), n)).otherwise(""))).select(*records.columns, "record_id")
