"""Readers of source records.  Values stay as written: nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header, quoted newlines and doubled quotes; a byte-order mark is dropped; empty cells are empty strings, not nulls.

    multi_line=False lets Spark split large files, for sources whose cells hold no newlines.
    """
    df = spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', inferSchema=False, emptyValue="", encoding="UTF-8")
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.lstrip("﻿")) for c in df.columns])


def read_json(spark: SparkSession, path: str, columns: list[str], index: str | None = None) -> DataFrame:
    """A top-level array of objects; the named keys as strings, null where absent, and ``_types``, the JSON types of their values.  Anything but an array is an error.

    index: name of a further column, each object's place in its array.
    """
    whole = spark.read.option("singleVariantColumn", "v").option("multiLine", True).json(path)
    if whole.where("schema_of_variant(v) NOT LIKE 'ARRAY%'").limit(1).count():
        raise ValueError("JSON source must be an array of objects")
    each = spark.sql("SELECT e.pos, e.value AS v FROM {whole} w, LATERAL variant_explode(w.v) e", whole=whole)
    types = F.to_json(F.create_map(*[x for c in columns for x in (F.lit(c), F.expr(f"schema_of_variant(try_variant_get(v, '$.{c}', 'variant'))"))]))
    at = [F.col("pos").cast("long").alias(index)] if index else []
    return each.select(*at, *[F.expr(f"try_variant_get(v, '$.{c}', 'string')").alias(c) for c in columns], types.alias("_types"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One object for each line; a malformed line is an error when it is read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """By suffix: .csv or .json."""
    suffix = path.lower().rpartition(".")[2]
    if suffix == "csv":
        return read_csv(spark, path)
    if suffix == "json":
        return read_json(spark, path, columns)
    raise ValueError(f"unsupported source suffix: .{suffix}")


def numbered(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """:func:`read_records` with ``record_index``, the place in the file; a CSV file is read by ranges, however its cells are quoted."""
    from sievewright.sources.ranges import read_numbered_csv

    suffix = path.lower().rpartition(".")[2]
    if suffix == "csv":
        return read_numbered_csv(spark, path)
    if suffix == "json":
        return read_json(spark, path, columns, "record_index")
    raise ValueError(f"unsupported source suffix: .{suffix}")


def load_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Canonical records of a file: reader and mapping in one."""
    from sievewright.operators.records import map_records

    return map_records(read_records(spark, path, columns))
