"""Fields that a model must not see, targets, group identifiers and duplicate links, as columns of every record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StringType

from sievewright.functions.text import utrim

FUTURE_FIELD = "FUTURE_FIELD"
CLEAN, WARNING, FAILED = "clean", "warning", "failed"


def _names(fields) -> tuple[str, ...]:
    out = tuple(sorted({str(f).strip() for f in fields}))
    if "" in out:
        raise ValueError("field names must not be blank")
    return out


@dataclass(frozen=True)
class LeakageConfig:
    forbidden: tuple[str, ...] = ("answer",)
    targets: tuple[str, ...] = ()
    proxies: tuple[str, ...] = ()
    groups: tuple[str, ...] = ()

    def __post_init__(self):
        for n in ("forbidden", "targets", "proxies", "groups"):
            object.__setattr__(self, n, _names(getattr(self, n)))


def populated(col: Column, kind: DataType) -> Column:
    """Whether a field says something: blank texts and empty containers do not, false and zero do."""
    if isinstance(kind, StringType):
        return F.coalesce(utrim(col) != "", F.lit(False))
    if isinstance(kind, (ArrayType, MapType)):
        return F.coalesce(F.size(col) > 0, F.lit(False))
    return col.isNotNull()


Fields = dict[str, tuple[Column, DataType]]


def fields_of(records: DataFrame, prefix: str = "") -> Fields:
    """Name, column and type of every column, or of a struct's fields."""
    schema = records.schema[prefix].dataType if prefix else records.schema
    return {f.name: (F.col(f"{prefix}.`{f.name}`" if prefix else f"`{f.name}`"), f.dataType) for f in schema.fields}


def _present(fields: Fields, names: tuple[str, ...]) -> Column:
    have = [c for c in names if c in fields]
    return F.array_compact(F.array(*[F.when(populated(*fields[c]), F.lit(c)) for c in have])) if have else F.array().cast("array<string>")


def _link_ok(duplicate_of: Column, index: Column) -> Column:
    return duplicate_of.isNull() | ((duplicate_of >= 0) & (duplicate_of < index))


def check(records: DataFrame, config: LeakageConfig = LeakageConfig(), index: str = "record_index", exact: str | None = None, semantic: str | None = None, fields: Fields | None = None) -> DataFrame:
    """Adds ``leakage``: status, issues, targets, grouping and unchecked fields.

    exact, semantic: columns with the index of an earlier record that this one repeats; a link that is not to an earlier
    one, or a group identifier that is not a scalar, makes the check fail (and say nothing else).  Identifiers are variants,
    so that numbers, texts and truth values stay what they are.  Proxies count only where
    there are targets.  Unchecked are configured fields that the records do not have as columns, not those that are null.
    fields: what is looked at, by default every column.
    """
    fields = fields_of(records) if fields is None else fields
    issues = F.transform(_present(fields, config.forbidden), lambda f: F.struct(F.lit(FUTURE_FIELD).alias("type"), f.alias("field")))
    proxies = config.proxies if config.targets else ()
    scalar = (StringType, NumericType, BooleanType)
    groups = [c for c in config.groups if c in fields]
    odd = [c for c in groups if not isinstance(fields[c][1], scalar)]
    pairs = [x for c in groups if c not in odd for x in (F.lit(c), F.when(populated(*fields[c]), fields[c][0]).cast("variant"))]
    identifiers = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.create_map().cast("map<string,variant>")
    link = lambda c: F.col(c).cast("long") if c else F.lit(None).cast("long")
    unchecked = sorted(set(config.forbidden + config.targets + config.groups + proxies) - set(fields))
    failed = ~(_link_ok(link(exact), F.col(index)) & _link_ok(link(semantic), F.col(index)))
    for c in odd:
        failed = failed | populated(*fields[c])
    none = lambda c: F.when(~F.col("_failed"), c)
    t = records.withColumn("_failed", failed)
    status = F.when(F.col("_failed"), FAILED).when(F.size(issues) > 0, WARNING).otherwise(CLEAN)
    out = F.struct(
        status.alias("status"), F.coalesce(none(issues), F.array().cast("array<struct<type:string,field:string>>")).alias("issues"),
        none(F.struct(_present(fields, config.targets).alias("target_fields"), _present(fields, proxies).alias("target_proxy_fields"))).alias("targets"),
        none(F.struct(link(exact).alias("exact_duplicate_group_id"), link(semantic).alias("semantic_duplicate_group_id"), identifiers.alias("identifiers"))).alias("grouping"),
        none(F.array(*[F.lit(c) for c in unchecked]) if unchecked else F.array().cast("array<string>")).alias("unchecked_fields"),
    )
    return t.withColumn("leakage", out).drop("_failed")


def summary(checked: DataFrame) -> DataFrame:
    """section, name, records: by status, by issue type and by field."""
    by_status = checked.select(F.lit("status").alias("section"), F.col("leakage.status").alias("name"))
    issue = checked.select(F.explode("leakage.issues").alias("i"))
    each = by_status.unionByName(issue.select(F.lit("type").alias("section"), F.col("i.type").alias("name"))).unionByName(issue.select(F.lit("field").alias("section"), F.col("i.field").alias("name")))
    return each.groupBy("section", "name").agg(F.count(F.lit(1)).alias("records"))
