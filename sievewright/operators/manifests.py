"""Canonical JSON, content digests, and manifests that name data by what it holds."""

from __future__ import annotations

import hashlib
import json
import math
import unicodedata
from dataclasses import fields, is_dataclass
from datetime import UTC, date, datetime
from datetime import time as clock_time
from enum import Enum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.sources import storage
from sievewright.sources.storage import write_text

#: Records under one inner digest, at each of LEVELS levels: 1024 ** 4 records and more.
FAN, LEVELS = 1024, 4


def _finite(value: float) -> float:
    if not math.isfinite(value):
        raise ValueError("numbers must be finite")
    return value


def _moment(value: datetime) -> str:
    if value.tzinfo is None:
        raise ValueError("times need a zone")
    return value.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def _mapping(value: dict) -> dict:
    out = {canonical(k): canonical(v) for k, v in value.items()}
    if any(not isinstance(k, str) for k in out):
        raise TypeError("keys must be strings")
    if len(out) < len(value):
        raise ValueError("two keys are equal once composed")
    return out


def _members(value) -> list:
    return sorted(map(canonical, value), key=canonical_json)


#: How values of each type are written; the first that fits counts.
_WRITTEN = (
    (Enum, lambda v: canonical(v.value)),
    ((type(None), int), lambda v: v),
    (str, lambda v: unicodedata.normalize("NFC", v)),
    (float, _finite),
    (datetime, _moment),
    ((date, clock_time), lambda v: v.isoformat()),
    (dict, _mapping),
    ((set, frozenset), _members),
    ((list, tuple), lambda v: list(map(canonical, v))),
)


def canonical(value):
    """A value with composed strings, sorted sets and UTC times; what JSON can't hold exactly is an error."""
    if is_dataclass(value) and not isinstance(value, type):
        return _mapping({f.name: getattr(value, f.name) for f in fields(value)})
    for kind, write in _WRITTEN:
        if isinstance(value, kind):
            return write(value)
    raise TypeError(f"cannot write {type(value).__name__} as JSON")


def canonical_json(value) -> str:
    return json.dumps(canonical(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest(value) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def named(prefix: str, value) -> str:
    """A short name that follows from the content."""
    return f"{prefix}_{digest(value)[:12]}"


def file_digest(path: str) -> dict[str, str]:
    """Base name and SHA-256 of a file's bytes, wherever it lies."""
    return {"name": path.rstrip("/").rpartition("/")[2], "sha256": storage.sha256(path)}


def tree_digest(records: DataFrame, index: str, record_digest: Column) -> DataFrame:
    """One row, records and sha256, over records in the order of their indexes.

    A tree of digests: index // 1024 names the group of records, and so on for four levels, so no task holds more
    than a group of 1024 digests (and repeats of one index), and only one row a group is shuffled.
    """
    t = records.select(F.col(index).cast("long").alias("i"), F.coalesce(record_digest, F.lit("")).alias("h"), F.lit(1).cast("long").alias("n"))
    for _ in range(LEVELS):
        in_order = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]), "\n")
        t = t.groupBy(F.expr(f"i div {FAN}").alias("g")).agg(F.sha2(in_order, 256).alias("h"), F.sum("n").alias("n")).withColumnRenamed("g", "i")
    top = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "h"))), lambda x: x["h"]), "\n")
    return t.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.sha2(top, 256).alias("sha256"))


def dataset_manifest(sources: list[dict[str, str]], config: dict, content: dict, version: str, created_at: datetime | None = None) -> dict:
    """What a dataset was made of; its name depends on everything but the time."""
    made_of = {"sources": sorted(sources, key=canonical_json), "config": config, "content": content, "pipeline_version": version}
    return canonical({"dataset_version": named("ds", made_of), "created_at": created_at or datetime.now(UTC), **made_of})


def manifest_changes(old: dict, new: dict) -> dict[str, bool]:
    """Which parts of two manifests differ."""
    return {f"{k}_changed": canonical_json(old.get(k)) != canonical_json(new.get(k)) for k in ("dataset_version", "sources", "config", "content", "pipeline_version", "created_at")}


def id_digests(rows: DataFrame, key: str, part: str) -> dict[str, str]:
    """For each part a digest of its different ids: a tree over ranges of their hashes, so that no task holds a part."""
    t = rows.select(F.col(part).alias("p"), F.sha2(F.col(key).cast("string"), 256).alias("h")).distinct()
    for cut in (6, 4, 2, 0):
        t = t.groupBy("p", F.substring("h", 1, cut).alias("g")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("h")) if cut == 6 else t.groupBy("p", F.substring("g", 1, cut).alias("g2")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("h")).withColumnRenamed("g2", "g")
    return {str(r.p): r.h for r in t.collect()}


def order_digests(split: DataFrame, key: str, order: str) -> dict[str, str]:
    """For each part a digest of its ids in the order of a column of whole numbers: a tree, so that no task holds a part."""
    parts = sorted(r[0] for r in split.select("split").distinct().collect())
    return {p: tree_digest(split.where(F.col("split") == p), order, F.sha2(F.col(key).cast("string"), 256)).first().sha256 for p in parts}


def split_manifest(split: DataFrame, label: str, seed: int, ratios: dict[str, float], dataset_version: str, key: str, order: str | None = None) -> dict:
    """Sizes, class counts and a digest of each part's ids; the ids themselves stay in the table.  order: a column by which they also have an order, kept in a further digest."""
    counts = split.groupBy("split", label).count().collect()
    parts = sorted({r["split"] for r in counts})
    per = {p: {str(r[label]): r["count"] for r in counts if r["split"] == p} for p in parts}
    made_of = {"dataset_version": dataset_version, "seed": seed, "ratios": ratios, "sizes": {p: sum(v.values()) for p, v in per.items()}, "classes": per, "ids": id_digests(split, key, "split")}
    if order:
        made_of |= {"order_column": order, "order": order_digests(split, key, order)}
    return canonical({"split_version": named("split", made_of), **made_of})


def sequential_digest(records: DataFrame, index: str, text: Column, tag: bytes = b"records-v1") -> dict:
    """One hash over all records in the order of their indexes, each with its length: for datasets small enough to pass through the driver one by one."""
    h, n = hashlib.sha256(tag), 0
    for r in records.select(F.col(index).alias("i"), text.alias("t")).orderBy("i").toLocalIterator():
        raw = r.t.encode()
        h.update(len(raw).to_bytes(8, "big") + raw)
        n += 1
    return {"records": n, "sha256": h.hexdigest()}


def write_json(value, path: str) -> None:
    """Pretty and sorted; readers see the old file or the new one."""
    write_text(json.dumps(canonical(value), sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n", path)
