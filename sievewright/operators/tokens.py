"""Token ids of classification texts for sequence models: an injected tokeniser, stable label ids, truncation, and the checks of a dataset."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.functions.text import by_size

#: A tokeniser: texts to lists of ids.
Encode = Callable[[list[str]], list[list[int]]]


class LabelMapping:
    """Labels and their ids, in the order given."""

    def __init__(self, order: list[str]):
        if len(order) < 2 or len(set(order)) != len(order) or any(not isinstance(c, str) or not c for c in order):
            raise ValueError("a label order needs two different names or more")
        self.order, self.ids = list(order), {c: i for i, c in enumerate(order)}

    def encode(self, label: str) -> int:
        if label not in self.ids:
            raise ValueError(f"unknown label {label!r}")
        return self.ids[label]

    def decode(self, i: int) -> str:
        return self.order[i]


def check_tokenizer(encode: Encode) -> None:
    got = encode(["a text", ""])
    if len(got) != 2 or not got[0] or any(not isinstance(i, int) or isinstance(i, bool) or i < 0 for ids in got for i in ids):
        raise ValueError("a tokeniser must give a list of ids for each text")


def words_as_ids(texts: list[str]) -> list[list[int]]:
    """The tokeniser where none is given: each word by the crc32 of its bytes, between a start (1) and an end (2)."""
    import zlib

    return [[1, *(3 + zlib.crc32(w.encode()) % 50_000 for w in t.lower().split()), 2] for t in texts]


def tokenize(records: DataFrame, labels: LabelMapping, encode: Encode = words_as_ids, max_length: int = 256, key: str = "record_id", text: str = "text", label: str = "label") -> DataFrame:
    """key, input_ids, attention_mask, label id and n_tokens before the cut at max_length; no padding."""
    if isinstance(max_length, bool) or not isinstance(max_length, int) or max_length < 1:
        raise ValueError("max_length must be a whole number from 1 on")
    check_tokenizer(encode)
    kind = records.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in by_size(batch, 1)):
            whole = encode([t or "" for t in b.column(1).to_pylist()])
            n_tokens = pa.array([len(x) for x in whole], pa.int32())
            cut = pa.array([x[:max_length] for x in whole], pa.list_(pa.int32()))
            mask = pa.ListArray.from_arrays(cut.offsets, pa.array(np.ones(len(cut.values), np.int32)))
            yield pa.RecordBatch.from_arrays([b.column(0), cut, mask, pa.array([labels.encode(x) for x in b.column(2).to_pylist()], pa.int32()), n_tokens], [key, "input_ids", "attention_mask", "label", "n_tokens"])

    return records.select(key, text, label).mapInArrow(run, f"{key} {kind}, input_ids array<int>, attention_mask array<int>, label int, n_tokens int")


def check_alignment(records: DataFrame, tokens: DataFrame, labels: LabelMapping, max_length: int, key: str = "record_id", label: str = "label") -> None:
    """Every record has its one row of ids, its label's id, a mask as long as its ids, and no more ids than allowed."""
    numbers = F.create_map(*[F.lit(x) for c, i in labels.ids.items() for x in (c, i)])
    a = records.select(key, F.element_at(numbers, F.col(label)).alias("want"), F.lit(1).alias("_a"))
    j = a.join(tokens.select(key, "input_ids", "attention_mask", F.col("label").alias("got"), F.lit(1).alias("_b")), key, "full")
    bad = F.col("_a").isNull() | F.col("_b").isNull() | ~F.col("want").eqNullSafe(F.col("got")) | (F.size("input_ids") != F.size("attention_mask")) | (F.size("input_ids") > max_length) | (F.size("input_ids") == 0)
    if j.where(bad).limit(1).count() or tokens.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError("token rows do not fit their records")


def length_analysis(tokens: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row: records, least, mean, interpolated percentiles and most of the uncut lengths."""
    p = [F.percentile(length, F.lit(s)).alias(f"p{int(100 * s)}") for s in (0.5, 0.75, 0.9, 0.95, 0.99)]
    return tokens.agg(F.count(F.lit(1)).alias("records"), F.min(length).alias("least"), F.round(F.avg(length), 6).alias("mean"), *p, F.max(length).alias("most"))


def write_dataset(folder: str, parts: dict[str, DataFrame], labels: LabelMapping, max_length: int, tokenizer: str, split_version: str) -> dict:
    """Token tables, label mapping and policy; read back, counted, and named by what they hold."""
    from sievewright.operators import manifests
    from sievewright.sources import storage

    sizes = {}
    with storage.together(folder) as staged:
        for name, frame in parts.items():
            frame.write.parquet(f"{staged}/{name}")
            back = frame.sparkSession.read.parquet(f"{staged}/{name}")
            sizes[name] = back.count()
            if sizes[name] != frame.count() or back.where(F.size("input_ids") > max_length).limit(1).count():
                raise ValueError(f"{name} read back differs from what was written")
        made_of = {"split_version": split_version, "tokenizer": tokenizer, "max_length": max_length, "truncation": True, "padding": "dynamic", "labels": labels.order, "sizes": sizes}
        manifest = {"dataset_version": manifests.named("tokens", made_of), **made_of}
        manifests.write_json(manifest, f"{staged}/token_manifest.json")
    return manifest
