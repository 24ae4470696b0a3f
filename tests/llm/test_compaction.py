"""Compaction against a plain version that reads the files it left."""

import collections
import datetime
import glob
import hashlib
import math
import os
import random
import zlib

import pyarrow.parquet as pq
import pytest

from sievewright.llm import compaction
from sievewright.llm.compaction import Staircase


@pytest.mark.parametrize("seed", range(30))
def test_staircase_is_first_fit(seed):
    rng = random.Random(seed)
    capacity = rng.randint(1, 60)
    stairs, free = Staircase(capacity), []
    for _ in range(rng.randint(1, 300)):
        size = rng.randint(1, capacity)
        want = next((i for i, f in enumerate(free) if f >= size), len(free))
        if want == len(free):
            free.append(capacity)
        free[want] -= size
        assert stairs.place(size) == want
        assert stairs.highest[: len(free)].tolist() == [max(free[: i + 1]) for i in range(len(free))]


def plain(rows):
    """What the contract asks for, by loops: rows are (id, at, value) and the result is {(day, lot, piece): ...}."""
    def share(x):
        return 1 + len(rows) // x

    days = collections.defaultdict(list)
    for r in rows:
        days[None if r[1] is None else (r[1] - datetime.datetime(1970, 1, 1)).days].append(r)
    out = {}
    for day, own in days.items():
        files = collections.defaultdict(list)
        for r in own:
            h = zlib.crc32(b"" if r[0] is None else str(r[0]).encode())
            files[h // 16 % (1 + len(own) // share(200)), min(h % 4, h // 4 % 4)].append(r)
        for f in files.values():
            f.sort(key=lambda r: (r[1] or datetime.datetime.min, r[0] is not None, r[0] or 0))
        groups = []
        for unit in sorted((u for u in files if len(files[u]) < share(750)), key=lambda u: (-len(files[u]), u)):
            n = len(files[unit])
            fit = next((g for g in groups if sum(len(files[u]) for u in g) + n <= share(400)), None)
            groups.append([unit]) if fit is None else fit.append(unit)
        groups += [[u] for u in files if len(files[u]) >= share(750)]
        for g in groups:
            ids = [r[0] for u in g for r in files[u]]
            known = [i for i in ids if i is not None]
            cents = sum(math.floor(100 * r[2] + 0.5) for u in g for r in files[u] if r[2] is not None)
            out[(day, *g[0])] = (len(ids), min(known, default=None), max(known, default=None), cents, ",".join(f"{a}-{b}" for a, b in g), hashlib.sha256(",".join("" if i is None else str(i) for i in ids).encode()).hexdigest(), len(g) > 1)
    return out


def table(spark, n, seed=1, days=9, odd=True):
    rng = random.Random(seed)
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        # a third of the rows fall on one day
        day = 3 if rng.random() < 0.34 else rng.randrange(days)
        at = start + datetime.timedelta(days=day, seconds=rng.randrange(0, 86400, 600))
        rows.append((i, at, None if rng.random() < 0.05 else round(rng.uniform(-5, 90), 2), f"x{i}"))
    if odd:
        rows += [(None, start, 1.0, "a"), (5, None, 2.0, "b"), (6, None, None, None), rows[7], rows[7], (-4, datetime.datetime(1969, 12, 31, 23), 3.0, "c")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "click_id long, arrived_at timestamp_ntz, value double, unit_day string").repartition(3)
    return rows, df


@pytest.mark.parametrize("n,seed", [(3000, 1), (900, 2), (40, 3)])
def test_equals_plain(spark, tmp_path, n, seed):
    rows, df = table(spark, n, seed)
    got = compaction.compacted(df, "arrived_at", "click_id", "value", f"file://{tmp_path}/t").collect()
    assert {(r.day, r.lot, r.piece): (r.n_rows, r.min_click_id, r.max_click_id, r.cents, r.sources, r.ids_sha256, r.rewritten) for r in got} == plain(rows)
    files = glob.glob(f"{tmp_path}/t/data/**/*.parquet", recursive=True)
    assert sorted("file:" + f for f in files) == sorted(r.path.replace("file:///", "file:/") for r in got)
    for r in got:
        inside = pq.ParquetFile(r.path.removeprefix("file:").replace("///", "/")).read()
        assert ",".join(inside.column_names) == r.columns == "click_id,arrived_at,value,unit_day"
        assert hashlib.sha256(",".join("" if x is None else str(x) for x in inside["click_id"].to_pylist()).encode()).hexdigest() == r.ids_sha256
    assert any(not r.rewritten for r in got) and (n < 400 or any(r.rewritten for r in got))
    # every column came along
    assert sorted(x for r in got for x in map(str, pq.ParquetFile(r.path.removeprefix("file:").replace("///", "/")).read()["unit_day"].to_pylist())) == sorted(str(r[3]) for r in rows)


def test_untouched_files_keep_their_bytes_and_swap_repeats(spark, tmp_path):
    _, df = table(spark, 1500, 4)
    layout = compaction.Layout(f"file://{tmp_path}/t", df)
    n = compaction.write_units(df, layout, "arrived_at", "click_id")

    def stand():
        return {f: hashlib.sha256(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{tmp_path}/t/data/**/*.parquet", recursive=True)}

    before = stand()
    compaction.compact(layout, compaction.share(n, 750), compaction.share(n, 400))
    after = stand()
    kept = set(before) & set(after)
    assert kept and all(before[f] == after[f] for f in kept)
    assert all(os.path.basename(f).startswith("compact-") for f in set(after) - kept)
    compaction.swap(layout)
    assert stand() == after
    got = compaction.describe(layout, "click_id", "value").collect()
    assert {r.path.removeprefix("file:").replace("///", "/") for r in got if not r.rewritten} == kept


def test_swap_goes_on_after_a_crash(spark, tmp_path, monkeypatch):
    rows, df = table(spark, 800, 5)
    layout = compaction.Layout(f"file://{tmp_path}/t", df)
    n = compaction.write_units(df, layout, "arrived_at", "click_id")
    calls = []

    class Crash(Exception):
        pass

    real = layout.file

    def file(path):
        calls.append(path)
        if len(calls) == 23:
            raise Crash
        return real(path)

    monkeypatch.setattr(layout, "file", file)
    with pytest.raises(Crash):
        compaction.compact(layout, compaction.share(n, 750), compaction.share(n, 400))
    monkeypatch.setattr(layout, "file", real)
    compaction.swap(layout)
    got = compaction.describe(layout, "click_id", "value").collect()
    assert {(r.day, r.lot, r.piece): (r.n_rows, r.ids_sha256) for r in got} == {k: (v[0], v[5]) for k, v in plain(rows).items()}


def test_empty_table(spark, tmp_path):
    _, df = table(spark, 3, 1, odd=False)
    assert compaction.compacted(df.where("false"), "arrived_at", "click_id", "value", f"file://{tmp_path}/t").count() == 0
    assert os.listdir(f"{tmp_path}/t/data") == []


def test_times_with_a_zone_and_equal_sizes(spark, tmp_path):
    rows, df = table(spark, 200, 6, odd=False)
    zoned = df.withColumn("arrived_at", df.arrived_at.cast("timestamp"))
    got = compaction.compacted(zoned, "arrived_at", "click_id", "value", f"file://{tmp_path}/t").collect()
    assert {(r.day, r.lot, r.piece): r.sources for r in got} == {k: v[4] for k, v in plain(rows).items()}
