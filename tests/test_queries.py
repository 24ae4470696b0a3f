"""Every query with an oracle equals DuckDB on the smallest tables."""

import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from sievewright.plans import more_queries  # noqa: F401  (registers its queries)
from sievewright.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else round(float(v), 5)
    return v


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_equals_oracle(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    cursor = duck.execute(Q.ORACLE_SQL[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    want = [dict(zip(columns, r)) for r in cursor.fetchall()]
    order = sorted(columns)
    assert sorted(repr([plain(r[c]) for c in order]) for r in got.collect()) == sorted(repr([plain(r[c]) for c in order]) for r in want)


def test_entry_works_without_optional_parts(tmp_path):
    root = Path(__file__).resolve().parents[1]
    code = f"import sys; sys.modules['sievewright.llm'] = None; sys.modules['corpus_pipeline'] = None; sys.path.insert(0, {str(root)!r}); import __spark_entry__ as e; n = e.queries(); assert 'scan_documents' in n and 'pipeline' not in n and not any(x.startswith('op1_') for x in n)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)


def test_addresses_as_the_sql_masks_them(spark, duck, tmp_path):
    """Odd texts, on which the wider rule of ``mask_ipv4`` differs from the query's SQL."""
    import random

    draw = random.Random(5)
    texts = ["ip10.0.0.1.", "10.0.0.1 10.0.0.2 10.0.0.3", "010.000.000.001", "_1.2.3.4", "1.2.3.4.", "1.2.3.4.5", "1.2.3.4.x", "1.2.3.4\n", "1.2.3.4\n\n5.6.7.8", "é1.2.3.4ü", "256.1.1.1", "1.2.3.4.\n", "1.2.3.4x", "1.2.3.4,5.6.7.8", None, ""]
    texts += ["".join(draw.choice(["1.2.3.4", "10.20.255.7", "256.1", "01.2.3.4", ".", " ", "\n", "\r", "x", "_", "-", "é", "5", " ", "😀"]) for _ in range(draw.randint(1, 8))) for _ in range(3000)]
    d = tmp_path / "t"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{d}/documents.parquet")
    got = {r.doc_id: r.text_md5 for r in Q.QUERIES["mask_ipv4"](spark, str(d)).collect()}
    want = dict(duckdb.connect().execute(f"WITH documents AS (SELECT * FROM '{d}/documents.parquet/*.parquet') {Q.ORACLE_SQL['mask_ipv4']}").fetchall())
    assert got == want
