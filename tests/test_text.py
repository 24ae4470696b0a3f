import pytest
from pyspark.sql import functions as F

from sievewright.functions import markup
from sievewright.functions import text as T
from sievewright.operators import records as R
from sievewright.sources import files, sinks


def apply(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


MASKED = [
    ("call +49 170 1234567 now", "call <PHONE> now"),
    ("(743) 555-3824", "<PHONE>"),
    ("743-555-3824", "<PHONE>"),
    ("version 743-55-3824", "version 743-55-3824"),
    ("host 10.0.0.1.", "host <IP_ADDRESS>."),
    ("300.1.1.1 and 1.2.3 and 1.2.3.4.5", "300.1.1.1 and 1.2.3 and 1.2.3.4.5"),
    ("card 4111 1111 1111 1111", "card <PAYMENT_CARD>"),
    ("card 4111-1111-1111-1112", "card 4111-1111-1111-1112"),
    ("0000 0000 0000 0000", "0000 0000 0000 0000"),
    ("see CUST-12345, Acc-99999 and cust-12", "see <ACCOUNT_ID>, <ACCOUNT_ID> and cust-12"),
    ("<PHONE> stays", "<PHONE> stays"),
    ("743 555 3824, 0123 4567890 and 0123-4567890", "<PHONE>, <PHONE> and <PHONE>"),
    ("(743)555-3824", "(743)555-3824"),
    ("order 01234567890, port 8080, build 928372", "order 01234567890, port 8080, build 928372"),
    ("ip10.0.0.1 and 010.000.000.001", "ip<IP_ADDRESS> and <IP_ADDRESS>"),
    ("999.999.999.999 0010.0.0.1", "999.999.999.999 0010.0.0.1"),
    ("x4111111111111111y", "x<PAYMENT_CARD>y"),
    ("CUST-12345-X and xCUST-12345", "CUST-12345-X and xCUST-12345"),
    ("+1 (743) 555-3824", "+1 <PHONE>"),
    (None, None),
    ("", ""),
]


def test_masking_and_its_repetition(spark):
    got = apply(spark, T.mask_pii, [a for a, _ in MASKED])
    assert got == [b for _, b in MASKED]
    assert apply(spark, T.mask_pii, got) == got


def test_normalisation(spark):
    assert apply(spark, T.normalize_whitespace, ["  a  b \t\n\n\n\n c  ", ""]) == ["a b\n\nc", ""]
    assert apply(spark, T.collapse_punctuation, ["wait... what?!?? no!!!"]) == ["wait. what?!? no!"]
    assert apply(spark, T.mask_urls, ["go to https://a.b/c?d=1, or (www.x.org)."]) == ["go to <URL>, or (<URL>)."]
    urls = {"see http://a.b/x_(y).": "see <URL>.", "https://a.com,https://b.com": "<URL>,<URL>", "(www.a.b/[c])!": "(<URL>)!", "\"http://a.b\"": '"<URL>"', "xwww.a.b": "xwww.a.b", "http://a.b/)(}": "<URL>}", "www.!": "<URL>.!"}
    assert apply(spark, T.mask_urls, list(urls)) == list(urls.values())
    assert apply(spark, T.mask_emails, ["Mail A.b+c@d-e.org now", "a@-b.com", "ref=j@e.com", "a@b.co-", "a@b"]) == ["Mail <EMAIL> now", "a@-b.com", "ref=<EMAIL>", "a@b.co-", "a@b"]
    assert apply(spark, markup.visible, ["<script>x</script>", "<b> </b>", "a\x00&nbsp;", "\x01", None]) == ["x", " ", "a\xa0", "", None]
    assert apply(spark, markup.casefold, ["STRASSE", "Straße"]) == ["strasse", "strasse"]
    tags = ["<body>x<caption>y</caption></body>", "a<br/>b", "<svg><title>t</title></svg>", "<q1/>z", "<script/>hidden?", "<style>a<b>", "caf\u0065\u0301 &lt;b&gt;"]
    assert apply(spark, T.markup_to_text, tags) == ["\nxy\n", "a\n\nb", "t", "<q1/>z", "hidden?", "", "caf\u00e9 <b>"]
    pages = ["<p>a &amp; b</p><script>x()</script><b>c</b>", "a < b", "<EMAIL> <timeout>", None]
    assert apply(spark, T.markup_to_text, pages) == ["\na & b\nc", "a < b", "<EMAIL> <timeout>", None]


def test_fingerprint_depends_on_field_borders(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x")], "s string, m string")
    a, b, c, d = [r[0] for r in df.select(T.fingerprint(F.col("s"), F.col("m"))).collect()]
    assert a != b and c == d


def test_csv_equals_json(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿subject,body,type,queue,priority,language,version,tag_1,tag_2\n"He said ""hi""","line one\nline two",Incident,Q,high,en,52,x,nan\n,b,Request,Q,urgent,de,52.0,,y\n', encoding="utf-8")
    (tmp_path / "a.json").write_text('[{"subject": "He said \\"hi\\"", "body": "line one\\nline two", "type": "Incident", "queue": "Q", "priority": "high", "language": "en", "version": 52, "tag_1": "x", "tag_2": "nan"}, {"body": "b", "type": "Request", "queue": "Q", "priority": "urgent", "language": "de", "version": "52.0", "tag_2": "y"}]')
    columns = "subject body type queue priority language version tag_1 tag_2".split()
    got = [R.schema_errors(R.map_records(files.read_records(spark, str(tmp_path / f"a.{s}"), columns))).drop("_types").orderBy("language").collect() for s in ("csv", "json")]
    assert got[0] == got[1]
    assert got[0][0].subject is None and got[0][0].errors == ["priority:literal_error"] and got[0][0].tags == ["y"]
    assert got[0][1].errors == [] and got[0][1].tags == ["x"]
    (tmp_path / "b.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        files.read_json(spark, str(tmp_path / "b.json"), ["a"])


def test_json_lines_keep_nulls_and_order(spark):
    df = spark.createDataFrame([("é", None, 1)], "b string, a string, c int")
    assert sinks.json_lines(df).first()[0] == '{"a":null,"b":"é","c":1}'


def test_long_texts_pass_python_in_parts(spark):
    """A tokeniser and markup meet few long texts at once, whatever a batch holds."""
    import pyarrow as pa

    from sievewright.functions.markup import PART, by_size
    from sievewright.operators import tokens

    texts = pa.array(["x" * 300_000, None, "", "y" * (3 * PART), *["z" * 400_000] * 5])
    parts = list(by_size(texts))
    assert pa.concat_arrays(parts).equals(texts) and all(len(p) == 1 or sum(len(x or "") for x in p.to_pylist()) <= PART for p in parts)
    rows = spark.range(40, numPartitions=1).selectExpr("id AS record_id", "repeat('x', 200000) AS text", "'a' AS label")
    got = tokens.tokenize(rows, tokens.LabelMapping(["a", "b"]), lambda texts: [[len(texts)]] * len(texts))
    assert got.selectExpr("max(input_ids[0])", "count(*)").first() == (5, 40)
