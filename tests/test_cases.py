"""Literal cases of text rules, records, leakage and policies; splits with null labels; record ids; what normalisation changed."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from sievewright.functions import markup as U
from sievewright.functions import text as T
from sievewright.operators import audit as A
from sievewright.operators import calibration as P
from sievewright.operators import classification as C
from sievewright.operators import evaluation as E
from sievewright.operators import leakage as G
from sievewright.operators import manifests as D
from sievewright.operators import records as R
from sievewright.operators import splits as S
from sievewright.plans import curation

CASES = []


def cases(name, column, pairs):
    CASES.append(pytest.param(column, pairs, id=name))


cases("mask_cases", T.mask_pii, [
    ("call +49 170 1234567 now", "call <PHONE> now"), ("743 555 3824", "<PHONE>"), ("0123 4567890", "<PHONE>"), ("(743) 555-3824", "<PHONE>"), ("(743)555-3824", "(743)555-3824"), ("order 01234567890", "order 01234567890"),
    ("ip10.0.0.1.", "ip<IP_ADDRESS>."), ("1.2.3.4.5 300.1.1.1", "1.2.3.4.5 300.1.1.1"), ("x4111 1111 1111 1111", "x<PAYMENT_CARD>"), ("4111-1111-1111-1112", "4111-1111-1111-1112"), ("0000 0000 0000 0000", "0000 0000 0000 0000"),
    ("CUST-12345-X, Acc-99999 and cust-12", "CUST-12345-X, <ACCOUNT_ID> and cust-12"), ("<PHONE> 10.0.0.1", "<PHONE> <IP_ADDRESS>"), (None, None), ("", ""),
])
cases("url_cases", T.mask_urls, [
    ("see http://a.b/x_(y).", "see <URL>."), ("https://a.com,https://b.com", "<URL>,<URL>"), ("(www.a.b/[c])!", "(<URL>)!"), ('"http://a.b"', '"<URL>"'), ("x@www.a.b", "x@www.a.b"), ("http://a.b/)(}", "<URL>}"), ("none", "none"), (None, None),
])
cases("email_cases", T.mask_emails, [("a@-b.com", "a@-b.com"), ("ref=j+k@e.co.uk", "ref=<EMAIL>"), ("a@b", "a@b"), ("a@b.co-", "a@b.co-"), ("A.b@C-d.Org!", "<EMAIL>!")])
cases("markup_cases", T.markup_to_text, [
    ("<body>x<caption>y</caption></body>", "\nxy\n"), ("a<br/>b", "a\n\nb"), ("<svg><title>t</title></svg>", "t"), ("<EMAIL> <timeout> a < b", "<EMAIL> <timeout> a < b"), ("<q1/>z", "<q1/>z"), ("<p>a &amp; b</p><script>x()</script>", "\na & b\n"),
    ("café", "café"), ("<style>a<b>", ""), (None, None),
])
cases("visible_cases", lambda c: T.utrim(U.visible(c)) == "", [("<script>x</script>", False), ("<b> </b>", True), ("&nbsp;\x01", True), ("<!-- c -->", True), ("<img>", True), (" a ", False), ("", True)])
cases("normalize_cases", lambda c: T.normalize_native(T.markup_to_text(c)), [
    ("Nothing works!? can't open A-7 (v10.0.3) under /srv/mail, F#", "Nothing works!? can't open A-7 (v10.0.3) under /srv/mail, F#"), ("a\x00b\r\nc\rd", "ab\nc\nd"), ("wait...  what?? \n\n\n\n end ", "wait. what?\n\nend"),
    ("Visit https://e.com/r. Mail j@e.com, <b>now</b>", "Visit <URL>. Mail <EMAIL>, now"), ("/o?id=1&ref=j@e.com", "/o?id=1&ref=<EMAIL>"),
])
cases("casefold_cases", lambda c: F.regexp_replace(U.casefold(T.utrim(c)), r"(?U)\s+", " "), [("STRASSE", "strasse"), ("Straße", "strasse"), (" A \t B ", "a b"), (None, None)])

_RAW = [
    # subject, body, type, queue, priority, language, version, tag_1, tag_2, answer; then subject, version, tags, reason, errors
    (("  ", "hello", "Incident", "IT", "high", "en", " 52 ", "x", "nan", "done"), (None, 52, "x", None, "")),
    (("Hi", "<script>x</script>", "", "IT", "low", "de", "52.0", " y ", "y", " "), ("Hi", 52, " y |y", None, "")),
    (("Hi", "<b> </b>", "Change", "IT", "low", "de", "1_000", None, "", None), ("Hi", 1000, "", "EMPTY_MESSAGE", "")),
    ((None, None, "Change", None, "HIGH", "de", "5.5", "NaN", "z", "a"), (None, None, "z", "SCHEMA_VALIDATION", "message:string_type,queue:string_type,priority:literal_error,source_version:int_parsing")),
    (("s", "m", "Problem", "Q", "medium", "en", None, "a", "a", ""), ("s", None, "a|a", "SCHEMA_VALIDATION", "source_version:int_type")),
    (("s", "\x01 ", "Problem", "Q", "medium", "en", "-5", None, None, None), ("s", -5, "", "EMPTY_MESSAGE", "")),
]
_RAW_COLUMNS = "subject body type queue priority language version tag_1 tag_2 answer".split()


def _raw(spark):
    return spark.createDataFrame([(i, *a) for i, (a, _) in enumerate(_RAW)], "record_index long, " + ", ".join(f"{c} string" for c in _RAW_COLUMNS))



@pytest.mark.parametrize("column,pairs", CASES)
def test_cases(spark, column, pairs):
    t = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(pairs)], "id int, text string")
    got = {r.id: r.result for r in t.select("id", column(F.col("text")).alias("result")).collect()}
    assert got == {i: b for i, (_, b) in enumerate(pairs)}


def test_records(spark):
    """Mapping, coercion, tags, validation and routing."""
    t = R.route(R.map_records(_raw(spark)), shown=U.visible("message"))
    t = t.select("record_index", "subject", R.whole_number(F.col("source_version")), F.array_join("tags", "|"), "reason", F.array_join("errors", ","))
    assert {r[0]: tuple(r)[1:] for r in t.collect()} == {i: b for i, (_, b) in enumerate(_RAW)}


def test_validation_counts(spark):
    got = {tuple(r) for r in R.validation_counts(R.route(R.map_records(_raw(spark)), shown=U.visible("message"))).collect()}
    assert got == {("reason", "SCHEMA_VALIDATION", 2), ("reason", "EMPTY_MESSAGE", 2), ("type", "string_type", 2), ("type", "literal_error", 1), ("type", "int_parsing", 1), ("type", "int_type", 1), ("type", "empty_message", 2), ("path", "message", 3), ("path", "queue", 1), ("path", "priority", 1), ("path", "source_version", 2)}


def test_leakage(spark):
    """Forbidden fields, targets, group identifiers and fields that are not there."""
    t = G.check(_raw(spark), G.LeakageConfig(("answer", "ghost"), ("type",), (), ("queue",)))
    k = F.col("leakage")
    t = t.select("record_index", k["status"], F.array_join(F.transform(k["issues"], lambda x: x["field"]), ","), F.array_join(k["targets"]["target_fields"], ","), F.try_variant_get(F.element_at(k["grouping"]["identifiers"], F.lit("queue")), "$", "string"), F.array_join(k["unchecked_fields"], ","))
    assert {tuple(r) for r in t.collect()} == {(0, "warning", "answer", "type", "IT", "ghost"), (1, "clean", "", "", "IT", "ghost"), (2, "clean", "", "type", "IT", "ghost"), (3, "warning", "answer", "type", None, "ghost"), (4, "clean", "", "type", "Q", "ghost"), (5, "clean", "", "type", "Q", "ghost")}


def test_canonical_json():
    for v, want in (({"b": [1, 2.5], "a": "é"}, '{"a":"é","b":[1,2.5]}'), ({"x": {"z", "y"}}, '{"x":["y","z"]}'), ([None, True, "é"], '[null,true,"é"]')):
        assert D.canonical_json(v) == want and D.digest(v) == hashlib.sha256(want.encode()).hexdigest()


def test_policies_and_cost():
    want = [("answer", "never", "written after the fact"), ("message", "input", None), ("priority", "target", "may stand in for the target"), ("queue", "target", "may stand in for the target"), ("tags", "metadata", None), ("ticket_type", "target", None)]
    assert [(r["field"], r["use"], r["risk"]) for r in A.field_policy([f for f, _, _ in want], "ticket_type")] == want
    for hourly, rate in ((2.0, 50.0), (0.5, 1000.0)):
        r = E.cost(rate, hourly)
        assert round(r["per_1000"], 9) == round(hourly / (rate * 3600) * 1000, 9) and round(r["per_1000000"], 6) == round(hourly / (rate * 3600) * 1e6, 6)


def test_label_lists(spark):
    t = spark.createDataFrame([(0, None), (1, []), (2, [" ", None]), (3, ["a", ""]), (4, ["a", "b"])], "id int, labels array<string>")
    assert [r.state for r in t.select("id", A.label_state(F.col("labels"), many=True).alias("state")).orderBy("id").collect()] == ["missing", "missing", "blank", "invalid", "valid"]


def test_whole_numbers(spark):
    given = {"00000000052": 52, "2147483648": 2**31, "9" * 38: 10**38 - 1, "-0": 0, "+7": 7, " 1_000 ": 1000, "1__0": None, "_1": None, "5.0": 5, "5.5": None, "": None, "-012.00": -12}
    t = spark.createDataFrame([(k,) for k in given], "v string")
    assert {r.v: None if r.n is None else int(r.n) for r in t.withColumn("n", R.whole_number(F.col("v"))).collect()} == given
    # too long for the decimal, yet a whole number
    long = spark.createDataFrame([("9" * 50,)], "v string").select(R.whole_digits(F.col("v")).alias("d"), R.whole_number(F.col("v")).alias("n")).first()
    assert long.d == "9" * 50 and long.n is None


@pytest.fixture(scope="module")
def unlabelled(spark):
    return spark.createDataFrame([(i, None if i % 5 == 0 else "ab"[i % 2]) for i in range(50)], "id int, label string")


def test_splits_keep_records_without_a_label(unlabelled):
    for split in (C.stratified_split(unlabelled, "label", "id"), S.halves(unlabelled, "label", "id"), S.numbered(unlabelled, "id", 1, ["label"])):
        got = split.collect()
        assert sorted(r.id for r in got) == list(range(50)) and sum(r.label is None for r in got) == 10
    at = sorted(r._at for r in S.numbered(unlabelled, "id", 1, ["label"]).where("label is null").collect())
    assert at == list(range(1, 11))
    parts = [r.split for r in C.stratified_split(unlabelled, "label", "id").where("label is null").collect()]
    assert sorted(parts).count("train") == 7 and parts.count("validation") == 1


def test_exact_duplicates_keep_records_without_a_key(spark):
    t = spark.createDataFrame([(0, "a"), (1, "a"), (2, None), (3, "b")], "record_index long, fingerprint string")
    assert {r.record_index: r.duplicate_of for r in R.exact_duplicates(t).collect()} == {0: None, 1: 0, 2: None, 3: None}


def test_record_ids(spark):
    odd = ['quote " and \\\\ slash / \\\\u00E9', "é ß 漢 🙂 \x7f \x01 \t\n\r\b\f", "\\é", "", "plain", "\u2028x"]
    rows = [(i, None if i % 4 == 0 else t, t, "Incident", "IT", "high", "en", str(i % 3), "Tag " + t, None) for i, t in enumerate(odd * 3)] + [(90, None, None, None, None, None, None, None, None, None)]
    source = spark.createDataFrame(rows, "record_index long, subject string, body string, type string, queue string, priority string, language string, version string, tag_1 string, tag_2 string")
    seen, want = {}, {}
    for i, subject, body, kind, queue, priority, language, version, tag, _ in rows:
        blank = subject is None or not subject.strip()
        tags = [tag] if tag is not None else []
        payload = {"subject": None if blank else subject, "message": body, "ticket_type": kind, "queue": queue, "priority": priority, "language": language, "source_version": None if version is None else int(version), "tags": tags}
        digest = hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()
        n = seen[digest] = seen.get(digest, -1) + 1
        want[i] = f"record:{digest}" + (f":{n}" if n else "")
    for stretch in (65536, 4):
        assert {r.record_index: r.record_id for r in R.record_ids(R.map_records(source), stretch=stretch).collect()} == want


def test_curation_counts_what_normalisation_changed(spark):
    rows = [("Hi!!", "see http://a.b now"), (None, "same"), ("x", "mail a@b.co or c@d.eu..."), (None, "call +49 170 1234567")]
    source = spark.createDataFrame([(i, s, b, "Incident", "IT", "high", "en", "1") for i, (s, b) in enumerate(rows)], "record_index long, subject string, body string, type string, queue string, priority string, language string, version string")
    got = curation.curate(source).report["preprocessing"]
    assert got == {"records": 4, "records_changed": 2, "fields_changed": 3, "urls": 1, "emails": 2, "fields_masked": 1, "characters_removed": sum(len(a) for a in ("Hi!!", rows[0][1], rows[2][1])) - sum(len(a) for a in ("Hi!", "see <URL> now", "mail <EMAIL> or <EMAIL>."))}


def test_decisions_wait_for_a_selected_threshold(spark):
    t = spark.createDataFrame([(0, [0.7, 0.3]), (1, [0.4, 0.6])], "id int, p array<double>")
    got = t.select("id", P.decide_by_policy(F.col("p"), {"status": "selected", "threshold": 0.65}).alias("d")).orderBy("id").collect()
    assert [r.d for r in got] == ["accepted", "needs_review"]
    for policy in ({"status": "pending", "threshold": None}, {"status": "unreachable", "threshold": None}, {"status": "pending", "threshold": 0.5}, {"status": "selected", "threshold": None}, {}):
        with pytest.raises(ValueError, match="no threshold"):
            P.decide_by_policy(F.col("p"), policy)
