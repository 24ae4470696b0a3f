"""Further registered queries: records, labels, leakage, splits, features, evaluation and tokens, with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievewright.functions import languages as N
from sievewright.functions import text as T
from sievewright.operators import audit as A
from sievewright.operators import classification as C
from sievewright.operators import evaluation as E
from sievewright.operators import language as L
from sievewright.operators import leakage as G
from sievewright.operators import records as R
from sievewright.operators import splits as S
from sievewright.operators import subwords as W
from sievewright.operators import tokens as K
from sievewright.plans.queries import _DIST, _LABELLED, _LANG, _NAMES, _PARTS, _PRED, _SOURCE, _SPLIT, _weighted, _weights, labelled, parts, predictions, query, source_records, table


def quoted(v: str) -> str:
    """A literal in SQL."""
    return "'" + v.replace("'", "''") + "'"


# --- records, labels, language, leakage ----------------------------------------------------------------------


@query(f"SELECT record_index, path, type FROM (SELECT record_index, 'ticket_type' AS path, 'string_type' AS type FROM ({_SOURCE}) WHERE type IS NULL UNION ALL SELECT record_index, 'priority', 'literal_error' FROM ({_SOURCE}) WHERE priority IS NULL OR priority NOT IN ('low','medium','high') UNION ALL SELECT record_index, 'message', 'empty_message' FROM ({_SOURCE}) WHERE type IS NOT NULL AND priority = 'high' AND trim(body) = '')")
def error_details(spark, d):
    return R.error_details(R.route(R.map_records(source_records(spark, d)))).select("record_index", F.col("loc").alias("path"), "type")


_TRIMMED = "trim({}, chr(32) || chr(9) || chr(10) || chr(13))"


@query(f"SELECT doc_id, md5(array_to_string(list_filter([s, t], lambda x: x IS NOT NULL AND x <> ''), chr(10) || chr(10))) AS classified, md5(coalesce(source, '') || chr(10) || text) AS encoded FROM (SELECT *, {_TRIMMED.format('source')} AS s, {_TRIMMED.format('text')} AS t FROM documents)")
def joined_texts(spark, d):
    """Subject and message as classifiers and as the encoder read them, blank ones too; the source stands for the subject."""
    t = table(spark, d, "documents")
    return t.select("doc_id", F.md5(T.joined_text(F.col("source"), F.col("text"))).alias("classified"), F.md5(T.semantic_text(F.col("source"), F.col("text"))).alias("encoded"))


@query(f"SELECT CASE WHEN status = 'detected' THEN code ELSE 'unknown' END AS language, count(*) AS records, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM documents), 6) AS share, count(*) FILTER (status = 'uncertain') AS uncertain, count(*) FILTER (status = 'failed') AS failed FROM ({_LANG}) GROUP BY 1")
def language_report(spark, d):
    return L.summary(L.detect(table(spark, d, "documents"), "text"))


_LEAK = "SELECT doc_id, quality, toxic, lang FROM documents LEFT JOIN labels USING (doc_id)"


@query(f"SELECT doc_id, CASE WHEN quality IS NULL THEN 'clean' ELSE 'warning' END AS status, CASE WHEN toxic IS NULL THEN '' ELSE 'toxic' END AS targets, coalesce(lang, '') AS lang_id, 'answer' AS unchecked FROM ({_LEAK})")
def leakage_checks(spark, d):
    """Quality stands for a forbidden field, toxic for the target, the language for a group identifier; no answer is there."""
    t = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    t = G.check(t, G.LeakageConfig(("quality", "answer"), ("toxic",), (), ("lang",)), index="doc_id")
    k = F.col("leakage")
    return t.select("doc_id", k["status"].alias("status"), F.array_join(k["targets"]["target_fields"], ",").alias("targets"), F.coalesce(F.try_variant_get(F.element_at(k["grouping"]["identifiers"], F.lit("lang")), "$", "string"), F.lit("")).alias("lang_id"), F.array_join(k["unchecked_fields"], ",").alias("unchecked"))


_KINDS = "SELECT doc_id, doc_id % 7 AS seven, CAST(doc_id % 7 AS VARCHAR) AS named, n_chars > 500 AS long, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang FROM documents"


@query(f"SELECT doc_id, '{{' || CASE WHEN lang IS NOT NULL THEN '\"lang\":\"' || lang || '\",' ELSE '' END || CASE WHEN long IS NOT NULL THEN '\"long\":' || long || ',' ELSE '' END || '\"named\":\"' || named || '\",\"seven\":' || seven || '}}' AS identifiers FROM ({_KINDS})")
def leakage_identifiers(spark, d):
    """Group identifiers keep their kinds: a number is not the text of its digits, and a truth value is neither."""
    seven, t = F.col("doc_id") % 7, table(spark, d, "documents")
    t = t.select("doc_id", seven.alias("seven"), seven.cast("string").alias("named"), (F.col("n_chars") > 500).alias("long"), F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    t = G.check(t, G.LeakageConfig((), (), (), ("seven", "named", "long", "lang")), index="doc_id")
    return t.select("doc_id", F.to_json("leakage.grouping.identifiers").alias("identifiers"))


@query("SELECT CASE WHEN first < doc_id THEN first END AS group_id, count(*) AS records FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first FROM documents) GROUP BY 1")
def duplicate_group_links(spark, d):
    """Exact duplicate links as the leakage check's group ids: the canonical row itself has none."""
    t = table(spark, d, "documents").select("doc_id", T.fingerprint(F.lit(None).cast("string"), F.col("text")).alias("fingerprint"))
    t = G.check(R.exact_duplicates(t, index="doc_id"), index="doc_id", exact="duplicate_of")
    return t.groupBy(F.col("leakage.grouping.exact_duplicate_group_id").alias("group_id")).agg(F.count(F.lit(1)).alias("records"))


@query(f"WITH g AS (SELECT md5(text) AS k, count(*) AS records, min(label) <> max(label) AS conflicting, min(doc_id) AS first, list_slice(list_sort(list(doc_id)), 1, 5) AS ids FROM ({_LABELLED}) WHERE label IS NOT NULL GROUP BY text HAVING count(*) > 1) SELECT first, records, conflicting, CASE WHEN row_number() OVER (ORDER BY first) <= 10 THEN array_to_string(ids, ',') END AS examples FROM g")
def duplicate_group_examples(spark, d):
    g = A.duplicate_groups(labelled(spark, d), "doc_id", "text", "label")
    return g.select("first", "records", "conflicting", F.array_join("examples", ",").alias("examples"))


_LISTS = f"SELECT doc_id, list_filter([label, CASE WHEN toxic = 1 THEN 'Toxic' END, lang], lambda x: x IS NOT NULL) AS labels FROM ({_LABELLED})"


@query(f"SELECT label, count(*) AS records, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM ({_LISTS}) WHERE len(labels) > 0), 6) AS share FROM (SELECT unnest(list_distinct(labels)) AS label FROM ({_LISTS})) GROUP BY label")
def multilabel_distribution(spark, d):
    t = labelled(spark, d).select("doc_id", F.array_compact(F.array("label", F.when(F.col("toxic") == 1, "Toxic"), "lang")).alias("labels"))
    return A.multilabel_distribution(t, "labels")


@query("SELECT doc_id, CASE WHEN len(labels) = 0 THEN 'missing' WHEN len(list_filter(labels, lambda x: trim(x) <> '')) = 0 THEN 'blank' WHEN len(list_filter(labels, lambda x: trim(x) = '')) > 0 THEN 'invalid' ELSE 'valid' END AS state FROM (SELECT doc_id, list_filter([lang, CASE WHEN quality = 0 THEN ' ' END, CASE WHEN toxic = 1 THEN 'Toxic' END], lambda x: x IS NOT NULL) AS labels FROM documents LEFT JOIN labels USING (doc_id))")
def label_list_states(spark, d):
    """Lists of the language, a blank for poor quality, and toxicity."""
    t = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    labels = F.array_compact(F.array("lang", F.when(F.col("quality") == 0, " "), F.when(F.col("toxic") == 1, "Toxic")))
    return t.select("doc_id", A.label_state(labels, many=True).alias("state"))


@query("SELECT doc_id, md5(CASE WHEN source IS NULL OR source = '' THEN '' ELSE source || chr(10) END || text) AS read_md5, length(text) AS n FROM documents")
def language_texts(spark, d):
    """What language detection reads; the source stands for the subject."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.language_text(F.col("source"), F.col("text"))).alias("read_md5"), F.length("text").cast("long").alias("n"))


def language_characters(spark, d):
    """Languages of documents by script and character trigrams."""
    return L.detect(table(spark, d, "documents"), "text", N.character_backend).select("doc_id", "status", "language_detected", "confidence")


query()(language_characters)


@query("SELECT doc_id, len(regexp_extract_all(text, '\\p{Latin}')) AS latin, len(regexp_extract_all(text, '\\p{Cyrillic}')) AS cyrillic, len(regexp_extract_all(text, '\\p{Han}')) AS han, len(regexp_extract_all(text, '[\\p{Hiragana}\\p{Katakana}]')) AS kana FROM documents")
def script_letters(spark, d):
    """Letters by script, which decide the languages that have one of their own."""
    n = N.script_counts(F.col("text"))
    return table(spark, d, "documents").select("doc_id", *[n[s].cast("long").alias(s.lower()) for s in ("Latin", "Cyrillic", "Han", "Kana")])


# --- splits --------------------------------------------------------------------------------------------------


@query("SELECT doc_id, CASE WHEN r <= floor(n * 0.7) THEN 'train' WHEN r <= floor(n * 0.7) + floor(n * 0.15) THEN 'validation' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256('42|' || doc_id), doc_id) AS r, CAST(count(*) OVER () AS DOUBLE) AS n FROM documents)")
def random_split(spark, d):
    return S.random_split(table(spark, d, "documents").select("doc_id"), "doc_id")


_VALID = f"SELECT doc_id, label FROM ({_SPLIT}) WHERE split = 'validation' AND label IS NOT NULL"


@query(f"SELECT doc_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY sha256('7|' || doc_id)) <= floor(count(*) OVER (PARTITION BY label) / 2.0) THEN 'calibration' ELSE 'threshold' END AS half FROM ({_VALID})")
def calibration_halves(spark, d):
    v = _labels_split(spark, d).where("split = 'validation' and label is not null").select("doc_id", "label")
    return S.halves(v, "label", "doc_id", 7)


def _labels_split(spark, d):
    return C.stratified_split(labelled(spark, d).select("doc_id", "label"), "label", "doc_id")


_BROKEN = f"SELECT doc_id, split FROM ({_SPLIT}) WHERE doc_id % 50 <> 3 UNION ALL SELECT doc_id, 'test' FROM ({_SPLIT}) WHERE doc_id % 40 = 1 AND doc_id % 50 <> 3 UNION ALL SELECT -1 - doc_id, 'train' FROM ({_SPLIT}) WHERE doc_id % 60 = 0"


@query(f"""SELECT CAST(count(given) AS BIGINT) AS records, CAST(sum(put) AS BIGINT) AS assigned, count(*) FILTER (given > 1) AS repeated, count(*) FILTER (put > 1) AS assigned_twice, count(*) FILTER (parts > 1) AS overlap, count(*) FILTER (given IS NOT NULL AND put IS NULL) AS missing, count(*) FILTER (given IS NULL) AS extra
 FROM (SELECT doc_id, count(*) AS given FROM ({_LABELLED}) GROUP BY 1) FULL JOIN (SELECT doc_id, count(*) AS put, count(DISTINCT split) AS parts FROM ({_BROKEN}) GROUP BY 1) USING (doc_id)""")
def broken_split_integrity(spark, d):
    """A split with records left out, assigned twice and invented, and what the check counts."""
    s = _labels_split(spark, d).select("doc_id", "split")
    kept = s.where("doc_id % 50 <> 3")
    broken = kept.unionByName(kept.where("doc_id % 40 = 1").withColumn("split", F.lit("test"))).unionByName(s.where("doc_id % 60 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit("train").alias("split")))
    return S.integrity(labelled(spark, d).select("doc_id"), broken, "doc_id")


_VALID_ALL = f"SELECT doc_id, label, split FROM ({_SPLIT}) WHERE label IS NOT NULL"
_SHARES = f"SELECT p.split, w.label, coalesce(c.n, 0) AS n, p.size, w.total AS here, (SELECT count(*) FROM ({_VALID_ALL})) AS total FROM (SELECT split, count(*) AS size FROM ({_VALID_ALL}) GROUP BY 1) p, (SELECT label, count(*) AS total FROM ({_VALID_ALL}) GROUP BY 1) w LEFT JOIN (SELECT split, label, count(*) AS n FROM ({_VALID_ALL}) GROUP BY ALL) c ON c.split = p.split AND c.label = w.label"


@query(f"SELECT split, label, round(CAST(n AS DOUBLE) / size, 6) AS share, round(CAST(here AS DOUBLE) / total, 6) AS overall, abs(CAST(n AS DOUBLE) / size - CAST(here AS DOUBLE) / total) <= 2.0E0 / size AND n > 0 AS \"within\" FROM ({_SHARES})")
def split_proportions(spark, d):
    return S.proportions(_labels_split(spark, d).where("label is not null"), "label").drop("deviation")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY sha256('5|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 25")
def seeded_sample(spark, d):
    return S.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", "doc_id", 25, 5)


@query(f"SELECT split, doc_id // 10000 AS chunk, len(list(doc_id)) AS n, md5(string_agg(doc_id, ',' ORDER BY doc_id)) AS ids FROM ({_SPLIT}) GROUP BY ALL")
def split_id_lists(spark, d):
    return S.id_lists(_labels_split(spark, d), "doc_id", "doc_id").select("split", "chunk", F.size("keys").cast("long").alias("n"), F.md5(F.array_join("keys", ",")).alias("ids"))


@query(f"SELECT a.split AS a, b.split AS b, count(*) AS shared FROM (SELECT DISTINCT text, split FROM ({_PARTS})) a JOIN (SELECT DISTINCT text, split FROM ({_PARTS})) b ON a.text = b.text AND a.split < b.split GROUP BY ALL")
def texts_in_several_parts(spark, d):
    """How many different texts two parts share: leakage that ids do not show."""
    p = parts(spark, d).select(F.sha2("text", 256).alias("t"), "split").distinct()
    q = p.select("t", F.col("split").alias("b"))
    return p.withColumnRenamed("split", "a").join(q, "t").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


# --- features ------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, count(*) AS terms, count(*) FILTER (term LIKE '% %') AS pairs, round(max(weight), 5) AS top_weight, round(sum(weight * weight), 6) AS length FROM ({_weighted(f'''SELECT doc_id, text FROM ({_PARTS}) WHERE split <> 'train' ''')}) GROUP BY doc_id")
def tfidf_transform(spark, d):
    """Validation and test records over the training vocabulary."""
    w = _weights(spark, d, "split <> 'train'")
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"), F.count_if(F.col("term").contains(" ")).alias("pairs"), F.round(F.max("weight"), 5).alias("top_weight"), F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("length"))


# --- evaluation ----------------------------------------------------------------------------------------------

_CLASSES = [*_NAMES, "Unseen"]
_FROZEN = f"""SELECT label, coalesce(support, 0) AS support, coalesce(hit, 0) AS hit, coalesce(called, 0) AS called FROM (SELECT unnest([{', '.join(map(quoted, _CLASSES))}]) AS label)
 LEFT JOIN (SELECT actual AS label, count(*) AS support, count(*) FILTER (actual = predicted) AS hit FROM ({_PRED}) GROUP BY 1) USING (label) LEFT JOIN (SELECT predicted AS label, count(*) AS called FROM ({_PRED}) GROUP BY 1) USING (label)"""
_FROZEN_PRF = f"SELECT label, support, hit, CASE WHEN called > 0 THEN CAST(hit AS DOUBLE) / called ELSE 0 END AS p, CASE WHEN support > 0 THEN CAST(hit AS DOUBLE) / support ELSE 0 END AS r, CASE WHEN support + called > 0 THEN 2.0E0 * hit / (support + called) ELSE 0 END AS f FROM ({_FROZEN})"


@query(f"SELECT label, support, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM ({_FROZEN_PRF})")
def frozen_class_scores(spark, d):
    """Scores over a fixed order of classes, one of which never occurs."""
    s = E.frozen_scores(predictions(spark, d), _CLASSES)
    return s.select("label", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(f"SELECT CAST(sum(support) AS BIGINT) AS records, round(CAST(sum(hit) AS DOUBLE) / sum(support), 6) AS accuracy, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1, round(sum(f * support) / sum(support), 6) AS weighted_f1 FROM ({_FROZEN_PRF})")
def frozen_summary(spark, d):
    return E.summary_scores(E.frozen_scores(predictions(spark, d), _CLASSES))


@query(f"SELECT a.label AS actual, b.label AS predicted, (SELECT count(*) FROM ({_PRED}) q WHERE q.actual = a.label AND q.predicted = b.label) AS records FROM ({_FROZEN}) a, ({_FROZEN}) b")
def frozen_confusion(spark, d):
    return E.confusion_scaffold(predictions(spark, d), _CLASSES)


@query(f"SELECT doc_id, label AS actual, predicted FROM ({_LABELLED}) JOIN (SELECT doc_id, predicted FROM ({_PRED})) USING (doc_id) WHERE label IS NOT NULL")
def aligned_predictions(spark, d):
    rows = labelled(spark, d).where("label is not null").select("doc_id", "label")
    return E.align(rows, predictions(spark, d).where("actual is not null"), "doc_id")


_WRONG = f"SELECT doc_id, actual, predicted, md5(text) AS text_md5 FROM ({_PRED}) JOIN documents USING (doc_id) WHERE actual <> predicted"


@query(_WRONG)
def prediction_errors(spark, d):
    e = E.errors(predictions(spark, d), table(spark, d, "documents"), "doc_id")
    return e.select("doc_id", "actual", "predicted", F.md5("text").alias("text_md5"))


@query(f"SELECT kind, count(*) AS records FROM (SELECT CASE WHEN actual = 'Request' THEN 'false_negative' END AS kind FROM ({_WRONG}) UNION ALL SELECT CASE WHEN predicted = 'Request' THEN 'false_positive' END FROM ({_WRONG})) WHERE kind IS NOT NULL GROUP BY 1")
def class_error_counts(spark, d):
    e = E.errors(predictions(spark, d), table(spark, d, "documents"), "doc_id")
    kinds = [E.class_errors(e, "Request", k).agg(F.count(F.lit(1)).alias("records")).select(F.lit(k).alias("kind"), "records") for k in ("false_negative", "false_positive")]
    return kinds[0].unionByName(kinds[1]).where("records > 0")


@query(f"SELECT doc_id, predicted FROM ({_PRED}) WHERE doc_id IN (SELECT doc_id FROM ({_VALID}))")
def validation_subset(spark, d):
    ids = _labels_split(spark, d).where("split = 'validation' and label is not null")
    return E.subset(predictions(spark, d), ids, "doc_id").select("doc_id", "predicted")


@query(f"SELECT label, records, (SELECT count(*) FROM ({_WRONG}) WHERE actual = label) AS false_negatives, (SELECT count(*) FROM ({_WRONG}) WHERE predicted = label) AS false_positives FROM ({_DIST}) WHERE records = (SELECT min(records) FROM ({_DIST}))")
def minority_errors(spark, d):
    return E.minority(C.class_distribution(labelled(spark, d), "label"), predictions(spark, d))


@query(f"SELECT label, records, round(CAST(records AS DOUBLE) / sum(records) OVER (), 6) AS share, CASE WHEN row_number() OVER (ORDER BY records DESC, label) = 1 THEN 'majority' WHEN row_number() OVER (ORDER BY records, label) = 1 THEN 'minority' ELSE '' END AS role, r < (SELECT avg(r) FROM ({_FROZEN_PRF}) WHERE label <> 'Unseen') AS below_macro_recall FROM ({_DIST}) JOIN ({_FROZEN_PRF}) USING (label)")
def imbalance_analysis(spark, d):
    return E.imbalance_analysis(E.frozen_scores(predictions(spark, d), _NAMES), C.class_distribution(labelled(spark, d), "label").select("label", "records"))


_EACH = f"SELECT unnest(['all', actual]) AS label, actual, predicted, confidence FROM ({_PRED}) WHERE actual IS NOT NULL"


@query(f"SELECT label, count(*) AS records, round(avg(confidence), 6) AS mean, round(avg(confidence) FILTER (actual = predicted), 6) AS mean_right, round(avg(confidence) FILTER (actual <> predicted), 6) AS mean_wrong, count(*) FILTER (actual <> predicted AND confidence >= 0.9) AS sure_errors, count(*) FILTER (actual <> predicted AND actual IN ('Request', 'Problem') AND predicted IN ('Request', 'Problem')) AS mixed_up FROM ({_EACH}) GROUP BY label")
def confidence_summary(spark, d):
    return E.confidence_summary(predictions(spark, d).where("actual is not null"), ("Request", "Problem"))


@query(f"SELECT threshold, label, count(*) AS records, count(*) FILTER (confidence >= threshold) AS accepted, round(CAST(count(*) FILTER (confidence >= threshold) AS DOUBLE) / count(*), 6) AS coverage, count(*) FILTER (confidence >= threshold AND actual <> predicted) AS accepted_errors FROM ({_EACH}), (SELECT unnest([0.0E0, 0.5E0, 0.8E0]) AS threshold) GROUP BY ALL")
def threshold_by_class(spark, d):
    return E.threshold_by_class(predictions(spark, d).where("actual is not null"), [0.5, 0.8])


@query(f"SELECT label, round((SELECT count(*) FROM ({_VALID_ALL}) WHERE split = 'train') / (4.0E0 * count(*)), 9) AS weight FROM ({_VALID_ALL}) WHERE split = 'train' GROUP BY label")
def training_weights(spark, d):
    """Balanced weights over the fixed order of classes, from training records alone."""
    counts = {r.label: r["count"] for r in _labels_split(spark, d).where("split = 'train' and label is not null").groupBy("label").count().collect()}
    return spark.createDataFrame([(k, round(float(v), 9)) for k, v in E.balanced_weights(counts, _NAMES).items()], "label string, weight double")


# --- tokens --------------------------------------------------------------------------------------------------

_TOK = "SELECT doc_id, len(regexp_extract_all(text, '[^ \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\u0085 ]+')) + 2 AS n FROM documents JOIN labels USING (doc_id)"


def _tokens(spark, d):
    return K.tokenize(labelled(spark, d).where("label is not null"), K.LabelMapping(_NAMES), max_length=128, key="doc_id")


@query(f"SELECT doc_id, CAST(n AS INTEGER) AS n_tokens, CAST(least(n, 128) AS INTEGER) AS kept, CASE label {' '.join(f'WHEN {quoted(c)} THEN {i}' for i, c in enumerate(_NAMES))} END AS label FROM ({_TOK}) JOIN (SELECT doc_id, label FROM ({_LABELLED})) USING (doc_id) WHERE label IS NOT NULL")
def tokenized_records(spark, d):
    return _tokens(spark, d).select("doc_id", "n_tokens", F.size("input_ids").alias("kept"), "label")


@query(f"SELECT count(*) AS records, CAST(min(n) AS INTEGER) AS least, round(avg(n), 6) AS mean, {', '.join(f'quantile_cont(n, {p}) AS p{int(100 * p)}' for p in (0.5, 0.75, 0.9, 0.95, 0.99))}, CAST(max(n) AS INTEGER) AS most FROM ({_TOK}) JOIN (SELECT doc_id, label FROM ({_LABELLED})) USING (doc_id) WHERE label IS NOT NULL")
def token_length_analysis(spark, d):
    return K.length_analysis(_tokens(spark, d))


#: Letters and digits, as begins and as continuations, and some common parts of words.
_PIECES = [*"abcdefghijklmnopqrstuvwxyz0123456789.,:;!?-", *(f"##{x}" for x in "abcdefghijklmnopqrstuvwxyz0123456789"), *"the and con pre com in re un der die das que los les".split(), *(f"##{x}" for x in "ing ed er tion en es ent al os ment ly st ch in on".split())]
_START, _END, _UNKNOWN = 1, 2, 0
_VOCAB = ", ".join(f"({quoted(p.removeprefix('##'))}, {str(p.startswith('##')).lower()}, {i + 3})" for i, p in enumerate(_PIECES))
_SUBWORDS = rf"""WITH RECURSIVE vocab(piece, continues, id) AS (VALUES {_VOCAB}),
 docs AS (SELECT doc_id, label, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+|[^\p{{Z}}\p{{C}}\p{{L}}\p{{N}}]') AS ws FROM ({_LABELLED}) WHERE label IS NOT NULL),
 occ AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM docs),
 walk(word, place, ids) AS (SELECT DISTINCT word, CAST(1 AS BIGINT), CAST([] AS INTEGER[]) FROM occ WHERE length(word) <= 100
  UNION ALL SELECT word, place + len, list_append(ids, id) FROM (SELECT w.word, w.place, w.ids, v.id, length(v.piece) AS len, row_number() OVER (PARTITION BY w.word ORDER BY length(v.piece) DESC) AS r FROM walk w JOIN vocab v ON substr(w.word, w.place, length(v.piece)) = v.piece AND v.continues = (w.place > 1)) WHERE r = 1),
 cuts AS (SELECT word, ids FROM walk WHERE place = length(word) + 1),
 texts AS (SELECT doc_id, flatten(list(coalesce(ids, [{_UNKNOWN}]) ORDER BY pos)) AS ids FROM occ LEFT JOIN cuts USING (word) GROUP BY doc_id)
 SELECT doc_id, label, CAST(coalesce(len(ids), 0) + 2 AS INTEGER) AS n_tokens, array_to_string(list_concat(list_concat([{_START}], coalesce(ids, [])[1:126]), [{_END}]), ',') AS ids FROM docs LEFT JOIN texts USING (doc_id)"""


@query(f"SELECT doc_id, CASE label {' '.join(f'WHEN {quoted(c)} THEN {i}' for i, c in enumerate(_NAMES))} END AS label, n_tokens, ids FROM ({_SUBWORDS})")
def subword_records(spark, d):
    """Records as subword ids of a small vocabulary, by greedy longest match."""
    pieces = W.from_pieces(spark, {p: i + 3 for i, p in enumerate(_PIECES)})
    t = W.tokenize(labelled(spark, d).where("label is not null"), K.LabelMapping(_NAMES), pieces, _UNKNOWN, _START, _END, 128, "doc_id")
    return t.select("doc_id", "label", "n_tokens", F.array_join("input_ids", ",").alias("ids"))
