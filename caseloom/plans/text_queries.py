"""Text, JSON and syslog extraction queries, file sources and sinks, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.configs import notes
from caseloom.operators import clean, text
from caseloom.plans import intake
from caseloom.plans import fixtures as fx
from caseloom.plans import rendered
from caseloom.plans.catalog import Catalog
from caseloom.plans.rendered import ITEMS, SYMPTOMS, attributes_sql
from caseloom.sources.files import spread

catalog = Catalog()
query = catalog.query

TINY = "TINYINT"


def _score(items: list[str]) -> str:
    return " + ".join(items)


# --- whole-text operators on the given tables ---

@query("txt2_split", r"""SELECT doc_id, CAST(i AS INT) AS record_no, md5(t) AS fingerprint FROM (SELECT doc_id, UNNEST(range(1, LEN(p) + 1)) AS i,
 regexp_replace(UNNEST(p), '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g') AS t FROM (SELECT doc_id, string_split_regex(text, '\.[ \t\r]*\n') AS p FROM documents)) WHERE t <> ''""")
def txt2(spark, sf):
    cut = text.split_records(spread(fx.table(spark, sf, "documents")), "text", r"\.[ \t\r]*\n", ["doc_id"])
    return cut.select("doc_id", "record_no", F.md5("text").alias("fingerprint"))


@query("txt2b_record_markers", f"""SELECT c_custkey, CAST(i AS INT) AS record_no, CASE i WHEN 1 THEN c_name WHEN 2 THEN c_mktsegment ELSE 'tail ' || c_custkey END AS text
 FROM customer, (SELECT UNNEST([1, 2, 4]) AS i)""")
def txt2b(spark, sf):
    blob = F.concat("c_name", F.lit("\n\n--- END OF RECORD #00001 ---\n"), F.col("c_mktsegment"), F.lit("\n---END OF RECORD  #2---\n \n--- END OF RECORD #3 ---\ntail "), F.col("c_custkey").cast("string"))
    blobs = fx.table(spark, sf, "customer").select("c_custkey", blob.alias("blob"))
    return text.split_records(blobs, "blob", notes.RECORD_END, ["c_custkey"])


@query("txt1_number", r"""SELECT doc_id, TRY_CAST(COALESCE(NULLIF(regexp_extract(LOWER(text), '(\d+)[ -]+(\d{3})|([1-9]\d{2,6})', 1), ''),
 NULLIF(regexp_extract(LOWER(text), '(\d+)[ -]+(\d{3})|([1-9]\d{2,6})', 3), '')) AS BIGINT) AS number FROM documents""")
def txt1(spark, sf):
    rule = text.Number("number", r"(\d+)[ -]+(\d{3})|([1-9]\d{2,6})", (1, 3), "bigint")
    return text.extract(spread(fx.table(spark, sf, "documents")), [rule], keep=["doc_id"])


@query("txt3_polarity", """SELECT conv_id, turn, CASE WHEN regexp_matches(LOWER(text), 'nicht|kein|pas de') THEN 0 WHEN regexp_matches(LOWER(text), ' the | und |avec') THEN 1
 WHEN contains(LOWER(text), 'ou') AND NOT contains(LOWER(text), 'ne ') AND NOT contains(LOWER(text), 'no ') THEN 1 ELSE 0 END AS polarity FROM conversations""")
def txt3(spark, sf):
    rule = text.Polarity("polarity", "nicht|kein|pas de", " the | und |avec", "ou", ("ne ", "no "))
    return text.extract(fx.table(spark, sf, "conversations"), [rule], keep=["conv_id", "turn"])


@query("txt4_class", """SELECT doc_id, CASE WHEN regexp_matches(LOWER(text), 'license|licence') THEN 'licensed' WHEN regexp_matches(LOWER(text), 'http|www') THEN 'linked' ELSE 'plain' END AS kind FROM documents""")
def txt4(spark, sf):
    rule = text.Choice("kind", (("license|licence", "licensed"), ("http|www", "linked")), "plain")
    return text.extract(spread(fx.table(spark, sf, "documents")), [rule], keep=["doc_id"])


_DICTIONARY = {"english": (["the ", " and "], [" nicht "]), "german": ([" und ", "sch"], [" the "]), "french": (["eau", "ç"], [" the "])}


@query("txt6_phrases", "SELECT doc_id, " + ", ".join("CASE WHEN " + " OR ".join(f"contains(LOWER(text), '{p}')" for p in yes) + f" THEN 1 ELSE 0 END AS {n}" for n, (yes, _) in _DICTIONARY.items()) + " FROM documents")
def txt6(spark, sf):
    return text.extract(spread(fx.table(spark, sf, "documents")), [text.Phrases(_DICTIONARY)], keep=["doc_id"])


@query("txt9_json", """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, CASE WHEN CAST(json_extract(props, '$.k') AS INT) IN (7, 29, 69) THEN 1 ELSE 0 END AS listed FROM events""")
def txt9(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    return events.select("event_id", "p.k", F.when(F.array_contains(F.array(F.lit(7), F.lit(29), F.lit(69)), F.col("p.k")), 1).otherwise(0).alias("listed"))


@query("txt12_sections", r"""SELECT page_id, md5(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS title, LENGTH(regexp_extract(html, '(?s)<article>(.*?)(?:</article>|</body>)', 1)) AS n FROM pages""")
def txt12(spark, sf):
    title, body = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1), F.regexp_extract("html", r"(?s)<article>(.*?)(?:</article>|</body>)", 1)
    return fx.table(spark, sf, "pages").select("page_id", F.md5(title).alias("title"), F.length(body).cast("bigint").alias("n"))


# --- records rendered from customers: the extraction must give back the attributes ---

@query("txt5_autism_notes", attributes_sql({**rendered.AUTISM, "aq_score": _score([f"({rendered.AUTISM[a]})" for a in ITEMS])},
                                           {c: TINY for c in ["sex", "jaundice", "family_asd", "label", "aq_score", *ITEMS]} | {"age": "SMALLINT"}))
def txt5(spark, sf):
    return intake.autism_notes(rendered.autism(spark, sf), keep=[rendered.K])


_TOD_SCORE = _score([f"({rendered.TODDLER[a]})" for a in ITEMS])


@query("txt7_toddler_posts", attributes_sql({**rendered.TODDLER, "score": _TOD_SCORE, "label": f"CASE WHEN {_TOD_SCORE} > 3 THEN 'Yes' ELSE 'No' END"},
                                            {c: TINY for c in [*ITEMS, "score", "age_months"]}))
def txt7(spark, sf):
    return intake.toddler_posts(rendered.toddler(spark, sf), keep=[rendered.K])


@query("txt13_diabetes_records", attributes_sql(rendered.DIABETES, {c: TINY for c in ["sex", "label", *SYMPTOMS]} | {"age": "SMALLINT"}))
def txt13(spark, sf):
    return intake.diabetes_records(rendered.diabetes(spark, sf), keep=[rendered.K])


@query("txt10_device_logs", attributes_sql(rendered.DIABETES, {c: TINY for c in ["sex", "label", *SYMPTOMS]} | {"age": "SMALLINT"}) + " WHERE c_custkey % 6 IN (4, 5)")
def txt10(spark, sf):
    return intake.diabetes_records(rendered.diabetes(spark, sf).where("c_custkey % 6 in (4, 5)"), keep=[rendered.K])


@query("txt15_stroke_notes", attributes_sql(rendered.STROKE, {c: TINY for c in ["gender", "hypertension", "heart_disease", "ever_married", "residence_type", "label"]}))
def txt15(spark, sf):
    return intake.stroke_notes(rendered.stroke(spark, sf), keep=[rendered.K], impute=False)


_AGE_BIN = "CASE WHEN age <= 18 THEN 1 WHEN age <= 40 THEN 2 WHEN age <= 60 THEN 3 WHEN age <= 80 THEN 4 ELSE 5 END"


@query("txt16_stroke_imputed", f"""WITH s AS ({attributes_sql(rendered.STROKE)}), m AS (SELECT {_AGE_BIN} AS b, median(bmi) AS m FROM s GROUP BY 1)
 SELECT c_custkey, ROUND(COALESCE(bmi, m), 6) AS bmi, work_type, smoking_status FROM s JOIN m ON b = {_AGE_BIN}""")
def txt16(spark, sf):
    return intake.stroke_notes(rendered.stroke(spark, sf), keep=[rendered.K]).select(rendered.K, F.round("bmi", 6).alias("bmi"), "work_type", "smoking_status")


@query("cln10b_merge_toddlers", f"""SELECT age, sex, label, COUNT(*) AS n, CAST(SUM(aq_score) AS BIGINT) AS score FROM (
 SELECT CAST(age AS SMALLINT) AS age, CAST(sex AS TINYINT) AS sex, CAST(label AS TINYINT) AS label, {_score(ITEMS)} AS aq_score FROM ({attributes_sql(rendered.AUTISM)})
 UNION ALL SELECT CAST(round_even(age_months/12.0, 0) AS SMALLINT), CAST(CASE sex WHEN 'm' THEN 1 ELSE 0 END AS TINYINT), CAST(CASE WHEN {_score(ITEMS)} > 3 THEN 1 ELSE 0 END AS TINYINT), {_score(ITEMS)}
 FROM ({attributes_sql(rendered.TODDLER)})) GROUP BY age, sex, label""")
def cln10b(spark, sf):
    merged = intake.merge_toddlers(intake.autism_notes(rendered.autism(spark, sf)), intake.toddler_posts(rendered.toddler(spark, sf)))
    return merged.groupBy("age", "sex", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("aq_score").alias("score"))


@query("txt18_coverage", """SELECT 'stroke' AS source, (SELECT COUNT(*) FROM customer) AS records_in, (SELECT COUNT(*) FROM customer) AS rows_out, c AS column_name,
 CASE WHEN c = 'bmi' THEN (SELECT COUNT(*) FROM customer WHERE c_custkey % 13 = 0) ELSE 0 END AS missing FROM (SELECT UNNEST(['gender', 'age', 'hypertension', 'heart_disease',
 'ever_married', 'work_type', 'residence_type', 'avg_glucose_level', 'bmi', 'smoking_status', 'label']) AS c)""")
def txt18(spark, sf):
    records = rendered.stroke(spark, sf)
    return text.extraction_coverage({"stroke": (records, intake.stroke_notes(records, impute=False))})


@query("txt17_typed_projection", attributes_sql({c: rendered.DIABETES[c] for c in ("age", "sex", "label")}, {"age": "SMALLINT", "sex": TINY, "label": TINY}))
def txt17(spark, sf):
    found = intake.diabetes_records(rendered.diabetes(spark, sf), keep=[rendered.K])
    return text.cast_result(found.select(rendered.K, "age", "sex", "label"), notes.DIABETES_TYPES)


@query("cln7_narrow", "SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS TINYINT) AS line8, CAST(l_quantity AS SMALLINT) AS qty16 FROM lineitem")
def cln7(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("line8"), F.col("l_quantity").alias("qty16"))
    return clean.cast_columns(lines, {"line8": "tinyint", "qty16": "smallint"})
