"""From record text to cleaned tables: the extraction plans of the four record kinds and the toddler merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.configs import notes
from caseloom.functions.scalar import total
from caseloom.operators.clean import MedianImputer, age_bracket, align_union, drop_sentinels, map_value, months_to_years
from caseloom.operators.text import cast_result, extract, extract_routed
from caseloom.session import cut_lineage

ITEMS = [f"a{i}" for i in range(1, 11)]


def autism_notes(records: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    return extract(records, notes.AUTISM, text, keep, notes.AUTISM_TYPES)


def toddler_posts(records: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    found = extract(records, notes.TODDLER, text, keep, normalise=notes.toddler_text)
    score = total([F.col(i) for i in ITEMS])
    scored = found.withColumn("score", score).withColumn("label", F.when(F.col("score") > notes.QCHAT_CUT, "Yes").otherwise("No"))
    return cast_result(scored, {c: "tinyint" for c in [*ITEMS, "age_months", "score"]})


def diabetes_records(records: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    return extract_routed(records, notes.DIABETES_PROSE, notes.DIABETES_DEVICE, notes.DIABETES_COLUMNS, text, keep, notes.DIABETES_TYPES)


def stroke_notes(records: DataFrame, text: str = "text", keep: Sequence[str] = (), impute: bool = True) -> DataFrame:
    """Extracted rows without unreadable gender; missing BMI is imputed by age bracket.

    The imputation reads its input more than once, so the extracted rows, which are small beside their text, are
    checkpointed first and the text is read once.
    """
    found = drop_sentinels(extract(records, notes.STROKE, text, keep, notes.STROKE_TYPES), "gender", [-1])
    if not impute:
        return found
    aged = cut_lineage(found).withColumn("_bracket", age_bracket("age"))
    return MedianImputer("bmi", "_bracket").fit(aged).transform(aged).drop("_bracket")


def merge_toddlers(autism: DataFrame, toddlers: DataFrame) -> DataFrame:
    """Toddler rows in the shape of the autism table: months become years, words become codes, and append."""
    yes_no = {"yes": 1, "no": 0}
    return align_union(autism, toddlers, {
        "age": months_to_years(F.col("age_months")), "sex": map_value(F.col("sex"), {"m": 1, "f": 0}),
        "jaundice": map_value(F.col("jaundice"), yes_no), "family_asd": map_value(F.col("family_asd"), yes_no),
        "label": map_value(F.col("label"), yes_no), "aq_score": F.col("score")})
