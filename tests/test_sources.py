from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from caseloom.plans import intake
from caseloom.operators.star import Cohort, Star, build_star, create_views, full_view
from caseloom.sources import files
from caseloom.streaming.records import stream_extract, stream_records


def notes_file(tmp_path, name="notes.txt"):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    parts = [f"Record #{i:05d}\nPt: {20 + i}yo M\nAQ-10: A1(+) A2(-)\nDx: ASD screen POS\n\n--- END OF RECORD #{i:05d} ---\n" for i in range(1, 6)]
    (folder / name).write_text("\n".join(parts) + "\n \n", encoding="utf-8")
    return str(folder)


def test_record_files(spark, tmp_path):
    rows = files.read_records(spark, notes_file(tmp_path)).orderBy("record_no").collect()
    assert [r["record_no"] for r in rows] == [1, 2, 3, 4, 5] and all(r["whole"] for r in rows)
    assert rows[0]["text"].startswith("Record #00001") and rows[4]["text"].endswith("POS")


def test_stray_marker_text_is_flagged(spark, tmp_path):
    folder = tmp_path / "stray"
    folder.mkdir()
    (folder / "n.txt").write_text("see END OF RECORD # in the manual\n--- END OF RECORD #1 ---\n", encoding="utf-8")
    assert [r["whole"] for r in files.read_records(spark, str(folder)).collect()].count(False) == 1


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("id,bmi,sex\n1, N/A ,Male\n2,27.5,?\n3,oops,\n")
    rows = files.read_raw_csv(spark, str(path), ["id", "bmi", "sex"], {"id": "int", "bmi": "double"}).collect()
    assert [tuple(r) for r in rows] == [(1, None, "Male"), (2, 27.5, None), (3, None, None)]


def cohort(spark, source, n):
    df = spark.range(n).select("id", (F.col("id") * 3.0).alias("age"), (F.col("id") % 2).cast("int").alias("sex"), F.lit(1).alias("y"))
    return Cohort(source, df, "id", {"age": F.col("age"), "gender": F.col("sex")}, {"label": F.col("y")})


def test_star_is_keyed_by_cohort_and_reloads(spark, tmp_path):
    star = build_star([cohort(spark, "autism", 5), cohort(spark, "stroke", 3)], cells=2)
    files.load_star(star, str(tmp_path / "star"))
    files.load_star(star, str(tmp_path / "star"))
    back = files.read_star(spark, str(tmp_path / "star"), list(star.facts))
    assert [r["patient_id"] for r in back.dim.orderBy("patient_id").collect()] == list(range(1, 9))
    assert {r["patient_id"] for r in back.facts["fact_stroke"].collect()} == {6, 7, 8}
    view = full_view(back.facts["fact_stroke"], back.dim, "patient_id", {"gender": ({1: "Male"}, "Female")}, {"label": "stroke_diagnosis"})
    create_views({"vw_stroke_full": view})
    assert spark.sql("SELECT gender, COUNT(*) AS n FROM vw_stroke_full GROUP BY gender ORDER BY gender").collect()[0]["n"] == 2


def test_a_load_that_fails_leaves_the_earlier_star(spark, tmp_path):
    path = str(tmp_path / "star")
    with pytest.raises(FileNotFoundError):
        files.read_star(spark, path, ["fact_stroke"])
    old = build_star([cohort(spark, "autism", 5), cohort(spark, "stroke", 3)], cells=2)
    files.load_star(old, path)
    broken = build_star([cohort(spark, "autism", 9), cohort(spark, "stroke", 4)], cells=2)
    bad = broken.facts["fact_stroke"].withColumn("label", F.raise_error(F.lit("lost on the way")).cast("int"))
    with pytest.raises(Exception, match="lost on the way"):
        files.load_star(Star(broken.dim, {**broken.facts, "fact_stroke": bad}, broken.key), path)
    back = files.read_star(spark, path, list(old.facts))
    assert back.dim.count() == 8 and back.facts["fact_autism"].count() == 5 and back.facts["fact_stroke"].count() == 3
    (tmp_path / "star" / "manifests" / "0000000007.json").write_text('{"number": 7, "fol')  # a manifest that is not written to its end
    assert files.read_star(spark, path, list(old.facts)).dim.count() == 8
    for n in (6, 7, 8):
        files.load_star(build_star([cohort(spark, "autism", n)], cells=2), path)
    assert files.read_star(spark, path, ["fact_autism"]).dim.count() == 8
    assert len([m for m in files._manifests(spark, path)]) == 2


def test_repeated_order_values_are_an_error(spark):
    twice = cohort(spark, "autism", 5)
    twice.frame = twice.frame.union(twice.frame.where("id = 3"))
    with pytest.raises(Exception, match="more than once"):
        build_star([twice])


def test_bucketed_star_joins_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    star = build_star([cohort(spark, "autism", 200)])
    files.load_star_bucketed(star, "gold", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("gold.fact_autism").join(spark.table("gold.dim_patient"), "patient_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert Star(spark.table("gold.dim_patient"), {"fact_autism": spark.table("gold.fact_autism")}).labels().count() == 200


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    folder = notes_file(tmp_path)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream_extract(stream_records(spark, folder), intake.autism_notes, out, state).awaitTermination()
    batch = intake.autism_notes(files.read_records(spark, folder))
    assert sorted(map(tuple, spark.read.parquet(out).drop("source").collect())) == sorted(map(tuple, batch.collect()))
