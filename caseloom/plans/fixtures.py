"""A patient star and an observation table derived from the driver's tables, in Spark and as SQL text.

Each function reads whole tables. The SQL forms are common table expressions with the same columns, used by the
oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.star import Star
from caseloom.session import cut_lineage

AQ_ITEMS = [f"a{i}" for i in range(1, 11)]
SYMPTOMS = ["polyuria", "polydipsia", "sudden_weight_loss", "weakness", "polyphagia", "genital_thrush", "visual_blurring",
            "itching", "irritability", "delayed_healing", "partial_paresis", "muscle_stiffness", "alopecia", "obesity"]
WORK_TYPES = ["Private", "Self-employed", "Govt_job", "children", "Never_worked"]
SMOKING = ["formerly smoked", "never smoked", "smokes", "Unknown"]
OBS_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "cents"]
OBS_FLAGS = ["f1", "f2", "f3", "f4"]
OBS_MEASURES = ["m1", "m2"]

# 0/1 expressions over one customer's orders, valid in Spark SQL and in DuckDB
_AQ = ["has_urgent", "has_p", "low2", "has_f", "low3", "odd", "third", "high2", "medium2", "unspecified2"]
_SY = ["has_urgent", "has_p", "high2", "medium2", "unspecified2", "low3", "has_f", "odd", "third", "high3", "medium3",
       "unspecified3", "fifth", "low2"]


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


_PER_CUSTOMER = {
    "n_orders": "COUNT(*)",
    "avg_price": "AVG(o_totalprice)",
    "has_urgent": f"MAX({_flag('o_orderpriority=' + repr('1-URGENT'))})",
    "has_p": f"MAX({_flag('o_orderstatus=' + repr('P'))})",
    "has_f": f"MAX({_flag('o_orderstatus=' + repr('F'))})",
    "low2": _flag(f"SUM({_flag('o_orderpriority=' + repr('5-LOW'))}) >= 2"),
    "low3": _flag(f"SUM({_flag('o_orderpriority=' + repr('5-LOW'))}) >= 3"),
    "high2": _flag(f"SUM({_flag('o_orderpriority=' + repr('2-HIGH'))}) >= 2"),
    "high3": _flag(f"SUM({_flag('o_orderpriority=' + repr('2-HIGH'))}) >= 3"),
    "medium2": _flag(f"SUM({_flag('o_orderpriority=' + repr('3-MEDIUM'))}) >= 2"),
    "medium3": _flag(f"SUM({_flag('o_orderpriority=' + repr('3-MEDIUM'))}) >= 3"),
    "unspecified2": _flag(f"SUM({_flag('o_orderpriority=' + repr('4-NOT SPECIFIED'))}) >= 2"),
    "unspecified3": _flag(f"SUM({_flag('o_orderpriority=' + repr('4-NOT SPECIFIED'))}) >= 3"),
    "top_priority": "MIN(o_orderpriority)",
    "odd": "CAST(COUNT(*) % 2 AS INT)",
    "third": _flag("COUNT(*) % 3 = 0"),
    "fourth": _flag("COUNT(*) % 4 = 0"),
    "fifth": _flag("COUNT(*) % 5 = 0"),
}

_DIM = {
    "patient_id": "c_custkey",
    "age": "CAST(FLOOR(ABS(c_acctbal)/100.0) AS DOUBLE)",
    "gender": "CAST(c_nationkey % 2 AS INT)",
    "source_dataset": "CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 'autism' "
                      "WHEN c_mktsegment='FURNITURE' THEN 'diabetes' ELSE 'stroke' END",
}

_WORK = ("CASE WHEN n_orders % 11 = 0 THEN 'Retired' WHEN n_orders % 5 = 0 THEN 'Private' WHEN n_orders % 5 = 1 THEN 'Self-employed' "
         "WHEN n_orders % 5 = 2 THEN 'Govt_job' WHEN n_orders % 5 = 3 THEN 'children' ELSE 'Never_worked' END")
_SMOKE = ("CASE WHEN top_priority='1-URGENT' THEN 'never smoked' WHEN top_priority='2-HIGH' THEN 'formerly smoked' "
          "WHEN top_priority='3-MEDIUM' THEN 'smokes' WHEN top_priority='4-NOT SPECIFIED' THEN 'Unknown' ELSE top_priority END")

_FACTS = {
    "autism": {**dict(zip(AQ_ITEMS, _AQ)), "aq_score": " + ".join(_AQ), "jaundice": "fourth", "family_asd": "fifth",
               "label": _flag("n_orders>10")},
    "diabetes": {**dict(zip(SYMPTOMS, _SY)), "label": _flag("n_orders>10")},
    "stroke": {"hypertension": "has_urgent", "heart_disease": "has_p", "ever_married": "odd", "work_type": _WORK,
               "residence_type": "third", "avg_glucose_level": "avg_price/1000.0",
               "bmi": "CASE WHEN n_orders % 7 = 0 THEN NULL ELSE avg_price/5000.0 END", "smoking_status": _SMOKE,
               "label": _flag("n_orders>14")},
}

_OBS = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey",
    "cents": "CAST(ROUND(l_extendedprice*100) AS BIGINT)",
    "label": _flag("l_returnflag='R'"), "f1": _flag("l_discount>=0.05"), "f2": _flag("l_tax>=0.04"),
    "f3": _flag("l_quantity>25"), "f4": _flag("l_linestatus='F'"), "m1": "l_quantity", "m2": "l_extendedprice",
}

_PRED = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "label": _flag("l_returnflag='R'"),
    "probability": "CAST((CAST(l_quantity AS BIGINT)*37 + l_linenumber*11) % 101 AS DOUBLE) / 101.0",
    "prediction": _flag("(CAST(l_quantity AS BIGINT)*37 + l_linenumber*11) % 101 >= 51"),
    "model": "CASE WHEN l_linenumber % 3 = 0 THEN 'forest' WHEN l_linenumber % 3 = 1 THEN 'logistic' ELSE 'tree' END",
    "dataset": "CASE WHEN l_suppkey % 3 = 0 THEN 'autism' WHEN l_suppkey % 3 = 1 THEN 'diabetes' ELSE 'stroke' END",
    "fold": "CAST(l_orderkey % 5 AS INT)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exprs(spec: dict[str, str]):
    return [F.expr(e).alias(n) for n, e in spec.items()]


def per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(*_exprs(_PER_CUSTOMER))


def dim_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(*_exprs(_DIM))


def fact(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    members = dim_patient(spark, sf_dir).where(F.col("source_dataset") == source).select("patient_id")
    joined = per_customer(spark, sf_dir).join(members, F.col("o_custkey") == F.col("patient_id"))
    return joined.select("patient_id", *_exprs(_FACTS[source]))


def star(spark: SparkSession, sf_dir: str) -> Star:
    """All cohorts at once: orders are aggregated and joined once, the result is written and split by cohort."""
    dim = dim_patient(spark, sf_dir)
    members = dim.select("patient_id", "source_dataset")
    keyed = cut_lineage(per_customer(spark, sf_dir).join(members, F.col("o_custkey") == F.col("patient_id")))
    return Star(dim, {f"fact_{s}": keyed.where(F.col("source_dataset") == s).select("patient_id", *_exprs(_FACTS[s])) for s in _FACTS})


def obs(spark: SparkSession, sf_dir: str, category: bool = False) -> DataFrame:
    """Line items as observations. The part brand is joined in only where it is used."""
    lines = table(spark, sf_dir, "lineitem")
    if not category:
        return lines.select(*_exprs(_OBS))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("cat"))
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(*_exprs(_OBS), "cat")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*_exprs(_PRED))


def _select(spec: dict[str, str], source: str, tail: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in spec.items()) + f" FROM {source} {tail}"


_CTE = {
    "per_cust": _select({"o_custkey": "o_custkey", **_PER_CUSTOMER}, "orders", "GROUP BY o_custkey"),
    "dim_patient": _select(_DIM, "customer"),
    **{f"fact_{s}": _select({"patient_id": "patient_id", **_FACTS[s]},
                            "per_cust JOIN dim_patient ON patient_id = o_custkey", f"WHERE source_dataset='{s}'") for s in _FACTS},
    "obs": _select(_OBS, "lineitem"),
    "obs_cat": _select({**_OBS, "cat": "p_brand"}, "lineitem JOIN part ON p_partkey = l_partkey"),
    "pred": _select(_PRED, "lineitem"),
}
_NEEDS = {f"fact_{s}": ["per_cust", "dim_patient"] for s in _FACTS}


def with_ctes(*names: str, **extra: str) -> str:
    """A WITH clause that defines the named fixtures, what they need, and extra expressions, in order."""
    order: list[str] = []
    for name in names:
        order += [n for n in [*_NEEDS.get(name, []), name] if n not in order]
    parts = [f"{n} AS ({_CTE[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


FACTS = [f"fact_{s}" for s in _FACTS]
