"""Feature preparation: one-hot, stratified split and folds, scaling, class weights, oversampling, feature order."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import ratio, seeded_uniform
from caseloom.operators.neighbours import nearest_points
from caseloom.operators.ranks import HashParts, hash_parts
from caseloom.operators.reshape import literal_rows, union_all

MAX_CATEGORIES = 1000
COPIES_PER_TASK_ROW = 10_000


@dataclass
class OneHot:
    """Dummy columns ``column_value`` in alphabetical order of the values; the first value of each column is dropped."""

    columns: Sequence[str]
    categories: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> OneHot:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in self.columns]).unpivot([], list(self.columns), "c", "v")
        rows = long.where("v IS NOT NULL").distinct().limit(MAX_CATEGORIES * len(self.columns) + 1).collect()
        for c in self.columns:
            self.categories[c] = sorted(r["v"] for r in rows if r["c"] == c)
            if len(self.categories[c]) > MAX_CATEGORIES:
                raise ValueError(f"{c} has more than {MAX_CATEGORIES} values; it is not a category")
        return self

    @property
    def names(self) -> list[str]:
        return [f"{c}_{v}" for c in self.columns for v in self.categories[c][1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        dummies = [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for c in self.columns for v in self.categories[c][1:]]
        return df.select(*[c for c in df.columns if c not in self.columns], *dummies)


def split_parts(df: DataFrame, key: str | Sequence[str], label: str, test: float = 0.2, seed: int = 42) -> HashParts:
    """Part 0 is the test set: the first round(test * n) rows of each class in seeded hash order."""
    return hash_parts(df, key, label, [F.round(F.col("n") * test)], seed)


def stratified_split(df: DataFrame, key: str | Sequence[str], label: str = "label", test: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Adds ``train`` / ``test``. The class sizes are exact and the same rows are chosen on every run."""
    parts = split_parts(df, key, label, test, seed).transform(df, out)
    return parts.withColumn(out, F.when(F.col(out) == 0, "test").otherwise("train"))


def stratified_folds(df: DataFrame, key: str | Sequence[str], label: str = "label", k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Adds a fold number 0 .. k-1; the folds of each class differ by at most one row."""
    starts = [F.ceil(F.col("n") * j / k) for j in range(1, k)]
    return hash_parts(df, key, label, starts, seed).transform(df, out)


@dataclass
class Scaler:
    """Zero mean and unit population variance. Fitted on the training rows; a constant column is only centred."""

    columns: Sequence[str]
    mean: dict[str, float] = field(default_factory=dict)
    std: dict[str, float] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> Scaler:
        row = train.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in self.columns]).first()
        self.mean = {c: row[c]["m"] for c in self.columns}
        self.std = {c: row[c]["s"] or 1.0 for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(self.mean[c])) / F.lit(self.std[c]) for c in self.columns})

    def table(self, df: DataFrame) -> DataFrame:
        return literal_rows(df.sparkSession, [(c, self.mean[c], self.std[c]) for c in self.columns], "feature string, mean double, std double")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight n / (2 * n_c) per class, and the negatives-per-positive weight of the positive class."""
    n = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    rows = F.inline(F.array(F.struct(F.lit(0).alias("class"), F.col("n0").alias("n_c")), F.struct(F.lit(1).alias("class"), F.col("n1").alias("n_c"))))
    return n.select("n0", "n1", rows).select(
        "class", F.col("n_c").alias("n"), ratio(F.col("n0") + F.col("n1"), 2 * F.col("n_c")).alias("weight"),
        ratio(F.col("n0"), F.col("n1")).alias("scale_pos_weight"))


def add_class_weight(df: DataFrame, train: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Adds the balanced weight of the row's class, computed on the training rows."""
    w = {r["class"]: r["weight"] for r in class_weights(train, label).collect()}
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w[1])).otherwise(F.lit(w[0])))


def _number_of(df: DataFrame, key: str) -> Column:
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.col(key).cast("bigint") if whole else F.xxhash64(F.col(key))


def smote(df: DataFrame, key: str, features: Sequence[str], label: str = "label", k: int = 5, seed: int = 42,
          cells: int | None = None) -> DataFrame:
    """Raises the minority class to the size of the majority by interpolating towards near minority rows.

    Returns the input rows (``copy`` 0) and the synthetic rows (``copy`` >= 1) with ``base`` naming the row they start
    from. Every minority row starts equally many synthetic rows, up to one. The neighbour and the step are drawn by
    hashing, so the result does not depend on the partitioning. Rows with equal features are handled once, as one
    point with a weight, however many there are. A row with a missing feature stays as it is and starts no synthetic row;
    without any complete minority row there are none. A key that is no whole number is named by its hash.
    """
    features = list(features)
    own = _number_of(df, key)
    complete = F.coalesce(reduce(and_, [~F.isnan(F.col(f).cast("double")) & F.col(f).isNotNull() for f in features], F.lit(True)), F.lit(False))
    counted = df.groupBy(label).agg(F.count(F.lit(1)), F.count_if(complete)).limit(3).collect()
    sizes = {r[0]: r[1] for r in counted}
    if len(sizes) != 2:
        raise ValueError(f"{label} must have two classes, found {sorted(sizes, key=str)}")
    minority = min(sizes, key=lambda c: (sizes[c], -c))
    n_min = next(r[2] for r in counted if r[0] == minority)
    need = max(sizes.values()) - sizes[minority] if n_min else 0
    original = df.select(own.alias("base"), F.lit(0).cast("bigint").alias("copy"), label,
                         *[F.col(f).cast("double").alias(f) for f in features])
    if need == 0:
        return original
    each, extra = divmod(need, n_min)
    rows = df.where((F.col(label) == minority) & complete).select(
        own.alias("_key"), F.lit(1).alias("_all"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    if extra:
        rows = hash_parts(rows, "_key", "_all", [F.lit(extra)], seed).transform(rows, "_part").withColumn(
            "_copies", F.lit(each) + F.when(F.col("_part") == 0, 1).otherwise(0))
    else:
        rows = rows.withColumn("_copies", F.lit(each))
    points = rows.groupBy("x").agg(F.min("_key").alias("id"), F.count(F.lit(1)).alias("m"), F.sum("_copies").alias("copies"))
    near = nearest_points(points, len(features), k, seed, cells)
    # the row's own twins come first, then other points, each as often as it occurs, k in all
    itself = F.array_repeat(F.col("x"), F.least(F.col("m") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform(F.col("near"), lambda n: F.array_repeat(n["x"], F.least(n["m"], F.lit(k)).cast("int"))))
    pool = F.slice(F.concat(itself, others), 1, k)
    chosen = near.where("copies > 0").select("id", "x", "copies", F.when(F.size(pool) > 0, pool).otherwise(F.array("x")).alias("pool"))
    # a point may stand for very many copies: cut the work into pieces and spread them before writing the copies out
    pieces = chosen.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES_PER_TASK_ROW)))).repartition("id", "_piece")
    first = F.col("_piece") * COPIES_PER_TASK_ROW + 1
    numbered = pieces.withColumn("copy", F.explode(F.sequence(first, F.least("copies", first + (COPIES_PER_TASK_ROW - 1)))))
    step = seeded_uniform(["id", "copy"], seed + 1)
    pick = F.floor(seeded_uniform(["id", "copy"], seed + 2) * F.size("pool")).cast("int")
    drawn = numbered.select("id", "copy", "x", F.get("pool", pick).alias("n"), step.alias("u"))
    kind = df.schema[label].dataType
    made = drawn.select(F.col("id").alias("base"), F.col("copy").cast("bigint").alias("copy"), F.lit(minority).cast(kind).alias(label),
                        *[(F.get("x", F.lit(i)) + F.col("u") * (F.get("n", F.lit(i)) - F.get("x", F.lit(i)))).alias(f) for i, f in enumerate(features)])
    return original.unionByName(made)


def smote_folds(df: DataFrame, key: str, features: Sequence[str], label: str = "label", fold: str = "fold", folds: Sequence[int] = range(5),
                k: int = 5, seed: int = 42) -> DataFrame:
    """Per fold: the other folds oversampled (``part`` train) and the fold as it is (``part`` valid)."""
    def one(f: int) -> list[DataFrame]:
        train = smote(df.where(F.col(fold) != f), key, features, label, k, seed)
        valid = df.where(F.col(fold) == f).select(_number_of(df, key).alias("base"), F.lit(0).cast("bigint").alias("copy"), label,
                                                  *[F.col(c).cast("double").alias(c) for c in features])
        return [train.select(F.lit(f).alias("cv_fold"), F.lit("train").alias("part"), "*"), valid.select(F.lit(f).alias("cv_fold"), F.lit("valid").alias("part"), "*")]
    with ThreadPoolExecutor(max_workers=5) as pool:  # the jobs of the folds share the executors
        return union_all([part for parts in pool.map(one, folds) for part in parts])


def feature_contract(df: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The saved features in the saved order as doubles; a missing feature is 0 and others are ignored."""
    present = set(df.columns)
    return df.select(*keep, *[(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in present else F.lit(0.0)).alias(c) for c in order])


