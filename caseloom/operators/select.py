"""Feature scores, rank aggregation and genetic subset search."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.functions.scalar import ratio
from caseloom.operators.ranks import CELL, prefix_sums, settle, small_side
from caseloom.operators.reshape import literal_rows
from caseloom.operators.stats import class_value_counts
from caseloom.session import compact, cut_lineage


def mutual_information(df: DataFrame, features: Sequence[str], label: str = "label", discrete: Sequence[str] = (), bins: int = 20) -> DataFrame:
    """Mutual information with the label in nats. Discrete features use their values, others equal-count bins."""
    counts = class_value_counts(df, features, label).withColumn("n", F.col("n0") + F.col("n1"))
    placed = prefix_sums(counts, "value", ["n", "n0", "n1"], ["feature"])
    share = F.floor(F.col("below_n") * bins / F.col("total_n")).cast("double")
    bin_ = F.when(F.col("feature").isin(list(discrete)), F.col("value")).otherwise(share) if discrete else share
    cells = placed.groupBy("feature", bin_.alias("bin")).agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.max("total_n0").alias("t0"), F.max("total_n1").alias("t1"))
    size = F.col("t0") + F.col("t1")

    def term(n: str, t: str):
        joint = F.col(n).cast("double") / size
        return F.when(F.col(n) > 0, joint * F.log(F.col(n) * size / ((F.col("n0") + F.col("n1")) * F.col(t).cast("double")))).otherwise(0.0)
    return cells.groupBy("feature").agg(F.sum(term("n0", "t0") + term("n1", "t1")).alias("score"))


def digamma(x: str) -> str:
    """SQL expression of the digamma function for numbers of 1 and more: the series at x + 6, brought back by its recurrence.
    The same text runs in other engines."""
    at = f"({x} + 6.0D)"
    steps = " + ".join(f"1.0D / ({x} + {i}.0D)" for i in range(6))
    square = f"({at} * {at})"
    return (f"(ln({at}) - 0.5D / {at} - (1.0D / 12 - (1.0D / 120 - (1.0D / 252 - (1.0D / 240 - 1.0D / 132 / {square}) / {square}) / {square}) / {square}) / {square}"
            f" - ({steps}))")


_FOUND = ("feature string, class int, value double, c bigint, ny bigint, k bigint, m bigint, tie boolean, lo double, hi double, "
          "kind string")
#: rows of a cell whose neighbours a task holds side by side
ROWS_AT_ONCE = 1 << 16


def _inside(value: np.ndarray, counts: np.ndarray, sizes: Sequence[int], k: int) -> Iterator[pd.DataFrame]:
    """Neighbours of one cell of a feature; values ascend, ``counts`` has a row a class. Values with k others of their class on either side
    in the cell are ``done``, and summed by k and m; or ``asked``, where rounding put a bound outside of the cell. Others are ``edge``s;
    values beside them are ``near`` an edge, as far as its neighbours can be."""
    below = np.concatenate([[0], np.cumsum(counts.sum(0))])
    for y, ny in enumerate(sizes):
        here = np.flatnonzero(counts[y])
        x, c = value[here], counts[y][here]
        at = np.minimum(np.arange(len(x)), np.arange(len(x))[::-1])  # values between this one and the end of the cell
        out = at < 2 * k
        yield pd.DataFrame({"class": y, "value": x[out], "c": c[out], "ny": ny, "kind": np.where(at[out] < k, "edge", "near")})
        wanted = min(k, ny - 1)
        steps = [*range(-1, -k - 1, -1), *range(1, k + 1)]
        for i in range(k, len(x) - k, ROWS_AT_ONCE):
            j = min(i + ROWS_AT_ONCE, len(x) - k)
            own, times = x[i:j], c[i:j]
            far = np.array([np.abs(x[i + s:j + s] - own) for s in steps])
            many = np.array([c[i + s:j + s] for s in steps])
            reach = np.full(j - i, np.inf)
            for d in far:
                reach = np.where(times - 1 + np.where(far <= d, many, 0).sum(0) >= wanted, np.minimum(reach, d), reach)
            d = np.where(times > wanted, 0.0, reach)
            tie = d == 0
            lo, hi = own - d, own + d
            for n in reversed(range(k)):  # the value that sets the radius bounds it exactly, whatever the rounding of the sum
                lo = np.where(far[n] == d, x[i + steps[n]:j + steps[n]], lo)
                hi = np.where(far[k + n] == d, x[i + steps[k + n]:j + steps[k + n]], hi)
            lo, hi = np.where(tie, own, lo), np.where(tie, own, hi)
            here_m = below[np.searchsorted(value, hi, "left")] - below[np.searchsorted(value, lo, "right")]
            twins = below[np.searchsorted(value, own, "right")] - below[np.searchsorted(value, own, "left")] - 1
            rows = pd.DataFrame({"class": y, "value": own, "c": times, "ny": ny, "k": np.where(tie, times - 1, wanted),
                                 "m": np.where(tie, twins, here_m), "tie": tie, "lo": lo, "hi": hi})
            beyond = (lo < value[0]) | (hi > value[-1])
            yield rows[["ny", "k", "m", "c"]][~beyond].groupby(["ny", "k", "m"], as_index=False)["c"].sum().assign(kind="done")
            yield rows[beyond].drop(columns="m").assign(kind="asked")


def _inside_cells(k: int):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches):
        whole = pd.concat([b.to_pandas() for b in batches] or [pd.DataFrame(columns=["feature", CELL])])  # a partition is a cell
        for (feature, _), rows in whole.groupby(["feature", CELL]):
            rows = rows.sort_values("value")
            counts = np.array([rows["n0"].to_numpy(np.int64), rows["n1"].to_numpy(np.int64)])
            for found in _inside(rows["value"].to_numpy(np.float64), counts, rows[["t0", "t1"]].iloc[0].tolist(), k):
                if len(found):
                    found = found.assign(feature=feature).reindex(columns=names)
                    found = found.astype({n: "Int64" for n in ("class", "c", "ny", "k", "m")} | {"tie": "boolean"})
                    yield pa.RecordBatch.from_pandas(found, schema=_found_schema(), preserve_index=False)
    return run


def _found_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "bigint": pa.int64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (f.split() for f in _FOUND.split(", "))])


def neighbour_information(df: DataFrame, features: Sequence[str], label: str = "label", k: int = 3, cells: int | None = None) -> DataFrame:
    """Mutual information with a 0/1 label in nats by the nearest-neighbour estimate for a class and a number (Ross 2014).

    A row's radius is the distance to its k-th nearest row of the same class (the last one, in a smaller class); m rows of any class
    are nearer than that, the row itself included, and the score is psi(N) + mean(psi(k) - psi(class size) - psi(m)), 0 at least. Where
    the radius is 0, k and m are the numbers of other rows with the same value, so ties need no noise. Values that are not there
    and classes of one row take no part. Rows are collapsed to (feature, value), which are cut into range partitions once. A value
    with k others of its class on either side in its cell is done there; the 2k a class at the edges of a cell find their neighbours
    among the edge values of all cells, and their m by the totals of the cells and one scan of the cells that hold their bounds.
    """
    counts = class_value_counts(df, features, label).select("feature", F.col("value").cast("double").alias("value"), "n0", "n1")
    celled = settle(counts, "value", ["feature"], cells)
    sizes = celled.groupBy("feature").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))  # one row a feature
    kept = [F.when(F.col(f"t{y}") > 1, F.col(f"n{y}")).otherwise(0).alias(f"n{y}") for y in (0, 1)]
    celled = celled.join(F.broadcast(sizes), "feature").select("feature", "value", CELL, *kept, "t0", "t1").where("n0 + n1 > 0")
    points = celled.select("feature", "value", CELL, (F.col("n0") + F.col("n1")).alias("n"))
    found = cut_lineage(celled.select("feature", "value", CELL, "n0", "n1", "t0", "t1").mapInArrow(_inside_cells(k), _FOUND))

    def beside(window, prefix: str) -> dict:
        entry = F.struct("value", "c")
        return {f"{prefix}{side}{j}": step(entry, j).over(window) for j in range(1, k + 1) for side, step in (("b", F.lag), ("a", F.lead))}
    # in their order, k neighbours of an edge value stand next to it
    rows = found.where("kind IN ('edge', 'near')").withColumns(beside(W.partitionBy("feature", "class").orderBy("value"), "out_")).where("kind = 'edge'")
    near = F.filter(F.array(*[F.col(f"out_{s}{j}") for s in "ba" for j in range(1, k + 1)]), lambda e: e.isNotNull())
    rows = rows.select("feature", "class", "value", "c", "ny", F.transform(near, lambda e: F.struct(F.abs(e["value"] - F.col("value")).alias("d"), e["c"].alias("c"), e["value"].alias("at"))).alias("near"))
    wanted = F.least(F.lit(k), F.col("ny") - 1)
    within = lambda e: F.col("c") - 1 + F.aggregate(F.filter("near", lambda o: o["d"] <= e["d"]), F.lit(0).cast("bigint"), lambda t, o: t + o["c"])
    reach = F.array_min(F.transform(F.filter("near", lambda e: within(e) >= wanted), lambda e: e["d"]))
    rows = rows.withColumn("d", F.when(F.col("c") > wanted, 0.0).otherwise(reach)).withColumn("k", F.when(F.col("d") == 0, F.col("c") - 1).otherwise(wanted))

    def bound(sign: int):
        # the value that sets the radius bounds it exactly, whatever the rounding of the sum
        at = F.filter("near", lambda e: (e["d"] == F.col("d")) & ((e["at"] - F.col("value")) * sign > 0))
        return F.when(F.col("d") == 0, F.col("value")).otherwise(F.coalesce(F.get(at, F.lit(0))["at"], F.col("value") + sign * F.col("d")))
    row = ["class", "value", "c", "ny", "k", "tie"]
    rows = rows.select("feature", *row[:-1], (F.col("d") == 0).alias("tie"), bound(-1).alias("lo"), bound(1).alias("hi"))
    rows = rows.unionByName(found.where("kind = 'asked'").select(rows.columns))
    tie = F.col("tie")
    asked = rows.select("feature", F.struct(*row).alias("row"), F.inline(F.array(
        F.struct(F.struct(F.col("hi").alias("v"), F.when(tie, 2).otherwise(0).alias("o")).alias("at"), F.lit(1).alias("sign")),
        F.struct(F.struct(F.col("lo").alias("v"), F.when(tie, 0).otherwise(2).alias("o")).alias("at"), F.lit(-1).alias("sign")))))
    asked = asked.select("feature", "at", F.lit(None).cast("int").alias(CELL), F.lit(0).cast("bigint").alias("n"), "row", "sign")
    # whole cells before a bound, and the cell that it may cut: the first whose last value is not before it
    ends = points.groupBy("feature", CELL).agg(F.sum("n").alias("n"), F.max("value").alias("last")).select(
        "feature", F.struct(F.col("last").alias("v"), F.lit(1).alias("o")).alias("at"), CELL, "n",
        F.lit(None).cast(asked.schema["row"].dataType).alias("row"), F.lit(None).cast("int").alias("sign"))
    before = lambda order: W.partitionBy("feature").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    placed = ends.unionAll(asked).select("feature", "at", "row", "sign", F.coalesce(F.sum("n").over(before("at")), F.lit(0)).alias("n"),
                                         F.last(CELL, ignorenulls=True).over(before(F.desc("at"))).alias("_cut"))
    placed = cut_lineage(placed.where("row IS NOT NULL"))
    cut = small_side(placed.select(F.col("feature").alias("_feature"), "_cut", "at", "row", "sign"))
    same = (F.col("feature") == F.col("_feature")) & (F.col(CELL) == F.col("_cut"))
    inside = points.join(cut, same & ((F.col("value") < F.col("at.v")) | (F.col("value") == F.col("at.v")) & (F.col("at.o") == 2)))
    signed = [df.select("feature", "row", (F.col("n") * F.col("sign")).alias("n")) for df in (placed, inside)]
    m = signed[0].unionAll(signed[1]).groupBy("feature", "row").agg(F.sum("n").alias("m"))
    m = m.select("feature", "row.ny", "row.k", (F.col("m") - F.when(F.col("row.tie"), 1).otherwise(0)).alias("m"), "row.c")
    m = m.unionByName(found.where("kind = 'done'").select(m.columns)).groupBy("feature", "ny", "k", "m").agg(F.sum("c").alias("c"))
    each = F.expr(f"c * ({digamma('k')} - {digamma('ny')} - {digamma('m')})")
    score = m.groupBy("feature").agg(F.sum(each).alias("s"), F.sum("c").alias("total"))
    return score.select("feature", F.greatest(F.lit(0.0), F.expr(f"{digamma('total')} + s / total")).alias("score"))


def _linear_sums(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Per feature: range, class sums, class counts and correlation with the label, one row each, from one aggregate."""
    def sums(c: str):
        x, y = F.col(f"`{c}`").cast("double"), F.col(label)
        zero, one = F.when(y == 0, x), F.when(y == 1, x)
        return F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.sum(zero).alias("s0"), F.sum(one).alias("s1"), F.count(zero).alias("n0"),
                        F.count(one).alias("n1"), F.corr(x, y.cast("double")).alias("r")).alias(c)
    wide = df.agg(*[sums(c) for c in features])
    return wide.unpivot([], [F.col(f"`{c}`") for c in features], "feature", "s").select("feature", "s.*")


def _chi2_of_sums():
    span = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    o0, o1 = (F.col("s0") - F.col("n0") * F.col("lo")) / span, (F.col("s1") - F.col("n1") * F.col("lo")) / span
    e0, e1 = (o0 + o1) * ratio(F.col("n0"), F.col("n0") + F.col("n1")), (o0 + o1) * ratio(F.col("n1"), F.col("n0") + F.col("n1"))
    return F.coalesce(F.try_divide((o0 - e0) * (o0 - e0), e0) + F.try_divide((o1 - e1) * (o1 - e1), e1), F.lit(0.0))


def chi2_score(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Chi-square of class sums against expected sums after scaling each feature to [0, 1]."""
    return _linear_sums(df, features, label).select("feature", _chi2_of_sums().alias("score"))


def feature_scores(df: DataFrame, features: Sequence[str], label: str = "label", discrete: Sequence[str] = ()) -> DataFrame:
    """(method, feature, position, score) for mutual information, chi-square and absolute correlation."""
    position = literal_rows(df.sparkSession, [(f, i) for i, f in enumerate(features)], "feature string, position int")
    pair = F.inline(F.array(F.struct(F.lit("chi2").alias("method"), _chi2_of_sums().alias("score")),
                            F.struct(F.lit("correlation").alias("method"), F.abs("r").alias("score"))))
    linear = _linear_sums(df, features, label).select("feature", pair)
    information = mutual_information(df, features, label, discrete).withColumn("method", F.lit("mutual_info"))
    return linear.unionByName(information).join(position, "feature").select("method", "feature", "position", F.coalesce("score", F.lit(0.0)).alias("score"))


def aggregate_ranks(scores: DataFrame, top: int | None = None) -> DataFrame:
    """Average rank over the methods, best first. Equal scores keep the order of the features.

    The windows run over one row per feature and method.
    """
    ranked = scores.withColumn("r", F.row_number().over(W.partitionBy("method").orderBy(F.desc("score"), "position")) - 1)
    mean = ranked.groupBy("feature", "position").agg(F.avg("r").alias("avg_rank")).orderBy("avg_rank", "position")
    return (mean.limit(top) if top else mean).select("feature", "avg_rank")


def default_top(n_features: int) -> int:
    return max(3, n_features // 2)


@dataclass
class GeneticSearch:
    """Genetic search for a feature subset; the data is only ever touched by Spark aggregates.

    One aggregate collects the weighted cross-products of all features per fold; from them the linear scorer of any
    subset is solved on the driver (matrices of the size of the feature list). Equal rows are collapsed to one with a count;
    one more pass over these per generation counts the confusion matrices of all its new subsets. Fitness is the mean weighted F1 over the held-out folds times
    max(1 - 0.005 * size, 0.5).
    """

    features: Sequence[str]
    label: str = "label"
    fold: str = "fold"
    folds: int = 3
    population: int = 20
    generations: int = 15
    crossover: float = 0.8
    mutation: float = 0.15
    elite: int = 2
    seed: int = 42
    history: list[dict] = field(default_factory=list)
    cache: dict[tuple, float] = field(default_factory=dict)

    def _grams(self, df: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        names = ["_one", *self.features]
        data = df.select(self.fold, self.label, F.lit(1.0).alias("_one"), *[F.col(f"`{f}`").cast("double").alias(f) for f in self.features])
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        products = F.array(*[F.sum(F.col(f"`{names[i]}`") * F.col(f"`{names[j]}`")) for i, j in pairs])
        out: dict[int, dict[int, np.ndarray]] = {}
        for r in data.groupBy(self.fold, self.label).agg(products.alias("g")).collect():
            g = np.zeros((len(names), len(names)))
            for (i, j), v in zip(pairs, r["g"]):
                g[i, j] = g[j, i] = v
            out.setdefault(r[self.fold], {})[r[self.label]] = g
        empty = np.zeros((len(names), len(names)))
        return {f: (by.get(0, empty), by.get(1, empty)) for f, by in out.items()}

    def _scorer(self, grams: dict, held_out: int, genome: tuple) -> np.ndarray:
        """Balanced least-squares weights of the subset, trained on the other folds; 0 outside the subset."""
        g0 = sum(g[0] for f, g in grams.items() if f != held_out)
        g1 = sum(g[1] for f, g in grams.items() if f != held_out)
        w0, w1 = 0.5 / max(g0[0, 0], 1.0), 0.5 / max(g1[0, 0], 1.0)
        keep = [0, *[i + 1 for i, bit in enumerate(genome) if bit]]
        a = (w0 * g0 + w1 * g1)[np.ix_(keep, keep)] + 1e-9 * np.eye(len(keep))
        b = (w1 * g1[0] - w0 * g0[0])[keep]
        out = np.zeros(len(genome) + 1)
        out[keep] = np.linalg.solve(a, b)
        return out

    def _collapsed(self, df: DataFrame) -> DataFrame:
        """Distinct rows with their number ``_n``: a scorer gives equal rows the same guess."""
        wide = df.select(*[F.col(f"`{f}`").cast("double").alias(f) for f in self.features], F.coalesce(F.col(self.label) == 1, F.lit(False)).alias("_y"), F.col(self.fold).alias("_f"))
        return compact(wide.groupBy(*wide.columns).agg(F.count(F.lit(1)).alias("_n")))

    def _evaluate(self, rows: DataFrame, grams: dict, genomes: list[tuple]) -> None:
        new = [g for g in dict.fromkeys(genomes) if g not in self.cache]
        if not new:
            return
        folds = sorted(grams)
        weights = {f: np.stack([self._scorer(grams, f, g) for g in new], axis=1) for f in folds}
        features, width = list(self.features), len(new)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = {f: np.zeros((4, width), dtype="int64") for f in folds}
            for p in batches:
                x = np.column_stack([np.ones(len(p)), p[features].to_numpy(dtype=float)])
                y, at, n = p["_y"].to_numpy(), p["_f"].to_numpy(), p["_n"].to_numpy()
                for f in folds:
                    guess, truth, m = x[at == f] @ weights[f] > 0, y[at == f], n[at == f]
                    sums[f] += np.stack([m[w] @ (guess[w] == g) for w in (~truth, truth) for g in (False, True)])
            for f in folds:
                yield pd.DataFrame({"fold": f, "genome": np.arange(width), "tn": sums[f][0], "fp": sums[f][1], "fn": sums[f][2], "tp": sums[f][3]})
        partial = rows.select(*features, "_y", "_f", "_n").mapInPandas(count, "fold int, genome int, tn bigint, fp bigint, fn bigint, tp bigint")
        totals = partial.groupBy("fold", "genome").agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")]).collect()
        f1 = {i: [] for i in range(width)}
        for r in totals:
            f1[r["genome"]].append(_weighted_f1(r["tn"], r["fp"], r["fn"], r["tp"]))
        for i, genome in enumerate(new):
            self.cache[genome] = float(np.mean(f1[i])) * max(1.0 - 0.005 * sum(genome), 0.5)

    def _repaired(self, rng: np.random.Generator, population: np.ndarray) -> np.ndarray:
        """Fills rows that select fewer than two features with their most preferred ones, by a random preference."""
        least = min(2, population.shape[1])
        preference = rng.random(population.shape) + population  # selected features come first
        forced = preference >= np.sort(preference, axis=1)[:, -least:][:, :1]
        return population | (forced & (population.sum(axis=1) < least)[:, None])

    def _offspring(self, rng: np.random.Generator, population: np.ndarray, fitness: np.ndarray, rows: int) -> np.ndarray:
        """``rows`` children of a whole generation at once: tournament, crossover by a mask, mutation by a mask."""
        size, width = population.shape
        entrants = rng.integers(size, size=(2, rows, 2))  # (parent, child, entrant)
        mother, father = population[np.take_along_axis(entrants, fitness[entrants].argmax(axis=2)[..., None], axis=2)[..., 0]]
        cut = np.where(rng.random(rows) < self.crossover, rng.integers(0, width + 1, rows), width)
        children = np.where(np.arange(width)[None, :] < cut[:, None], mother, father)
        return self._repaired(rng, children ^ (rng.random(children.shape) < self.mutation))

    def run(self, df: DataFrame) -> tuple[list[str], float]:
        """The best subset and its fitness; ``history`` holds one entry per generation."""
        rng = np.random.default_rng(self.seed)
        grams, rows = self._grams(df), self._collapsed(df).persist()
        population = self._repaired(rng, rng.random((self.population, len(self.features))) < 0.5)
        for generation in range(1, self.generations + 1):
            genomes = [tuple(row) for row in population.astype(int).tolist()]
            self._evaluate(rows, grams, genomes)
            fitness = np.array([self.cache[g] for g in genomes])
            leaders = np.argsort(-fitness, kind="stable")
            self.history.append({"generation": generation, "best_fitness": float(fitness[leaders[0]]), "avg_fitness": float(fitness.mean()),
                                 "n_features": int(population[leaders[0]].sum())})
            population = np.concatenate([population[leaders[:self.elite]], self._offspring(rng, population, fitness, self.population - self.elite)])
        rows.unpersist()
        best = max(self.cache, key=self.cache.__getitem__)
        return [f for f, bit in zip(self.features, best) if bit], self.cache[best]

    def history_table(self, df: DataFrame) -> DataFrame:
        rows = [(h["generation"], h["best_fitness"], h["avg_fitness"], h["n_features"]) for h in self.history]
        return literal_rows(df.sparkSession, rows, "generation int, best_fitness double, avg_fitness double, n_features int")


def _weighted_f1(tn: int, fp: int, fn: int, tp: int) -> float:
    pos, neg = tp + fn, tn + fp
    one = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
    zero = 2 * tn / (2 * tn + fp + fn) if tn else 0.0
    return (pos * one + neg * zero) / (pos + neg) if pos + neg else 0.0
