"""Model explanations: impurity importance, permutation importance, tree Shapley values, local linear surrogates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
import math
import pickle
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import seeded_hash
from caseloom.operators.ranks import number_rows
from caseloom.operators.reshape import literal_rows
from caseloom.session import shared_dir

ROWS_PER_SOLVE = 512
#: steps of a walk out of the numbers beyond the last row; with a million rows a walk of 32 has a chance below 1e-90
_WALK = 32
#: rows that borrow values in one part of the join, and rows that are packed at once
_ASKING_IN_PART, _ROWS_IN_PACK = 1 << 20, 1 << 20
_ROWS_IN_BATCH = 1 << 14
#: values that are whole numbers after one of these factors are packed as such
_FACTORS = (1, 100, 10, 1000, 10_000)
_BUNDLE = "_at bigint, _n int, _first bigint, _layout binary, _blob binary"
_CELLS = 1 << 20
TOP_SHARE = 0.75


def tree_importance(model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Impurity importance per feature, most important first; the top quarter is flagged."""
    values = [float(v) for v in model.featureImportances.toArray()]
    cut = float(np.quantile(values, TOP_SHARE))
    return literal_rows(df.sparkSession, [(f, v, v >= cut) for f, v in zip(features, values)],
                        "feature string, importance double, top boolean").orderBy(F.desc("importance"), "feature")


def permuted_position(position: str, a: str, b: str, repeat: str, seed: int, integer_div: str = "div") -> str:
    """SQL expression of one step of a keyed permutation of 0 .. a * b - 1: a Feistel network of four rounds on the remainder and
    the quotient by a. The same text runs in other engines with their sign for integer division."""
    def mixed(x: str, round_: int) -> str:
        once = f"((({x} + 1) * 2654435761 + ({repeat} * 131 + {seed * 7919 + round_ * 104729})) % 4294967296)"
        return f"(({once} {integer_div} 128) * 48271 % 2147483647)"
    left, right = f"({position} % {a})", f"({position} {integer_div} {a})"
    for round_ in range(0, 4, 2):
        left = f"(({left} + {mixed(right, round_)}) % {a})"
        right = f"(({right} + {mixed(left, round_ + 1)}) % {b})"
    return f"({right} * {a} + {left})"


def _sides(n: int) -> tuple[int, int]:
    """Two numbers of about the same size whose product is ``n`` or a little more."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _whole(values: np.ndarray) -> tuple[np.ndarray, int, int]:
    """(numbers, lowest, factor): (numbers + lowest) / factor is the value, to the last bit; with factor 0 the numbers are its bits."""
    with np.errstate(invalid="ignore", over="ignore"):
        for factor in _FACTORS:
            for part in (values[:64], values):
                scaled = np.rint(part * factor)
                whole = np.where(np.abs(scaled) < 2.0 ** 52, scaled, 0).astype(np.int64)
                if not np.array_equal((whole / factor).view(np.int64), part.view(np.int64)):
                    break
            else:
                lowest = int(whole.min(initial=0))
                return (whole - lowest).view(np.uint64), lowest, factor
    return values.view(np.uint64), 0, 0


def _bundled(keys: np.ndarray, columns: Sequence[tuple[np.ndarray, np.ndarray | None]], size: int) -> pa.RecordBatch:
    """Rows (key, values, nulls) in the order of their keys, one bundle for each ``size`` keys. A row takes as many bits as the widest
    number of each column needs: the step from the key before, the values as whole numbers where they are, a bit for nulls if there are any."""
    order = np.argsort(keys)
    keys = keys[order]
    at = keys // size
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    steps = np.diff(keys, prepend=keys[:1])
    steps[starts] = 0
    fields = [(steps.view(np.uint64), 0, 1)]
    for values, nulls in columns:
        fields += [_whole(values[order]), (np.zeros(1, np.uint64) if nulls is None else nulls[order].astype(np.uint64), 0, 1)]
    words, used, layout = [], [], []
    for numbers, lowest, factor in fields:
        bits = int(numbers.max()).bit_length()
        if not words or used[-1] + bits > 64:
            words.append(np.zeros(len(keys), np.uint64))
            used.append(0)
        layout.append((len(words) - 1, used[-1], bits, lowest, factor))
        if bits:
            words[-1] |= numbers << np.uint64(used[-1])
        used[-1] += bits
    raw = [np.frombuffer(w.astype(">u8").tobytes(), np.uint8).reshape(-1, 8) for w in words]
    blobs = []
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        blobs.append(np.packbits(np.concatenate([np.unpackbits(w[a:b], axis=1)[:, 64 - u:] for w, u in zip(raw, used)], axis=1)).tobytes())
    shape = pickle.dumps((used, layout))
    return pa.RecordBatch.from_arrays([
        pa.array(at[starts], pa.int64()), pa.array(np.diff(np.r_[starts, len(keys)]), pa.int32()), pa.array(keys[starts], pa.int64()),
        pa.array([shape] * len(starts), pa.binary()), pa.array(blobs, pa.binary())], ["_at", "_n", "_first", "_layout", "_blob"])


def _unbundled(n: int, first: int, layout: bytes, blob: bytes) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The keys and columns of one bundle."""
    used, fields = pickle.loads(layout)
    bits = np.unpackbits(np.frombuffer(blob, np.uint8), count=n * sum(used)).reshape(n, -1)
    words, at = [], 0
    for u in used:
        whole = np.zeros((n, 64), np.uint8)
        whole[:, 64 - u:] = bits[:, at:at + u]
        words.append(np.packbits(whole, axis=1).view(">u8").ravel().astype(np.uint64))
        at += u
    found = []
    for word, shift, width, lowest, factor in fields:
        numbers = (words[word] >> np.uint64(shift)) & np.uint64((1 << width) - 1) if width else np.zeros(n, np.uint64)
        found.append((numbers.view(np.int64) + lowest) / factor if factor else numbers.view(np.float64))
    keys = first + np.cumsum(found[0].astype(np.int64))
    return keys, [(values, nulls > 0) for values, nulls in zip(found[1::2], found[2::2])]


def _bundles(size: int):
    """Rows of a key and numbers, packed for the part of the join that holds their key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= _ROWS_IN_PACK:
                yield packed(held)
                held, n = [], 0
        if held:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        columns = [c.combine_chunks() for c in table.columns[1:]]
        return _bundled(table.column(0).to_numpy(), [(c.fill_null(0.0).to_numpy(), c.is_null().to_numpy(zero_copy_only=False) if c.null_count else None) for c in columns], size)
    return run


def _met(size: int, names: Sequence[str]):
    """Each asking row with the values of the row that its key names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, asked, donors in zip(*(batch[c] for c in ("_at", "_asked", "_donors"))):
                start = at.as_py() * size
                keys, columns = joined([_unbundled(*d.values()) for d in donors.as_py()])
                place = np.zeros(size, np.int64)
                place[keys - start] = np.arange(len(keys))
                held, n = [], 0
                for i in range(len(asked)):
                    held.append(_unbundled(*asked[i].as_py().values()))
                    n += len(held[-1][0])
                    if n >= _ROWS_IN_BATCH or i == len(asked) - 1:
                        wanted, own = joined(held)
                        lent = [(v[row], m[row]) for row in [place[wanted - start]] for v, m in columns]
                        yield pa.RecordBatch.from_arrays([pa.array(v, mask=m) for v, m in [*own, *lent]], list(names))
                        held, n = [], 0

    def joined(parts: list) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        columns = [tuple(np.concatenate(c) for c in zip(*same)) for same in zip(*(columns for _, columns in parts))]
        return np.concatenate([k for k, _ in parts]), columns
    return run


def permutation_importance(df: DataFrame, key: str | Sequence[str], features: Sequence[str], predict: Callable[[DataFrame], DataFrame],
                           label: str = "label", repeats: int = 10, seed: int = 42) -> DataFrame:
    """Drop in accuracy when one feature is permuted: mean and standard deviation over the repeats.

    Rows are numbered in the hash order of their key, by range partitioning. In each repeat a keyed permutation of all numbers
    (``permuted_position``, repeated while it lands beyond the last row) says from which row a row borrows its feature; one join by
    number brings the borrowed values of all repeats and features. Both sides travel packed (``_bundled``), a row in a few bytes,
    and a part of the join holds a bounded number of asking rows. ``predict`` adds a 0/1 ``prediction`` and scores all variants in
    one job, and the untouched rows beside it. Rows with one key are numbered in any order among each other.
    """
    keys, names = [key] if isinstance(key, str) else list(key), list(features)
    own, lent = [f"_x{i}" for i in range(len(names))], [f"_d{i}" for i in range(len(names))]
    hashed = df.select(F.col(label).cast("int").alias("_y"), seeded_hash(keys, seed).alias("_h"), *[F.col(f"`{f}`").cast("double").alias(x) for f, x in zip(names, own)])
    numbered = number_rows(hashed, "_h", "_i").select((F.col("_i") - 1).alias("_i"), "_y", *own)
    n, width = numbered.count(), len(names)
    a, b = _sides(n)
    # a number beyond the last row is moved on; a walk visits each of the a * b - n such numbers once at most, and few of them
    steps = min(a * b - n, _WALK) + 1
    step = [permuted_position(x, f"{a}L", f"{b}L", "_r", seed) for x in ("_i", "v")]
    # the first step is compiled; only the few numbers that land beyond the last row are walked on
    walk = f"if(_to < {n}, _to, aggregate(sequence(1, {steps}), _to, (v, _s) -> if(v < {n}, v, {step[1]})))"
    asked = numbered.select("_i", "_y", *own, F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(repeats).cast("bigint"))).alias("_r")).select(
        "*", F.expr(step[0]).alias("_to")).select(F.expr(walk).alias("_d"), F.col("_y").cast("double"), (F.col("_r") - 1).cast("double").alias("_r"), *own)
    donors = numbered.select(F.col("_i").alias("_d"), *own)
    # numbers are dense, so equal runs of them are even parts: bounded donors are looked up in memory, and nothing is sorted
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * repeats // _ASKING_IN_PART))
    size = max(1, -(-n // parts))
    packed = [rows.mapInArrow(_bundles(size), _BUNDLE).repartition(parts, "_at").groupBy("_at").agg(
        F.collect_list(F.struct("_n", "_first", "_layout", "_blob")).alias(out)) for rows, out in ((asked, "_asked"), (donors, "_donors"))]
    columns = ["_y", "_r", *own, *lent]
    with_donors = packed[0].join(packed[1].hint("shuffle_hash"), "_at").mapInArrow(_met(size, columns), ", ".join(f"{c} double" for c in columns))
    # a copy of a row carries the one value it borrows, not those of all variants
    spread = with_donors.select(F.col("_y").cast("int"), F.col("_r").cast("bigint"), *own, F.posexplode(F.array(*lent)).alias("_f", "_borrowed")).withColumn("_v", F.col("_r") * width + F.col("_f"))
    plain = numbered.select("_y", F.lit(-1).cast("bigint").alias("_v"), F.lit(None).cast("double").alias("_borrowed"), *own)
    at = F.pmod("_v", F.lit(width))
    columns = [F.when((F.col("_v") >= 0) & (at == i), F.col("_borrowed")).otherwise(F.col(own[i])).alias(f) for i, f in enumerate(names)]

    def accuracy(rows: DataFrame) -> DataFrame:
        scored = predict(rows.select("_y", "_v", *columns))
        return scored.groupBy("_v").agg(F.avg((F.col("prediction") == F.col("_y")).cast("double")).alias("a"))
    # one row per (feature, repeat), compared with the untouched variant, for which nothing is borrowed
    base = accuracy(plain).select("a").scalar()
    drop = accuracy(spread).select(F.pmod("_v", F.lit(width)).alias("_f"), (base - F.col("a")).alias("d"))
    name = F.element_at(F.array(*[F.lit(f) for f in names]), (F.col("_f") + 1).cast("int"))
    return drop.groupBy("_f").agg(F.avg("d").alias("importance_mean"), F.stddev_pop("d").alias("importance_std")).select(
        name.alias("feature"), "importance_mean", "importance_std")


@dataclass
class LeafTable:
    """The leaves of one forest with the same number m of distinct path features.

    ``features`` (leaf, m), the interval (``low``, ``high``] of each, the share of training rows that met it, the leaf's value.
    """

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def add_to(self, out: np.ndarray, x: np.ndarray) -> None:
        """Adds the Shapley values of all leaves to ``out`` (row, feature), in pieces of bounded size."""
        leaves, m = self.features.shape
        step = max(1, _CELLS // (m * max(1, len(x))))
        for i in range(0, leaves, step):
            f = self.features[i:i + step]
            met = (x[:, f] > self.low[i:i + step]) & (x[:, f] <= self.high[i:i + step])
            phi = leaf_values(self.value[i:i + step], self.share[i:i + step], met)
            for j in range(len(f)):
                out[:, f[j]] += phi[:, j]


def leaf_values(value: np.ndarray, share: np.ndarray, met: np.ndarray) -> np.ndarray:
    """Shapley values (row, leaf, m) of the games v(S) = value * prod_{S} met * prod_{not S} share.

    The weight s! (m - 1 - s)! / m! of a coalition of s others is the integral of t^s (1 - t)^(m - 1 - s), so the value of i is
    value * (met_i - share_i) times the integral over t of the product over the others of share (1 - t) + met t. That is a polynomial
    of degree m - 1: m / 2 Gauss points give it exactly. Along a path the products are extended from both ends, so nothing is
    divided out again, and a leaf costs m * m / 2 steps a row, whatever its depth.
    """
    m = share.shape[1]
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    total = np.zeros(met.shape)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = np.where(met, share * (1 - t) + t, share * (1 - t))
        others = np.empty(met.shape)
        others[..., 0] = 1.0
        np.cumprod(factor[..., :-1], axis=-1, out=others[..., 1:])
        behind = np.cumprod(factor[..., :0:-1], axis=-1)[..., ::-1]
        others[..., :-1] *= behind
        total += w * others
    return value[:, None] * (met - share) * total


def forest_leaves(model: RandomForestClassificationModel, df: DataFrame) -> tuple[list[LeafTable], float]:
    """Leaf tables and the mean prediction, read from the saved form of the forest (a model: its size does not depend on the rows)."""
    path = shared_dir(df.sparkSession, "forest")
    model.write().overwrite().save(path)
    rows = df.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    found, base, scale = [], 0.0, 1.0 / len(trees)
    for nodes in trees.values():
        stack = [(0, {})]
        while stack:
            at, path_ = stack.pop()
            node = nodes[at]
            cover = float(sum(node["impurityStats"]))
            if node["leftChild"] < 0:
                value = scale * float(node["impurityStats"][1]) / cover if cover else 0.0
                base += value * float(np.prod([s for _, _, s in path_.values()]))
                if path_:
                    found.append((value, path_))
                continue
            split = node["split"]
            if split["numCategories"] not in (-1, None):
                raise ValueError("categorical splits are not supported")
            feature, cut = split["featureIndex"], float(split["leftCategoriesOrThreshold"][0])
            for child, below in ((node["leftChild"], True), (node["rightChild"], False)):
                low, high, share = path_.get(feature, (-np.inf, np.inf, 1.0))
                part = float(sum(nodes[child]["impurityStats"])) / cover if cover else 0.0
                bound = (low, min(high, cut), share * part) if below else (max(low, cut), high, share * part)
                stack.append((child, {**path_, feature: bound}))
    tables = []
    for _, same in groupby(sorted(found, key=lambda f: len(f[1])), key=lambda f: len(f[1])):
        leaves = list(same)
        column = [np.array([[b[i] for b in p.values()] for _, p in leaves]) for i in range(3)]
        values = np.array([v for v, _ in leaves])
        tables.append(LeafTable(np.array([list(p) for _, p in leaves]), *column, values))
    return tables, base


def shap_values(model: RandomForestClassificationModel, df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Path-dependent Shapley values of the probability of class 1: kept columns, one column per feature, ``base``.

    The Shapley values of a leaf depend only on which of its intervals a row meets (``leaf_values``).
    """
    tables, base = forest_leaves(model, df)
    shared = df.sparkSession.sparkContext.broadcast(tables)
    names, kept = list(features), list(keep)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            x = p[names].to_numpy(dtype=float)
            out = np.zeros_like(x)
            for i in range(0, len(x), ROWS_PER_SOLVE):
                for t in shared.value:
                    t.add_to(out[i:i + ROWS_PER_SOLVE], x[i:i + ROWS_PER_SOLVE])
            yield pd.concat([p[kept].reset_index(drop=True), pd.DataFrame(out, columns=names).assign(base=base)], axis=1)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields] + [f"`{n}` double" for n in names] + ["base double"])
    return df.select(*kept, *[F.col(f"`{n}`").cast("double").alias(n) for n in names]).mapInPandas(explain, schema)


def mean_abs_shap(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute Shapley value per feature, largest first."""
    wide = values.agg(*[F.avg(F.abs(F.col(f"`{f}`"))).alias(f) for f in features])
    return wide.unpivot([], [F.col(f"`{f}`") for f in features], "feature", "importance").orderBy(F.desc("importance"), "feature")


def local_surrogates(df: DataFrame, features: Sequence[str], mean: dict[str, float], std: dict[str, float],
                     predict: Callable[[DataFrame], DataFrame], keep: Sequence[str] = (), samples: int = 5000, seed: int = 42) -> DataFrame:
    """Local linear weights per row and feature, strongest first: (kept columns, feature, weight).

    The perturbations are drawn around the training mean, so one set, scored once by ``predict`` (which adds
    ``probability``), serves every explained row; rows differ in the distance weights of their ridge regression.
    """
    names, kept, d = list(features), list(keep), len(features)
    centre, spread = np.array([mean[f] for f in names]), np.array([std[f] or 1.0 for f in names])
    z = np.random.RandomState(seed).normal(size=(samples, d))
    spark = df.sparkSession
    drawn = spark.createDataFrame(pd.DataFrame(z * spread + centre, columns=names).assign(_i=np.arange(samples)))
    target = predict(drawn).select("_i", "probability").orderBy("_i").toPandas()["probability"].to_numpy()
    shared = spark.sparkContext.broadcast((z, target))
    width2 = 0.75 * 0.75 * d

    def weights_of(x: np.ndarray, p: np.ndarray, z: np.ndarray, target: np.ndarray, products: np.ndarray) -> np.ndarray:
        """Ridge weights of a block of rows. The perturbations are shared, so all Gram matrices are one matrix product."""
        w = np.sqrt(np.exp(-np.maximum((x * x).sum(1)[:, None] - 2 * x @ z.T + (z * z).sum(1), 0) / width2))
        size = w.sum(1) + 1  # the row itself has weight 1
        mean_x, mean_y = (w @ z + x) / size[:, None], (w @ target + p) / size
        gram = (w @ products).reshape(-1, d, d) + x[:, :, None] * x[:, None, :] - size[:, None, None] * mean_x[:, :, None] * mean_x[:, None, :]
        right = (w * target) @ z + x * p[:, None] - (size * mean_y)[:, None] * mean_x
        return np.linalg.solve(gram + np.eye(d), right[:, :, None])[:, :, 0]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, target = shared.value
        products = (z[:, :, None] * z[:, None, :]).reshape(len(z), d * d)
        for p in batches:
            x, y = (p[names].to_numpy(dtype=float) - centre) / spread, p["probability"].to_numpy(dtype=float)
            blocks = [weights_of(x[i:i + ROWS_PER_SOLVE], y[i:i + ROWS_PER_SOLVE], z, target, products) for i in range(0, len(p), ROWS_PER_SOLVE)]
            yield pd.concat([p[kept].reset_index(drop=True), pd.DataFrame(np.concatenate([np.zeros((0, d)), *blocks]), columns=names)], axis=1)
    scored = predict(df).select(*kept, *[F.col(f"`{n}`").cast("double").alias(n) for n in names], "probability")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields] + [f"`{n}` double" for n in names])
    wide = scored.mapInPandas(solve, schema)
    return wide.unpivot(kept, [F.col(f"`{n}`") for n in names], "feature", "weight").withColumn("strength", F.abs("weight"))
