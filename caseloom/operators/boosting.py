"""Second-order gradient boosting of many models at once: one scan a level serves all folds and both ways of growing.

Rows are binned and packed into blocks. A member is one training set (a fold left out, or all rows) of one recipe. Each scan
adds up, for every member, the gradients and curvatures of its open nodes by feature and bin; the sums of all blocks meet per
member, and only these sums (nodes x features x bins, no rows) come to the driver, which picks the splits. Members go on at
their own pace: one may be in its second tree while another ends its first. Margins are part of the blocks: about once a tree
the blocks are kept anew with them, and they are written after every few trees, so a lost executor replays little. Rows of one
training set lie together, and a member looks at its own rows only.

Training sets that a task can hold need no scan a level: the rows of each member go to a task of its own, which grows all its trees.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import cut_lineage, partitions_for

BINS = 64
ROWS_IN_PART = 1 << 19
TREES_BETWEEN = 16
_BLOCK = "keys binary, labels binary, members binary, bins binary, margins binary"


@dataclass(frozen=True)
class Growth:
    """How a recipe grows its trees: level by level to ``depth``, or best leaf first to ``leaves`` (three quarters of what is left a scan)."""

    name: str
    rounds: int = 100
    rate: float = 0.1
    depth: int | None = None
    leaves: int | None = None
    rows: float = 1.0
    columns: float = 1.0
    l2: float = 1.0
    least_hessian: float = 1.0
    least_rows: int = 1
    seed: int = 42


def level_wise(name: str = "Boosted Trees", rounds: int = 100, **more) -> Growth:
    """Trees of depth 5 on a part of the rows and columns, penalised leaves."""
    return Growth(name, rounds, depth=5, rows=0.8, columns=0.8, **more)


def leaf_wise(name: str = "Boosted Trees (leaf-wise)", rounds: int = 100, **more) -> Growth:
    """Trees of 31 leaves with 20 rows each, unpenalised."""
    return Growth(name, rounds, leaves=31, l2=0.0, least_hessian=1e-3, least_rows=20, **more)


@dataclass
class Tree:
    """Nodes in order of birth; a leaf has feature -1. A row goes left where its bin is at most ``cut``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(-1)
            self.value.append(v)
        return self.left[node], self.left[node] + 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            at = node[moving]
            node[moving] = left[at] + (bins[moving, feature[at]] > cut[at])
            moving = moving[feature[node[moving]] >= 0]
        return node

    def score(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]


def drawn(keys: np.ndarray, share: float, seed: int, round_: int) -> np.ndarray:
    """Which rows a tree sees: by a hash of the row key, the same in every scan and every retry."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 1_000_003 + round_ + 1) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) < np.uint64(min(share, 1 - 2**-53) * 2**64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


@dataclass
class Member:
    """One model while it grows."""

    growth: Growth
    number: int
    training: int
    weights: tuple[float, float]
    start: float
    features: int
    trees: list[Tree] = field(default_factory=list)
    #: trees that the written margins do not have yet
    pending: list[Tree] = field(default_factory=list)

    def __post_init__(self):
        self._plant()

    def _plant(self) -> None:
        self.tree, self.open, self.level, self.known, self.round = Tree(), [0], 0, {}, len(self.trees)
        n = max(1, round(self.growth.columns * self.features))
        self.columns = np.sort(np.random.default_rng([self.growth.seed, len(self.trees)]).choice(self.features, n, replace=False))

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.growth.rounds

    def view(self) -> Member:
        """What a scan needs: without the finished trees and the sums of split nodes."""
        out = copy(self)
        out.trees, out.known, out.pending = [], {}, list(self.pending)
        return out

    def best(self, sums: np.ndarray) -> tuple | None:
        """(gain, feature, cut, values of both sides) of the best split of a node with sums (features, bins, 3)."""
        g = self.growth
        left = np.cumsum(sums, 1)[:, :-1]
        right = sums[0].sum(0) - left
        score = lambda x: x[..., 0] ** 2 / np.maximum(x[..., 1] + g.l2, 1e-12)
        gain = 0.5 * (score(left) + score(right) - score(sums[0].sum(0)))
        sound = (np.minimum(left[..., 1], right[..., 1]) >= g.least_hessian) & (np.minimum(left[..., 2], right[..., 2]) >= g.least_rows)
        allowed = np.zeros(self.features, bool)
        allowed[self.columns] = True
        gain = np.round(np.where(sound & allowed[:, None], gain, -1.0), 9)
        f, c = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[f, c] <= 1e-9:
            return None
        value = lambda x: float(-g.rate * x[0] / max(x[1] + g.l2, 1e-12))
        return float(gain[f, c]), int(f), int(c), (value(left[f, c]), value(right[f, c]))

    def take(self, sums: np.ndarray) -> None:
        """The sums of the open nodes: picks splits, opens their children, or ends the tree."""
        g = self.growth
        if self.open == [0]:
            whole = sums[0, 0].sum(0)
            self.tree.value[0] = float(-g.rate * whole[0] / max(whole[1] + g.l2, 1e-12))
        self.known.update({n: s for n, x in zip(self.open, sums) if (s := self.best(x)) is not None})
        chosen = sorted(self.known, key=lambda n: (-self.known[n][0], n))
        more = True
        if g.leaves is not None:
            room = g.leaves - 1 - len(self.tree.feature) // 2
            chosen = chosen[:-(-3 * room // 4)] if room else []
            more = room > len(chosen)
        self.level += 1
        self.open = [child for n in chosen for child in self.tree.split(n, *self.known.pop(n)[1:])]
        if not self.open or not more or (g.depth is not None and self.level >= g.depth):
            self.trees.append(self.tree)
            self.pending.append(self.tree)
            self._plant()


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of edges below it; missing values are in the lowest bin."""
    out = np.zeros(values.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, np.nan_to_num(values[:, f], nan=-np.inf), "left")
    return out


def feature_edges(df: DataFrame, features: Sequence[str], bins: int = BINS, error: float = 0.001) -> list[np.ndarray]:
    """At most ``bins - 1`` edges a feature: quantiles from one scan of mergeable sketches."""
    cuts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(features)]).approxQuantile(
        [f"c{i}" for i in range(len(features))], [i / bins for i in range(1, bins)], error)
    return [np.unique(np.array(c, float)) for c in cuts]


def _packed(edges: list[np.ndarray], start: list[float]):
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                values = np.stack([batch[f"c{i}"].to_numpy(zero_copy_only=False) for i in range(len(edges))], 1)
                margins = np.tile(np.array(start, np.float64), (n, 1))
                yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.binary()) for k, v in (
                    ("keys", batch["key"].to_numpy().tobytes()), ("labels", batch["label"].to_numpy().astype(np.uint8).tobytes()),
                    ("members", batch["members"].to_numpy().tobytes()), ("bins", binned(values, edges).tobytes()), ("margins", margins.tobytes()))})
    return run


def _arrays(batch: pa.RecordBatch, i: int, features: int, members: int):
    """The arrays of one block, without a copy."""
    keys, labels, training, bins, margins = (np.frombuffer(batch[c][i].as_buffer(), t) for c, t in (
        ("keys", np.int64), ("labels", np.uint8), ("members", np.int64), ("bins", np.uint8), ("margins", np.float64)))
    return keys, labels, training, bins.reshape(len(keys), features), margins.reshape(len(keys), members)


def _sums(block, m: Member, bins: int) -> np.ndarray | None:
    """(open nodes, features, bins, 3): gradients, curvatures and rows of a member in one block; features it may not use are 0."""
    keys, labels, training, binned_, margins = block
    used = np.flatnonzero((training >> m.training) & 1)
    if m.growth.rows < 1:
        used = used[drawn(keys[used], m.growth.rows, m.growth.seed, m.round)]
    rows = binned_[used]
    slot = np.full(len(m.tree.feature), -1)
    slot[m.open] = np.arange(len(m.open))
    at = slot[m.tree.leaf_of(rows)]
    if not (here := at >= 0).all():
        used, rows, at = used[here], rows[here], at[here]
    if not len(used):
        return None
    margin = margins[used, m.number] + sum((t.score(rows) for t in m.pending), np.zeros(len(used)))
    p, y = sigmoid(margin), labels[used]
    w = np.array(m.weights)[y]
    gradient, curvature = w * (p - y), w * p * (1 - p)
    out = np.zeros((len(m.open), m.features, bins, 3))
    for f in {0, *m.columns.tolist()}:  # the first feature gives the sums of the nodes
        cell = at * bins + rows[:, f]
        for j, x in enumerate((gradient, curvature, None)):
            out[:, f, :, j] = np.bincount(cell, x, len(m.open) * bins).reshape(len(m.open), bins)
    return out


def _scan(members: list[Member], bins: int, features: int, width: int):
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = _arrays(batch, i, features, width)
                for m in members:
                    if (s := _sums(block, m, bins)) is not None:
                        total[m.number] = total[m.number] + s if m.number in total else s
        if total:
            yield pa.RecordBatch.from_pydict({"member": pa.array(list(total), pa.int32()), "sums": pa.array([x.tobytes() for x in total.values()], pa.binary())})
    return run


def _added(key, table):
    parts = [np.frombuffer(x, np.float64) for x in table["sums"].to_pylist()]
    return pa.table({"member": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([np.sum(parts, 0).tobytes()], pa.binary())})


def _moved(pending: dict[int, list[Tree]], features: int, width: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                *_, bins, margins = _arrays(batch, i, features, width)
                margins = margins.copy()
                for number, trees in pending.items():
                    for t in trees:
                        margins[:, number] += t.score(bins)
                yield batch.slice(i, 1).set_column(batch.schema.get_field_index("margins"), "margins", pa.array([margins.tobytes()], pa.binary()))
    return run


def _dealt(edges: list[np.ndarray], members: list[Member]):
    """The rows of each member as blocks of their own."""
    def run(batches):
        for batch in batches:
            values = np.stack([batch[f"c{i}"].to_numpy(zero_copy_only=False) for i in range(len(edges))], 1)
            keys, labels, training = batch["key"].to_numpy(), batch["label"].to_numpy().astype(np.uint8), batch["members"].to_numpy()
            bins, found = binned(values, edges), []
            for m in members:
                used = np.flatnonzero((training >> m.training) & 1)
                if len(used):
                    found.append((m.number, *(x[used].tobytes() for x in (keys, labels, bins))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int32(), *[pa.binary()] * 3))], ["member", "keys", "labels", "bins"])
    return run


def _grow(m: Member, keys: np.ndarray, labels: np.ndarray, binned_: np.ndarray, bins: int) -> None:
    """All trees of a member whose rows are here. A row keeps its node, and what it adds to the sums, as long as a tree grows."""
    order = np.argsort(keys, kind="stable")  # however the rows arrived
    keys, labels, binned_ = keys[order], labels[order], binned_[order]
    columns, margin, w = np.ascontiguousarray(binned_.T), np.full(len(keys), m.start), np.array(m.weights)[labels]
    while not m.done:
        p, tree = sigmoid(margin), m.tree
        gradient, curvature = w * (p - labels), w * p * (1 - p)
        used = np.flatnonzero(drawn(keys, m.growth.rows, m.growth.seed, m.round)) if m.growth.rows < 1 else np.arange(len(keys))
        node = np.zeros(len(used), np.int64)
        while m.tree is tree:
            slot = np.full(len(tree.feature), -1)
            slot[m.open] = np.arange(len(m.open))
            at = slot[node]
            here = at >= 0  # the others are in nodes that have been looked at
            at, own = at[here] * bins, used[here]
            g, h = gradient[own], curvature[own]
            out = np.zeros((len(m.open), m.features, bins, 3))
            for f in {0, *m.columns.tolist()}:
                cell = at + columns[f, own]
                for j, x in enumerate((g, h, None)):
                    out[:, f, :, j] = np.bincount(cell, x, len(m.open) * bins).reshape(len(m.open), bins)
            m.take(out)
            if m.tree is tree:
                feature, cut, left = np.array(tree.feature), np.array(tree.cut), np.array(tree.left)
                split = feature[node] >= 0
                at = node[split]
                node[split] = left[at] + (binned_[used[split], feature[at]] > cut[at])
        margin += tree.score(binned_)


def _grown_in_tasks(members: list[Member], features: int, bins: int):
    """Takes the blocks of one member, gives its trees."""
    def run(batches):
        blocks: dict[int, list] = {}
        for batch in batches:
            for number, *block in zip(*(batch[c].to_pylist() for c in ("member", "keys", "labels", "bins"))):
                blocks.setdefault(number, []).append([np.frombuffer(x, t) for x, t in zip(block, (np.int64, np.uint8, np.uint8))])
        for number, parts in blocks.items():
            keys, labels, binned_ = (np.concatenate(c) for c in zip(*parts))
            m = members[number]
            _grow(m, keys, labels, binned_.reshape(len(keys), features), bins)
            yield pa.RecordBatch.from_pydict({"member": pa.array([number], pa.int32()), "trees": pa.array([pickle.dumps(m.trees)], pa.binary())})
    return run


@dataclass
class Booster:
    """A fitted member: scores arrays of feature values."""

    name: str
    start: float
    trees: list[Tree]
    edges: list[np.ndarray]

    def margin(self, values: np.ndarray) -> np.ndarray:
        bins = binned(values, self.edges)
        return self.start + sum((t.score(bins) for t in self.trees), np.zeros(len(bins)))

    def transform(self, df: DataFrame, features: Sequence[str], probability: str = "probability", prediction: str = "prediction") -> DataFrame:
        return scored(df, [self], F.lit(0), vector(features), probability, prediction)


def vector(features: Sequence[str]) -> Column:
    """Features as one array; null is NaN."""
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in features])


def scored(df: DataFrame, boosters: Sequence[Booster], which: Column, values: Column, probability: str = "probability", prediction: str = "prediction") -> DataFrame:
    """Adds the probability of class 1 and the 0/1 prediction by the booster whose number is ``which``, from an array of values."""
    boosters = list(boosters)

    @F.pandas_udf("double")
    def score(which: pd.Series, values: pd.Series) -> pd.Series:
        rows, chosen = np.stack(values.to_numpy()) if len(values) else np.zeros((0, len(boosters[0].edges))), which.to_numpy()
        out = np.zeros(len(rows))
        for i in np.unique(chosen):
            out[chosen == i] = sigmoid(boosters[i].margin(rows[chosen == i]))
        return pd.Series(out)
    return df.withColumn(probability, score(which.cast("int"), values)).withColumn(prediction, (F.col(probability) > 0.5).cast("int"))


def boost(df: DataFrame, features: Sequence[str], growths: Sequence[Growth], key: str, label: str = "label", training: Column | None = None,
          trainings: int = 1, bins: int = BINS, edges: list[np.ndarray] | None = None) -> dict[tuple[str, int], Booster]:
    """Boosters by (recipe, training set). Bit t of ``training`` says whether a row belongs to training set t (default: all in one).

    Classes of a training set weigh the same in total. ``key`` only seeds the drawing of rows: repeated and null keys are drawn
    together. Null and NaN features are in the lowest bin. A training set without rows, or of one class, gives its base rate.
    ``bins`` is 256 at most.
    """
    if not 2 <= bins <= 256 or trainings > 62:
        raise ValueError("2 to 256 bins, 62 training sets at most")
    edges = feature_edges(df, features, bins) if edges is None else edges
    rows = df.select(F.xxhash64(F.col(key)).alias("key"), F.col(label).cast("int").alias("label"), (F.lit(1) if training is None else training).cast("bigint").alias("members"),
                     *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"c{i}") for i, c in enumerate(features)])
    bit = [F.sum(F.shiftright("members", t).bitwiseAND(1)).cast("bigint") for t in range(trainings)]
    found = {r[0]: r[1:] for r in rows.groupBy("label").agg(*bit, F.count(F.lit(1))).collect()}
    members: list[Member] = []
    for growth in growths:
        for t in range(trainings):
            n = [found[c][t] or 0 if c in found else 0 for c in (0, 1)]
            weights = tuple(sum(n) / (2 * x) if x else 0.0 for x in n)
            start = 30.0 if n[1] and not n[0] else -30.0 if n[0] and not n[1] else 0.0  # classes weigh the same: even odds
            members.append(Member(growth, len(members), t, weights, start, len(features)))
            if not all(n):
                members[-1].growth = Growth(growth.name, 0)
    width = len(members)
    growing = [m for m in members if not m.done]
    if growing and max(sum(found[c][m.training] for c in (0, 1)) for m in growing) <= ROWS_IN_PART:
        dealt = rows.mapInArrow(_dealt(edges, growing), "member int, keys binary, labels binary, bins binary")
        grown = dealt.repartitionById(width, "member").mapInArrow(_grown_in_tasks(members, len(features), bins), "member int, trees binary")
        for row in grown.collect():  # one row a member: its trees, no rows of the data
            members[row["member"]].trees = pickle.loads(row["trees"])
        return {(m.growth.name, m.training): Booster(m.growth.name, m.start, m.trees, edges) for m in members}
    parts = partitions_for(df.sparkSession, sum(x[-1] for x in found.values()), ROWS_IN_PART)
    rows = rows.repartition(parts).sortWithinPartitions("members")
    blocks, spent, moves = cut_lineage(rows.mapInArrow(_packed(edges, [m.start for m in members]), _BLOCK)).persist(), [], 0
    while growing := [m for m in members if not m.done]:
        sums = blocks.mapInArrow(_scan([m.view() for m in growing], bins, len(features), width), "member int, sums binary")
        if parts > 1:  # with one part there is nothing to add up
            sums = sums.groupBy("member").applyInArrow(_added, "member int, sums binary")
        got = {row["member"]: row["sums"] for row in sums.collect()}  # one row a member: its open nodes, no rows of the data
        for m in growing:
            shape = (len(m.open), len(features), bins, 3)
            m.take(np.frombuffer(got[m.number], np.float64).reshape(shape) if m.number in got else np.zeros(shape))
        while spent:  # the scan has kept the blocks that replace these
            spent.pop().unpersist()
        if sum(len(m.pending) for m in members) >= len(growing) and any(not m.done for m in members):
            spent.append(blocks)
            blocks = blocks.mapInArrow(_moved({m.number: m.pending for m in members if m.pending}, len(features), width), _BLOCK)
            moves += 1
            blocks = (cut_lineage(blocks) if moves % TREES_BETWEEN == 0 else blocks).persist()
            for m in members:
                m.pending = []
    for kept in (*spent, blocks):
        kept.unpersist()
    return {(m.growth.name, m.training): Booster(m.growth.name, m.start, m.trees, edges) for m in members}
