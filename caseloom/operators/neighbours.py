"""Exact nearest neighbours of points among themselves, without comparing all pairs.

Points are dealt to the nearest of a few pivots of their cell, and cells that are still too large are dealt again, until every
cell is bounded: the cells form a tree that lies in tables, level by level. Each point first finds its nearest neighbours in its
own cell; their distance bounds how far a better one can be, and only the branches that can hold one (by the triangle inequality
and by the bisector between pivots) are followed down to other cells. Nothing is left out: the result equals brute force.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.functions.scalar import seeded_hash
from caseloom.operators.reshape import union_all
from caseloom.session import cut_lineage

POINTS_PER_CELL = 2048
PIVOTS_PER_CELL = 64
ROWS_PER_GROUP = 20_000
_BLOCK = 512
_BLOCK_CELLS = 8_000_000
_SLACK = 1e-9


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences, so that equal points are at exactly 0."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(out)


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(-1, width)


def _rows(a: np.ndarray) -> pd.Series:
    return pd.Series(list(a), dtype=object)


def _top(queries: pd.DataFrame, points: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """The k nearest points of each query, the query itself excluded; equal distances go by id."""
    order = points["id"].to_numpy().argsort(kind="stable")
    ids, m = points["id"].to_numpy()[order], points["m"].to_numpy()[order]
    b, a, own = _matrix(points["x"], width)[order], _matrix(queries["x"], width), queries["id"].to_numpy()
    parts = []
    step = max(1, min(_BLOCK, _BLOCK_CELLS // max(1, len(b))))
    for start in range(0, len(a), step):
        block = slice(start, start + step)
        d = _distances(a[block], b)
        d[own[block, None] == ids[None, :]] = np.inf
        best = d.argsort(axis=1, kind="stable")[:, :k]
        dist = np.take_along_axis(d, best, axis=1)
        row, col = np.nonzero(np.isfinite(dist))
        at = best[row, col]
        parts.append((own[block][row], ids[at], dist[row, col], m[at], b[at]))
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0), np.empty(0), np.empty(0), np.empty(0), np.empty((0, width))]
    return pd.DataFrame({"id": columns[0], "nid": columns[1], "d": columns[2], "m": columns[3], "x": _rows(columns[4])})


_FOUND = "id bigint, nid bigint, d double, m bigint, x array<double>"


def nearest_points(points: DataFrame, width: int, k: int, seed: int = 42, cells: int | None = None) -> DataFrame:
    """Adds ``near``: the k nearest other points as structs (d, nid, m, x), nearest first.

    ``points`` has a unique ``id``, distinct vectors ``x`` and weights ``m``. A cell has ``POINTS_PER_CELL`` points at most, or as
    many as ``cells`` equal cells would have; there is no bound on the number of cells or levels.
    """
    points = cut_lineage(points)  # what follows reads the points several times
    most = POINTS_PER_CELL if cells is None else max(1, -(-points.count() // cells))
    slim, levels = _cells(points.select("id", "x", "m"), width, most, seed)
    inside = cut_lineage(slim.groupBy("cell").applyInPandas(lambda p: _top(p, p, width, k), _FOUND))
    found = inside.unionByName(_elsewhere(slim, inside, levels, width, k)) if levels else inside
    best = (found.withColumn("_r", F.row_number().over(W.partitionBy("id").orderBy("d", "nid"))).where(F.col("_r") <= k)
            .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("d", "nid", "m", "x"))).alias("near")))
    empty = F.array().cast("array<struct<d: double, nid: bigint, m: bigint, x: array<double>>>")
    return points.join(best, "id", "left").withColumn("near", F.coalesce("near", empty))


def _salted(rows: DataFrame, beside: DataFrame, key: str, rows_in_group: int = ROWS_PER_GROUP) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``salt``: ``rows`` of one key are dealt to groups of bounded size, and each group has a copy of what stands
    ``beside`` them. The counts stay in a table."""
    beside = beside.select(*[F.col(c).alias(c) for c in beside.columns])  # columns of its own, where both come from one table
    groups = cut_lineage(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows_in_group).alias("_groups")))
    dealt = rows.join(groups, key).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("_groups"))).drop("_groups")
    copied = beside.join(groups, key).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_groups") - 1))).drop("_groups")
    return dealt, copied


def _cells(slim: DataFrame, width: int, most: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """(id, x, m, cell) with at most ``most`` points a cell, and per level the table (cell, child, pivot, radius, leaf)."""
    def deal(p: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        pivots = pivots.sort_values("number")
        x, centres = _matrix(p["x"], width), _matrix(pivots["pivot"], width)
        parts = [_distances(x[i:i + _BLOCK], centres) for i in range(0, len(x), _BLOCK)]
        at = np.concatenate([d.argmin(axis=1) for d in parts]) if parts else np.zeros(0, int)
        own = np.concatenate([d.min(axis=1) for d in parts]) if parts else np.zeros(0)
        child = pivots["child"].to_numpy()[at]
        return pd.DataFrame({"id": p["id"], "x": p["x"], "m": p["m"], "cell": child, "own": own, "parent": p["cell"], "pivot": _rows(centres[at])})

    done, levels = [], []
    rows = slim.withColumn("cell", F.lit("")).withColumn("n", F.lit(slim.count()).cast("bigint"))
    while True:
        large = rows.where(F.col("n") > most).drop("n")
        done.append(rows.where(F.col("n") <= most).drop("n"))
        if large.isEmpty():
            break
        rank = F.row_number().over(W.partitionBy("cell").orderBy(seeded_hash("id", seed), "id"))
        pivots = large.withColumn("number", rank).where(F.col("number") <= PIVOTS_PER_CELL).select(
            "cell", "number", F.concat("cell", F.lit("/"), F.col("number").cast("string")).alias("child"), F.col("x").alias("pivot"))
        dealt, beside = _salted(large, cut_lineage(pivots), "cell")
        assigned = cut_lineage(dealt.groupBy("cell", "salt").cogroup(beside.groupBy("cell", "salt")).applyInPandas(
            deal, "id bigint, x array<double>, m bigint, cell string, own double, parent string, pivot array<double>"))
        children = assigned.groupBy("parent", F.col("cell").alias("child")).agg(F.first("pivot").alias("pivot"), F.max("own").alias("radius"), F.count(F.lit(1)).alias("n"))
        children = cut_lineage(children)
        levels.append(children.select(F.col("parent").alias("cell"), "child", "pivot", "radius", (F.col("n") <= most).alias("leaf")))
        rows = assigned.select("id", "x", "m", "cell").join(children.select(F.col("child").alias("cell"), "n"), "cell").select("id", "x", "m", "cell", "n")
    return cut_lineage(union_all(done)), levels


def _elsewhere(slim: DataFrame, inside: DataFrame, levels: list[DataFrame], width: int, k: int) -> DataFrame:
    """Neighbours in other cells than the own one, as far as they can be nearer than those found inside."""
    def follow(q: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
        x, pivots, radius = _matrix(q["x"], width), _matrix(children["pivot"], width), children["radius"].to_numpy()
        names, leaf, own = children["child"].to_numpy(), children["leaf"].to_numpy(), q["own"].to_numpy()
        between, parts = _distances(pivots, pivots), []
        for i in range(0, len(x), _BLOCK):
            block = slice(i, i + _BLOCK)
            d = _distances(x[block], pivots)
            near = d.argmin(axis=1)
            gap = between[near]
            with np.errstate(divide="ignore", invalid="ignore"):
                bisector = np.where(gap > 0, (d ** 2 - d[np.arange(len(d)), near][:, None] ** 2) / (2 * gap), 0.0)
            ask = np.maximum(d - radius[None, :], bisector) <= q["ub"].to_numpy()[block, None] * (1 + _SLACK) + _SLACK
            row, child = np.nonzero(ask & ~(leaf[None, :] & (names[None, :] == own[block, None])))
            parts.append((row + i, child))
        row, child = (np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, int) for j in range(2))
        return pd.DataFrame({"id": q["id"].to_numpy()[row], "x": pd.Series(q["x"].to_numpy()[row], dtype=object), "ub": q["ub"].to_numpy()[row],
                             "own": own[row], "cell": names[child], "leaf": leaf[child]})

    # no bound yet for a point with fewer than k others in its cell
    reach = inside.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.max("d").alias("d"))
    ub = F.when(F.col("c") >= k, F.col("d")).otherwise(float("inf"))
    asking = slim.join(reach, "id", "left").select("id", "x", ub.alias("ub"), F.col("cell").alias("own"), F.lit("").alias("cell"))
    queries = []
    for children in levels:
        dealt, beside = _salted(asking, children, "cell")
        followed = cut_lineage(dealt.groupBy("cell", "salt").cogroup(beside.groupBy("cell", "salt")).applyInPandas(
            follow, "id bigint, x array<double>, ub double, own string, cell string, leaf boolean"))
        queries.append(followed.where("leaf").select("id", "x", "cell"))
        asking = followed.where("NOT leaf").drop("leaf")

    def answer(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        return _top(q, p, width, k)
    dealt, copied = _salted(union_all(queries), slim, "cell")
    return dealt.groupBy("cell", "salt").cogroup(copied.groupBy("cell", "salt")).applyInPandas(answer, _FOUND)
