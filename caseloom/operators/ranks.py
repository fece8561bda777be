"""Ordered running totals, exact quantiles, row numbers and hash-ordered parts without a one-task window.

The order of a whole table is never handed to a single task. Rows are first collapsed to distinct values, Spark's
range partitioning cuts the (group, value) order into cells of about equal size, each cell is summed on its own and
the few cell totals are turned into offsets. A value that holds a third of all rows is one row after the first step,
and a group that holds a third of all values is spread over a third of the cells. The same path runs at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.functions.scalar import HASH_BITS, seeded_hash
from caseloom.session import cut_lineage, written

CELL = "_cell"
HASH_CELL_BITS = 20
#: bits that ``monotonically_increasing_id`` has for the place in a partition
_PLACE_BITS = 33
BROADCAST_ROWS = 10_000


def small_side(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written table for broadcast if it was counted to have at most ``rows`` rows, else leaves the join to Spark."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def settle(counts: DataFrame, value: str, group: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """The table with the number of its cell in ``_cell``: runs of neighbours in the order of group and value.

    Equal (group, value) pairs share a cell. There are ``spark.sql.shuffle.partitions`` cells, of which AQE joins small
    ones, unless ``cells`` says how many. The cut is sampled, so the table is checkpointed with it: every later
    reader, and a recomputed task, sees the same cells, and what the table was aggregated from is scanned once.
    """
    order = [F.col(c) for c in (*group, value)]
    cut = counts.repartitionByRange(cells, *order) if cells else counts.repartitionByRange(*order)
    return cut_lineage(cut.withColumn(CELL, F.spark_partition_id()))


def prefix_sums(counts: DataFrame, value: str, measures: Sequence[str], group: Sequence[str] = (),
                cells: int | None = None, settled: bool = False) -> DataFrame:
    """Adds ``below_<m>`` (sum over rows of the same group with a smaller value) and ``total_<m>`` per measure.

    ``counts`` should hold one row per (group, value). Rows with equal values are ordered arbitrarily. ``settled`` says
    that the caller has settled the table already, by the same group and value.
    """
    group = list(group)
    celled = counts if settled else settle(counts, value, group, cells)
    before = W.partitionBy(*group, CELL).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    local = celled.select("*", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_in_{m}") for m in measures])
    # a cell holds a run of the order: there are at most as many totals as cells and groups together
    per_cell = celled.groupBy(*group, CELL).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = W.partitionBy(*group).orderBy(CELL).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(*group)
    offsets = per_cell.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col(CELL).alias("_at"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_off_{m}") for m in measures],
        *[F.sum(m).over(everything).alias(f"total_{m}") for m in measures])
    match = local[CELL] == offsets["_at"]
    for g in group:
        match = match & local[g].eqNullSafe(offsets[f"_g_{g}"])
    return local.join(offsets, match).select(
        *[c for c in celled.columns if c != CELL],
        *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"below_{m}") for m in measures],
        *[f"total_{m}" for m in measures])


def weighted_quantiles(counts: DataFrame, value: str, weight: str, probs: dict[str, float],
                       group: Sequence[str] = (), method: str = "linear", cells: int | None = None,
                       extra: Sequence[Column] = (), carry: Sequence[str] = (), settled: bool = False) -> DataFrame:
    """Exact quantiles of a (group, value, weight) table, where ``weight`` says how often the value occurs.

    ``linear`` interpolates between neighbours; ``lower`` takes the value at rank floor(p * (n - 1)). One row per
    group with one column per entry of ``probs`` (name to probability), and the ``extra`` aggregates of the table,
    which may use ``total_<c>``, the group's sum of each column in ``carry``. Rows of weight 0 take no part in the
    quantiles.
    """
    group = list(group)
    placed = prefix_sums(counts, value, [weight, *carry], group, cells, settled)
    below, size, width = F.col(f"below_{weight}"), F.col(f"total_{weight}"), F.col(weight)

    def at(index: Column) -> Column:
        return F.max(F.when((below <= index) & (index < below + width), F.col(value)))

    aggregates, results = [], []
    for name, p in probs.items():
        position = F.lit(float(p)) * (size - 1)
        low = F.floor(position)
        aggregates.append(at(low).alias(f"_lo_{name}"))
        if method == "lower":
            results.append(F.col(f"_lo_{name}").alias(name))
            continue
        aggregates += [at(F.ceil(position)).alias(f"_hi_{name}"), F.max(position - low).alias(f"_w_{name}")]
        lo, hi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        results.append((lo + (hi - lo) * F.col(f"_w_{name}")).alias(name))
    out = placed.groupBy(*group).agg(*aggregates, *extra)
    named = [c for c in out.columns if c not in group and not c.startswith("_")]
    return out.select(*group, *results, *named)


def quantiles(df: DataFrame, value: str, probs: dict[str, float], group: Sequence[str] = (),
              method: str = "linear", cells: int | None = None) -> DataFrame:
    """Exact quantiles of a column per group; NULLs are left out."""
    counts = (df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_n")))
    return weighted_quantiles(counts, "_v", "_n", probs, group, method, cells)


def number_rows(df: DataFrame, key: str, out: str = "row_number", block: str | None = None,
                blocks: Sequence | None = None, cells: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 in the order of a unique numeric ``key``.

    With ``block`` the numbers run through the listed blocks one after the other, each ordered by the key. Without, the rows are
    shuffled and written once: a row's place in its cell is known when it is written.
    """
    if block is None:
        ranged = df.repartitionByRange(cells, F.col(key)) if cells else df.repartitionByRange(F.col(key))
        placed = written(ranged.sortWithinPartitions(key).withColumn("_place", F.monotonically_increasing_id()), "numbered")
        cell = F.shiftright("_place", _PLACE_BITS)
        sizes = placed.groupBy(cell.alias(CELL)).agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(W.orderBy(CELL).rowsBetween(W.unboundedPreceding, -1))
        starts = cut_lineage(sizes.select(CELL, F.coalesce(before, F.lit(0)).alias("_before")))  # one row a cell
        inside = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1).cast("bigint"))
        return placed.join(small_side(starts), cell == F.col(CELL)).select(*[F.col(f"`{c}`") for c in df.columns], (inside + F.col("_before") + 1).cast("bigint").alias(out))
    group = [block] if block else []
    celled = settle(df.withColumn("_one", F.lit(1).cast("bigint")), key, group, cells)
    placed = prefix_sums(celled, key, ["_one"], group, settled=True)
    start = F.lit(0)
    if block:
        sizes = {r[0]: r[1] for r in celled.where(F.col(block).isin(list(blocks))).groupBy(block).count().collect()}
        begin, branch = 0, None
        for name in blocks:
            hit = F.col(block) == name
            branch = F.when(hit, begin) if branch is None else branch.when(hit, begin)
            begin += sizes.get(name, 0)
        start = branch
    return placed.withColumn(out, (start + F.col("below__one") + 1).cast("bigint")).drop(
        "_one", "below__one", "total__one")


@dataclass
class HashParts:
    """Cut points of the seeded hash order per class, as a table (_cut_label, _cuts)."""

    key: list[str]
    label: str
    seed: int
    cuts: DataFrame

    def transform(self, df: DataFrame, out: str, closed: bool = False) -> DataFrame:
        """Adds the part number, 0 .. number of cuts; rows of a class not seen by ``fit`` get NULL.

        A row at a cut starts the next part, or, if ``closed``, ends the one before.
        """
        hashed = df.withColumn("_hash", seeded_hash(self.key, self.seed))
        known = hashed.join(small_side(self.cuts), F.col(self.label).eqNullSafe(F.col("_cut_label")), "left")
        part = F.size(F.filter("_cuts", lambda cut: F.col("_hash") > cut if closed else F.col("_hash") >= cut))
        return known.withColumn(out, F.when(F.col("_cuts").isNotNull(), part)).drop("_hash", "_cut_label", "_cuts")


def hash_parts(df: DataFrame, key: str | Sequence[str], label: str, starts: Sequence[Column], seed: int = 42) -> HashParts:
    """Finds, per class, the hash value at each rank in ``starts`` (expressions over the class size ``n``).

    The first pass counts rows per hash prefix; only the rows of the prefixes that hold a wanted rank, about one in a
    million of the class each, are ever sorted. Copies of a key always land in the same part. The classes and their
    cuts stay in tables, whatever their number.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.select(F.col(label).alias("_label"), seeded_hash(keys, seed).alias("_hash")).withColumn(
        CELL, F.shiftright("_hash", HASH_BITS - HASH_CELL_BITS))
    per_cell = hashed.groupBy("_label", CELL).agg(F.count(F.lit(1)).alias("_n"))
    run = W.partitionBy("_label").orderBy(CELL)
    placed = per_cell.select(
        "*", F.coalesce(F.sum("_n").over(run.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_below"),
        F.sum("_n").over(W.partitionBy("_label")).alias("n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), s.cast("bigint").alias("rank"))
                                 for i, s in enumerate(starts)]))
    rank, below = F.col("_w.rank"), F.col("_below")
    found = cut_lineage(
        placed.select("_label", CELL, "_below", "_n", "n", wanted.alias("_w"))
        .where((rank >= below) & (rank < below + F.col("_n")) | ((rank >= F.col("n")) & (below == 0)))
        .select(F.col("_label").alias("_l"), F.col(CELL).alias("_c"), "_w.i",
                F.when(rank < F.col("n"), rank - below + 1).alias("_at")))
    inner = found.where(F.col("_at").isNotNull())
    same = F.col("_label").eqNullSafe(F.col("_l")) & (F.col(CELL) == F.col("_c"))
    boundary = hashed.join(small_side(inner.select("_l", "_c").distinct()), same, "left_semi")
    ranked = boundary.withColumn("_r", F.row_number().over(W.partitionBy("_label", CELL).orderBy("_hash")))
    exact = ranked.join(small_side(inner), same & (F.col("_r") == F.col("_at"))).select("_l", "i", "_hash")
    beyond = found.where(F.col("_at").isNull()).select("_l", "i", F.lit(1 << HASH_BITS).cast("bigint").alias("_hash"))
    cuts = exact.union(beyond).groupBy(F.col("_l").alias("_cut_label")).agg(
        F.sort_array(F.collect_list(F.struct("i", "_hash"))).alias("_by_start"))  # one entry per start, not per row
    return HashParts(keys, label, seed, cut_lineage(cuts.select("_cut_label", F.col("_by_start._hash").alias("_cuts"))))
