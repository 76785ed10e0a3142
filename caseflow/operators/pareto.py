"""Pareto analysis for two maximised objectives.

Different points are numbered twice: ``r`` by (first, second) objective downwards and ``s`` by (second, first).  One point
dominates another exactly when both of its numbers are smaller, whatever ties the objectives have.  Both numberings are cut
into strips of ``STRIP`` points, so a row strip, a column strip and a cell where two of them meet hold that many points at most,
however the points lie.

* Dominators are counted inside the row strip, inside the column strip, and by a table of cell totals for all cells before both.
* Fronts go over the cells in waves, one anti-diagonal after the other, its cells in parallel.  A cell gets the fronts reached
  before it as two step functions (along its rows and along its columns) and hands them on to its two neighbours; each wave is
  written, so a lost executor costs a part of one wave.

Points that fit one strip are one cell in one task.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, scratch_path, written
from . import split as SP

STRIP = 1_000_000  # points of a strip: bounds what a task holds
POINT, RIGHT, DOWN = 0, 1, 2  # rows of a wave: a point's front, a step for the cell to the right, a step for the cell below


def steps(at: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step function of the running maximum of ``height`` over places ``at``: its places upwards and its heights there."""
    order = np.lexsort((-height, at))
    at, height = at[order], height[order]
    up = height > np.concatenate([[0], np.maximum.accumulate(height)[:-1]]) if len(at) else np.zeros(0, bool)
    return at[up], height[up]


def _height(places: np.ndarray, heights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Height of a step function just before each place (0 before the first step)."""
    return np.concatenate([[0], heights])[np.searchsorted(places, at, "left")]


def cell_fronts(r: np.ndarray, s: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Fronts of a cell's points, ``r`` upwards, none below ``least``.

    ``low[k]`` is the smallest ``s`` met so far on front ``k`` or beyond; it never falls with ``k``, so the entries smaller than a
    point's ``s`` are the fronts that dominate it.
    """
    front = np.empty(len(r), np.int64)
    low: list[int] = []
    for n, (at, floor) in enumerate(zip(s.tolist(), least.tolist())):
        reached = bisect_left(low, at)
        k = max(reached, floor)
        low[reached:k + 1] = [at] * (k + 1 - reached)
        front[n] = k
    return front


def weight_before(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each place of a permutation: total weight of earlier places with a smaller value (halving the places, sorted by value)."""
    n = len(value)
    total = np.zeros(n, np.int64)
    place = np.argsort(value, kind="stable")
    for bit in range(max(n - 1, 0).bit_length() - 1, -1, -1):
        block = place >> (bit + 1)
        left = (place >> bit) & 1 == 0
        seen = np.cumsum(np.where(left, weight[place], 0))
        first = np.concatenate([[True], block[1:] != block[:-1]])
        before = np.where(first, seen - np.where(left, weight[place], 0), 0)
        seen = seen - np.maximum.accumulate(before)
        total[place[~left]] += seen[~left]
        place = place[np.argsort(place >> bit, kind="stable")]
    return total


def rank_points(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Front and number of dominators of each row of (n, 2) maximised objectives, all in memory."""
    points, row, weight = np.unique(at, axis=0, return_inverse=True, return_counts=True)
    by_r = np.lexsort((-points[:, 1], -points[:, 0]))
    s = np.empty(len(points), np.int64)
    s[np.lexsort((-points[:, 0], -points[:, 1]))] = np.arange(len(points))
    front, beaten = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    front[by_r] = cell_fronts(by_r, s[by_r], np.zeros(len(points), np.int64))
    beaten[by_r] = weight_before(s[by_r], weight[by_r].astype(np.int64))
    return front[row.reshape(-1)], beaten[row.reshape(-1)]


def _numbered(points: DataFrame, strip: int) -> DataFrame:
    """Different points (a, b, w rows each) with both numbers, both strips and the wave of their cell."""
    by_r = SP.global_rank(points, [F.desc("a"), F.desc("b")]).withColumnRenamed("_rank", "r")
    both = SP.global_rank(by_r, [F.desc("b"), F.desc("a")]).withColumnRenamed("_rank", "s")
    return both.withColumns({"i": F.floor(F.col("r") / strip), "j": F.floor(F.col("s") / strip)}).withColumn("wave", F.col("i") + F.col("j"))


def _dominators(points: DataFrame, n_strips: int) -> DataFrame:
    """(r, n_dominators) of numbered points: own row strip, own column strip from earlier row strips, cells before both."""
    def in_rows(strip: pd.DataFrame) -> pd.DataFrame:
        strip = strip.sort_values("r")
        return pd.DataFrame({"r": strip["r"], "n": weight_before(strip["s"].to_numpy(), strip["w"].to_numpy())})

    def in_columns(strip: pd.DataFrame) -> pd.DataFrame:
        strip = strip.sort_values("s", ignore_index=True)
        value = np.empty(len(strip), np.int64)
        value[np.lexsort((-strip["s"].to_numpy(), strip["i"].to_numpy()))] = np.arange(len(strip))  # a point's own row strip does not count
        return pd.DataFrame({"r": strip["r"], "n": weight_before(value, strip["w"].to_numpy())})

    narrow = points.select("r", "s", "i", "j", "w")
    schema = "r long, n long"
    totals = narrow.groupBy("i", "j").agg(F.sum("w").alias("w"))
    cells = F.broadcast(totals) if n_strips <= 1000 else totals  # at most n_strips squared rows
    grid = (points.sparkSession.range(n_strips * n_strips)
            .select(F.floor(F.col("id") / n_strips).alias("i"), (F.col("id") % n_strips).alias("j")).join(cells, ["i", "j"], "left"))
    along = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("j").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.withColumn("w", F.sum("w").over(along)).select("i", "j", F.coalesce(F.sum("w").over(down), F.lit(0)).alias("n"))
    far = narrow.join(before, ["i", "j"]).select("r", "n")
    parts = [narrow.groupBy("i").applyInPandas(in_rows, schema), narrow.groupBy("j").applyInPandas(in_columns, schema), far]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("r").agg(F.sum("n").alias("n_dominators"))


def _fronts(points: DataFrame, n_strips: int, strip: int) -> DataFrame:
    """(r, front) of numbered points, wave after wave."""
    spark = points.sparkSession
    schema = "kind int, i long, j long, at long, height long"

    def cell(key: tuple, inside: pd.DataFrame, borders: pd.DataFrame) -> pd.DataFrame:
        i, j = key
        inside = inside.sort_values("r")
        r, s = inside["r"].to_numpy(np.int64), inside["s"].to_numpy(np.int64)
        rows, columns = (steps(b["at"].to_numpy(np.int64), b["height"].to_numpy(np.int64))
                         for b in (borders[borders["kind"] == RIGHT], borders[borders["kind"] == DOWN]))
        front = cell_fronts(r, s, np.maximum(_height(*rows, r), _height(*columns, s)))
        out = [pd.DataFrame({"kind": POINT, "i": i, "j": j, "at": r, "height": front})]
        for kind, own, other, at, start, to in ((RIGHT, rows, columns, r, i * strip - 1, (i, j + 1)), (DOWN, columns, rows, s, j * strip - 1, (i + 1, j))):
            # what the other border ends with holds from the start of this one on
            place, height = steps(np.concatenate([own[0], at, [start]]), np.concatenate([own[1], front + 1, other[1][-1:] if len(other[1]) else [0]]))
            if max(to) < n_strips:
                out.append(pd.DataFrame({"kind": kind, "i": to[0], "j": to[1], "at": place, "height": height}))
        return pd.concat(out, ignore_index=True).astype({"kind": np.int32})

    folder = scratch_path(spark, "fronts")
    table = scratch_path(spark, "cells")
    points.select("r", "s", "i", "j", "wave").repartition("i", "j").write.partitionBy("wave").parquet(table)
    cells = spark.read.schema("r long, s long, i long, j long, wave long").parquet(table)
    last = spark.createDataFrame([], schema)
    for wave in range(2 * n_strips - 1):
        here = cells.where(F.col("wave") == wave).drop("wave").groupBy("i", "j")
        there = last.where(F.col("kind") != POINT).groupBy("i", "j")
        here.cogroup(there).applyInPandas(cell, schema).write.parquet(f"{folder}/wave={wave}")
        last = spark.read.schema(schema).parquet(f"{folder}/wave={wave}")
    return (spark.read.schema(schema + ", wave long").parquet(folder).where(F.col("kind") == POINT)
            .select(F.col("at").alias("r"), F.col("height").cast("int").alias("front")))


def pareto_rank(points: DataFrame, key: str = "ind", objs: tuple[str, str] = ("o1", "o2"), strip: int = STRIP) -> DataFrame:
    """W6 + J12: add ``front`` (0 = non-dominated) and ``n_dominators`` to any number of points.

    Equal points do not dominate each other and share their front.  A point with a null or NaN objective is compared with none:
    both columns are null.  Other columns (the key's too) pass through; an empty table gives an empty table.  Over more than one
    strip there are two waves a strip, so the time of a set far larger than a population grows with its number of strips.
    """
    a, b = (F.col(o).cast("double") for o in objs)
    known = a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b)
    if points.limit(strip + 1).count() <= strip:
        def run(batches):
            whole = pd.concat(list(batches), ignore_index=True)
            at = whole[list(objs)].to_numpy(dtype=np.float64)
            full = ~np.isnan(at).any(1)
            front, beaten = rank_points(at[full])
            yield whole.assign(front=pd.Series(front, np.flatnonzero(full)).reindex(whole.index).astype("Int32"),
                               n_dominators=pd.Series(beaten, np.flatnonzero(full)).reindex(whole.index).astype("Int64"))

        added = [T.StructField("front", T.IntegerType()), T.StructField("n_dominators", T.LongType())]
        return points.coalesce(1).mapInPandas(run, T.StructType([*points.schema.fields, *added]))
    ensure_checkpoint_dir(points.sparkSession)
    points = written(points, "points")
    different = points.where(known).groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("w"))
    numbered = written(_numbered(different, strip), "numbered")
    n_strips = -(-numbered.count() // strip)
    if n_strips == 0:
        return points.withColumns({"front": F.lit(None).cast("int"), "n_dominators": F.lit(None).cast("long")})
    placed = (numbered.select("a", "b", "r").join(_fronts(numbered, n_strips, strip), "r").join(_dominators(numbered, n_strips), "r")
              .select(F.col("a").alias("_a"), F.col("b").alias("_b"), "front", "n_dominators"))
    return points.join(placed, (a == F.col("_a")) & (b == F.col("_b")) & known, "left").drop("_a", "_b")


def crowding(ranked: DataFrame, key: str = "ind", objs: tuple[str, ...] = ("o1", "o2"), front: str = "front") -> DataFrame:
    """Crowding distance within each front; ends of every objective get inf,
    inner points (next - previous) / span; a zero span adds nothing."""
    inf = F.lit(float("inf"))
    total = None
    for o in objs:
        w = Window.partitionBy(front).orderBy(F.col(o), F.col(key))
        wa = Window.partitionBy(front)
        rn = F.row_number().over(w)
        cnt = F.count(F.lit(1)).over(wa)
        span = F.max(o).over(wa) - F.min(o).over(wa)
        gap = F.lead(o).over(w) - F.lag(o).over(w)
        term = F.when((rn == 1) | (rn == cnt), inf).when(span > 0, gap / span).otherwise(F.lit(0.0))
        total = term if total is None else total + term
    return ranked.withColumn("crowd", total)


def survivors(ranked_crowded: DataFrame, n: int, key: str = "ind") -> DataFrame:
    """Whole fronts first, the last front by crowding (desc); ties by key; points without a front come last."""
    return ranked_crowded.orderBy(F.asc_nulls_last("front"), F.desc("crowd"), F.col(key)).limit(n)


def front_stats(ranked: DataFrame, objs: tuple[str, ...] = ("o1", "o2")) -> DataFrame:
    """A19 (front form): size of front 0, maximum and mean of each objective over all points."""
    return ranked.agg(F.sum((F.col("front") == 0).cast("long")).alias("front0_size"),
                      *[f(o).alias(f"{name}_{o}") for o in objs for name, f in (("max", F.max), ("mean", F.avg))])
