"""Per-label threshold calibration over a grid.

One aggregation by label counts, for every grid value, predicted and true positives (2K + 1 sums a label, combined
map-side); the best threshold is picked inside the row.  No probability is joined with the grid and no histogram is read
again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def arange(start: float, stop: float, step: float) -> list[float]:
    """Grid values exactly as a float ``arange`` produces them."""
    n = int(math.ceil((stop - start) / step))
    delta = (start + step) - start
    return [start + i * delta for i in range(n)]


# Coarse grid used inside fitness, fine grid for calibration.
FIT_GRID = arange(0.10, 0.90, 0.10)
FINE_GRID = arange(0.10, 0.90, 0.05)
DEFAULT_THRESHOLD = 0.5


def f1_from_counts(tp: Column, pp: Column, ap: Column) -> Column:
    """F1 = 2tp / (pp + ap); 0 when the denominator is 0."""
    den = pp + ap
    return F.when(den > 0, F.lit(2.0) * tp / den).otherwise(F.lit(0.0))


def best_thresholds(scores: DataFrame, grid: list[float] = FINE_GRID, label: str = "label_id", p: str = "p",
                    y: str = "y", labels: DataFrame | None = None, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(label, threshold, f1) — best F1 per label, lowest threshold on ties,
    ``default`` (0.5) with F1 0 when no threshold gives a positive F1.

    ``labels`` (one column named ``label``) lists labels that must appear even
    when absent from ``scores``; otherwise the labels seen in ``scores``.
    """
    hit, real = [F.col(p) >= F.lit(t) for t in grid], F.col(y).cast("long")
    sums = [F.sum(h.cast("long")).alias(f"pp{k}") for k, h in enumerate(hit)] + [F.sum(F.when(h, real).otherwise(0)).alias(f"tp{k}") for k, h in enumerate(hit)]
    wide = scores.groupBy(label).agg(F.sum(real).alias("ap"), *sums)
    f1 = lambda k: f1_from_counts(F.col(f"tp{k}"), F.col(f"pp{k}"), F.col("ap"))
    best = F.array_max(F.array(*[F.struct(f1(k).alias("f1"), F.lit(-k).alias("k"), F.lit(t).alias("threshold")) for k, t in enumerate(grid)]))
    found = wide.select(label, best.alias("_b"))
    if labels is not None:
        found = labels.join(found, label, "left")
    good = F.col("_b.f1") > 0
    return found.select(label, F.when(good, F.col("_b.threshold")).otherwise(F.lit(default)).alias("threshold"),
                        F.when(good, F.col("_b.f1")).otherwise(F.lit(0.0)).alias("f1"))
