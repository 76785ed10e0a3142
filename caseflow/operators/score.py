"""Batch scoring with a one-hidden-layer network.

The network is small (genome = d*h + h + h*o + o doubles), so weights travel
with the task closure while cases stream through Arrow batches: each batch
is one matrix product per layer.  Everything else (thresholds, top-k,
sensitivity) stays in built-in expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr as X


@dataclass(frozen=True)
class NetShape:
    """Genome layout: [W1 (d x h, row-major) | b1 (h) | W2 (h x o) | b2 (o)]."""

    d: int
    h: int
    o: int

    @property
    def n_params(self) -> int:
        return self.d * self.h + self.h + self.h * self.o + self.o

    def segments(self) -> list[tuple[str, int, int]]:
        """(name, first gene, gene count) per block."""
        a = self.d * self.h
        b = a + self.h
        c = b + self.h * self.o
        return [("W1", 0, a), ("b1", a, self.h), ("W2", b, self.h * self.o), ("b2", c, self.o)]

    def unpack(self, genome: np.ndarray) -> list[np.ndarray]:
        """The blocks as arrays, in genome order; weight blocks as matrices."""
        width = {"W1": (self.d, self.h), "W2": (self.h, self.o)}
        genes = np.asarray(genome, dtype=np.float64)
        return [genes[at:at + count].reshape(width.get(name, count)) for name, at, count in self.segments()]


def forward(x: np.ndarray, genome: np.ndarray, shape: NetShape) -> np.ndarray:
    """sigmoid(relu(x W1 + b1) W2 + b2), input to the sigmoid clipped to +-30."""
    w1, b1, w2, b2 = shape.unpack(genome)
    hidden = np.maximum(0.0, x @ w1 + b1)
    z = np.clip(hidden @ w2 + b2, -X.SIGMOID_CLIP, X.SIGMOID_CLIP)
    return 1.0 / (1.0 + np.exp(-z))


def score(df: DataFrame, genome, shape: NetShape, features: str = "features", keep: list[str] | None = None,
          out: str = "probs") -> DataFrame:
    """M6: add ``out`` = probability array (length o) for every row of ``df``."""
    keep = keep if keep is not None else [c for c in df.columns if c != features]
    g = np.asarray(genome, dtype=np.float64)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches):
        import pyarrow as pa

        for rb in batches:
            flat = rb.column(len(keep)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            probs = forward(flat.reshape(rb.num_rows, shape.d), g, shape)
            ends = pa.array(np.arange(rb.num_rows + 1, dtype=np.int32) * shape.o)
            yield pa.RecordBatch.from_arrays([*rb.columns[:len(keep)], pa.ListArray.from_arrays(ends, pa.array(probs.ravel()))],
                                             names=[*keep, out])

    return df.select(*keep, features).mapInArrow(run, schema)


def long_probs(scored: DataFrame, key: str, probs: str = "probs") -> DataFrame:
    """(key, label_id, p) from a probability array (dense case x label form)."""
    return scored.select(key, F.posexplode(probs).alias("label_id", "p")).withColumn(
        "label_id", F.col("label_id").cast("int"))


def predict_flags(long_scores: DataFrame, thresholds: DataFrame, label: str = "label_id") -> DataFrame:
    """Add ``pred`` = p >= threshold[label].  ``thresholds`` has one row per
    label (bounded by the model's output width), so it is broadcast."""
    return long_scores.join(F.broadcast(thresholds.select(label, "threshold")), label, "inner").withColumn(
        "pred", F.col("p") >= F.col("threshold"))


def adjusted_threshold(t, sensitivity: float):
    """Threshold x (1.5 - s) clipped to [0, 1]; s = 0.5 keeps it."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t * F.lit(1.5 - sensitivity)))


def sensitivity_counts(long_scores: DataFrame, thresholds: DataFrame, values: list[float],
                       label: str = "label_id") -> DataFrame:
    """Number of predicted (case, label) pairs at each sensitivity value — one pass."""
    j = long_scores.join(F.broadcast(thresholds.select(label, "threshold")), label, "inner")
    aggs = [F.sum((F.col("p") >= adjusted_threshold(F.col("threshold"), s)).cast("long")).alias(f"n_s{int(round(s * 100)):03d}")
            for s in values]
    return j.agg(*aggs)


def topk_labels(long_scores: DataFrame, k: int, key: str = "case_id", label: str = "label_id") -> DataFrame:
    """The k most probable labels per case (ties by label id), with rank 1..k."""
    w = Window.partitionBy(key).orderBy(F.desc("p"), F.asc(label))
    return long_scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
