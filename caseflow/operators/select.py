"""Linear oracle and binary feature selection.

The Gram matrices XᵀX and XᵀY are the only pass over the data: each Arrow
batch contributes a k x k and a k x L partial sum, combined by one
aggregation.  Every mask then needs only a k' x k' solve on the driver (k is
the feature width, bounded by the model), and the validation scores of all
masks of a generation come from one more pass.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import calibrate as CAL
from . import step as ST
from .evolve import _dense_y, fitness_np
from .sums import array_total, collected_total

# Binary search configuration.
POP = 40
GENS = 30
TOURNEY_K = 3
P_CROSS = 0.9
P_MUT = 0.03
ELITES = 2
PARSIMONY = 0.04
RIDGE_ALPHA = 5.0
SEED = 42


def _blocks(pdf: pd.DataFrame, features: str, labels: str, n_labels: int, rows: int = 1024):
    """(X, Y) of a batch in blocks of rows, which bounds what a block of scores for many masks takes."""
    for at in range(0, len(pdf), rows):
        part = pdf.iloc[at:at + rows]
        x = np.stack([np.asarray(v, dtype=np.float64) for v in part[features].to_numpy()])
        yield x, _dense_y(part[labels], len(part), n_labels)


def gram_total(data: DataFrame, k: int, n_labels: int, features: str = "features", labels: str = "labels") -> DataFrame:
    """One row ``acc`` with XᵀX, XᵀY, the column sums of X and the row count, end to end."""

    def run(batches):
        xx, xy, sx, n = np.zeros((k, k)), np.zeros((k, n_labels)), np.zeros(k), 0
        for pdf in batches:
            for x, y in _blocks(pdf, features, labels, n_labels):
                xx += x.T @ x
                xy += x.T @ y
                sx += x.sum(0)
                n += len(x)
        if n:
            yield pd.DataFrame({"acc": [np.concatenate([xx.ravel(), xy.ravel(), sx, [n]]).tolist()]})

    return array_total(data.select(features, labels).mapInPandas(run, "acc array<double>"), k * k + k * n_labels + k + 1)


def gram_parts(data: DataFrame, k: int, n_labels: int, features: str = "features", labels: str = "labels") -> DataFrame:
    """Long (block, i, j, value) sums of XᵀX (block 'xx') and XᵀY (block 'xy')."""
    cell = gram_total(data, k, n_labels, features, labels).select(F.posexplode("acc").alias("at", "value")).where(F.col("at") < k * (k + n_labels))
    inside = F.col("at") < k * k
    at, width = F.when(inside, F.col("at")).otherwise(F.col("at") - k * k), F.when(inside, k).otherwise(n_labels)
    return cell.select(F.when(inside, "xx").otherwise("xy").alias("block"), F.floor(at / width).cast("int").alias("i"),
                       (at % width).cast("int").alias("j"), "value")


def gram_arrays(data: DataFrame, k: int, n_labels: int, features: str = "features", labels: str = "labels"):
    """(XᵀX, XᵀY, column sums, rows) as arrays: bounded by the feature width."""
    acc = np.asarray(gram_total(data, k, n_labels, features, labels).first()["acc"])
    xx, xy, sx, n = np.split(acc, np.cumsum([k * k, k * n_labels, k]))
    return xx.reshape(k, k), xy.reshape(k, n_labels), sx, int(n[0])


def ridge_weights(xx: np.ndarray, xy: np.ndarray, cols: np.ndarray | None = None, alpha: float = RIDGE_ALPHA) -> np.ndarray:
    """W = (XᵀX + αI)⁻¹ XᵀY on the chosen columns (no intercept)."""
    if cols is not None:
        xx = xx[np.ix_(cols, cols)]
        xy = xy[cols]
    return np.linalg.solve(xx + alpha * np.eye(xx.shape[0]), xy)


def apply_mask(df: DataFrame, mask: list[bool] | np.ndarray, features: str = "features", out: str | None = None) -> DataFrame:
    """keep the feature positions whose mask bit is set (fixed positions:
    an array projection, no shuffle)."""
    keep = [i for i, b in enumerate(mask) if b]
    arr = F.array(*[F.element_at(features, i + 1) for i in keep]) if keep else F.array().cast("array<double>")
    return df.withColumn(out or features, arr)


def zscore(scores: DataFrame, label: str = "label_id", s: str = "score", out: str = "z") -> DataFrame:
    """Per-label z-score (population std, +1e-9)."""
    stats = scores.groupBy(label).agg(F.avg(s).alias("_m"), F.stddev_pop(s).alias("_sd"))
    return scores.join(F.broadcast(stats), label).withColumn(
        out, (F.col(s) - F.col("_m")) / (F.col("_sd") + F.lit(1e-9))).drop("_m", "_sd")


def mask_fitness(val: DataFrame, masks: np.ndarray, train_gram, val_gram, n_labels: int, grid: list[float] = CAL.FIT_GRID,
                 alpha: float = RIDGE_ALPHA, parsimony: float = PARSIMONY, features: str = "features",
                 labels: str = "labels") -> tuple[np.ndarray, np.ndarray]:
    """(fitness, f1) for every mask in one pass over the validation rows.

    A mask's weights come from the training Gram submatrix.  Its scores' mean and deviation per label (A22) follow from
    the validation Gram matrix, w·mean(x) and wᵀ(XᵀX / n)w, so no pass is needed for them; the pass counts z-scored,
    squashed scores by label and grid bucket.  Fitness is the mean best F1 less ``parsimony`` times the share of features
    used; an empty mask scores 0.
    """
    k = masks.shape[1]
    weights = np.zeros((len(masks), k, n_labels))
    for w, mask in zip(weights, masks):
        cols = np.flatnonzero(mask)
        if len(cols):
            w[cols] = ridge_weights(train_gram[0], train_gram[1], cols, alpha)
    xx, _, sx, n = val_gram
    mean = np.einsum("k,mkl->ml", sx / max(n, 1), weights)
    square = np.einsum("mkl,kj,mjl->ml", weights, xx / max(n, 1), weights, optimize=True)
    spread = np.sqrt(np.maximum(square - mean ** 2, 0.0)) + 1e-9
    shared = val.sparkSession.sparkContext.broadcast((weights, mean, spread))
    cuts, cells = np.asarray(grid), n_labels * (len(grid) + 1)
    first_cell = np.arange(n_labels) * (len(grid) + 1)

    def run(batches):
        w_, mean_, spread_ = shared.value
        seen = np.zeros((2, len(w_), cells))
        for pdf in batches:
            for x, y in _blocks(pdf, features, labels, n_labels):
                for m, w in enumerate(w_):
                    z = np.clip((x @ w - mean_[m]) / spread_[m], -30.0, 30.0)
                    cell = (np.searchsorted(cuts, 1.0 / (1.0 + np.exp(-z)), side="right") + first_cell).ravel()
                    seen[0, m] += np.bincount(cell, minlength=cells)
                    seen[1, m] += np.bincount(cell, weights=y.ravel(), minlength=cells)
        if seen.any():
            yield pd.DataFrame({"acc": [seen.ravel().tolist()]})

    parts = val.select(features, labels).mapInPandas(run, "acc array<double>")
    counts, hits = collected_total(parts, 2 * len(masks) * cells).reshape(2, len(masks), n_labels, -1)
    shared.unpersist()
    used = masks.mean(axis=1)
    f1 = np.where(used > 0, fitness_np(counts, hits), 0.0)
    return np.where(used > 0, f1 - parsimony * used, 0.0), f1


STEP = ST.StepConfig(tournament_k=TOURNEY_K, p_crossover=P_CROSS, p_mutation=P_MUT, elitism=ELITES)


def feature_select(train: DataFrame, val: DataFrame, k: int, n_labels: int, pop: int = POP, gens: int = GENS, seed: int = SEED,
                   features: str = "features", labels: str = "labels"):
    """Search over feature masks.  Returns (best mask, its fitness, F1 of all features, history).

    History rows: generation, best fitness of the population, F1 and feature count of the best mask so far.
    """
    grams = [gram_arrays(d, k, n_labels, features, labels) for d in (train, val)]
    score = lambda masks: mask_fitness(val, masks, *grams, n_labels, features=features, labels=labels)
    masks = ST.uniform(seed, "mask", 0, np.arange(pop), np.arange(k)) < 0.5
    fitness, f1 = score(np.concatenate([masks, np.ones((1, k), bool)]))  # the last row is the base line
    base, fitness, f1 = float(f1[-1]), fitness[:-1], f1[:-1]
    best = None
    history = []
    for gen in range(gens + 1):
        if gen:
            masks = ST.next_masks(masks, fitness, STEP, seed, gen)
            fitness, f1 = score(masks)
        top = ST.by_fitness(fitness)[0]
        if best is None or fitness[top] > best[1]:
            best = masks[top].copy(), float(fitness[top]), float(f1[top])
        if gen:
            history.append((gen, float(fitness[top]), best[2], int(best[0].sum())))
    return best[0], best[1], base, history
