"""Connection-weight feature importance.

importance(i) = sum_h |W1[i, h]| * sum_o |W2[h, o]| — computed from the
genome's long form: one aggregation for the hidden influence, one join on
the hidden unit, one aggregation per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .score import NetShape


def importance(genes: DataFrame, shape: NetShape, names: DataFrame | None = None) -> DataFrame:
    """genes: (gene, value) of one genome -> (feature_id, importance[, feature])."""
    a = shape.d * shape.h
    b = a + shape.h
    c = b + shape.h * shape.o
    w1 = genes.where(F.col("gene") < a).select(
        (F.col("gene") / shape.h).cast("int").alias("feature_id"), (F.col("gene") % shape.h).cast("int").alias("h"),
        F.abs("value").alias("w"))
    w2 = genes.where((F.col("gene") >= b) & (F.col("gene") < c)).select(
        ((F.col("gene") - b) / shape.o).cast("int").alias("h"), F.abs("value").alias("w"))
    infl = w2.groupBy("h").agg(F.sum("w").alias("infl"))
    imp = w1.join(F.broadcast(infl), "h").groupBy("feature_id").agg(F.sum(F.col("w") * F.col("infl")).alias("importance"))
    if names is not None:
        imp = imp.join(names, "feature_id", "left")
    return imp


def top_features(imp: DataFrame, k: int = 20) -> DataFrame:
    """K most important features (ties by feature id), ranked 1..k."""
    top = imp.orderBy(F.desc("importance"), "feature_id").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature_id")))
