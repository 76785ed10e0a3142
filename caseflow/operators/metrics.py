"""Multi-label metrics over a long (case, label, y, pred) table.

Per-label counts are one aggregation keyed on the label (L groups, combined
map-side); per-case counts one aggregation keyed on the case.  Neither
gathers a group's rows: only sums travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import safe_div


def label_counts(pred: DataFrame, label: str = "label_id", y: str = "y", flag: str = "pred") -> DataFrame:
    """Per label tp, predicted positives (pp), actual positives (ap), n."""
    yp = F.col(y).cast("long")
    pr = F.col(flag).cast("long")
    return pred.groupBy(label).agg(
        F.sum(yp * pr).alias("tp"), F.sum(pr).alias("pp"), F.sum(yp).alias("ap"), F.count(F.lit(1)).alias("n"))


def label_prf(pred: DataFrame, label: str = "label_id", y: str = "y", flag: str = "pred") -> DataFrame:
    """Precision, recall, F1 per label; every zero denominator -> 0."""
    c = label_counts(pred, label, y, flag)
    return c.select(
        label, "tp", "pp", "ap",
        safe_div(F.col("tp").cast("double"), F.col("pp")).alias("precision"),
        safe_div(F.col("tp").cast("double"), F.col("ap")).alias("recall"),
        safe_div(F.lit(2.0) * F.col("tp"), F.col("pp") + F.col("ap")).alias("f1"),
    )


def summary(pred: DataFrame, key: str = "case_id", label: str = "label_id", y: str = "y", flag: str = "pred",
            n_labels: int | None = None) -> DataFrame:
    """Macro F1 / precision / recall, micro F1, samples F1, Hamming loss.

    Macro means are over all labels (zeros included); pass ``n_labels`` when
    some labels may be absent from ``pred``.  The input must be dense (one row
    per case and label) for the Hamming denominator.
    """
    c = label_counts(pred, label, y, flag)
    prf = c.select(
        "tp", "pp", "ap", "n",
        safe_div(F.col("tp").cast("double"), F.col("pp")).alias("precision"),
        safe_div(F.col("tp").cast("double"), F.col("ap")).alias("recall"),
        safe_div(F.lit(2.0) * F.col("tp"), F.col("pp") + F.col("ap")).alias("f1"),
    )
    nl = F.lit(float(n_labels)) if n_labels else F.count(F.lit(1)).cast("double")
    per_label = prf.agg(
        (F.sum("f1") / nl).alias("f1_macro"),
        (F.sum("precision") / nl).alias("precision_macro"),
        (F.sum("recall") / nl).alias("recall_macro"),
        safe_div(F.lit(2.0) * F.sum("tp"), F.sum("pp") + F.sum("ap")).alias("f1_micro"),
        F.sum(F.col("pp") + F.col("ap") - F.lit(2) * F.col("tp")).alias("_wrong"),
        F.sum("n").alias("_cells"),
    )
    yp = F.col(y).cast("long")
    pr = F.col(flag).cast("long")
    per_case = pred.groupBy(key).agg(F.sum(yp * pr).alias("tp"), F.sum(pr).alias("pp"), F.sum(yp).alias("ap")).agg(
        F.avg(safe_div(F.lit(2.0) * F.col("tp"), F.col("pp") + F.col("ap"))).alias("f1_samples"))
    # two one-row aggregates side by side: union then pick the non-null value
    both = per_label.unionByName(per_case, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("f1_macro", "f1_micro", "f1_samples", "precision_macro", "recall_macro",
                                      "_wrong", "_cells")])
    return both.select("f1_macro", "f1_micro", "f1_samples", "precision_macro", "recall_macro",
                       (F.col("_wrong") / F.col("_cells")).alias("hamming_loss"))


def case_outcomes(pred: DataFrame, key: str = "case_id", label: str = "label_id", y: str = "y",
                  flag: str = "pred", p: str = "p") -> DataFrame:
    """U2 + A12 + M9: per case real / predicted / TP / FP / FN sets and counts, and the highest probability
    where the table has probabilities."""
    top = [F.max(p).alias("max_p")] if p in pred.columns else []
    lab = F.col(label)
    yes = F.col(y) == 1
    on = F.col(flag)
    return pred.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(yes, lab))).alias("real"),
        F.array_sort(F.collect_list(F.when(on, lab))).alias("predicted"),
        F.array_sort(F.collect_list(F.when(yes & on, lab))).alias("tp"),
        F.array_sort(F.collect_list(F.when(~yes & on, lab))).alias("fp"),
        F.array_sort(F.collect_list(F.when(yes & ~on, lab))).alias("fn"),
        *top,
    ).select(key, "real", "predicted", "tp", "fp", "fn", *["max_p"] * len(top),
             F.size("real").alias("n_real"), F.size("predicted").alias("n_predicted"), F.size("tp").alias("n_hits"))


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """A13 + F7: cases, cases with a hit, hit rate, mean real and predicted counts."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("n_cases"),
        F.sum((F.col("n_hits") > 0).cast("long")).alias("n_with_hit"),
        F.avg((F.col("n_hits") > 0).cast("double")).alias("hit_rate"),
        F.avg("n_real").alias("mean_real"),
        F.avg("n_predicted").alias("mean_predicted"),
    )
