"""Validation against a drug/effect knowledge base.

Name tables and effect tables are joined as DataFrames; the suffix fallback
explodes a fixed number of candidate names per drug, so the lookup stays an
equi-join (broadcast when AQE finds the name table small) followed by one
``min_by`` per drug.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X

# Salt suffixes tried in this order when a full name is unknown.
SALT_SUFFIXES = [" HYDROCHLORIDE", " SODIUM", " POTASSIUM", " CALCIUM", " MESYLATE",
                 " MALEATE", " TARTRATE", " FUMARATE", " ACETATE", " SULFATE",
                 " CITRATE", " BESYLATE", " SUCCINATE"]
EFFECT_TYPE = "PT"
F1_EPS = 1e-9


def known_effects(effects: DataFrame) -> DataFrame:
    """F5 + P7 + J8: (stitch_flat, known array<string>) from PT rows, title-cased."""
    e = effects.where(F.col("meddra_type") == EFFECT_TYPE).select(
        "stitch_flat", X.py_title(X.strip_ws("side_effect")).alias("effect"))
    return e.groupBy("stitch_flat").agg(F.array_sort(F.collect_set("effect")).alias("known"))


def name_table(names: DataFrame, order: str = "row_order") -> DataFrame:
    """upper(strip(name)) -> id; on duplicate names the last row wins."""
    n = names.select(F.upper(X.strip_ws("drug_name")).alias("name"), "stitch_id", order)
    return n.groupBy("name").agg(F.max_by("stitch_id", F.col(order)).alias("stitch_id"))


def name_candidates(drugs: DataFrame, drug: str = "drug", suffixes: list[str] = SALT_SUFFIXES) -> DataFrame:
    """(drug, prio, cand): the full name (prio 0) and, for each matching
    suffix i (1-based, in order), the name with that one suffix removed."""
    up = F.upper(X.strip_ws(drug))
    cands = [F.struct(F.lit(0).alias("prio"), up.alias("cand"))]
    for i, suf in enumerate(suffixes, start=1):
        base = X.strip_ws(up.substr(F.lit(1), F.length(up) - F.lit(len(suf))))
        cands.append(F.when(up.endswith(suf), F.struct(F.lit(i).alias("prio"), base.alias("cand"))))
    arr = F.filter(F.array(*cands), lambda c: c.isNotNull())
    return drugs.select(drug, F.explode(arr).alias("_c")).select(drug, "_c.prio", "_c.cand")


def map_names(drugs: DataFrame, names: DataFrame, drug: str = "drug", with_suffixes: bool = True) -> DataFrame:
    """(drug, stitch_id, prio) — exact name first, else the first
    suffix whose removal resolves; null when nothing resolves."""
    table = name_table(names)
    cand = name_candidates(drugs.select(drug).distinct(), drug, SALT_SUFFIXES if with_suffixes else [])
    hit = cand.join(table, cand.cand == table.name, "inner")
    best = hit.groupBy(drug).agg(F.min_by(F.struct("stitch_id", "prio"), F.col("prio")).alias("_b"))
    return drugs.select(drug).distinct().join(best, drug, "left").select(
        drug, F.col("_b.stitch_id").alias("stitch_id"), F.col("_b.prio").alias("prio"))


def drug_scores(predicted: DataFrame, mapped: DataFrame, known: DataFrame, vocab: DataFrame,
                drug: str = "drug") -> DataFrame:
    """A14 (M10): per drug — stitch_found, known effects in vocabulary, predicted,
    tp, precision, recall, f1 (null when no known effect is in the vocabulary;
    precision 0 when nothing is predicted; +1e-9 in the F1 denominator)."""
    kl = known.select("stitch_flat", F.explode("known").alias("label"))
    kl = kl.join(vocab.select("label"), "label", "left_semi")  # J9: known effects inside the vocabulary
    kin = kl.groupBy("stitch_flat").agg(F.collect_list("label").alias("kin"))
    k = mapped.join(kin, mapped.stitch_id == kin.stitch_flat, "left").select(
        drug, "stitch_id", F.coalesce("kin", F.array().cast("array<string>")).alias("kin"))
    j = predicted.join(k, drug, "inner")
    tp = F.size(F.array_intersect("predicted", "kin"))
    n_pred = F.size("predicted")
    n_kin = F.size("kin")
    prec = F.when(n_kin > 0, F.when(n_pred > 0, tp / n_pred).otherwise(F.lit(0.0)))
    rec = F.when(n_kin > 0, tp / n_kin)
    f1 = F.when(n_kin > 0, F.lit(2.0) * prec * rec / (prec + rec + F.lit(F1_EPS)))
    return j.select(
        drug, F.col("stitch_id").isNotNull().alias("stitch_found"), n_kin.alias("effects_in_vocab"),
        n_pred.alias("n_predicted"), F.when(n_kin > 0, tp).otherwise(F.lit(0)).alias("tp"),
        prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
        F.array_join(F.array_sort("predicted"), "|").alias("predicted_effects"))


def validation_report(scores: DataFrame) -> DataFrame:
    """T4: drugs ordered by F1 (unscored last), then by number of predictions."""
    return scores.orderBy(F.desc_nulls_last("f1"), F.desc("n_predicted"), "drug")


def validation_summary(scores: DataFrame) -> DataFrame:
    """A15 + F9: means over drugs with a score, mapped and total counts."""
    return scores.agg(
        F.count(F.lit(1)).alias("n_drugs"),
        F.count("f1").alias("n_scored"),
        F.sum(F.col("stitch_found").cast("long")).alias("n_mapped"),
        F.avg("f1").alias("mean_f1"), F.avg("precision").alias("mean_precision"), F.avg("recall").alias("mean_recall"))


def outcome(pred: Column, known: Column) -> Column:
    """Hit / probable / no evidence / —."""
    return (F.when(pred & known, F.lit("hit")).when(~pred & known, F.lit("probable"))
            .when(pred & ~known, F.lit("no evidence")).otherwise(F.lit("—")))


def compare_topk(probs: DataFrame, known_in_vocab: DataFrame, k: int = 15, key: str = "drug",
                 label: str = "label") -> DataFrame:
    """M11 (W9 + P17): the k most probable labels per key with their outcome.
    probs: (key, label, p, predicted); known_in_vocab: (key, label)."""
    w = Window.partitionBy(key).orderBy(F.desc("p"), F.asc(label))
    top = probs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    kn = known_in_vocab.select(key, label, F.lit(True).alias("_known"))
    t = top.join(kn, [key, label], "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    return t.withColumn("outcome", outcome(F.col("predicted"), F.col("_known"))).withColumnRenamed("_known", "known")


def missed_effects(known_in_vocab: DataFrame, top: DataFrame, key: str = "drug", label: str = "label") -> DataFrame:
    """Known effects (in vocabulary) that are not among the top-k."""
    return known_in_vocab.join(top.select(key, label), [key, label], "left_anti")


def set_scores(probs: DataFrame, top: DataFrame, known_in_vocab: DataFrame, key: str = "drug",
               label: str = "label") -> DataFrame:
    """Precision / recall of the predicted set and of the top-k set vs known."""
    kn = known_in_vocab.select(key, label, F.lit(1).alias("_k"))
    pred = probs.where("predicted").select(key, label).join(kn, [key, label], "left").groupBy(key).agg(
        F.count(F.lit(1)).alias("n_pred"), F.count("_k").alias("tp_pred"))
    tk = top.select(key, label).join(kn, [key, label], "left").groupBy(key).agg(
        F.count(F.lit(1)).alias("n_top"), F.count("_k").alias("tp_top"))
    nk = known_in_vocab.groupBy(key).agg(F.count(F.lit(1)).alias("n_known"))
    j = nk.join(pred, key, "left").join(tk, key, "left").fillna(0)
    return j.select(
        key, "n_known",
        X.safe_div(F.col("tp_pred").cast("double"), F.col("n_pred")).alias("precision_pred"),
        X.safe_div(F.col("tp_pred").cast("double"), F.col("n_known")).alias("recall_pred"),
        X.safe_div(F.col("tp_top").cast("double"), F.col("n_top")).alias("precision_top"),
        X.safe_div(F.col("tp_top").cast("double"), F.col("n_known")).alias("recall_top"))
