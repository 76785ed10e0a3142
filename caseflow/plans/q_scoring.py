"""Queries: scoring, threshold calibration, metrics, per-case outcomes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import calibrate as CAL
from ..operators import evolve as EV
from ..operators import metrics as M
from ..operators import score as SC
from ..sources.driver_views import SCORE_VIEW_DUCKDB, read_table, view
from .registry import query

SCORE_WITH = f"WITH c_score AS ({SCORE_VIEW_DUCKDB})"
SENSITIVITIES = [0.1, 0.25, 0.5, 0.75, 1.0]
TOPK = 3
# Network used on the embeddings: 64 inputs -> 8 hidden -> 10 outputs.
EMB_SHAPE = SC.NetShape(64, 8, 10)
SEED = 42


def thresholds_sql() -> str:
    """Brute force: every label x every grid value, best F1, lowest on ties, 0.5 if none > 0."""
    return f"""cnt AS (
        SELECT s.label_id, g.k, g.t,
               sum(CASE WHEN s.p >= g.t THEN 1 ELSE 0 END) AS pp,
               sum(CASE WHEN s.p >= g.t AND s.y = 1 THEN 1 ELSE 0 END) AS tp,
               sum(s.y) AS ap
        FROM c_score s, {S.FINE_GRID} GROUP BY s.label_id, g.k, g.t),
    f AS (SELECT *, CASE WHEN pp + ap > 0 THEN 2.0::DOUBLE * tp / (pp + ap) ELSE 0.0::DOUBLE END AS f1 FROM cnt),
    b AS (SELECT label_id, t, f1, row_number() OVER (PARTITION BY label_id ORDER BY f1 DESC, k ASC) AS rn FROM f),
    thr AS (SELECT label_id, CASE WHEN f1 > 0 THEN t ELSE 0.5 END AS threshold,
                   CASE WHEN f1 > 0 THEN f1 ELSE 0.0 END AS f1 FROM b WHERE rn = 1)"""


PRED_SQL = """pred AS (SELECT s.case_id, s.label_id, s.y, s.p, s.p >= t.threshold AS pred
                       FROM c_score s JOIN thr t ON s.label_id = t.label_id)"""


def calibrated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    scores = view(spark, sf_dir, "c_score")
    thr = CAL.best_thresholds(scores, CAL.FINE_GRID)
    return scores, thr


@query("calibrate_thresholds", "M7 A18 J11", SCORE_WITH + ", " + thresholds_sql() + """
       SELECT CAST(label_id AS INTEGER) AS label_id, threshold, f1 FROM thr""")
def q_calibrate(spark, sf_dir):
    return calibrated(spark, sf_dir)[1]


@query("label_prf", "A6 A7 P15", SCORE_WITH + ", " + thresholds_sql() + ", " + PRED_SQL + """
       SELECT CAST(label_id AS INTEGER) AS label_id,
              CAST(sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
              CAST(sum(CASE WHEN pred THEN 1 ELSE 0 END) AS BIGINT) AS pp,
              CAST(sum(y) AS BIGINT) AS ap,
              CASE WHEN sum(CASE WHEN pred THEN 1 ELSE 0 END) > 0
                   THEN sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END)::DOUBLE / sum(CASE WHEN pred THEN 1 ELSE 0 END)
                   ELSE 0.0 END AS precision,
              CASE WHEN sum(y) > 0 THEN sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END)::DOUBLE / sum(y) ELSE 0.0 END AS recall,
              CASE WHEN sum(CASE WHEN pred THEN 1 ELSE 0 END) + sum(y) > 0
                   THEN 2.0::DOUBLE * sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END) / (sum(CASE WHEN pred THEN 1 ELSE 0 END) + sum(y))
                   ELSE 0.0 END AS f1
       FROM pred GROUP BY label_id""")
def q_label_prf(spark, sf_dir):
    scores, thr = calibrated(spark, sf_dir)
    return M.label_prf(SC.predict_flags(scores, thr))


@query("metrics_summary", "A8 A9 A10 A11", SCORE_WITH + ", " + thresholds_sql() + ", " + PRED_SQL + """,
       lab AS (SELECT label_id, sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
                      sum(CASE WHEN pred THEN 1 ELSE 0 END)::DOUBLE AS pp, sum(y)::DOUBLE AS ap FROM pred GROUP BY label_id),
       lm AS (SELECT avg(CASE WHEN pp + ap > 0 THEN 2 * tp / (pp + ap) ELSE 0 END) AS f1_macro,
                     avg(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END) AS precision_macro,
                     avg(CASE WHEN ap > 0 THEN tp / ap ELSE 0 END) AS recall_macro,
                     CASE WHEN sum(pp) + sum(ap) > 0 THEN 2 * sum(tp) / (sum(pp) + sum(ap)) ELSE 0 END AS f1_micro,
                     (sum(pp) + sum(ap) - 2 * sum(tp)) / (SELECT count(*) FROM pred) AS hamming_loss FROM lab),
       cs AS (SELECT case_id, sum(CASE WHEN pred AND y = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
                     sum(CASE WHEN pred THEN 1 ELSE 0 END)::DOUBLE AS pp, sum(y)::DOUBLE AS ap FROM pred GROUP BY case_id),
       cm AS (SELECT avg(CASE WHEN pp + ap > 0 THEN 2 * tp / (pp + ap) ELSE 0 END) AS f1_samples FROM cs)
       SELECT round(f1_macro, 6) AS f1_macro, round(f1_micro, 6) AS f1_micro, round(f1_samples, 6) AS f1_samples,
              round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro,
              round(hamming_loss, 6) AS hamming_loss FROM lm, cm""")
def q_metrics_summary(spark, sf_dir):
    scores, thr = calibrated(spark, sf_dir)
    s = M.summary(SC.predict_flags(scores, thr))
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


def _ids(arr: str) -> str:
    return f"array_to_string(list_sort({arr}), '|')"


@query("case_outcomes", "U2 A12 M9", SCORE_WITH + ", " + thresholds_sql() + ", " + PRED_SQL + f"""
       SELECT case_id,
              {_ids("coalesce(list(label_id) FILTER (WHERE y = 1), [])")} AS real,
              {_ids("coalesce(list(label_id) FILTER (WHERE pred), [])")} AS predicted,
              {_ids("coalesce(list(label_id) FILTER (WHERE pred AND y = 1), [])")} AS tp,
              {_ids("coalesce(list(label_id) FILTER (WHERE pred AND y = 0), [])")} AS fp,
              {_ids("coalesce(list(label_id) FILTER (WHERE NOT pred AND y = 1), [])")} AS fn,
              CAST(count(*) FILTER (WHERE y = 1) AS INTEGER) AS n_real,
              CAST(count(*) FILTER (WHERE pred) AS INTEGER) AS n_predicted,
              CAST(count(*) FILTER (WHERE pred AND y = 1) AS INTEGER) AS n_hits,
              round(max(p), 6) AS max_p
       FROM pred GROUP BY case_id""")
def q_case_outcomes(spark, sf_dir):
    scores, thr = calibrated(spark, sf_dir)
    out = M.case_outcomes(SC.predict_flags(scores, thr))
    for c in ("real", "predicted", "tp", "fp", "fn"):
        out = out.withColumn(c, F.array_join(F.col(c).cast("array<string>"), "|"))
    return out.withColumn("max_p", F.round("max_p", 6))


@query("outcome_summary", "A13 F7", SCORE_WITH + ", " + thresholds_sql() + ", " + PRED_SQL + """,
       cs AS (SELECT case_id, count(*) FILTER (WHERE y = 1) AS n_real, count(*) FILTER (WHERE pred) AS n_pred,
                     count(*) FILTER (WHERE pred AND y = 1) AS n_hits FROM pred GROUP BY case_id)
       SELECT count(*) AS n_cases, CAST(count(*) FILTER (WHERE n_hits > 0) AS BIGINT) AS n_with_hit,
              round(avg(CASE WHEN n_hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
              round(avg(n_real), 6) AS mean_real, round(avg(n_pred), 6) AS mean_predicted FROM cs""")
def q_outcome_summary(spark, sf_dir):
    scores, thr = calibrated(spark, sf_dir)
    s = M.outcome_summary(M.case_outcomes(SC.predict_flags(scores, thr)))
    return s.select("n_cases", "n_with_hit", *[F.round(c, 6).alias(c) for c in ("hit_rate", "mean_real", "mean_predicted")])


@query("topk_labels", "W9 T1", SCORE_WITH + f"""
       SELECT case_id, CAST(rank AS INTEGER) AS rank, label_id, round(p, 6) AS p FROM (
           SELECT case_id, label_id, p, row_number() OVER (PARTITION BY case_id ORDER BY p DESC, label_id) AS rank
           FROM c_score) WHERE rank <= {TOPK}""")
def q_topk_labels(spark, sf_dir):
    t = SC.topk_labels(view(spark, sf_dir, "c_score"), TOPK)
    return t.select("case_id", F.col("rank").cast("int").alias("rank"), "label_id", F.round("p", 6).alias("p"))


@query("sensitivity", "P15 P16", SCORE_WITH + ", " + thresholds_sql() + """
       SELECT """ + ", ".join(
    f"CAST(sum(CASE WHEN s.p >= greatest(0.0, least(1.0, t.threshold * {1.5 - v!r})) THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS n_s{int(round(v * 100)):03d}" for v in SENSITIVITIES) + """
       FROM c_score s JOIN thr t ON s.label_id = t.label_id""")
def q_sensitivity(spark, sf_dir):
    scores, thr = calibrated(spark, sf_dir)
    return SC.sensitivity_counts(scores, thr, SENSITIVITIES)


def genes_sql(shape: SC.NetShape, seed: int, ind_sql: str = "0", n_ind: int = 1, scale: float = 1.0) -> str:
    """E3 in SQL: (ind, gene, w) for n_ind individuals, hash normals x segment std."""
    std = EV.segment_std_sql(shape, "gene", scale)
    return f"""SELECT i.ind, g.gene, {S.hash_normal(seed, "'init'", '0', 'i.ind', 'g.gene')} * {std} AS w
               FROM (SELECT range AS ind FROM range(0, {n_ind})) i, (SELECT range AS gene FROM range(0, {shape.n_params})) g"""


def forward_sql(shape: SC.NetShape, x_table: str, w_table: str) -> str:
    """Long-form forward pass: x_table(case_id, i, v), w_table(ind, gene, w) -> (ind, case_id, k, p)."""
    d, h, o = shape.d, shape.h, shape.o
    a, b, c = d * h, d * h + h, d * h + h + h * o
    return f"""
    w1 AS (SELECT ind, gene // {h} AS i, gene % {h} AS j, w FROM {w_table} WHERE gene < {a}),
    b1 AS (SELECT ind, gene - {a} AS j, w FROM {w_table} WHERE gene >= {a} AND gene < {b}),
    w2 AS (SELECT ind, (gene - {b}) // {o} AS j, (gene - {b}) % {o} AS k, w FROM {w_table} WHERE gene >= {b} AND gene < {c}),
    b2 AS (SELECT ind, gene - {c} AS k, w FROM {w_table} WHERE gene >= {c}),
    hz AS (SELECT w1.ind, x.case_id, w1.j, sum(x.v * w1.w) AS z FROM {x_table} x JOIN w1 ON x.i = w1.i GROUP BY ALL),
    ha AS (SELECT hz.ind, hz.case_id, hz.j, greatest(0.0, hz.z + b1.w) AS a FROM hz JOIN b1 ON hz.ind = b1.ind AND hz.j = b1.j),
    oz AS (SELECT ha.ind, ha.case_id, w2.k, sum(ha.a * w2.w) AS z FROM ha JOIN w2 ON ha.ind = w2.ind AND ha.j = w2.j GROUP BY ALL),
    prob AS (SELECT oz.ind, oz.case_id, oz.k, {S.sigmoid('oz.z + b2.w')} AS p FROM oz JOIN b2 ON oz.ind = b2.ind AND oz.k = b2.k)"""


EMB_X = """x AS (SELECT vec_id AS case_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS i,
                        CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"""


def embedding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("case_id"), F.col("embedding").cast("array<double>").alias("features"), "label")


@query("forward_pass", "M6 P20 E3", f"""WITH w AS ({genes_sql(EMB_SHAPE, SEED)}), {EMB_X}, {forward_sql(EMB_SHAPE, 'x', 'w')}
       SELECT case_id, CAST(k AS INTEGER) AS label_id, round(p, 6) AS p FROM prob""")
def q_forward_pass(spark, sf_dir):
    pop = EV.init_population(spark, EMB_SHAPE, 1, SEED)
    genome = np.asarray(pop.where("ind = 0").first()["genome"])
    scored = SC.score(embedding_features(spark, sf_dir), genome, EMB_SHAPE, keep=["case_id"])
    return SC.long_probs(scored, "case_id").select("case_id", "label_id", F.round("p", 6).alias("p"))
