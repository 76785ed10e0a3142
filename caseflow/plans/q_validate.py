"""Queries: knowledge-base name mapping, validation, comparison, reporting.

Predicted effects per drug come from the assembled cases: the share of a
drug's cases that report each label (a co-occurrence scorer over the whole
case table); a label is predicted when the share reaches 0.3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import labels as L
from ..operators import validate as V
from ..session import written
from ..sources.driver_views import view
from . import sqlcte as Q
from .q_cases import TEST_MIN_FREQ, cases_from_views
from .registry import query

SHARE = 0.3
TOP_DRUGS = 30
TOP_LABELS = 15


def drug_label_probs(cases: DataFrame, vocab: DataFrame, top: DataFrame, share: float = SHARE) -> DataFrame:
    """(drug, label, p, predicted): share of the drug's cases reporting the label, for the drugs of ``top`` (TOP_DRUGS
    rows, so it is broadcast and the other drugs' rows go before anything is counted)."""
    dc = cases.select("primaryid", F.explode("drug").alias("drug"), "reactions").join(F.broadcast(top), "drug", "left_semi")
    n_drug = dc.groupBy("drug").agg(F.count(F.lit(1)).alias("n_cases"))
    dl = (dc.select("drug", F.explode("reactions").alias("label"))
          .join(L.dimension(vocab.select("label")), "label", "left_semi")
          .groupBy("drug", "label").agg(F.count(F.lit(1)).alias("n")))
    return dl.join(n_drug, "drug").select("drug", "label", (F.col("n") / F.col("n_cases")).alias("p")).withColumn(
        "predicted", F.col("p") >= F.lit(share))


def _validation_parts(spark: SparkSession, sf_dir: str):
    cases = written(cases_from_views(spark, sf_dir), "cases")
    vocab = L.label_vocab(cases, TEST_MIN_FREQ)
    top = L.topk_terms(L.term_frequency(cases, "drug"), TOP_DRUGS).select(F.col("term").alias("drug"))
    probs = drug_label_probs(cases, vocab, top)
    known = V.known_effects(view(spark, sf_dir, "c_known"))
    mapped = V.map_names(top, view(spark, sf_dir, "c_names"), with_suffixes=False)
    return cases, vocab, top, probs, known, mapped


def kb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vocab, top, probs, known, mapped = _validation_parts(spark, sf_dir)
    pred = probs.where("predicted").groupBy("drug").agg(F.collect_list("label").alias("_p"))
    predicted = top.join(pred, "drug", "left").select("drug", F.coalesce("_p", F.array().cast("array<string>")).alias("predicted"))
    return V.drug_scores(predicted, mapped, known, vocab)


def _kb_sql() -> str:
    return Q.cases_with("c_known", "c_names") + f""",
    freq AS (SELECT label, count(*) AS n FROM (SELECT unnest(reactions) AS label FROM cases) GROUP BY label),
    vocab AS (SELECT label FROM freq WHERE n >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED})),
    dc AS (SELECT primaryid, unnest(drug) AS drug FROM cases),
    nd AS (SELECT drug, count(*) AS n_cases FROM dc GROUP BY drug),
    top AS (SELECT drug FROM (SELECT drug, row_number() OVER (ORDER BY n_cases DESC, drug) AS r FROM nd) WHERE r <= {TOP_DRUGS}),
    rl AS (SELECT primaryid, unnest(reactions) AS label FROM cases),
    dl AS (SELECT dc.drug, rl.label, count(*) AS n FROM dc JOIN rl ON dc.primaryid = rl.primaryid
           WHERE rl.label IN (SELECT label FROM vocab) GROUP BY dc.drug, rl.label),
    pr AS (SELECT dl.drug, dl.label, dl.n::DOUBLE / nd.n_cases AS p, dl.n::DOUBLE / nd.n_cases >= {SHARE} AS predicted
           FROM dl JOIN nd ON dl.drug = nd.drug WHERE dl.drug IN (SELECT drug FROM top)),
    nm AS (SELECT upper({S.strip_ws('drug_name')}) AS name, arg_max(stitch_id, row_order) AS id FROM c_names GROUP BY 1),
    mp AS (SELECT t.drug, nm.id AS stitch_id FROM top t LEFT JOIN nm ON upper({S.strip_ws('t.drug')}) = nm.name),
    kin AS (SELECT DISTINCT stitch_flat, {S.py_title(S.strip_ws('side_effect'))} AS label FROM c_known
            WHERE meddra_type = 'PT' AND {S.py_title(S.strip_ws('side_effect'))} IN (SELECT label FROM vocab)),
    kd AS (SELECT mp.drug, kin.label FROM mp JOIN kin ON mp.stitch_id = kin.stitch_flat)"""


@query("name_mapping", "J6 J7", "WITH " + ",\n".join(Q.views("c_probe", "c_names")) + f""",
    nm AS (SELECT upper({S.strip_ws('drug_name')}) AS name, arg_max(stitch_id, row_order) AS id FROM c_names GROUP BY 1),
    sx AS (SELECT * FROM (VALUES {", ".join(f"({i}, {S.q(s)})" for i, s in enumerate(V.SALT_SUFFIXES, start=1))}) t(prio, suf)),
    up AS (SELECT drug, upper({S.strip_ws('drug')}) AS u FROM c_probe),
    cand AS (SELECT drug, 0 AS prio, u AS cand FROM up
             UNION ALL SELECT drug, sx.prio, {S.strip_ws("left(u, length(u) - length(sx.suf))")} FROM up, sx WHERE ends_with(u, sx.suf)),
    hit AS (SELECT cand.drug, cand.prio, nm.id FROM cand JOIN nm ON cand.cand = nm.name),
    best AS (SELECT drug, arg_min(id, prio) AS stitch_id, min(prio) AS prio FROM hit GROUP BY drug)
    SELECT up.drug, best.stitch_id, CAST(coalesce(best.prio, -1) AS INTEGER) AS prio FROM up LEFT JOIN best ON up.drug = best.drug""")
def q_name_mapping(spark, sf_dir):
    return V.map_names(view(spark, sf_dir, "c_probe"), view(spark, sf_dir, "c_names")).select(
        "drug", "stitch_id", F.coalesce("prio", F.lit(-1)).cast("int").alias("prio"))


@query("kb_validation", "M10 J8 A14 F5 T4 J9", _kb_sql() + """,
    pred AS (SELECT t.drug, coalesce(list(pr.label) FILTER (WHERE pr.predicted), []) AS predicted
             FROM top t LEFT JOIN pr ON t.drug = pr.drug GROUP BY t.drug),
    kk AS (SELECT mp.drug, mp.stitch_id, coalesce(list(kd.label) FILTER (WHERE kd.label IS NOT NULL), []) AS kin
           FROM mp LEFT JOIN kd ON mp.drug = kd.drug GROUP BY mp.drug, mp.stitch_id),
    j AS (SELECT p.drug, k.stitch_id, p.predicted, len(list_intersect(p.predicted, k.kin)) AS tp, len(p.predicted) AS np,
                 len(k.kin) AS nk FROM pred p JOIN kk k ON p.drug = k.drug),
    s AS (SELECT *, CASE WHEN nk > 0 THEN CASE WHEN np > 0 THEN tp / np ELSE 0.0 END END AS pc,
                    CASE WHEN nk > 0 THEN tp / nk END AS rc FROM j)
    SELECT drug, stitch_id IS NOT NULL AS stitch_found, CAST(nk AS INTEGER) AS effects_in_vocab,
           CAST(np AS INTEGER) AS n_predicted, CAST(CASE WHEN nk > 0 THEN tp ELSE 0 END AS INTEGER) AS tp,
           round(pc, 9) AS precision, round(rc, 9) AS recall,
           round(CASE WHEN nk > 0 THEN 2.0 * pc * rc / (pc + rc + 1e-9) END, 9) AS f1,
           array_to_string(list_sort(predicted), '|') AS predicted_effects FROM s""")
def q_kb_validation(spark, sf_dir):
    s = kb_scores(spark, sf_dir)
    return s.select("drug", "stitch_found", "effects_in_vocab", "n_predicted", "tp",
                    *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "predicted_effects")


@query("kb_summary", "A15 F9 A17", _kb_sql() + """,
    pred AS (SELECT t.drug, coalesce(list(pr.label) FILTER (WHERE pr.predicted), []) AS predicted
             FROM top t LEFT JOIN pr ON t.drug = pr.drug GROUP BY t.drug),
    kk AS (SELECT mp.drug, mp.stitch_id, coalesce(list(kd.label) FILTER (WHERE kd.label IS NOT NULL), []) AS kin
           FROM mp LEFT JOIN kd ON mp.drug = kd.drug GROUP BY mp.drug, mp.stitch_id),
    j AS (SELECT p.drug, k.stitch_id, len(list_intersect(p.predicted, k.kin)) AS tp, len(p.predicted) AS np, len(k.kin) AS nk
          FROM pred p JOIN kk k ON p.drug = k.drug),
    s AS (SELECT *, CASE WHEN nk > 0 THEN CASE WHEN np > 0 THEN tp / np ELSE 0.0 END END AS pc,
                    CASE WHEN nk > 0 THEN tp / nk END AS rc FROM j),
    f AS (SELECT *, CASE WHEN nk > 0 THEN 2.0 * pc * rc / (pc + rc + 1e-9) END AS f1 FROM s)
    SELECT count(*) AS n_drugs, count(f1) AS n_scored, CAST(sum(CASE WHEN stitch_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_mapped,
           round(avg(f1), 9) AS mean_f1, round(avg(pc), 9) AS mean_precision, round(avg(rc), 9) AS mean_recall FROM f""")
def q_kb_summary(spark, sf_dir):
    s = V.validation_summary(kb_scores(spark, sf_dir))
    return s.select("n_drugs", "n_scored", "n_mapped", *[F.round(c, 9).alias(c) for c in ("mean_f1", "mean_precision", "mean_recall")])


@query("kb_compare", "M11 W9 P17", _kb_sql() + f""",
    tk AS (SELECT drug, label, p, predicted, row_number() OVER (PARTITION BY drug ORDER BY p DESC, label) AS rank FROM pr)
    SELECT tk.drug, CAST(tk.rank AS INTEGER) AS rank, tk.label, round(tk.p, 9) AS p, tk.predicted,
           kd.label IS NOT NULL AS known,
           CASE WHEN tk.predicted AND kd.label IS NOT NULL THEN 'hit' WHEN NOT tk.predicted AND kd.label IS NOT NULL THEN 'probable'
                WHEN tk.predicted THEN 'no evidence' ELSE '—' END AS outcome
    FROM tk LEFT JOIN kd ON tk.drug = kd.drug AND tk.label = kd.label WHERE tk.rank <= {TOP_LABELS}""")
def q_kb_compare(spark, sf_dir):
    _, vocab, _, probs, known, mapped = _validation_parts(spark, sf_dir)
    kd = _known_in_vocab(mapped, known, vocab)
    c = V.compare_topk(probs, kd, TOP_LABELS)
    return c.select("drug", F.col("rank").cast("int").alias("rank"), "label", F.round("p", 9).alias("p"),
                    "predicted", "known", "outcome")


def _known_in_vocab(mapped, known, vocab):
    kl = known.select("stitch_flat", F.explode("known").alias("label")).join(vocab.select("label"), "label", "left_semi")
    return mapped.join(kl, mapped.stitch_id == kl.stitch_flat).select("drug", "label")


@query("kb_sets", "A16 J10", _kb_sql() + f""",
    tk AS (SELECT drug, label, predicted FROM (
               SELECT drug, label, predicted, row_number() OVER (PARTITION BY drug ORDER BY p DESC, label) AS rank FROM pr)
           WHERE rank <= {TOP_LABELS}),
    nk AS (SELECT drug, count(*) AS n_known FROM kd GROUP BY drug),
    pp AS (SELECT pr.drug, count(*) AS n_pred, count(kd.label) AS tp FROM pr LEFT JOIN kd ON pr.drug = kd.drug AND pr.label = kd.label
           WHERE pr.predicted GROUP BY pr.drug),
    tt AS (SELECT tk.drug, count(*) AS n_top, count(kd.label) AS tp FROM tk LEFT JOIN kd ON tk.drug = kd.drug AND tk.label = kd.label
           GROUP BY tk.drug),
    ms AS (SELECT kd.drug, count(*) AS n_missed FROM kd LEFT JOIN tk ON kd.drug = tk.drug AND kd.label = tk.label
           WHERE tk.label IS NULL GROUP BY kd.drug)
    SELECT nk.drug, nk.n_known,
           round(CASE WHEN coalesce(pp.n_pred, 0) > 0 THEN pp.tp::DOUBLE / pp.n_pred ELSE 0.0 END, 9) AS precision_pred,
           round(coalesce(pp.tp, 0)::DOUBLE / nk.n_known, 9) AS recall_pred,
           round(CASE WHEN coalesce(tt.n_top, 0) > 0 THEN tt.tp::DOUBLE / tt.n_top ELSE 0.0 END, 9) AS precision_top,
           round(coalesce(tt.tp, 0)::DOUBLE / nk.n_known, 9) AS recall_top,
           coalesce(ms.n_missed, 0) AS n_missed
    FROM nk LEFT JOIN pp ON nk.drug = pp.drug LEFT JOIN tt ON nk.drug = tt.drug LEFT JOIN ms ON nk.drug = ms.drug""")
def q_kb_sets(spark, sf_dir):
    _, vocab, _, probs, known, mapped = _validation_parts(spark, sf_dir)
    kd = _known_in_vocab(mapped, known, vocab)
    w = F.row_number().over(Window.partitionBy("drug").orderBy(F.desc("p"), "label"))
    top = probs.withColumn("rank", w).where(F.col("rank") <= TOP_LABELS)
    sc = V.set_scores(probs, top, kd)
    missed = V.missed_effects(kd, top).groupBy("drug").agg(F.count(F.lit(1)).alias("n_missed"))
    out = sc.join(missed, "drug", "left").fillna(0, subset=["n_missed"])
    return out.select("drug", "n_known", *[F.round(c, 9).alias(c) for c in
                                           ("precision_pred", "recall_pred", "precision_top", "recall_top")], "n_missed")
