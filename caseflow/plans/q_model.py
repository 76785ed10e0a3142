"""Queries: raw cases through the whole model, the test-case table, and the knowledge base held against the model.

The model is fitted where fitting is cheap (vocabularies, medians, label vocabulary on all cases); its weights are the
hash-derived first individual of the searches and its thresholds are hash-derived too, so SQL can state them.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import casemodel as CM
from ..operators import features as FT
from ..operators import labels as L
from ..operators import step as ST
from ..operators import validate as V
from ..operators.split import hash_split
from ..session import ensure_checkpoint_dir, written
from ..sources import artefacts as A
from ..sources.driver_views import view
from . import sqlcte as Q
from .q_cases import SEED, TEST_MIN_FREQ, cases_from_views
from .q_features import features_sql
from .registry import query

HIDDEN = 24
TOP_DRUGS, TOP_LABELS = 30, 15


def model_of(cases: DataFrame) -> CM.CaseModel:
    labels = [r["label"] for r in L.label_vocab(cases, TEST_MIN_FREQ).orderBy("label_id").collect()]  # a vocabulary
    featurizer = FT.fit_features(cases)
    shape = CM.SC.NetShape(featurizer.dim, HIDDEN, len(labels))
    genome = ST.first_population(shape, np.arange(1), SEED, 1.0)[0]
    thresholds = 0.4 + 0.2 * ST.uniform(SEED, "thr", 0, np.arange(len(labels)))
    return CM.CaseModel(featurizer, genome, HIDDEN, labels, thresholds.tolist())


_FIT = features_sql().replace("WITH ", "", 1) + f""",
    freq AS (SELECT label, count(*) AS n FROM (SELECT unnest(reactions) AS label FROM cases) GROUP BY label),
    vocab AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM freq WHERE n >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED})),
    thr AS (SELECT label, k, 0.4 + 0.2 * {S.hash_unit(SEED, "'thr'", '0', 'k')} AS t FROM vocab),
    dm AS (SELECT (SELECT count(*) FROM dv) AS nd, (SELECT count(*) FROM iv) AS ni, (SELECT count(*) FROM ov) AS no_,
                  (SELECT count(*) FROM tv) AS nt, (SELECT count(*) FROM vocab) AS o),
    dd AS (SELECT *, nd + ni + no_ + nt + 8 AS d FROM dm),
    w1 AS (SELECT i, j, {S.hash_normal(SEED, "'init'", '0', '0', 'i * 24 + j')} * sqrt(2.0::DOUBLE / d) AS w
           FROM (SELECT d, unnest(range(0, d)) AS i FROM dd), (SELECT unnest(range(0, 24)) AS j)),
    b1 AS (SELECT j, {S.hash_normal(SEED, "'init'", '0', '0', 'd * 24 + j')} * 0.01 AS w FROM dd, (SELECT unnest(range(0, 24)) AS j)),
    w2 AS (SELECT j, k, {S.hash_normal(SEED, "'init'", '0', '0', 'd * 24 + 24 + j * o + k')} * sqrt(1.0::DOUBLE / 24) AS w
           FROM (SELECT d, o, unnest(range(0, o)) AS k FROM dd), (SELECT unnest(range(0, 24)) AS j)),
    b2 AS (SELECT k, {S.hash_normal(SEED, "'init'", '0', '0', 'd * 24 + 24 + 24 * o + k')} * 0.05 AS w FROM (SELECT d, o, unnest(range(0, o)) AS k FROM dd))"""
_DEMO = """unnest([a / 100.0, w / 100.0, CASE WHEN s = 'M' THEN 1.0 ELSE 0.0 END, CASE WHEN s = 'F' THEN 1.0 ELSE 0.0 END,
                  CASE WHEN a < 30 THEN 1.0 ELSE 0.0 END, CASE WHEN a >= 30 AND a <= 60 THEN 1.0 ELSE 0.0 END,
                  CASE WHEN a > 60 THEN 1.0 ELSE 0.0 END, CASE WHEN no_other THEN 1.0 ELSE 0.0 END]) AS v, unnest(range(0, 8)) AS k"""
_CASE_X = f"""x AS (SELECT DISTINCT c.primaryid AS id, CAST(dv.pos AS BIGINT) AS i, 1.0::DOUBLE AS v FROM (SELECT primaryid, unnest(drug) AS term FROM cn) c JOIN dv ON c.term = dv.term
           UNION ALL SELECT DISTINCT c.primaryid, iv.pos + nd, 1.0 FROM (SELECT primaryid, unnest(indications) AS term FROM cn) c JOIN iv ON c.term = iv.term, dd
           UNION ALL SELECT DISTINCT c.primaryid, ov.pos + nd + ni, 1.0 FROM (SELECT primaryid, unnest(other_drugs) AS term FROM cn) c JOIN ov ON c.term = ov.term, dd
           UNION ALL SELECT primaryid, pos + nd + ni + no_, value FROM tfidf, dd
           UNION ALL SELECT primaryid, nd + ni + no_ + nt + k, v FROM (SELECT primaryid, {_DEMO} FROM demo), dd)"""
_FORWARD = f"""hid AS (SELECT x.id, w1.j, sum(x.v * w1.w) AS z FROM x JOIN w1 ON x.i = w1.i GROUP BY x.id, w1.j),
    act AS (SELECT id, hid.j, greatest(0.0, z + b1.w) AS a FROM hid JOIN b1 ON hid.j = b1.j),
    outz AS (SELECT id, w2.k, sum(act.a * w2.w) AS z FROM act JOIN w2 ON act.j = w2.j GROUP BY id, w2.k),
    pr AS (SELECT id, thr.label, thr.k, {S.sigmoid('z + b2.w')} AS p, {S.sigmoid('z + b2.w')} >= t AS predicted
           FROM outz JOIN b2 ON outz.k = b2.k JOIN thr ON outz.k = thr.k)"""
_SPLIT = f"""lab AS (SELECT primaryid, list_sort(list(label)) AS reaction_list FROM (SELECT primaryid, unnest(reactions) AS label FROM cases) SEMI JOIN vocab USING (label) GROUP BY primaryid),
    sp AS (SELECT primaryid, reaction_list, {Q.rank_by_hash(SEED, 'primaryid')} AS r, count(*) OVER () AS n FROM lab),
    test AS (SELECT primaryid, reaction_list FROM sp WHERE r < CAST(ceil(0.3 * n) AS BIGINT))"""


def test_cases(cases: DataFrame) -> DataFrame:
    labelled = L.label_cases(cases, L.label_vocab(cases, TEST_MIN_FREQ))
    return hash_split(labelled, "primaryid", SEED).where("split = 'test'").drop("split")


@query("score_cases", "M8 M6 P11 P15 W9", f"""WITH {_FIT}, {_CASE_X}, {_FORWARD}
    SELECT primaryid, CAST(count(*) FILTER (predicted) AS INTEGER) AS n_predicted, arg_max(label, p) AS top_label, round(max(p), 6) AS max_p
    FROM cases LEFT JOIN pr ON id = primaryid GROUP BY primaryid""")
def q_score_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every assembled case, missing attributes included, through featurizer, network and thresholds."""
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = model_of(cases)
    rows = cases.select("primaryid", "drug", "other_drugs", "indications", "age_years", "weight_kg", "sex")
    scored = CM.predict(rows, model, CM.predicted_labels(model), CM.top_labels(model, 1))
    best = F.get("top", F.lit(0))
    return scored.select("primaryid", F.size("predicted").alias("n_predicted"), best["label"].alias("top_label"), F.round(best["p"], 6).alias("max_p"))


@query("test_case_table", "M9 U2 A12", f"""WITH {_FIT}, {_CASE_X}, {_FORWARD}, {_SPLIT},
    pd AS (SELECT id, coalesce(list_sort(list(label) FILTER (predicted)), []) AS pl FROM pr GROUP BY id),
    j AS (SELECT c.*, t.reaction_list AS rl, pd.pl, list_filter(pd.pl, lambda z: list_contains(t.reaction_list, z)) AS hit
          FROM test t JOIN cases c ON t.primaryid = c.primaryid JOIN pd ON pd.id = t.primaryid)
    SELECT primaryid, age_years, sex, weight_kg, array_to_string(drug, '|') AS drug, array_to_string(other_drugs, '|') AS other_drugs,
           array_to_string(indications, '|') AS indications, array_to_string(rl, '|') AS real, array_to_string(pl, '|') AS predicted,
           array_to_string(hit, '|') AS tp, array_to_string(list_filter(pl, lambda z: NOT list_contains(rl, z)), '|') AS fp,
           array_to_string(list_filter(rl, lambda z: NOT list_contains(pl, z)), '|') AS fn,
           CAST(len(rl) AS INTEGER) AS n_real, CAST(len(pl) AS INTEGER) AS n_predicted, CAST(len(hit) AS INTEGER) AS n_hits FROM j""")
def q_test_case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = model_of(cases)
    rows = test_cases(cases).select("primaryid", "age_years", "sex", "weight_kg", "drug", "other_drugs", "indications", "reaction_list")
    return CM.case_table(rows, model)


@query("model_store", "S8 S9 S10 M13 J13 T8", f"""WITH {_FIT},
    saved AS (SELECT 1 AS run, k, label, 0.5 AS t FROM thr UNION ALL SELECT 2, k, label, t FROM thr),
    runs AS (SELECT run, avg(t) AS m FROM saved GROUP BY run)
    SELECT CAST(run AS BIGINT) AS run, CAST(k AS BIGINT) AS label_id, label, round(t, 9) AS threshold, round(w, 9) AS bias, round(m, 9) AS mean_threshold,
           round(CASE WHEN run = 2 THEN m - 0.5 END, 9) AS change, run = (SELECT CASE WHEN max(m) FILTER (run = 2) > 0.5 THEN 2 ELSE 1 END FROM runs) AS best
    FROM saved JOIN b2 USING (k) JOIN runs USING (run)""")
def q_model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted model saved twice, with flat thresholds and with its own, and a writer that never commits in between; both versions
    read back from the store, labels checked against the data, each with its run's metric."""
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = model_of(cases)
    vocab = written(L.label_vocab(cases, TEST_MIN_FREQ).select("label_id", "label"), "labels")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/store-{uuid.uuid4().hex}"

    def save(thresholds: list[float]) -> None:
        table = spark.createDataFrame(list(enumerate(thresholds)), "label_id int, threshold double")
        metrics = {"mean_threshold": sum(thresholds) / max(len(thresholds), 1)}
        A.save_model(spark, folder, model.genome, table, vocab, model.featurizer, metrics, {"hidden": model.hidden})

    save([0.5] * len(model.labels))
    vocab.limit(0).write.parquet(f"{folder}/data/v-unfinished/labels")
    save(model.thresholds)
    told = []
    for version in A.versions(spark, folder):
        genome, thresholds, labels, _, _ = A.load_model(spark, folder, version)
        A.contract_check(labels, vocab)
        bias = spark.createDataFrame([(i, float(b)) for i, b in enumerate(genome[len(genome) - len(model.labels):])], "label_id int, bias double")
        told.append(labels.join(thresholds, "label_id").join(bias, "label_id").withColumn("run", F.lit(version.number).cast("long")))
    rows = told[0].unionByName(told[1]).join(A.compare_runs(spark, folder).where("metric = 'mean_threshold'"), "run")
    return rows.select("run", F.col("label_id").cast("long").alias("label_id"), "label", F.round("threshold", 9).alias("threshold"), F.round("bias", 9).alias("bias"),
                       F.round("value", 9).alias("mean_threshold"), F.round("change", 9).alias("change"), "best")


_KNOWN = f"""nm AS (SELECT upper({S.strip_ws('drug_name')}) AS name, arg_max(stitch_id, row_order) AS id FROM c_names GROUP BY 1),
    kin AS (SELECT DISTINCT stitch_flat, {S.py_title(S.strip_ws('side_effect'))} AS label FROM c_known
            WHERE meddra_type = 'PT' AND {S.py_title(S.strip_ws('side_effect'))} IN (SELECT label FROM vocab))"""
_KB_VIEWS = ", ".join(Q.views("c_known", "c_names"))


@query("kb_model_validation", "M10 A14 J8 T4", f"""WITH {_KB_VIEWS}, {_FIT}, {_KNOWN},
    top AS (SELECT term AS drug FROM (SELECT term, row_number() OVER (ORDER BY n DESC, term) AS r FROM (
                SELECT term, count(*) AS n FROM (SELECT primaryid, unnest(drug) AS term FROM cases) GROUP BY term)) WHERE r <= {TOP_DRUGS}),
    gd AS (SELECT DISTINCT am AS a, wm AS w, '' AS s, true AS no_other FROM med),
    x AS (SELECT top.drug AS id, CAST(dv.pos AS BIGINT) AS i, 1.0::DOUBLE AS v FROM top JOIN dv ON upper({S.strip_ws('top.drug')}) = dv.term
          UNION ALL SELECT top.drug, tv.pos + nd + ni + no_, 1.0 FROM top, tv, dd WHERE tv.term = 'unknown'
          UNION ALL SELECT top.drug, nd + ni + no_ + nt + k, v FROM top, (SELECT {_DEMO} FROM gd), dd), {_FORWARD},
    pd AS (SELECT id, coalesce(list_sort(list(label) FILTER (predicted)), []) AS pl FROM pr GROUP BY id),
    kk AS (SELECT top.drug, nm.id AS stitch_id, coalesce(list(kin.label) FILTER (kin.label IS NOT NULL), []) AS kl
           FROM top LEFT JOIN nm ON upper({S.strip_ws('top.drug')}) = nm.name LEFT JOIN kin ON nm.id = kin.stitch_flat GROUP BY top.drug, nm.id),
    c AS (SELECT drug, stitch_id, coalesce(pl, []) AS pl, len(kl) AS nk, len(coalesce(pl, [])) AS np, len(list_intersect(coalesce(pl, []), kl)) AS tp
          FROM kk LEFT JOIN pd ON pd.id = kk.drug),
    r AS (SELECT *, CASE WHEN nk > 0 THEN CASE WHEN np > 0 THEN tp / np ELSE 0.0 END END AS pc, CASE WHEN nk > 0 THEN tp / nk END AS rc FROM c)
    SELECT drug, stitch_id IS NOT NULL AS stitch_found, CAST(nk AS INTEGER) AS effects_in_vocab, CAST(np AS INTEGER) AS n_predicted,
           CAST(CASE WHEN nk > 0 THEN tp ELSE 0 END AS INTEGER) AS tp, round(pc, 9) AS precision, round(rc, 9) AS recall,
           round(CASE WHEN nk > 0 THEN 2.0 * pc * rc / (pc + rc + 1e-9) END, 9) AS f1, array_to_string(pl, '|') AS predicted_effects FROM r""")
def q_kb_model_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 30 most frequent drugs as patients without attributes, scored by the model and held against the knowledge base."""
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = model_of(cases)
    top = L.topk_terms(L.term_frequency(cases, "drug"), TOP_DRUGS).select(F.col("term").alias("drug"))
    scored = CM.predict(CM.generic_cases(top), model, CM.predicted_labels(model)).select(F.col("name").alias("drug"), "predicted")
    labels = spark.createDataFrame([(n,) for n in model.labels], "label string")
    scores = V.drug_scores(scored, V.map_names(top, view(spark, sf_dir, "c_names"), with_suffixes=False), V.known_effects(view(spark, sf_dir, "c_known")), labels)
    return V.validation_report(scores).select("drug", "stitch_found", "effects_in_vocab", "n_predicted", "tp",
                                              *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "predicted_effects")


@query("kb_case_compare", "M11 P17 W9", f"""WITH {_KB_VIEWS}, {_FIT}, {_CASE_X}, {_FORWARD}, {_SPLIT}, {_KNOWN},
    tk AS (SELECT id, label, p, predicted, row_number() OVER (PARTITION BY id ORDER BY p DESC, label) AS rank FROM pr WHERE id IN (SELECT primaryid FROM test)),
    kd AS (SELECT DISTINCT c.primaryid, kin.label FROM (SELECT primaryid, unnest(drug) AS drug FROM cases) c
           JOIN nm ON upper({S.strip_ws('c.drug')}) = nm.name JOIN kin ON nm.id = kin.stitch_flat)
    SELECT tk.id AS primaryid, CAST(rank AS INTEGER) AS rank, tk.label, round(p, 6) AS p,
           CASE WHEN predicted AND kd.label IS NOT NULL THEN 'hit' WHEN kd.label IS NOT NULL THEN 'probable' WHEN predicted THEN 'no evidence' ELSE '—' END AS outcome
    FROM tk LEFT JOIN kd ON kd.primaryid = tk.id AND kd.label = tk.label WHERE rank <= {TOP_LABELS}""")
def q_kb_case_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test case's 15 most probable labels against what the knowledge base has for the case's drugs."""
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = model_of(cases)
    rows = test_cases(cases).select("primaryid", "drug", "other_drugs", "indications", "age_years", "weight_kg", "sex")
    scored = CM.predict(rows, model, CM.top_labels(model, TOP_LABELS))
    top = scored.select("primaryid", F.posexplode("top").alias("pos", "t"))
    drugs = rows.select("primaryid", F.explode("drug").alias("drug"))
    mapped = V.map_names(drugs.select("drug").distinct(), view(spark, sf_dir, "c_names"), with_suffixes=False)
    effects = V.known_effects(view(spark, sf_dir, "c_known"))
    known = mapped.join(effects, F.col("stitch_id") == F.col("stitch_flat")).select("drug", "known")
    by_case = drugs.join(L.dimension(known), "drug").groupBy("primaryid").agg(F.array_distinct(F.flatten(F.collect_list("known"))).alias("known"))
    out = top.join(by_case, "primaryid", "left")
    is_known = F.coalesce(F.array_contains("known", F.col("t.label")), F.lit(False))
    return out.select("primaryid", (F.col("pos") + 1).alias("rank"), F.col("t.label").alias("label"), F.round("t.p", 6).alias("p"),
                      V.outcome(F.col("t.predicted"), is_known).alias("outcome"))
