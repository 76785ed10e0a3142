"""Queries: featurization (multi-hot, residual tf-idf, demographics, assembled rows)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import features as FT
from ..session import written
from ..sources.driver_views import view
from . import sqlcte as Q
from .q_cases import cases_from_views
from .registry import query

# Vocabulary sizes, stated here for the SQL.
K_DRUG, K_INDI, K_OTHER = 90, 50, 40
NAMES = FT.STRUCT_FEATURES


def _vocab_sql(name: str, col: str, k: int) -> str:
    return f"""{name} AS (SELECT term, CAST(pos AS INTEGER) AS pos FROM (
        SELECT term, row_number() OVER (ORDER BY n DESC, term) - 1 AS pos FROM (
            SELECT term, count(*) AS n FROM (SELECT primaryid, unnest({col}) AS term FROM cn) WHERE term <> ''
            GROUP BY term)) WHERE pos < {k})"""


NORM_SQL = f"""cn AS (SELECT primaryid, age_years, weight_kg, sex,
        list_transform(coalesce(drug, []), lambda t: upper({S.strip_ws('t')})) AS drug,
        list_transform(coalesce(indications, []), lambda t: upper({S.strip_ws('t')})) AS indications,
        list_transform(coalesce(other_drugs, []), lambda t: upper({S.strip_ws('t')})) AS other_drugs FROM cases)"""


def features_sql() -> str:
    """WITH clause: cases, vocabularies, residual tf-idf (long), medians."""
    return Q.cases_with() + f""", {NORM_SQL},
    {_vocab_sql('dv', 'drug', K_DRUG)}, {_vocab_sql('iv', 'indications', K_INDI)}, {_vocab_sql('ov', 'other_drugs', K_OTHER)},
    rt AS (SELECT primaryid, lower(t) AS t FROM (SELECT primaryid, unnest(drug) AS t FROM cn) WHERE t <> '' AND t NOT IN (SELECT term FROM dv)
           UNION ALL SELECT primaryid, lower(t) FROM (SELECT primaryid, unnest(other_drugs) AS t FROM cn) WHERE t <> '' AND t NOT IN (SELECT term FROM ov)
           UNION ALL SELECT primaryid, lower(t) FROM (SELECT primaryid, unnest(indications) AS t FROM cn) WHERE t <> '' AND t NOT IN (SELECT term FROM iv)),
    docs AS (SELECT primaryid, t FROM rt UNION ALL SELECT primaryid, 'unknown' FROM cn WHERE primaryid NOT IN (SELECT primaryid FROM rt)),
    tok AS (SELECT primaryid, unnest(regexp_extract_all(t, '{S.TOKEN}')) AS term FROM docs),
    tf AS (SELECT primaryid, term, count(*) AS tf FROM tok GROUP BY primaryid, term),
    st AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM tf GROUP BY term HAVING count(*) >= 5),
    tv AS (SELECT term, df, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS pos FROM (
           SELECT term, df FROM st ORDER BY ctf DESC, term LIMIT 40)),
    nd AS (SELECT count(*) AS n FROM cn),
    tw AS (SELECT tf.primaryid, tv.term, tv.pos, tf.tf * (ln((1 + nd.n) / (1 + tv.df)) + 1) AS x FROM tf JOIN tv ON tf.term = tv.term, nd),
    tn AS (SELECT primaryid, sqrt(sum(x * x)) AS nrm FROM tw GROUP BY primaryid),
    tfidf AS (SELECT tw.primaryid, tw.term, tw.pos, tw.x / tn.nrm AS value FROM tw JOIN tn ON tw.primaryid = tn.primaryid),
    med AS (SELECT coalesce(median(age_years), 50.0) AS am, coalesce(median(weight_kg), 70.0) AS wm FROM cn),
    demo AS (SELECT primaryid, coalesce(age_years, am) AS a, coalesce(weight_kg, wm) AS w,
                    upper({S.strip_ws("coalesce(sex, '')")}) AS s, len(list_filter(other_drugs, lambda t: t <> '')) = 0 AS no_other
             FROM cn, med)"""


def fitted(spark: SparkSession, sf_dir: str):
    cases = written(cases_from_views(spark, sf_dir), "cases")
    model = FT.fit_features(cases)
    return cases, model


@query("multi_hot", "P9 J5 M2", Q.cases_with() + f""", {NORM_SQL}, {_vocab_sql('dv', 'drug', K_DRUG)}
    SELECT DISTINCT c.primaryid, dv.pos AS feature_id FROM (SELECT primaryid, unnest(drug) AS term FROM cn) c
    JOIN dv ON c.term = dv.term""")
def q_multi_hot(spark, sf_dir):
    cases, model = fitted(spark, sf_dir)
    mh = cases.select("primaryid", FT.multi_hot(F.col("drug"), model.drug_vocab).alias("f"))
    return FT.sparse_entries(mh, "primaryid", "f").select("primaryid", F.col("feature_id").cast("int").alias("feature_id"))


@query("residual_tfidf", "P12 A5 M3 M1", features_sql() + """
    SELECT primaryid, term, round(value, 9) AS value FROM tfidf""")
def q_residual_tfidf(spark, sf_dir):
    cases, model = fitted(spark, sf_dir)
    resid = FT.residual_text(F.col("drug"), F.col("other_drugs"), F.col("indications"), model)
    v = FT.with_tfidf(cases, resid, model.tfidf_terms, model.tfidf_idf, "tf", ["primaryid"])
    e = FT.sparse_entries(v, "primaryid", "tf")
    terms = spark.createDataFrame(list(enumerate(model.tfidf_terms)), "feature_id int, term string")
    return e.join(F.broadcast(terms), "feature_id").select("primaryid", "term", F.round("value", 9).alias("value"))


@query("text_tfidf", "M3 A5", "WITH " + ",\n".join(Q.views("c_text")) + f""",
    tok AS (SELECT doc_id, unnest(regexp_extract_all(text, '{S.TOKEN}')) AS term FROM c_text),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
    st AS (SELECT term, count(*) AS df, sum(tf) AS ctf FROM tf GROUP BY term HAVING count(*) >= 5),
    tv AS (SELECT term, df FROM st ORDER BY ctf DESC, term LIMIT 40),
    nd AS (SELECT count(*) AS n FROM c_text),
    tw AS (SELECT tf.doc_id, tv.term, tf.tf * (ln((1 + nd.n) / (1 + tv.df)) + 1) AS x FROM tf JOIN tv ON tf.term = tv.term, nd),
    tn AS (SELECT doc_id, sqrt(sum(x * x)) AS nrm FROM tw GROUP BY doc_id)
    SELECT tw.doc_id, tw.term, round(tw.x / tn.nrm, 9) AS value FROM tw JOIN tn ON tw.doc_id = tn.doc_id""")
def q_text_tfidf(spark, sf_dir):
    docs = view(spark, sf_dir, "c_text")
    terms, idf = FT.fit_tfidf(docs, "text", "doc_id")
    v = FT.with_tfidf(docs, F.col("text"), terms, idf, "tf", ["doc_id"])
    e = FT.sparse_entries(v, "doc_id", "tf")
    tt = spark.createDataFrame(list(enumerate(terms)), "feature_id int, term string")
    return e.join(F.broadcast(tt), "feature_id").select("doc_id", "term", F.round("value", 9).alias("value"))


@query("medians", "A4", Q.cases_with() + f""", {NORM_SQL}
    SELECT coalesce(median(age_years), 50.0) AS age_median, coalesce(median(weight_kg), 70.0) AS weight_median FROM cn""")
def q_medians(spark, sf_dir):
    a, w = FT.medians(cases_from_views(spark, sf_dir))
    return spark.createDataFrame([(a, w)], "age_median double, weight_median double")


@query("demographic_features", "P11 A4", features_sql() + """
    SELECT primaryid, a / 100.0 AS age_norm, w / 100.0 AS weight_norm,
           CASE WHEN s = 'M' THEN 1.0 ELSE 0.0 END AS sex_M, CASE WHEN s = 'F' THEN 1.0 ELSE 0.0 END AS sex_F,
           CASE WHEN a < 30 THEN 1.0 ELSE 0.0 END AS age_lt30, CASE WHEN a >= 30 AND a <= 60 THEN 1.0 ELSE 0.0 END AS age_30_60,
           CASE WHEN a > 60 THEN 1.0 ELSE 0.0 END AS age_gt60, CASE WHEN no_other THEN 1.0 ELSE 0.0 END AS no_other_drugs
    FROM demo""")
def q_demographic_features(spark, sf_dir):
    cases, model = fitted(spark, sf_dir)
    d = cases.select("primaryid", *[c.alias(n) for c, n in zip(FT.demographics(model), NAMES)])
    return d


@query("feature_rows", "M4 P21", features_sql() + f""",
    nd_ AS (SELECT (SELECT count(*) FROM dv) AS nd, (SELECT count(*) FROM iv) AS ni, (SELECT count(*) FROM ov) AS no_,
                   (SELECT count(*) FROM tv) AS nt),
    mh AS (SELECT DISTINCT c.primaryid, dv.pos AS fid FROM (SELECT primaryid, unnest(drug) AS term FROM cn) c JOIN dv ON c.term = dv.term
           UNION SELECT DISTINCT c.primaryid, iv.pos + nd FROM (SELECT primaryid, unnest(indications) AS term FROM cn) c
                 JOIN iv ON c.term = iv.term, nd_
           UNION SELECT DISTINCT c.primaryid, ov.pos + nd + ni FROM (SELECT primaryid, unnest(other_drugs) AS term FROM cn) c
                 JOIN ov ON c.term = ov.term, nd_),
    allf AS (SELECT primaryid, fid, 1.0 AS value FROM mh
             UNION ALL SELECT primaryid, pos + nd + ni + no_, round(value, 9) FROM tfidf, nd_
             UNION ALL SELECT primaryid, nd + ni + no_ + nt + k, v FROM (
                 SELECT primaryid, unnest([a / 100.0, w / 100.0, CASE WHEN s = 'M' THEN 1.0 ELSE 0.0 END,
                        CASE WHEN s = 'F' THEN 1.0 ELSE 0.0 END, CASE WHEN a < 30 THEN 1.0 ELSE 0.0 END,
                        CASE WHEN a >= 30 AND a <= 60 THEN 1.0 ELSE 0.0 END, CASE WHEN a > 60 THEN 1.0 ELSE 0.0 END,
                        CASE WHEN no_other THEN 1.0 ELSE 0.0 END]) AS v,
                        unnest(range(0, 8)) AS k FROM demo), nd_)
    SELECT primaryid, CAST(fid AS INTEGER) AS feature_id, value FROM allf WHERE value <> 0""")
def q_feature_rows(spark, sf_dir):
    cases, model = fitted(spark, sf_dir)
    f = FT.transform_features(cases, model)
    e = FT.sparse_entries(f, "primaryid")
    lo = len(model.drug_vocab) + len(model.indi_vocab) + len(model.other_vocab)
    tfid = (F.col("feature_id") >= lo) & (F.col("feature_id") < lo + len(model.tfidf_terms))
    # tf-idf entries carry a norm summed in engine-specific order: rounded; the rest are exact
    return e.select("primaryid", F.col("feature_id").cast("int").alias("feature_id"),
                    F.when(tfid, F.round("value", 9)).otherwise(F.col("value")).alias("value"))



@query("feature_names", "P21 M1", features_sql() + """,
    n_ AS (SELECT 0 AS block, pos, 'drug_' || term AS name FROM dv UNION ALL SELECT 1, pos, 'indi_' || term FROM iv
           UNION ALL SELECT 2, pos, 'other_' || term FROM ov UNION ALL SELECT 3, pos, 'tf_' || term FROM tv
           UNION ALL SELECT 4, CAST(generate_subscripts(l, 1) - 1 AS INTEGER), unnest(l)
           FROM (SELECT ['age_norm', 'weight_norm', 'sex_M', 'sex_F', 'age_lt30', 'age_30_60', 'age_gt60', 'no_other_drugs'] AS l))
    SELECT CAST(row_number() OVER (ORDER BY block, pos) - 1 AS INTEGER) AS feature_id, name FROM n_""")
def q_feature_names(spark, sf_dir):
    _, model = fitted(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(model.feature_names)), "feature_id int, name string")
