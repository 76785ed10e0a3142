"""Queries: reporting (patient sentence, translation, substring filter, stage audit)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import cases as C
from ..operators import report as R
from ..sources.driver_views import read_table, view
from . import sqlcte as Q
from .q_cases import cases_from_views
from .registry import query

NEEDLE = "RING"


def _clean_sql(e: str, n: int) -> str:
    return (f"CASE WHEN {e} IS NULL OR length({S.strip_ws(e)}) = 0 THEN 'unknown' "
            f"ELSE substring({S.strip_ws(f'replace({e}, chr(124), {S.q(", ")})')}, 1, {n}) END")


@query("patient_text", "P13", Q.cases_with() + f""",
    ex AS (SELECT primaryid, age_years, weight_kg, sex, array_to_string(drug, '|') AS d,
                  array_to_string(other_drugs, '|') AS o, array_to_string(indications, '|') AS i FROM cases)
    SELECT primaryid, 'patient: ' ||
           CASE WHEN age_years IS NULL THEN 'age unknown' ELSE 'age ' || CAST(CAST(trunc(age_years) AS INTEGER) AS VARCHAR) || ' years' END
           || ', ' || CASE upper({S.strip_ws("coalesce(sex, '')")}) WHEN 'M' THEN 'sex male' WHEN 'F' THEN 'sex female' ELSE 'sex unknown' END
           || ', ' || CASE WHEN weight_kg IS NULL THEN 'weight unknown' ELSE 'weight ' || CAST(CAST(trunc(weight_kg) AS INTEGER) AS VARCHAR) || ' kg' END
           || '. drug: ' || ({_clean_sql('d', 120)}) || '. other medications: ' || ({_clean_sql('o', 150)})
           || '. indication: ' || ({_clean_sql('i', 200)}) AS text
    FROM ex""")
def q_patient_text(spark, sf_dir):
    ex = C.export_cases(cases_from_views(spark, sf_dir))
    return ex.select("primaryid", R.patient_text(
        F.col("age_years"), F.col("sex"), F.col("weight_kg"), F.col("drug"), F.col("other_drugs"), F.col("indications")).alias("text"))


@query("translate_terms", "P14", "WITH " + ",\n".join(Q.views("c_indi") + [
    Q.term_sets("indi_sets", "c_indi", "indi_pt", "indications")]) + f""",
    tr AS (SELECT DISTINCT {S.py_title('n.n_name')} AS effect, r.r_name AS effect_local
           FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
    ex AS (SELECT primaryid, unnest(indications) AS t, generate_subscripts(indications, 1) AS i FROM indi_sets)
    SELECT s.primaryid, string_agg(coalesce(tr.effect_local, ex.t), '|' ORDER BY ex.i) AS translated
    FROM indi_sets s LEFT JOIN ex ON s.primaryid = ex.primaryid LEFT JOIN tr ON ex.t = tr.effect GROUP BY s.primaryid""")
def q_translate_terms(spark, sf_dir):
    sets = C.term_sets(view(spark, sf_dir, "c_indi"), "indi_pt", "indications")
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    table = n.join(r, n.n_regionkey == r.r_regionkey).select(
        C.X.py_title(F.col("n_name")).alias("effect"), F.col("r_name").alias("effect_local")).distinct()
    t = R.translate_list(sets, "indications", table, "primaryid", out="tr")
    return t.select("primaryid", F.array_join("tr", "|").alias("translated"))


@query("substring_filter", "F6", Q.cases_with() + f"""
    SELECT primaryid, array_to_string(drug, '|') AS drug FROM cases
    WHERE contains(array_to_string(drug, '|'), {S.q(NEEDLE)})""")
def q_substring_filter(spark, sf_dir):
    ex = C.export_cases(cases_from_views(spark, sf_dir))
    return ex.where(R.contains_literal(F.col("drug"), NEEDLE)).select("primaryid", "drug")


@query("stage_audit", "A17", Q.cases_with() + """
    SELECT 'demo_rows' AS stage, count(*) AS n FROM c_demo
    UNION ALL SELECT 'demo_cases', count(*) FROM demo_clean
    UNION ALL SELECT 'drug_cases', count(*) FROM drug_sets
    UNION ALL SELECT 'reaction_cases', count(*) FROM reac_sets
    UNION ALL SELECT 'indication_cases', count(*) FROM indi_sets
    UNION ALL SELECT 'cases', count(*) FROM cases
    UNION ALL SELECT 'distinct_drugs', count(DISTINCT d) FROM (SELECT unnest(drug) AS d FROM cases)""")
def q_stage_audit(spark, sf_dir):
    demo_raw = view(spark, sf_dir, "c_demo")
    cases = cases_from_views(spark, sf_dir)
    stages = {
        "demo_rows": demo_raw,
        "demo_cases": C.clean_demo(demo_raw),
        "drug_cases": C.role_sets(view(spark, sf_dir, "c_drug")),
        "reaction_cases": C.term_sets(view(spark, sf_dir, "c_reac"), "pt", "reactions"),
        "indication_cases": C.term_sets(view(spark, sf_dir, "c_indi"), "indi_pt", "indications"),
        "cases": cases,
        "distinct_drugs": cases.select(F.explode("drug").alias("d")).distinct(),
    }
    return R.stage_counts(stages)


@query("display_values", "P18 P19", "WITH " + ",\n".join(Q.views("c_demo")) + """
    SELECT primaryid, coalesce(age_cod, '') AS age_cod, coalesce(sex, '') AS sex, round_even(CAST(wt AS DOUBLE), 1) AS wt FROM c_demo""")
def q_display_values(spark, sf_dir):
    """Text columns blank where missing, numbers rounded half to even."""
    d = view(spark, sf_dir, "c_demo").select("primaryid", "age_cod", "sex", R.round_half_even(F.col("wt").cast("double"), 1).alias("wt"))
    return R.blanks_for_nulls(d)


@query("case_lookup", "F8", Q.cases_with() + """
    SELECT primaryid, sex, age_years, array_to_string(drug, '|') AS drug FROM cases WHERE sex = 'F'""")
def q_case_lookup(spark, sf_dir):
    """All cases with one value of a column."""
    ex = C.export_cases(cases_from_views(spark, sf_dir))
    return R.lookup(ex, "sex", "F").select("primaryid", "sex", "age_years", "drug")
