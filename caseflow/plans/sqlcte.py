"""DuckDB CTE texts shared by the oracle queries (case assembly stages).

These restate the cleaning and assembly rules in plain SQL; the Spark side
implements the same rules with DataFrame operators in ``operators.cases``.
"""

from __future__ import annotations

from ..functions import sqlfrag as S
from ..operators.labels import NON_ADR_LABELS
from ..sources.driver_views import duckdb_view

EXCLUDED = ", ".join(S.q(t) for t in NON_ADR_LABELS)


def views(*names: str) -> list[str]:
    return [f"{n} AS ({duckdb_view(n)})" for n in names]


def demo_norm(src: str) -> str:
    return f"""SELECT primaryid, {S.sex_code('sex')} AS sex, {S.age_years('age', 'age_cod')} AS age_years,
               {S.weight_kg('wt', 'wt_cod')} AS weight_kg, reporter_country, _file, _row FROM {src}"""


def demo_clean(src: str = "c_demo") -> str:
    return f"""demo_clean AS (
        SELECT primaryid, sex, age_years, weight_kg, reporter_country FROM (
            SELECT *, row_number() OVER (PARTITION BY primaryid ORDER BY _file DESC, _row DESC) AS rn
            FROM ({demo_norm(src)})) WHERE rn = 1)"""


DRUG_ROWS = f"""drug_rows AS (
    SELECT primaryid, {S.norm_code('role_cod')} AS role,
           upper({S.strip_ws("coalesce(" + S.strip_ws('prod_ai') + ", " + S.strip_ws('drugname') + ")")}) AS drug
    FROM c_drug)"""

DRUG_SETS = """drug_sets AS (
    SELECT primaryid, ps AS drug, CASE WHEN len(o) > 0 THEN o END AS other_drugs FROM (
        SELECT primaryid, ps, list_sort(list_filter(oth, lambda x: NOT list_contains(ps, x))) AS o FROM (
            SELECT primaryid,
                   list_sort(coalesce(list(DISTINCT drug) FILTER (WHERE role = 'PS' AND drug <> ''), CAST([] AS VARCHAR[]))) AS ps,
                   coalesce(list(DISTINCT drug) FILTER (WHERE role IN ('SS', 'C', 'I') AND drug <> ''), CAST([] AS VARCHAR[])) AS oth,
                   max(CASE WHEN role = 'PS' THEN 1 ELSE 0 END) AS has_ps
            FROM drug_rows GROUP BY primaryid) WHERE has_ps = 1))"""


def term_sets(name: str, src: str, col: str, out: str) -> str:
    t = S.py_title(S.strip_ws(col))
    return f"""{name} AS (
        SELECT primaryid, list_sort(coalesce(list(DISTINCT t) FILTER (WHERE t <> ''), CAST([] AS VARCHAR[]))) AS {out}
        FROM (SELECT primaryid, {t} AS t FROM {src}) GROUP BY primaryid)"""


CASES = """cases AS (
    SELECT d.primaryid, d.sex, d.reporter_country, d.age_years, d.weight_kg,
           g.drug, g.other_drugs, r.reactions, i.indications
    FROM demo_clean d JOIN drug_sets g ON d.primaryid = g.primaryid
         JOIN reac_sets r ON d.primaryid = r.primaryid
         LEFT JOIN indi_sets i ON d.primaryid = i.primaryid
    WHERE len(g.drug) > 0 AND len(r.reactions) > 0)"""


def cases_with(*extra_views: str) -> str:
    """WITH clause up to the assembled ``cases`` table (plus extra views)."""
    parts = views("c_demo", "c_drug", "c_reac", "c_indi", *extra_views) + [
        demo_clean("c_demo"), DRUG_ROWS, DRUG_SETS,
        term_sets("reac_sets", "c_reac", "pt", "reactions"),
        term_sets("indi_sets", "c_indi", "indi_pt", "indications"),
        CASES,
    ]
    return "WITH " + ",\n".join(parts)


def rank_by_hash(seed, key: str) -> str:
    """0-based global rank by (md5 hash, key)."""
    return f"(row_number() OVER (ORDER BY {S.hash_bits(seed, key)}, {key}) - 1)"
