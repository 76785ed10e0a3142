"""Case assembly: clean raw batches and build one row per case.

Covers P1-P10 (units, sex, numbers, drug names, roles, title-case, term sets,
concomitant de-duplication), W1 (latest version), F1/F2 (role and minimum
information filters), A1/A2 (per-case set aggregates), J1-J4 (joins) and D1
(fixed-size hash sample).

Every shuffle here is keyed on ``primaryid``; set aggregates combine
map-side, and per-case sets are bounded by the distinct terms of that case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X
from . import split

# Role codes.
SUSPECT_ROLE = "PS"
CONCOMITANT_ROLES = ["SS", "C", "I"]
# Default sample size and seed of the case table.
SAMPLE_SIZE = 55000
SEED = 42

DEMO_COLUMNS = ["primaryid", "age", "age_cod", "sex", "wt", "wt_cod", "reporter_country"]


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """S3: keep the wanted columns that exist (others are simply absent)."""
    return df.select(*[c for c in wanted if c in df.columns])


def normalise_demo(df: DataFrame) -> DataFrame:
    """Numeric coercion, age to years, weight to kg, sex code."""
    cols = set(df.columns)
    age = X.num_or_null("age") if "age" in cols else F.lit(None).cast("double")
    wt = X.num_or_null("wt") if "wt" in cols else F.lit(None).cast("double")
    age_unit = F.col("age_cod") if "age_cod" in cols else F.lit(None).cast("string")
    wt_unit = F.col("wt_cod") if "wt_cod" in cols else F.lit(None).cast("string")
    keep = [c for c in df.columns if c not in ("age", "age_cod", "wt", "wt_cod", "sex")]
    return df.select(
        *keep,
        X.sex_code("sex" if "sex" in cols else F.lit(None).cast("string")).alias("sex"),
        X.scale_by_unit(age, age_unit, X.AGE_UNITS).alias("age_years"),
        X.scale_by_unit(wt, wt_unit, X.WEIGHT_UNITS).alias("weight_kg"),
    )


def latest_version(df: DataFrame, key: str = "primaryid", order: tuple[str, ...] = ("_file", "_row"),
                   keep_order: bool = False) -> DataFrame:
    """Keep the last row per key in (file, row) order.

    ``max_by`` over a struct of the order columns has a map-side partial (a sort aggregate, as its buffer holds strings),
    so a key with very many versions never gathers its rows in one place.
    """
    payload = [c for c in df.columns if c != key and (keep_order or c not in order)]
    ordk = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in payload]), ordk).alias("_v"))
    return agg.select(key, *[F.col("_v")[c].alias(c) for c in payload])


def clean_demo(raw: DataFrame, order: tuple[str, ...] = ("_file", "_row")) -> DataFrame:
    """DEMO batch -> one demographic row per case."""
    df = select_present(raw, DEMO_COLUMNS + list(order))
    return latest_version(normalise_demo(df), "primaryid", order)


def drug_name(prod_ai: str = "prod_ai", drugname: str = "drugname"):
    """P5: ingredient, else product name (only when the ingredient is missing)."""
    return F.upper(X.strip_ws(F.coalesce(X.strip_ws(prod_ai), X.strip_ws(drugname))))


def role_sets(raw_drugs: DataFrame) -> DataFrame:
    """F1, A1, J4, P5, P6, P8, P10 in one aggregation keyed on primaryid.

    Output: primaryid, drug (suspect set), other_drugs (concomitants minus
    suspects, null when empty).  Cases without any suspect row vanish (J4).
    """
    role = X.norm_code("role_cod")
    d = raw_drugs.select("primaryid", role.alias("role"), drug_name().alias("drug"))
    named = F.length("drug") > 0  # blank and missing names never enter a set (collect_set skips nulls)
    agg = d.groupBy("primaryid").agg(
        F.max((F.col("role") == SUSPECT_ROLE).cast("int")).alias("_has_ps"),
        F.collect_set(F.when((F.col("role") == SUSPECT_ROLE) & named, F.col("drug"))).alias("_ps"),
        F.collect_set(F.when(F.col("role").isin(CONCOMITANT_ROLES) & named, F.col("drug"))).alias("_other"),
    )
    ps = F.array_sort(F.col("_ps"))
    other = F.array_sort(F.array_except(F.col("_other"), F.col("drug")))
    return (
        agg.where(F.col("_has_ps") == 1)
        .select("primaryid", ps.alias("drug"), "_other")
        .select("primaryid", "drug", F.when(F.size(other) > 0, other).alias("other_drugs"))
    )


def term_sets(raw: DataFrame, term_col: str, out_col: str) -> DataFrame:
    """P7 + A2: title-case terms and aggregate a sorted distinct set per case."""
    t = X.py_title(X.strip_ws(term_col))
    agg = (raw.select("primaryid", t.alias("_t")).groupBy("primaryid")
           .agg(F.collect_set(F.when(F.length("_t") > 0, F.col("_t"))).alias("_s")))
    return agg.select("primaryid", F.array_sort(F.col("_s")).alias(out_col))


def assemble_cases(demo: DataFrame, drugs: DataFrame, reactions: DataFrame, indications: DataFrame) -> DataFrame:
    """J1-J3 + F2: demo ⋈ drugs ⋈ reactions ⟕ indications, minimum information.

    All four inputs are keyed on primaryid; AQE picks broadcast or sort-merge
    by the runtime sizes and the planner reuses one hash partitioning.
    """
    df = (
        demo.join(drugs, "primaryid", "inner")
        .join(reactions, "primaryid", "inner")
        .join(indications, "primaryid", "left")
    )
    return df.where((F.size("drug") > 0) & (F.size("reactions") > 0))


def build_cases(demo_raw: DataFrame, drug_raw: DataFrame, reac_raw: DataFrame, indi_raw: DataFrame,
                demo_order: tuple[str, ...] = ("_file", "_row"), sample_size: int | None = None,
                seed: int = SEED) -> DataFrame:
    """Entry 1: raw batches -> case table (optionally a fixed-size sample, D1)."""
    cases = assemble_cases(
        clean_demo(demo_raw, demo_order),
        role_sets(drug_raw),
        term_sets(reac_raw, "pt", "reactions"),
        term_sets(indi_raw, "indi_pt", "indications"),
    )
    if sample_size is None:
        return cases
    return hash_sample(cases, sample_size, seed)


def hash_sample(df: DataFrame, n: int, seed: int = SEED, key: str = "primaryid") -> DataFrame:
    """Fixed-size sample without replacement: the n smallest md5(seed:key)."""
    return split.hash_sample(df, n, key, seed)


def export_cases(cases: DataFrame) -> DataFrame:
    """Encode set columns as ``|``-joined strings (the CSV form of S4)."""
    out = cases
    for c in ("drug", "other_drugs", "reactions", "indications", "reaction_list"):
        if c in cases.columns:
            out = out.withColumn(c, F.array_join(c, "|"))
    return out
