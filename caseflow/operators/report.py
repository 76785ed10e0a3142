"""Reporting helpers.

All are column expressions or single-pass aggregations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expr as X

# The canonical patient sentence and its field limits.
TEXT_TEMPLATE = "patient: {age}, {sex}, {weight}. drug: {drug}. other medications: {other}. indication: {indi}"
DRUG_CHARS, OTHER_CHARS, INDI_CHARS = 120, 150, 200
SEX_WORDS = {"M": "sex male", "F": "sex female"}
UNKNOWN = "unknown"


# Rows of a dimension table that is broadcast.
MAX_DIMENSION = 100_000


def dimension(table: DataFrame) -> DataFrame:
    """The table marked for broadcast if it has MAX_DIMENSION rows at most, else as it is."""
    return F.broadcast(table) if table.limit(MAX_DIMENSION + 1).count() <= MAX_DIMENSION else table


def _clean(s: Column, max_chars: int) -> Column:
    txt = X.strip_ws(F.replace(s, F.lit("|"), F.lit(", ")))
    blank = s.isNull() | (F.length(X.strip_ws(s)) == 0)
    return F.when(blank, F.lit(UNKNOWN)).otherwise(F.substring(txt, 1, max_chars))


def patient_text(age: Column, sex: Column, weight: Column, drugs: Column, other: Column, indi: Column) -> Column:
    """Display sentence (the model does not read it); lists are ``|`` strings."""
    a = F.when(age.isNull(), F.lit("age unknown")).otherwise(F.concat(F.lit("age "), age.cast("int").cast("string"), F.lit(" years")))
    s = F.upper(X.strip_ws(F.coalesce(sex, F.lit(""))))
    sx = F.when(s == "M", F.lit(SEX_WORDS["M"])).when(s == "F", F.lit(SEX_WORDS["F"])).otherwise(F.lit("sex unknown"))
    w = F.when(weight.isNull(), F.lit("weight unknown")).otherwise(F.concat(F.lit("weight "), weight.cast("int").cast("string"), F.lit(" kg")))
    return F.concat(F.lit("patient: "), a, F.lit(", "), sx, F.lit(", "), w, F.lit(". drug: "), _clean(drugs, DRUG_CHARS),
                    F.lit(". other medications: "), _clean(other, OTHER_CHARS), F.lit(". indication: "), _clean(indi, INDI_CHARS))


def translate(df: DataFrame, col: str, table: DataFrame, src: str = "effect", dst: str = "effect_local",
              out: str | None = None) -> DataFrame:
    """Dictionary translation with fallback to the original.  A dictionary of up to MAX_DIMENSION terms is broadcast,
    so the rows are not shuffled by their (often very common) terms; a larger one is joined by them."""
    t = dimension(table.select(F.col(src).alias("_src"), F.col(dst).alias("_dst")))
    j = df.join(t, df[col] == t["_src"], "left")
    return j.withColumn(out or col, F.coalesce(F.col("_dst"), F.col(col))).drop("_src", "_dst")


def translate_list(df: DataFrame, col: str, table: DataFrame, key: str, src: str = "effect",
                   dst: str = "effect_local", out: str | None = None) -> DataFrame:
    """P14 on an array column: every element translated, order kept."""
    ex = df.select(key, F.posexplode(col).alias("_i", "_t"))
    tr = translate(ex, "_t", table, src, dst)
    back = tr.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_i", "_t"))).alias("_a")).select(
        key, F.transform("_a", lambda s: s["_t"]).alias(out or col))
    return df.drop(col).join(back, key, "left") if out is None else df.join(back, key, "left")


def contains_literal(s: Column, needle: str) -> Column:
    """literal substring match (no regex): 'INSULIN' also finds 'INSULIN GLARGINE'."""
    return s.contains(F.lit(needle))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """F8: point lookup."""
    return df.where(F.col(key) == F.lit(value))


def blanks_for_nulls(df: DataFrame) -> DataFrame:
    """Null -> '' for string display columns."""
    return df.fillna("")


def round_half_even(c: Column, digits: int = 3) -> Column:
    """Display rounding with ties to even."""
    return F.bround(c, digits)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One audit row per stage (name, rows)."""
    out = None
    for name, df in stages.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out
