"""Label vocabulary and term statistics.

Term counts explode per-case sets and aggregate with a map-side partial, so
a popular term costs one partial row per task, not one row per case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .report import dimension

# Reaction terms that are not adverse drug reactions and are
# never used as labels.
NON_ADR_LABELS = [
    "Inappropriate Schedule Of Product Administration",
    "Incorrect Dose Administered",
    "Product Dose Omission Issue",
    "Drug Dose Omission By Device",
    "Wrong Technique In Product Usage Process",
    "Overdose",
    "Accidental Exposure To Product",
    "Device Breakage",
    "Device Issue",
    "Product Storage Error",
    "Product Use Issue",
    "Product Use In Unapproved Indication",
    "Off Label Use",
    "Drug Ineffective",
    "Therapeutic Product Effect Incomplete",
    "Therapy Interrupted",
    "No Adverse Event",
    "Maternal Exposure During Pregnancy",
    "Hospitalisation",
    "Illness",
    "General Physical Health Deterioration",
    "Condition Aggravated",
    "Toxicity To Various Agents",
]
# Minimum number of cases for a label (tuned for ~55,000 cases).
MIN_REACTION_FREQ = 300


def term_frequency(df: DataFrame, col: str, out: str = "term") -> DataFrame:
    """A3: number of cases containing each term of an array column."""
    return (
        df.select(F.explode(col).alias(out))
        .where(F.col(out).isNotNull() & (F.length(out) > 0))
        .groupBy(out)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def topk_terms(freq: DataFrame, k: int, term: str = "term") -> DataFrame:
    """K most frequent terms; ties by term (code-point order).  Adds 0-based ``pos``."""
    top = freq.orderBy(F.desc("n"), F.asc(term)).limit(k)
    return top.withColumn("pos", (F.row_number().over(Window.orderBy(F.desc("n"), F.asc(term))) - 1).cast("int"))


def exclusion_table(spark: SparkSession, terms: list[str] = NON_ADR_LABELS) -> DataFrame:
    return spark.createDataFrame([(t,) for t in terms], "label string")


def label_vocab(cases: DataFrame, min_freq: int = MIN_REACTION_FREQ, exclusions: list[str] = NON_ADR_LABELS,
                col: str = "reactions") -> DataFrame:
    """F3 + T8: (label_id, label, n_cases) — frequent, not excluded, sorted by label.

    The result has at most (total term occurrences / min_freq) rows.
    """
    spark = cases.sparkSession
    freq = term_frequency(cases, col, "label").where(F.col("n") >= min_freq)
    kept = freq.join(F.broadcast(exclusion_table(spark, exclusions)), "label", "left_anti")
    return kept.select(
        (F.row_number().over(Window.orderBy("label")) - 1).cast("int").alias("label_id"),
        "label",
        F.col("n").alias("n_cases"),
    )


def label_pairs(cases: DataFrame, vocab: DataFrame, key: str = "primaryid", col: str = "reactions") -> DataFrame:
    """M5 / J9 (long form): (key, label_id, label) for every valid label of a case.  A vocabulary of checked size is
    broadcast, so a label of a third of all cases is no join key."""
    ex = cases.select(key, F.explode(col).alias("label"))
    return ex.join(dimension(vocab.select("label", "label_id")), "label", "inner").select(key, "label_id", "label")


def label_cases(cases: DataFrame, vocab: DataFrame, key: str = "primaryid", col: str = "reactions") -> DataFrame:
    """J9 + F4: add ``reaction_list`` (valid labels only) and keep cases with one or more."""
    per_case = label_pairs(cases, vocab, key, col).groupBy(key).agg(
        F.array_sort(F.collect_list("label")).alias("reaction_list"))
    return cases.join(per_case, key, "inner")


def label_imbalance(vocab: DataFrame, k: int = 15) -> DataFrame:
    """The k most and k least frequent labels, tagged top / bottom."""
    top = vocab.orderBy(F.desc("n_cases"), "label").limit(k).withColumn("side", F.lit("top"))
    bottom = vocab.orderBy(F.asc("n_cases"), "label").limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", "label", "n_cases")


def distinct_terms(df: DataFrame, col: str, out: str = "term") -> DataFrame:
    """U4: distinct terms of an array column, sorted."""
    return df.select(F.explode(col).alias(out)).distinct().orderBy(out)
