"""Exact token counts from a length histogram.

Documents are encoded, counted by encoded length, and suffix sums over the histogram answer totals,
quantiles and truncated totals for every context limit without going back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import codec
from .common import column, cut, slices

#: Lengths per block of the two-level suffix sums: the upper level has (longest document / BLOCK) rows at most.
BLOCK = 256


def token_lengths(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """One row ``n_tokens long`` per document (null or empty text: 0)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                counts = [len(bpe.encode_bytes(t)) // 4 if t else 0 for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n_tokens"])

    return rows.mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``: at most one row per distinct length, combined before the shuffle."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Suffix and prefix sums at every length that occurs.

    Columns: context_limit (the length), n_docs, docs_at_least, docs_at_most, docs_over, total_tokens (all documents),
    tokens_below (in shorter documents), truncated_total (sum of min(length, context_limit)) and lost_tokens
    (total - truncated). The histogram is read twice, so it is written once and the documents are encoded once. Sums run inside blocks of BLOCK lengths and over the blocks' totals, so no task sorts the whole
    histogram. An empty histogram gives no rows; null lengths are not expected and count as 0.
    """
    h = histogram.select(F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), "n_docs")
    h = cut(h, "lengths").withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    h = h.groupBy("block", "n_tokens").agg(F.sum("n_docs").alias("n_docs")).withColumn("tokens", F.col("n_docs") * F.col("n_tokens"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    order = Window.orderBy("block")
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("b_docs").over(before), F.lit(0)).alias("p_docs"),
        F.coalesce(F.sum("b_tokens").over(before), F.lit(0)).alias("p_tokens"),
        F.sum("b_docs").over(all_rows).alias("all_docs"),
        F.sum("b_tokens").over(all_rows).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("c_docs", F.sum("n_docs").over(inside)).withColumn("c_tokens", F.sum("tokens").over(inside)).join(blocks, "block")
    at_most = F.col("p_docs") + F.col("c_docs")
    below = F.col("p_tokens") + F.col("c_tokens") - F.col("tokens")
    h = h.select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        (F.col("all_docs") - at_most + F.col("n_docs")).alias("docs_at_least"),
        at_most.alias("docs_at_most"),
        (F.col("all_docs") - at_most).alias("docs_over"),
        "total_tokens",
        below.alias("tokens_below"),
    )
    h = h.withColumn("truncated_total", F.col("tokens_below") + F.col("context_limit") * F.col("docs_at_least"))
    return h.withColumn("lost_tokens", F.col("total_tokens") - F.col("truncated_total"))


def answer_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Totals for given context limits, whether or not a document has that length.

    ``context_limit, docs_over, total_tokens, truncated_total, lost_tokens``: documents longer than the limit and the
    tokens that stay when each is cut there. The answer for a limit comes from the next longer length that occurs;
    limits beyond the longest document keep everything. The list is a parameter, so one conditional aggregate serves it.
    """
    rows = None
    for limit in limits:
        longer = F.col("context_limit") > limit
        one = sums.agg(
            F.lit(limit).cast("long").alias("context_limit"),
            F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)).alias("docs_over"),
            F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total_tokens"),
            F.coalesce(F.sum(F.col("n_docs") * F.least(F.col("context_limit"), F.lit(limit))), F.lit(0)).alias("truncated_total"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows.withColumn("lost_tokens", F.col("total_tokens") - F.col("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length such that at least that share of the documents are no longer."""
    rows = None
    for share in shares:
        enough = F.col("docs_at_most") >= F.ceil(F.lit(share) * (F.col("docs_at_most") + F.col("docs_over")))
        one = sums.agg(F.lit(share).alias("share"), F.min(F.when(enough, F.col("context_limit"))).alias("n_tokens"))
        rows = one if rows is None else rows.unionByName(one)
    return rows
