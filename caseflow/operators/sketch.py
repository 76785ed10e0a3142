"""Mergeable sketches of batches (A4 and A17 in one pass, without reading a batch again).

A table keeps one row for each batch: its rows, a HyperLogLog sketch of each column whose distinct values are asked for, and a
quantile sketch of each column whose quantiles are. Sketches of any set of batches unite into one that answers for all of them, so
a new batch costs one pass over itself. Distinct counts are within DISTINCT_ERROR of the exact ones, and the rank of a quantile
within RANK_ERROR of the rank that was asked for (each with over 99 % probability); the exact forms stay in ``features`` and
``report``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS, DISTINCT_ERROR = 14, 0.02
KLL_SIZE, RANK_ERROR = 800, 0.01


def batch_sketches(rows: DataFrame, batch: str | Column, distinct: list[str], quantiles: list[str]) -> DataFrame:
    """``batch, n_rows, distinct_<column>, quantiles_<column>``: one row for each batch.

    Nulls are in no sketch; a column without a value has an empty one; a null batch is a batch.
    """
    key = F.col(batch) if isinstance(batch, str) else batch
    sets = [F.hll_sketch_agg(F.col(c).cast("string"), HLL_BITS).alias(f"distinct_{c}") for c in distinct]
    orders = [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"quantiles_{c}") for c in quantiles]
    return rows.groupBy(key.alias("batch")).agg(F.count(F.lit(1)).alias("n_rows"), *sets, *orders)


def united(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """The sketches of several batches as one, for all rows or each group of ``by``."""
    sets = [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.startswith("distinct_")]
    orders = [F.kll_merge_agg_double(c).alias(c) for c in sketches.columns if c.startswith("quantiles_")]
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *sets, *orders)


def distinct_count(column: str) -> Column:
    """Estimated distinct values of a column of united sketches."""
    return F.hll_sketch_estimate(f"distinct_{column}")


def quantile(column: str, share: float) -> Column:
    """Estimated quantile of a column of united sketches; null without values."""
    sketch = f"quantiles_{column}"
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
