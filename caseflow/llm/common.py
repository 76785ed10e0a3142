"""Helpers shared by the operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute available)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.session import ensure_checkpoint_dir

#: White space of a word boundary, the same six code points in Java, Python and SQL regular expressions.
WS = r"[\x20\x09-\x0D]"
NOT_WS = r"[^\x20\x09-\x0D]"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    This ends the lineage: a lost executor costs a re-read of shared files, not a recomputation,
    and several readers share one computation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(v)`` where ``v`` stands for ``value``, evaluated once per row.

    A lambda variable is used because the optimizer may paste a projected column into every place
    that names it, and a lambda body would then evaluate it once per array element.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the maximal runs of non-white characters (null text: empty array)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{WS}+"))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, name: str, max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges whose ``name`` strings hold about ``max_bytes`` at most (one row at least)."""
    n, start = batch.num_rows, 0
    ends = np.cumsum(np.r_[0, pa.compute.binary_length(column(batch, name)).fill_null(0).to_numpy(zero_copy_only=False)], dtype=np.int64)
    while start < n:
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + max_bytes, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def tidy(run: Callable) -> Callable:
    """``run`` over batches, which gives freed memory back to the system when a task is over.

    Python workers wait for the next task, perhaps through stages that have none for them, and would keep what they once needed.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied
