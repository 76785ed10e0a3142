"""Reproducible hash ordering, samples and splits.

A case's position is the rank of ``md5(seed:key)`` (48 bits) among all cases, ties broken by key.  Samples and splits need the
k-th position only, which is found exactly by counting: rows by the hash's first 16 bits, then those of the bucket that holds
the k-th by the next 16, and so on (2^16 counts a round, summed before the shuffle).  A filter against the threshold then
decides every row where it is: no row is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expr as X
from ..session import ensure_checkpoint_dir

STEP = 16  # bits of the hash that a round of counting decides
FEW_ROWS = 50_000  # rows of a bucket that are sorted instead of counted further
SEED = 42
TEST_SIZE = 0.30
VAL_FRACTION = 0.10


def _bucket_of(counts: list[tuple[int, int]], k: int) -> tuple[int, int, int]:
    """``(bucket, place in it, rows in it)`` of the k-th row (from 1) by sorted buckets and their counts."""
    for bucket, n in counts:
        if k <= n:
            return bucket, k, n
        k -= n
    raise ValueError("k is larger than the number of rows")


class Positions:
    """Exact positions of a table's rows in hash order; rows with a null key have none."""

    def __init__(self, df: DataFrame, key: str, seed: int = SEED):
        self.key, self.h = F.col(key), X.hash_bits(seed, key)
        self.rows = df.where(self.key.isNotNull()).select(self.h.alias("_h"), self.key.alias("_k"))
        self.first = self._counts(self.rows, X.HASH_BITS - STEP)
        self.n = sum(n for _, n in self.first)

    def _counts(self, rows: DataFrame, shift: int) -> list[tuple[int, int]]:
        found = rows.groupBy(F.shiftright("_h", shift).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        return sorted((r["_b"], r["_n"]) for r in found.collect())  # at most 2^STEP rows

    def kth(self, k: int) -> tuple[int, object]:
        """Hash and key of the k-th row (1 to n)."""
        shift, counts = X.HASH_BITS - STEP, self.first
        while True:
            bucket, k, n = _bucket_of(counts, k)
            rows = self.rows.where(F.shiftright("_h", shift) == F.lit(bucket))
            if n <= FEW_ROWS:
                found = sorted((r["_h"], r["_k"]) for r in rows.collect())  # n of them
                return found[k - 1]
            if shift == 0:  # so many rows of one hash are repeats of a key, which stay together
                keys = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).orderBy("_k").toLocalIterator()
                return bucket, _bucket_of(((r["_k"], r["_n"]) for r in keys), k)[0]
            shift -= STEP
            counts = self._counts(rows, shift)

    def within(self, k: int) -> Column:
        """Whether a row is one of the first k; repeats of the k-th row's key are."""
        if k <= 0:
            return F.lit(False)
        if k >= self.n:
            return self.key.isNotNull()
        h, key = self.kth(k)
        return self.key.isNotNull() & ((self.h < F.lit(h)) | ((self.h == F.lit(h)) & (self.key <= F.lit(key))))


def hash_sample(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """Fixed-size sample without replacement: the n smallest md5(seed:key); null keys are not drawn."""
    return df.where(Positions(df, key, seed).within(n))


def split_sizes(n: int, test_size: float = TEST_SIZE, val_fraction: float = VAL_FRACTION) -> tuple[int, int]:
    """(n_test, n_val): test rounded up, validation = floor share of train."""
    n_test = int(math.ceil(test_size * n))
    n_val = int((n - n_test) * val_fraction)
    return n_test, n_val


def hash_split(df: DataFrame, key: str = "primaryid", seed: int = SEED, test_size: float = TEST_SIZE,
               val_fraction: float = VAL_FRACTION) -> DataFrame:
    """D2 + D3: add ``split`` in {'test', 'val', 'train'}; rows with a null key are left out.

    Positions [0, n_test) are test, the next floor(val_fraction * train) are
    validation, the rest train — the same bands for every consumer.
    """
    p = Positions(df, key, seed)
    n_test, n_val = split_sizes(p.n, test_size, val_fraction)
    s = F.when(p.within(n_test), "test").when(p.within(n_test + n_val), "val").otherwise("train")
    return df.where(F.col(key).isNotNull()).withColumn("split", s)


def global_rank(df: DataFrame, order: list, n_parts: int | None = None) -> DataFrame:
    """Add ``_rank`` = 0-based position in ascending ``order`` (must be a total order).

    Distributed: range-partition and sort within partitions, number rows with
    ``monotonically_increasing_id`` (partition id in the high bits), and add
    each partition's offset from a table with one row per partition.  The
    sorted table is checkpointed so both passes see the same partitions.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    s = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
         .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    s = s.withColumn("_pid", F.shiftright("_mid", 33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return s.join(F.broadcast(offsets), "_pid").withColumn("_rank", F.col("_off") + local).drop("_pid", "_off", "_mid")
