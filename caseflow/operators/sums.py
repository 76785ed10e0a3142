"""Element-wise totals of arrays that tasks produce, added up on the executors."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def array_total(parts: DataFrame, width: int) -> DataFrame:
    """One row ``acc``: the element-wise sum of the ``acc array<double>`` rows (one for each non-empty task of the
    producer), zeros where there is none.

    Two levels: about the square root of the number of tasks add up first, then one task adds their sums, so neither a
    task nor the driver ever holds one array for every task.
    """

    def add(batches):
        total = np.zeros(width)
        for pdf in batches:
            for acc in pdf["acc"]:
                total += np.asarray(acc)
        yield pd.DataFrame({"acc": [total.tolist()]})

    spark = parts.sparkSession
    level = max(2, math.isqrt(max(parts.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return parts.repartition(level).mapInPandas(add, "acc array<double>").repartition(1).mapInPandas(add, "acc array<double>")


def collected_total(parts: DataFrame, width: int) -> np.ndarray:
    """The total as an array: ``width`` numbers reach the driver, whatever the data."""
    return np.asarray(array_total(parts, width).first()["acc"])
