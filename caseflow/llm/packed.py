"""Packed exchange: arrays of numbers as rows of bytes, dealt by Spark and read back in order."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext


def planes(a: np.ndarray) -> bytes:
    """Whole numbers as byte planes: the width that the largest needs, then each number's lowest bytes, the next ones, ..."""
    whole = a.astype("<u8")
    width = max(1, -(-int(whole.max()).bit_length() // 8)) if len(whole) else 1
    return bytes([width]) + whole.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, : raw[0]] = body.T
    return out.view("<u8").reshape(-1)


def rows_by_key(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[int, Iterator[dict]]]:
    """Runs of equal ``name`` in sorted rows, each to be read before the next."""
    rows = (row for batch in batches for part in range(0, batch.num_rows, 64) for row in batch.slice(part, 64).to_pylist())
    return groupby(rows, key=lambda r: r[name])


def emit(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def chunk_numbers(bits: int = 20) -> Iterator[int]:
    """Numbers that no other task of the stage gives, the same when the task runs again."""
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << bits
    while True:
        yield number
        number += 1


def bucket_bits(spark) -> int:
    """Log2 of the hash buckets: as many buckets as shuffle partitions, 64 at least."""
    return max(6, math.ceil(math.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))


class Out:
    """Rows gathered into batches: a batch for every small row would cost more than the rows."""

    def __init__(self, names: list[str], kinds: list[pa.DataType], rows: int = 256, size: int = 4 << 20):
        self.names, self.kinds, self.rows, self.size = names, kinds, rows, size
        self.held: list[tuple] = []
        self.bytes = 0

    def add(self, *row) -> Iterator[pa.RecordBatch]:
        self.held.append(row)
        self.bytes += sum(len(x) for x in row if isinstance(x, bytes))
        if len(self.held) >= self.rows or self.bytes >= self.size:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield emit(self.held, self.names, self.kinds)
            self.held, self.bytes = [], 0
