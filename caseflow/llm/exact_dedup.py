"""Exact deduplication by skew-safe combining.

Three stages, each comparing full content and not only digests:

1. locally, in each task, copies met in one chunk of rows become one row that carries the content once and the chunk's
   member ids;
2. chunk winners meet by (digest, salt), so a text with copies everywhere is spread over SALTS tasks;
3. the salt winners, at most SALTS rows for a text, meet by digest.

A group's members never gather: each chunk's member list (bounded by the chunk) learns its group by a join on the
chunk winner's salt winner.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, column, slices

SALTS = 16
#: Bytes of distinct content that a task holds before it passes its winners on.
CHUNK_BYTES = 32 << 20

_LOCAL = "digest binary, content binary, wid long, rid long, members array<long>"


def normalised(text: str | None) -> bytes:
    """UTF-8 with each run of the six white characters as one space (null: empty).

    ``bytes.split()`` splits at exactly these six; a leading or trailing run stays one space.
    """
    raw = (text or "").encode()
    out = b" ".join(raw.split())
    if not out:
        return b" " if raw else b""
    return (b" " if raw[0] in b" \t\n\x0b\x0c\r" else b"") + out + (b" " if raw[-1] in b" \t\n\x0b\x0c\r" else b"")


def _combine_locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    serial = (task.partitionId() if task else 0) << 32
    held: dict[bytes, list[list]] = {}  # digest -> [content, members] of each distinct content
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal serial, size
        rows = []
        for digest, contents in held.items():
            for content, members in contents:
                members.sort(key=lambda i: (i is None, i))
                rows.append((digest, content, members[0], serial, members))
                serial += 1
        held.clear()
        size = 0
        for start in range(0, len(rows), 512):
            cols = list(zip(*rows[start : start + 512]))
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["digest", "content", "wid", "rid", "members"])

    for whole in batches:
        for batch in slices(whole, "text", 8 << 20):
            for i, text in zip(column(batch, "id").to_pylist(), column(batch, "text").to_pylist()):
                content = normalised(text)
                contents = held.setdefault(hashlib.sha256(content).digest(), [])
                for known in contents:
                    if known[0] == content:
                        known[1].append(i)
                        break
                else:
                    contents.append([content, [i]])
                    size += len(content) + 200
                size += 16
            if size > CHUNK_BYTES:
                yield from flush()
    yield from flush()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: id, ``keep_id, group_size, kept, digest binary``.

    Texts are equal when their normalised forms are (see ``normalised``; null counts as empty). The row with the smallest
    id stays, null ids last; of several rows with that id exactly one is kept. An empty table gives no rows. Other columns
    are not carried, so their names cannot clash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    local = rows.mapInArrow(_combine_locally, _LOCAL).withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int"))
    # An explicit exchange, read by both branches below (planned once, then reused).
    dealt = local.repartition("digest", "salt")
    best = F.struct(F.col("wid").isNull().alias("none"), F.col("wid").alias("id"), F.col("rid").alias("rid"))
    same = Window.partitionBy("digest", "salt", "content")
    salted = dealt.withColumn("salt_win", F.min(best).over(same)).withColumn("salt_rows", F.sum(F.size("members").cast("long")).over(same))

    winners = salted.where(F.col("rid") == F.col("salt_win.rid")).select("digest", "content", "salt_win", "salt_rows")
    equal = Window.partitionBy("digest", "content")
    groups = winners.repartition("digest").select(
        F.col("salt_win.rid").alias("salt_rid"), F.min("salt_win").over(equal).alias("win"), F.sum("salt_rows").over(equal).alias("group_size")
    )
    members = salted.select("digest", "rid", "members", F.col("salt_win.rid").alias("salt_rid"))
    out = members.join(groups, "salt_rid").select("digest", "rid", "win", "group_size", F.posexplode("members").alias("pos", "member"))
    return out.select(
        F.col("member").alias(id_col),
        F.col("win.id").alias("keep_id"),
        "group_size",
        ((F.col("rid") == F.col("win.rid")) & (F.col("pos") == 0)).alias("kept"),
        "digest",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each text, all columns as they were: the row with the smallest id (null ids last).

    Of several rows with that id and text any one stays. Null counts as empty; an empty table gives no rows; the helper
    columns live beside a struct of the row, so names cannot clash.
    """
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("id"), "digest")
    text = F.regexp_replace(F.coalesce(docs[text_col].cast("string"), F.lit("")), f"{WS}+", " ")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"))
    same = (rows["digest"] == kept["digest"]) & rows["id"].eqNullSafe(kept["id"])
    # Equal rows of one id are combined before the shuffle, so a row that is repeated without end is one row a task.
    return rows.join(kept, same, "left_semi").groupBy("digest", "id").agg(F.first("row").alias("row")).select("row.*")
