"""Streaming forms of two batch behaviours: later batches replace earlier case versions (W1), and new cases are scored as
they arrive (M8).

* ``latest_versions_stream``: a file stream of ``$``-separated batches, parsed by the batch reader's own rules.  The snapshot
  is kept in hash buckets of the case id; a micro-batch rewrites the buckets it touches and then writes a manifest that
  names each bucket's folder.  A failed micro-batch leaves the former manifest in force and is replayed; folders that
  neither of the last two manifests names are deleted.  All paths go through Hadoop's FileSystem.
* ``score_stream``: stateless scoring of a stream of featurized cases with fixed weights and thresholds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import score as SC
from ..operators.cases import latest_version, normalise_demo
from ..sources import files as FS
from ..sources.delimited import SEP, parse_lines

BUCKETS = 64
ORDER = ("_file", "_row")


def demo_stream(spark: SparkSession, folder: str, columns: list[str], sep: str = SEP) -> DataFrame:
    """A file stream of demographic batches with the given columns; a line with just their names is a header."""
    lines = spark.readStream.text(folder).select("value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_blk"))
    header = F.transform(F.split(F.lower("value"), "\\" + sep), lambda c: F.trim(c)) == F.array(*map(F.lit, columns))
    return parse_lines(lines.where(~header), columns, sep)


def _manifests(spark: SparkSession, root: str) -> list[str]:
    """Complete manifests, the newest last."""
    return [p.rsplit("/", 1)[0] for p in sorted(FS.matching(spark, f"{root}/manifest/v*/_SUCCESS"))]


def _folders(spark: SparkSession, manifest: str) -> dict[int, str]:
    return {r["bucket"]: r["folder"] for r in spark.read.parquet(manifest).collect()}  # at most BUCKETS rows


def _merge(root: str):
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # row order inside a file: block offset, then position within the block
        rows = batch.withColumn("_row", F.struct(F.col("_blk"), F.monotonically_increasing_id())).drop("_blk")
        fresh = latest_version(normalise_demo(rows), "primaryid", ORDER, keep_order=True)
        fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("primaryid"), F.lit(BUCKETS)).cast("int")).persist()
        known = _manifests(spark, root)
        folders = _folders(spark, known[-1]) if known else {}
        touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # at most BUCKETS rows
        old = [folders[b] for b in touched if b in folders]
        if old:
            fresh_and_old = spark.read.parquet(*old).withColumn("bucket", F.pmod(F.xxhash64("primaryid"), F.lit(BUCKETS)).cast("int")).unionByName(fresh)
            merged = latest_version(fresh_and_old, "primaryid", ORDER, keep_order=True)
        else:
            merged = fresh
        data = f"{root}/data/v{epoch:09d}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        fresh.unpersist()
        folders |= {b: f"{data}/bucket={b}" for b in touched}
        table = spark.createDataFrame(sorted(folders.items()), "bucket int, folder string")
        table.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v{epoch:09d}")
        _expire(spark, root)
    return run


def _expire(spark: SparkSession, root: str) -> None:
    """Delete what the last two manifests do not name (a reader may still be on the one before the last)."""
    known = _manifests(spark, root)
    named = {f for m in known[-2:] for f in _folders(spark, m).values()}
    kept = {f.split("://")[-1].split("/data/", 1)[-1] for f in named}
    for folder in FS.matching(spark, f"{root}/data/v*/bucket=*"):
        if folder.split("/data/", 1)[-1] not in kept:
            FS.delete(spark, folder)
    for manifest in known[:-2]:
        FS.delete(spark, manifest)


def latest_versions_stream(spark: SparkSession, folder: str, snapshot_root: str, checkpoint: str,
                           columns: list[str], available_now: bool = True) -> StreamingQuery:
    """Start the W1 merge stream; the newest manifest's folders hold one row per case."""
    q = demo_stream(spark, folder, columns).writeStream.foreachBatch(_merge(snapshot_root.rstrip("/"))).option(
        "checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


def latest_snapshot(spark: SparkSession, snapshot_root: str) -> DataFrame:
    known = _manifests(spark, snapshot_root.rstrip("/"))
    if not known:
        raise FileNotFoundError(snapshot_root)
    return spark.read.parquet(*_folders(spark, known[-1]).values())


def score_stream(stream: DataFrame, genome: np.ndarray, shape: SC.NetShape, thresholds: list[float],
                 key: str = "case_id") -> DataFrame:
    """M8 + P15 on a stream: (key, label_id, p, pred) for every arriving case."""
    scored = SC.score(stream.select(key, "features"), genome, shape, keep=[key])
    thr = F.array(*[F.lit(float(t)) for t in thresholds])
    return SC.long_probs(scored, key).withColumn("pred", F.col("p") >= F.element_at(thr, F.col("label_id") + 1))
