"""Session helpers.

On a cluster the session comes from the launcher; nothing here overrides
settings that are already present.  Local runs (tests, bench) get a small
configuration and a scratch checkpoint folder only when none is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# One BLAS thread per Python worker: Spark already runs one worker per core, so
# multi-threaded BLAS inside each worker would oversubscribe the cores.
WORKER_ENV = {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1", "MKL_NUM_THREADS": "1"}


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "caseflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on)."""
    for k, v in WORKER_ENV.items():  # local workers inherit the driver's environment
        os.environ.setdefault(k, v)
    builder = SparkSession.builder.master(f"local[{cores}]")
    for k, v in WORKER_ENV.items():  # executors on a cluster get it from the session config
        builder = builder.config(f"spark.executorEnv.{k}", v)
    spark = (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CASEFLOW_DRIVER_MEM", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the configured checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (a cluster session without one is an error).  Only local sessions
    without one get a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        # a machine-local folder would not survive executor loss on a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (needed by iterative operators)")
    path = tempfile.mkdtemp(prefix="caseflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared checkpoint folder that no other table has."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table under the shared checkpoint folder: several readers share one computation, the lineage ends,
    and no executor memory is held."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
