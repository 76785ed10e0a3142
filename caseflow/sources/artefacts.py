"""Result sinks and the versioned model store.

A model is a set of small Parquet tables — weights (gene, value), thresholds (label_id, threshold), labels (label_id, label),
featurizer vocabularies and parameters, config — and one metrics table for each run. A store keeps its versions:

* ``data/<name>/<table>`` and ``runs/<name>`` are written first, under a name that no other writer uses, and never changed;
* ``log/<number>.json`` is written last and names them: it is the commit. It is created exclusively, so of two writers that take the
  same number one takes the next, and it ends in a line break, so a reader passes over one that is not written to its end;
* a reader takes the newest complete entry (or one it asks for) and reads only what that names, whatever is saved meanwhile;
* ``expire`` deletes the tables of old versions and what unfinished writers left; log and metrics stay, so runs can be compared.

All paths go through Hadoop's FileSystem and Spark.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.features import FeatureModel
from . import files as FS

#: Unfinished writers' folders are left alone for so long (seconds).
GRACE = 24 * 3600


@dataclass(frozen=True)
class Version:
    """A committed save: its number and the name of its folders."""

    number: int
    name: str


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a result table (parquet, or CSV with a header)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").option("escape", '"').csv(path)  # quotes inside a field are doubled
    else:
        w.parquet(path)


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """Committed versions, oldest first; entries that are not written to their end are passed over."""
    found = []
    for path in FS.matching(spark, f"{folder}/log/*.json"):
        text = FS.read_text(spark, path)
        if text.endswith("\n"):
            found.append(Version(**json.loads(text)))
    return sorted(found, key=lambda v: v.number)


def _commit(spark: SparkSession, folder: str, name: str) -> Version:
    taken = [int(p.rsplit("/", 1)[-1].split(".")[0]) for p in FS.matching(spark, f"{folder}/log/*.json")]
    number = max(taken, default=0) + 1
    while True:
        try:
            FS.create_text(spark, f"{folder}/log/{number:012d}.json", json.dumps({"number": number, "name": name}) + "\n")
            return Version(number, name)
        except Py4JJavaError:
            if not FS.exists(spark, f"{folder}/log/{number:012d}.json"):
                raise
            number += 1  # another writer was first


def save_model(spark: SparkSession, folder: str, genome: np.ndarray, thresholds: DataFrame, labels: DataFrame,
               featurizer: FeatureModel, metrics: dict[str, float], config: dict[str, object]) -> Version:
    """S9 + S10 + M13: weights, thresholds, label names, featurizer, config and metrics as the store's next version."""
    name = f"v-{uuid.uuid4().hex}"
    vocab, params = featurizer.to_tables(spark)
    tables = {
        "weights": spark.createDataFrame([(i, float(v)) for i, v in enumerate(np.asarray(genome))], "gene long, value double"),
        "thresholds": thresholds.select("label_id", "threshold"),
        "labels": labels.select("label_id", "label"),
        "featurizer_vocab": vocab,
        "featurizer_params": params,
        "config": spark.createDataFrame([(k, str(v)) for k, v in config.items()], "key string, value string"),
    }
    for table, df in tables.items():
        df.write.parquet(f"{folder}/data/{name}/{table}")
    rows = [(k, float(v)) for k, v in metrics.items()]
    spark.createDataFrame(rows, "metric string, value double").write.parquet(f"{folder}/runs/{name}")
    return _commit(spark, folder, name)


def pinned(spark: SparkSession, folder: str, number: int | None = None) -> Version:
    """The newest version, or the one with a number; FileNotFoundError where there is none or its tables have expired."""
    found = [v for v in versions(spark, folder) if number is None or v.number == number]
    if not found or not FS.exists(spark, f"{folder}/data/{found[-1].name}"):
        raise FileNotFoundError(f"{folder}: no model" if number is None else f"{folder}: no model of version {number}")
    return found[-1]


def load_model(spark: SparkSession, folder: str, version: Version | None = None):
    """(genome, thresholds DataFrame, labels DataFrame, FeatureModel, config dict) of one version, by default the newest."""
    data = f"{folder}/data/{(version or pinned(spark, folder)).name}"
    genes = spark.read.parquet(f"{data}/weights").orderBy("gene").select("value").collect()  # model-sized
    genome = np.array([r[0] for r in genes])
    thr = spark.read.parquet(f"{data}/thresholds")
    labels = spark.read.parquet(f"{data}/labels")
    fm = FeatureModel.from_tables(spark.read.parquet(f"{data}/featurizer_vocab"),
                                  spark.read.parquet(f"{data}/featurizer_params"))
    cfg = {r["key"]: r["value"] for r in spark.read.parquet(f"{data}/config").collect()}
    return genome, thr, labels, fm, cfg


def compare_runs(spark: SparkSession, folder: str) -> DataFrame:
    """``run, metric, value, change, best`` of every committed run, expired or not: the change since the run before that has the
    metric (null for its first) and whether it has the metric's largest value (of equal ones the earliest)."""
    known = versions(spark, folder)
    if not known:
        return spark.createDataFrame([], "run long, metric string, value double, change double, best boolean")
    numbers = spark.createDataFrame([(v.name, v.number) for v in known], "name string, run long")
    metrics = spark.read.schema("metric string, value double").parquet(*[f"{folder}/runs/{v.name}" for v in known])
    metrics = metrics.withColumn("name", F.regexp_extract(F.input_file_name(), "/runs/(v-[0-9a-f]+)/", 1)).join(F.broadcast(numbers), "name")
    in_order = Window.partitionBy("metric").orderBy("run")
    by_value = Window.partitionBy("metric").orderBy(F.desc("value"), "run")
    return metrics.select("run", "metric", "value", (F.col("value") - F.lag("value").over(in_order)).alias("change"), (F.row_number().over(by_value) == 1).alias("best"))


def expire(spark: SparkSession, folder: str, keep: int = 2, grace: int = GRACE) -> list[str]:
    """Delete the tables of all but the newest ``keep`` versions, and folders without a log entry that have not changed for ``grace``
    seconds (of writers that never committed); names of the deleted. A reader of an expired version fails, it never sees another."""
    if keep < 1:
        raise ValueError("keep the newest version at least")
    known = versions(spark, folder)
    kept, committed = {v.name for v in known[-keep:]}, {v.name for v in known}
    gone = []
    for part in ("data", "runs"):
        for path in FS.matching(spark, f"{folder}/{part}/v-*"):
            name = path.rsplit("/", 1)[-1]
            old = part == "data" and name in committed and name not in kept
            if old or name not in committed and FS.age(spark, path) >= grace:
                FS.delete(spark, path)
                gone.append(f"{part}/{name}")
    return gone


def contract_check(model_labels: DataFrame, data_labels: DataFrame) -> None:
    """The model's (label_id, label) pairs must equal the data's; raise otherwise."""
    a = model_labels.select("label_id", "label")
    b = data_labels.select("label_id", "label")
    extra = a.join(b, ["label_id", "label"], "left_anti").limit(1).count()
    missing = b.join(a, ["label_id", "label"], "left_anti").limit(1).count()
    if extra or missing:
        raise ValueError("model labels do not match the dataset labels")

