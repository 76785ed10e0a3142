"""Scoring assembled cases with a trained model: features, network, thresholds, label sets.

A model is bounded by its vocabularies: it travels with the plan as literals and with the task closure, and every step is
a projection of the case table.  A case has as many probabilities as the model has labels, so what is made from them (label sets,
the most probable labels) is made where they are, an Arrow batch at a time, and only that leaves the pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features as FT
from . import score as SC


#: Cases that are filled in and scored at once: their features and probabilities stay in a processor's cache.
BATCH = 2048


@dataclass(frozen=True)
class CaseModel:
    featurizer: FT.FeatureModel
    genome: np.ndarray
    hidden: int
    labels: list[str]  # in label order
    thresholds: list[float]

    @property
    def shape(self) -> SC.NetShape:
        return SC.NetShape(self.featurizer.dim, self.hidden, len(self.labels))


@dataclass(frozen=True)
class Output:
    """A column made from a batch's (cases, labels) probabilities."""

    name: str
    kind: T.DataType
    of: Callable[[np.ndarray], object]  # an Arrow array


def predict(cases: DataFrame, model: CaseModel, *outputs: Output) -> DataFrame:
    """M8: ``cases`` (drug, other_drugs, indications, age_years, weight_kg, sex; missing values allowed) with ``outputs``, by
    default ``probs``: features, network and outputs in one pass over Arrow batches."""
    keep, outputs = cases.columns, outputs or (probabilities(),)
    schema = T.StructType([*cases.schema, *[T.StructField(o.name, o.kind) for o in outputs]])

    def run(batches):
        import pyarrow as pa

        for rb in batches:
            for part in (rb.slice(at, BATCH) for at in range(0, rb.num_rows, BATCH)):
                x = FT.filled(part.columns[len(keep):], part.num_rows, model.featurizer)
                probs = SC.forward(x, model.genome, model.shape)
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], *[o.of(probs) for o in outputs]], names=schema.names)

    return FT.located(cases, model.featurizer, keep).mapInArrow(run, schema)


def generic_cases(drugs: DataFrame, drug: str = "drug") -> DataFrame:
    """One patient without attributes for each drug: (drug name, the case columns)."""
    none = F.array().cast("array<string>")
    return drugs.select(F.col(drug).alias("name"), F.array(drug).alias("drug"), none.alias("other_drugs"), none.alias("indications"),
                        F.lit(None).cast("double").alias("age_years"), F.lit(None).cast("double").alias("weight_kg"), F.lit(None).cast("string").alias("sex"))


def probabilities(out: str = "probs") -> Output:
    """Array of the probabilities in label order."""
    return Output(out, T.ArrayType(T.DoubleType()), FT._list_array)


def _sorted_labels(model: CaseModel) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The labels' order by code points, and thresholds and labels in it."""
    order = sorted(range(len(model.labels)), key=lambda i: model.labels[i].encode())
    return np.array(order, dtype=np.int64), np.array(model.thresholds, dtype=np.float64)[order], [model.labels[i] for i in order]


def predicted_labels(model: CaseModel, out: str = "predicted") -> Output:
    """Sorted labels at or above their thresholds (what is no number counts as above, as in Spark's comparisons)."""
    order, thresholds, labels = _sorted_labels(model)

    def of(probs):
        import pyarrow as pa

        hit = ~(probs[:, order] < thresholds)
        ends = np.concatenate([[0], np.cumsum(hit.sum(1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(labels, pa.string()).take(pa.array(np.nonzero(hit)[1])))

    return Output(out, T.ArrayType(T.StringType()), of)


def top_labels(model: CaseModel, k: int, out: str = "top") -> Output:
    """Array of the k most probable (label, p, predicted), the first label on ties."""
    order, thresholds, labels = _sorted_labels(model)
    kind = T.StructType([T.StructField("label", T.StringType()), T.StructField("p", T.DoubleType()), T.StructField("predicted", T.BooleanType())])

    def of(probs):
        import pyarrow as pa

        p = probs[:, order]
        n, width = len(p), min(k, len(labels))
        if width == 1:  # the first of the largest, what is no number last
            at = np.where(np.isnan(p), -np.inf, p).argmax(1)[:, None]
        else:
            at = np.argsort(-p, axis=1, kind="stable")[:, :width]
        best = np.take_along_axis(p, at, 1)
        cells = [pa.array(labels, pa.string()).take(pa.array(at.ravel())), pa.array(best.ravel()), pa.array(~(best < thresholds[at]).ravel())]
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.StructArray.from_arrays(cells, kind.names))

    return Output(out, T.ArrayType(kind), of)


def case_table(cases: DataFrame, model: CaseModel, real: str = "reaction_list") -> DataFrame:
    """M9: the test-case table: attributes, real and predicted labels, hits, false alarms and misses, and their counts."""
    rows = predict(cases, model, predicted_labels(model, "_p")).withColumn("_r", F.array_sort(real))
    listed = lambda c: F.array_join(c, "|")
    hits = F.array_intersect("_p", "_r")
    return rows.select(
        "primaryid", "age_years", "sex", "weight_kg", listed("drug").alias("drug"), listed("other_drugs").alias("other_drugs"),
        listed("indications").alias("indications"), listed("_r").alias("real"), listed("_p").alias("predicted"), listed(hits).alias("tp"),
        listed(F.array_except("_p", "_r")).alias("fp"), listed(F.array_except("_r", "_p")).alias("fn"),
        F.size("_r").alias("n_real"), F.size("_p").alias("n_predicted"), F.size(hits).alias("n_hits"))
