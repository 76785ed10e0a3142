"""Streaming ingest keeps the latest version of each case across batches."""

import os
import time

import numpy as np

from caseflow.operators.score import NetShape, forward
from caseflow.streaming import ingest as S

COLS = ["primaryid", "age", "age_cod", "sex"]


def test_latest_versions_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "DEMO25Q1.txt"), "w") as f:
        f.write("primaryid$age$age_cod$sex\n1$10$YR$M\n2$20$YR$F\n")
    q = S.latest_versions_stream(spark, src, os.path.join(scratch, "snap"), os.path.join(scratch, "ck"), COLS)
    q.awaitTermination(120)
    with open(os.path.join(src, "DEMO25Q2.txt"), "w") as f:
        f.write("primaryid$age$age_cod$sex\n1$11$YR$M\n1$12$YR$M\n3$30$DEC$NA\n4$1$YR$F$over$long\n")
    time.sleep(1)
    snap = "file://" + os.path.join(scratch, "snap")  # the same folder by its URI
    q = S.latest_versions_stream(spark, src, snap, os.path.join(scratch, "ck"), COLS)
    q.awaitTermination(120)
    got = {r["primaryid"]: (r["age_years"], r["sex"]) for r in S.latest_snapshot(spark, snap).collect()}
    assert got == {"1": (12.0, "M"), "2": (20.0, "F"), "3": (300.0, "U")}


def test_score_stream(spark, scratch):
    shape = NetShape(3, 2, 2)
    g = np.linspace(-1, 1, shape.n_params)
    rows = [(i, [float(i), 1.0, -1.0]) for i in range(4)]
    path = os.path.join(scratch, "feat")
    spark.createDataFrame(rows, "case_id long, features array<double>").write.parquet(path)
    stream = spark.readStream.schema("case_id long, features array<double>").parquet(path)
    out = S.score_stream(stream, g, shape, [0.5, 0.5])
    q = out.writeStream.format("memory").queryName("scored_t").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["case_id"], r["label_id"]): r["p"] for r in spark.sql("SELECT * FROM scored_t").collect()}
    want = forward(np.array([r[1] for r in rows]), g, shape)
    for (i, j), p in got.items():
        assert abs(p - want[i, j]) < 1e-12
    assert len(got) == 8
