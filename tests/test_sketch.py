"""Sketches of batches: any set of batches answers without its rows, within the stated bounds."""

import random

from caseflow.operators import sketch as SK


def test_united_sketches_stay_within_their_bounds(spark, scratch):
    rng = random.Random(7)
    rows = [(b, f"c{rng.randrange(30_000)}", rng.gauss(40 + b, 9)) for b in range(5) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "batch int, drug string, age double")
    path = scratch + "/sketches"
    for b in range(5):  # each batch is read once
        SK.batch_sketches(df.where(f"batch = {b}"), "batch", ["drug"], ["age"]).write.mode("append").parquet(path)
    kept = spark.read.parquet(path)
    for some in ([0], [1, 3], [0, 1, 2, 3, 4]):
        r = SK.united(kept.where(kept["batch"].isin(some))).select("n_rows", SK.distinct_count("drug").alias("d"), SK.quantile("age", 0.5).alias("m"), SK.quantile("age", 0.9).alias("h")).first()
        mine = [x for x in rows if x[0] in some]
        exact = len({x[1] for x in mine})
        assert r.n_rows == len(mine) and abs(r.d - exact) <= SK.DISTINCT_ERROR * exact
        for value, share in ((r.m, 0.5), (r.h, 0.9)):
            assert abs(sum(x[2] <= value for x in mine) / len(mine) - share) <= SK.RANK_ERROR


def test_batches_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, "a", 5.0), (None, "b", 7.0)], "batch int, drug string, age double")
    kept = SK.batch_sketches(df, "batch", ["drug"], ["age"])
    told = {r.batch: (r.n_rows, r.d, r.m) for r in SK.united(kept, "batch").select("batch", "n_rows", SK.distinct_count("drug").alias("d"), SK.quantile("age", 0.5).alias("m")).collect()}
    assert told == {1: (2, 0, None), 2: (1, 1, 5.0), None: (1, 1, 7.0)}
    assert SK.united(kept).select(SK.distinct_count("drug").alias("d")).first().d == 2
