"""Steps that findings named for their growth: same results, work spread, nothing computed or held twice."""

import numpy as np
from pyspark.sql import functions as F

from caseflow.operators import calibrate as CAL
from caseflow.operators import evolve as EV
from caseflow.operators import step as ST
from caseflow.operators.score import NetShape, forward

SHAPE = NetShape(3, 2, 2)


def _rows(spark, n, parts=1):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(n, SHAPE.d)), rng.random((n, SHAPE.o)) < 0.3
    rows = [(v.tolist(), np.flatnonzero(t).tolist()) for v, t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "features array<double>, labels array<int>").coalesce(parts)


def _brute(x, y, pop, grid):
    bucket = np.stack([np.searchsorted(grid, forward(x, g, SHAPE), side="right") for g in pop])  # individual, row, label
    hot = bucket[..., None] == np.arange(len(grid) + 1)
    return hot.sum(1), (hot & y[None, :, :, None]).sum(1)


def test_packed_passes_equal_brute_force_and_use_all_cores(spark):
    x, y, data = _rows(spark, 4500)
    pop = ST.first_population(SHAPE, np.arange(19), 3, 1.0)
    with EV.PackedRows(data, SHAPE) as rows:
        for grid in (CAL.FIT_GRID, [0.5], CAL.FINE_GRID):
            for got, want in zip(rows.counts(pop, grid), _brute(x, y, pop, grid)):
                assert np.array_equal(got, want)
        held = rows.blocks.map(lambda b: len(b[1]) // SHAPE.o).glom().map(sum).collect()
    assert sum(held) == 4500 and min(held) > 0 and len(held) >= spark.sparkContext.defaultParallelism
    n, pos = EV.counts_array(EV.population_counts(data, pop, SHAPE, CAL.FIT_GRID), 19, SHAPE.o, len(CAL.FIT_GRID) + 1)
    assert np.array_equal(np.stack([n, pos]), np.stack(_brute(x, y, pop, CAL.FIT_GRID)))


def test_no_rows_and_missing_values(spark):
    pop = ST.first_population(SHAPE, np.arange(2), 3, 1.0)
    _, _, data = _rows(spark, 3)
    with EV.PackedRows(data.where("false"), SHAPE) as rows:
        assert not np.any(rows.counts(pop, [0.5])) and np.array_equal(rows.fitness(pop), [0, 0])
    scorer = EV.BlockScorer(pop, SHAPE, [0.2, 0.5])
    scorer.add(np.full((1, 3), np.nan), np.array([[True, False]]))
    want = _brute(np.full((1, 3), np.nan), np.array([[True, False]]), pop, [0.2, 0.5])
    assert np.array_equal(scorer.total, np.stack(want))


def test_cuts_are_where_the_sigmoid_reaches_the_grid():
    grid = [0.0, 0.1, 0.5, 0.85, 1.0]
    cuts = EV.logit_of(grid)
    assert cuts[0] == -np.inf and cuts[-1] == np.inf
    p = lambda z: 1.0 / (1.0 + np.exp(-z))
    assert (p(cuts[1:4]) >= grid[1:4]).all() and (p(np.nextafter(cuts[1:4], -np.inf)) < grid[1:4]).all()


def test_searches_in_lock_step_share_their_draws():
    import hashlib

    before = ST._kept.cache_info().hits
    a, b = (ST.uniform(11, "mut", 1, np.arange(80), np.arange(60)) for _ in range(2))
    assert ST._kept.cache_info().hits == before + 1 and a.shape == (80, 60) and np.array_equal(a, b)
    assert a[3, 4] == int.from_bytes(hashlib.md5(b"11:mut:1:3:4").digest()[:6], "big") / 2 ** 48


def test_medians_compute_their_input_once(spark, scratch):
    import os

    from caseflow.operators import features as FT

    def seen(batches):
        for pdf in batches:
            open(f"{scratch}/{os.getpid()}-{os.urandom(6).hex()}", "w").close()
            yield pdf

    rows = [(float(i % 37), float(i) if i % 3 else None) for i in range(999)]
    df = spark.createDataFrame(rows, "age_years double, weight_kg double").coalesce(1).mapInPandas(seen, "age_years double, weight_kg double")
    assert FT.medians(df) == (18.0, float(np.median([w for _, w in rows if w is not None])))
    assert len(os.listdir(scratch)) == 1
    assert FT.medians(df.where("false")) == (50.0, 70.0)


def test_feature_rows_and_tfidf_equal_the_column_forms(spark):
    from caseflow.operators import features as FT

    m = FT.FeatureModel(["A", "B"], ["X"], ["A"], ["cc", "unknown"], [1.5, 2.0], 40.0, 70.0)
    rows = [(1, [" a", "C cc", "cc"], ["x", None], None, None, 80.0, "m "), (2, None, None, ["a", "b"], 20.0, None, None),
            (3, [], ["zz"], ["A"], float("nan"), 1.0, "F"), (4, ["B", "B"], None, [" "], 61.0, 0.0, "U")]
    df = spark.createDataFrame(rows, "primaryid long, drug array<string>, indications array<string>, other_drugs array<string>, age_years double, weight_kg double, sex string")
    text = FT.residual_text(F.col("drug"), F.col("other_drugs"), F.col("indications"), m)
    vector = FT.tfidf_vector(text, m.tfidf_terms, m.tfidf_idf)
    want = F.concat(FT.multi_hot(F.col("drug"), m.drug_vocab), FT.multi_hot(F.col("indications"), m.indi_vocab),
                    FT.multi_hot(F.col("other_drugs"), m.other_vocab), vector, F.array(*FT.demographics(m)))
    got = {r["primaryid"]: r["features"] for r in FT.transform_features(df, m).collect()}
    assert len(got) == 4 and FT.transform_features(df, m).columns == [*df.columns, "features"]
    for r in df.select("primaryid", want.alias("w"), vector.alias("v")).collect():
        assert np.allclose(got[r["primaryid"]], r["w"], rtol=0, atol=1e-12, equal_nan=True)
    for r in FT.with_tfidf(df, text, m.tfidf_terms, m.tfidf_idf, "tf", ["primaryid"]).join(df.select("primaryid", vector.alias("v")), "primaryid").collect():
        assert np.allclose(r["tf"], r["v"], rtol=0, atol=1e-12)
    empty = FT.transform_features(df, FT.FeatureModel())
    assert all(len(r["features"]) == 8 for r in empty.collect())
    assert [r["tf"] for r in FT.with_tfidf(df, text, [], [], "tf", ["primaryid"]).collect()] == [[]] * 4


def test_lines_of_long_rows_are_never_broadcast(spark, scratch):
    from caseflow.sources import delimited as D

    with open(f"{scratch}/DEMO1.txt", "w") as f:
        f.write("a$b\n" + "".join(f'{i}$"x\ny"\n' for i in range(50)) + "51$z\n")
    df = D.read_batches(spark, scratch, "DEMO")
    assert sorted(tuple(r) for r in df.select("a", "b").collect()) == sorted([(str(i), "x\ny") for i in range(50)] + [("51", "z")])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan.split("Join")[1] and plan.count("strategy=merge") == 2


def _case_model(labels, thresholds):
    from caseflow.operators import casemodel as CM
    from caseflow.operators import features as FT

    featurizer = FT.FeatureModel(["A", "B"], ["X"], ["C"], ["cold", "unknown"], [1.5, 1.0], 40.0, 60.0)
    shape = CM.SC.NetShape(featurizer.dim, 3, len(labels))
    return CM.CaseModel(featurizer, np.random.default_rng(5).normal(size=shape.n_params), 3, labels, thresholds)


def test_label_sets_are_made_in_the_scoring_pass(spark):
    """Label sets and top labels against a loop over the labels: labels out of order, equal probabilities, ages without number."""
    from caseflow.operators import casemodel as CM
    from caseflow.operators import features as FT

    labels = ["b", "a", "Z", "é", "c"]
    model = _case_model(labels, [0.4, 0.6, 0.5, 0.5, 0.0])
    w1, b1, w2, b2 = model.shape.unpack(model.genome)
    w2[:, 1], b2[1] = w2[:, 0], b2[0]  # "a" and "b" are always as probable as each other
    rows = [(str(i), ["a "] * (i % 2) + ["zz cold"] * (i % 3), None if i % 4 else ["C", "q"], ["x"] if i % 5 else [], None if i % 3 else i * 1.0,
             float("nan") if i == 7 else 50.0, "m" if i % 2 else None) for i in range(60)]
    cases = spark.createDataFrame(rows, "primaryid string, drug array<string>, other_drugs array<string>, indications array<string>, age_years double, weight_kg double, sex string")
    probs = {r.primaryid: CM.SC.forward(np.array([r.features]), model.genome, model.shape)[0] for r in FT.transform_features(cases, model.featurizer).collect()}
    got = CM.predict(cases, model, CM.probabilities(), CM.predicted_labels(model), CM.top_labels(model, 1, "one"), CM.top_labels(model, 9, "all")).collect()
    assert len(got) == 60 and np.isnan(probs["7"]).all()
    for r in got:
        p = probs[r.primaryid]
        np.testing.assert_allclose(r.probs, p, rtol=1e-12)
        above = lambda i: not p[i] < model.thresholds[i]  # noqa: B023, E731
        assert r.predicted == sorted((labels[i] for i in range(5) if above(i)), key=str.encode)
        best = sorted(range(5), key=lambda i: (-p[i] if p[i] == p[i] else 9, labels[i].encode()))  # noqa: B023
        assert [(t.label, t.predicted) for t in r["all"]] == [(labels[i], above(i)) for i in best]
        assert [t.label for t in r["one"]] == [labels[best[0]]]
    none = _case_model([], [])
    empty = CM.predict(cases, none, CM.predicted_labels(none), CM.top_labels(none, 1)).collect()
    assert len(empty) == 60 and all(r.predicted == [] and r.top == [] for r in empty)


def test_score_cases_evaluates_no_expression_per_label(spark):
    """The plan after the assembled cases is one pass over Arrow batches: no label in it, no probabilities between its steps."""
    from caseflow.plans import q_model

    df = q_model.q_score_cases(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "probs" not in plan and "zip_with" not in plan and "Exchange" not in plan
