"""Literal edge-case rows for the cleaning, assembly and selection rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseflow.functions import expr as X
from caseflow.operators import calibrate as CAL
from caseflow.operators import cases as C
from caseflow.operators import evolve as EV
from caseflow.operators import features as FT
from caseflow.operators import metrics as M
from caseflow.operators import split as SP
from caseflow.operators import pareto as PA
from caseflow.operators import step as ST
from caseflow.operators import report as R
from caseflow.operators import validate as V
from caseflow.sources import delimited as D


def col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_units(spark):
    rows = [("36", "mon"), ("5", " DEC "), ("7", "xx"), ("7", None), ("abc", "YR")]
    df = spark.createDataFrame(rows, "age string, age_cod string")
    got = [r[0] for r in df.select(X.scale_by_unit(X.num_or_null("age"), F.col("age_cod"), X.AGE_UNITS)).collect()]
    assert got[0] == pytest.approx(3.0) and got[1] == 50.0 and got[2] == 7.0 and got[3] == 7.0 and got[4] is None
    w = spark.createDataFrame([("220", "lbs")], "wt string, wt_cod string")
    assert w.select(X.scale_by_unit(X.num_or_null("wt"), F.col("wt_cod"), X.WEIGHT_UNITS)).first()[0] == pytest.approx(99.792)


def test_sex(spark):
    assert col(spark, [" m ", "f", "UNK", None], X.sex_code) == ["M", "F", "U", "U"]


def test_numbers(spark):
    got = col(spark, [" 12 ", "1e3", ".5", "-3.", "5d", "0x1A", "1_000", ""], X.num_or_null)
    assert got == [12.0, 1000.0, 0.5, -3.0, None, None, None, None]


def test_title_case(spark):
    got = col(spark, ["crohn's disease", "drug-induced", "19th", "x_y", "sjögren's"], X.py_title)
    assert got == ["Crohn'S Disease", "Drug-Induced", "19Th", "X_Y", "Sjögren'S"]
    assert got == [s.title() for s in ["crohn's disease", "drug-induced", "19th", "x_y", "sjögren's"]]


def test_drug_name_fallback_only_when_missing(spark):
    df = spark.createDataFrame([(None, "aspirin "), ("ibuprofen", "x"), ("", "y")], "prod_ai string, drugname string")
    assert [r[0] for r in df.select(C.drug_name()).collect()] == ["ASPIRIN", "IBUPROFEN", ""]


def test_concomitants_and_lost_cases(spark):
    rows = [("1", "PS", "A", None), ("1", "SS", "A", None), ("2", "PS", "A", None), ("2", "C", "A", None),
            ("2", "C", "B", None), ("3", "SS", "Z", None)]
    df = spark.createDataFrame(rows, "primaryid string, role_cod string, prod_ai string, drugname string")
    got = {r["primaryid"]: (r["drug"], r["other_drugs"]) for r in C.role_sets(df).collect()}
    assert got["1"] == (["A"], None)
    assert got["2"] == (["A"], ["B"])
    assert "3" not in got  # only concomitant roles -> absent


def test_latest_version(spark):
    rows = [("1", "10", "YR", "a.txt", 1), ("1", "20", "YR", "b.txt", 0), ("2", "5", "YR", "a.txt", 1),
            ("2", "6", "YR", "a.txt", 2)]
    df = spark.createDataFrame(rows, "primaryid string, age string, age_cod string, _file string, _row int")
    got = {r["primaryid"]: r["age_years"] for r in C.clean_demo(df).collect()}
    assert got == {"1": 20.0, "2": 6.0}


def test_assembly_keeps_cases_without_indications(spark):
    demo = spark.createDataFrame([("1", "30", "YR", "M", "a", 0), ("2", "40", "YR", "F", "a", 1)],
                                 "primaryid string, age string, age_cod string, sex string, _file string, _row int")
    drugs = spark.createDataFrame([("1", "PS", "X", None), ("2", "PS", "Y", None)],
                                  "primaryid string, role_cod string, prod_ai string, drugname string")
    reac = spark.createDataFrame([("1", "nausea"), ("2", "rash")], "primaryid string, pt string")
    indi = spark.createDataFrame([("1", "pain")], "primaryid string, indi_pt string")
    got = {r["primaryid"]: r["indications"] for r in C.build_cases(demo, drugs, reac, indi).collect()}
    assert got == {"1": ["Pain"], "2": None}


def test_bad_rows_and_na_tokens(spark, scratch):
    p = f"{scratch}/DEMO25Q1.txt"
    with open(p, "w") as f:
        f.write("A$B$C\n4$5\n6$7$8$9\n$NA$null\n1$2$3\n")
    rows = D.read_batches(spark, scratch, "DEMO").orderBy("_row").select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [("4", "5", None), (None, None, None), ("1", "2", "3")]


def test_threshold_defaults_and_ties(spark):
    # label 0: nothing positive -> all F1 = 0 -> 0.5; label 1: same F1 at several thresholds -> lowest
    rows = [(1, 0, 0, 0.9), (2, 0, 0, 0.2), (1, 1, 1, 0.95), (2, 1, 0, 0.05)]
    s = spark.createDataFrame(rows, "case_id int, label_id int, y int, p double")
    got = {r["label_id"]: (r["threshold"], r["f1"]) for r in CAL.best_thresholds(s, CAL.FINE_GRID).collect()}
    assert got[0] == (0.5, 0.0)
    assert got[1] == (CAL.FINE_GRID[0], 1.0)


def test_calibration_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    n, L = 400, 5
    p = rng.random((n, L))
    y = (rng.random((n, L)) < 0.3).astype(int)
    rows = [(i, j, int(y[i, j]), float(p[i, j])) for i in range(n) for j in range(L)]
    s = spark.createDataFrame(rows, "case_id int, label_id int, y int, p double")
    got = {r["label_id"]: r["threshold"] for r in CAL.best_thresholds(s, CAL.FINE_GRID).collect()}
    for j in range(L):
        best_t, best_f = 0.5, 0.0
        for t in CAL.FINE_GRID:
            pred = p[:, j] >= t
            tp, pp, ap = (pred & (y[:, j] == 1)).sum(), pred.sum(), y[:, j].sum()
            f1 = 2 * tp / (pp + ap) if pp + ap else 0.0
            if f1 > best_f:
                best_t, best_f = t, f1
        assert got[j] == best_t


def test_f1_zero_labels_count_in_macro(spark):
    rows = [(1, 0, 1, True), (1, 1, 0, False), (2, 0, 0, False), (2, 1, 0, False)]
    pred = spark.createDataFrame(rows, "case_id int, label_id int, y int, pred boolean")
    s = M.summary(pred).first()
    assert s["f1_macro"] == pytest.approx(0.5)
    assert s["f1_micro"] == pytest.approx(1.0)
    assert s["f1_samples"] == pytest.approx(0.5)  # case 2: empty vs empty -> 0
    assert s["hamming_loss"] == 0.0


def test_outcome_invariants(spark):
    rng = np.random.default_rng(5)
    rows = [(i, j, int(rng.random() < 0.3), bool(rng.random() < 0.4)) for i in range(50) for j in range(6)]
    pred = spark.createDataFrame(rows, "case_id int, label_id int, y int, pred boolean")
    for r in M.case_outcomes(pred).collect():
        assert len(r["tp"]) + len(r["fn"]) == r["n_real"]
        assert len(r["tp"]) + len(r["fp"]) == r["n_predicted"]


def test_age_bins_and_medians(spark):
    rows = [("1", 29.9, None, "M", None), ("2", 30.0, 80.0, "F", ["X"]), ("3", 60.0, None, None, None),
            ("4", 60.1, None, None, None), ("5", None, None, None, None)]
    df = spark.createDataFrame(rows, "primaryid string, age_years double, weight_kg double, sex string, other_drugs array<string>")
    m = FT.FeatureModel(age_median=45.0, weight_median=70.0)
    got = {r[0]: r[1:] for r in df.select("primaryid", *FT.demographics(m)).collect()}
    assert got["1"][4:7] == (1.0, 0.0, 0.0)
    assert got["2"][4:7] == (0.0, 1.0, 0.0) and got["2"][7] == 0.0
    assert got["3"][4:7] == (0.0, 1.0, 0.0)
    assert got["4"][4:7] == (0.0, 0.0, 1.0)
    assert got["5"][0] == 0.45 and got["5"][4:7] == (0.0, 1.0, 0.0)  # median bin


def test_residual_text(spark):
    m = FT.FeatureModel(drug_vocab=["A"], indi_vocab=["PAIN"], other_vocab=[])
    df = spark.createDataFrame([(["A"], None, ["Pain"]), (None, None, None), (["B C"], ["B C"], None)],
                               "drug array<string>, other_drugs array<string>, indications array<string>")
    got = [r[0] for r in df.select(FT.residual_text(F.col("drug"), F.col("other_drugs"), F.col("indications"), m)).collect()]
    assert got == ["unknown", "unknown", "b c b c"]


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["aa bb aa", "bb cc", "aa cc dd", "aa", "bb bb", "cc aa", "9x aa1 b"] * 2)], "doc_id int, text string")
    terms, idf = FT.fit_tfidf(docs, "text", "doc_id", min_df=2, max_terms=3)
    assert terms == sorted(terms) and len(terms) == 3
    n = 14
    row = docs.where("doc_id = 0").select(FT.tfidf_vector(F.col("text"), terms, idf)).first()[0]
    raw = np.array([{"aa": 2, "bb": 1}.get(t, 0) for t in terms], dtype=float) * np.array(idf)
    assert np.allclose(row, raw / np.linalg.norm(raw))
    assert idf[terms.index("aa")] == pytest.approx(math.log((1 + n) / (1 + 8)) + 1)


def test_name_mapping(spark):
    names = spark.createDataFrame([(1, "ID1", "metformin"), (2, "ID2", "Aspirin"), (3, "ID3", "aspirin ")],
                                  "row_order int, stitch_id string, drug_name string")
    drugs = spark.createDataFrame([("METFORMIN HYDROCHLORIDE",), ("METFORMIN SODIUM HYDROCHLORIDE",), ("ASPIRIN",)], "drug string")
    got = {r["drug"]: r["stitch_id"] for r in V.map_names(drugs, names).collect()}
    assert got == {"METFORMIN HYDROCHLORIDE": "ID1", "METFORMIN SODIUM HYDROCHLORIDE": None, "ASPIRIN": "ID3"}


def test_validation_scores(spark):
    pred = spark.createDataFrame([("D1", ["E1", "E2"]), ("D2", []), ("D3", ["E1"])], "drug string, predicted array<string>")
    mapped = spark.createDataFrame([("D1", "S1"), ("D2", "S1"), ("D3", "S9")], "drug string, stitch_id string")
    known = spark.createDataFrame([("S1", ["E1", "Z"]), ("S9", ["Q"])], "stitch_flat string, known array<string>")
    vocab = spark.createDataFrame([("E1",), ("E2",)], "label string")
    got = {r["drug"]: r for r in V.drug_scores(pred, mapped, known, vocab).collect()}
    assert got["D1"]["precision"] == 0.5 and got["D1"]["recall"] == 1.0
    assert got["D2"]["precision"] == 0.0 and got["D2"]["tp"] == 0
    assert got["D3"]["f1"] is None and got["D3"]["tp"] == 0  # no known effect in the vocabulary


def test_substring_filter(spark):
    df = spark.createDataFrame([("INSULIN",), ("INSULIN GLARGINE",), ("IN.ULIN",)], "d string")
    assert df.where(R.contains_literal(F.col("d"), "INSULIN")).count() == 2


def test_dominance_and_crowding(spark):
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0), (3, 0.5, 0.5), (4, 2.0, 0.0)], "ind int, o1 double, o2 double")
    r = {x["ind"]: x["front"] for x in PA.pareto_rank(pts).collect()}
    assert r == {1: 0, 2: 0, 4: 0, 3: 1}  # equal points do not dominate each other
    c = {x["ind"]: x["crowd"] for x in PA.crowding(PA.pareto_rank(pts)).collect()}
    assert math.isinf(c[3])  # a front of one point


def test_rank_probabilities(spark):
    fit = spark.createDataFrame([(i, float(i % 3)) for i in range(7)], "ind int, fitness double")
    p = {r["ind"]: r["prob"] for r in EV.rank_probs(fit, 1.7).collect()}
    assert sum(p.values()) == pytest.approx(1.0)
    p2 = EV.rank_probs(fit, 2.0).orderBy("rank").first()["prob"]
    assert p2 == pytest.approx(0.0)
    p1 = {r["prob"] for r in EV.rank_probs(fit, 1.0).collect()}
    assert all(x == pytest.approx(1 / 7) for x in p1)
    single = spark.createDataFrame([(1, 0.3)], "ind int, fitness double")
    assert EV.rank_probs(single, 1.7).first()["prob"] == 1.0
    assert ST.rank_share(np.array([0.1, 0.5, 0.3]), 1.7).sum() == pytest.approx(1.0)


def test_empty_mask_scores_zero(spark):
    from caseflow.operators import select as SEL
    rng = np.random.default_rng(0)
    val = spark.createDataFrame([(i, [float(x) for x in rng.random(4)], [int(i % 2)]) for i in range(30)],
                                "case_id int, features array<double>, labels array<int>")
    masks = np.array([[False] * 4, [True] * 4])
    gram = SEL.gram_arrays(val, 4, 2)
    fit, f1 = SEL.mask_fitness(val, masks, gram, gram, 2)
    assert fit[0] == 0.0 and f1[0] == 0.0 and fit[1] == pytest.approx(f1[1] - SEL.PARSIMONY)


def test_patient_text(spark):
    df = spark.createDataFrame([(72.9, "F", 82.4, "GABAPENTIN", "TRAMADOL", "Pain"), (25.0, "M", None, "ADALIMUMAB", None, "")],
                               "a double, s string, w double, d string, o string, i string")
    got = [r[0] for r in df.select(R.patient_text(*[F.col(c) for c in "aswdoi"])).collect()]
    assert got[0] == ("patient: age 72 years, sex female, weight 82 kg. drug: GABAPENTIN. "
                      "other medications: TRAMADOL. indication: Pain")
    assert got[1].endswith("weight unknown. drug: ADALIMUMAB. other medications: unknown. indication: unknown")


def test_crossover_children_are_complementary(spark):
    pairs = spark.createDataFrame([(0, [1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0])], "pair long, g1 array<double>, g2 array<double>")
    for kind in ("uniform", "one_point", "arithmetic"):
        r = EV.crossover(pairs, kind).first()
        assert np.allclose(np.array(r["c1"]) + np.array(r["c2"]), [6.0, 8.0, 10.0, 12.0])
    with pytest.raises(ValueError):
        EV.crossover(pairs, "nope")


def test_ridge_matches_numpy(spark):
    from caseflow.operators import select as SEL
    rng = np.random.default_rng(11)
    x = rng.normal(size=(60, 5))
    labs = [[int(i % 3)] + ([2] if i % 4 == 0 else []) for i in range(60)]
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], labs[i]) for i in range(60)],
                               "case_id int, features array<double>, labels array<int>").repartition(4)
    xx, xy, sx, n = SEL.gram_arrays(df, 5, 3)
    assert n == 60 and np.allclose(sx, x.sum(0))
    y = np.zeros((60, 3))
    for i, ls in enumerate(labs):
        y[i, sorted(set(ls))] = 1.0
    assert np.allclose(xx, x.T @ x) and np.allclose(xy, x.T @ y)
    w = SEL.ridge_weights(xx, xy)
    assert np.allclose(w, np.linalg.solve(x.T @ x + 5.0 * np.eye(5), x.T @ y))


def test_mask_fitness_matches_brute_force(spark):
    from caseflow.operators import select as SEL
    rng = np.random.default_rng(21)
    n, k, L = 90, 6, 3
    x = rng.normal(size=(n, k))
    labs = [[int(rng.integers(0, L))] for _ in range(n)]
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], labs[i]) for i in range(n)],
                               "case_id int, features array<double>, labels array<int>").repartition(5)
    masks = np.array([[True, False, True, True, False, True], [True] * k, [False] * k])
    gram = SEL.gram_arrays(df, k, L)
    fit, f1 = SEL.mask_fitness(df, masks, gram, gram, L)
    y = np.zeros((n, L), dtype=bool)
    for i, ls in enumerate(labs):
        y[i, ls] = True
    for r in range(2):
        cols = np.nonzero(masks[r])[0]
        w = np.linalg.solve(x[:, cols].T @ x[:, cols] + 5.0 * np.eye(len(cols)), x[:, cols].T @ y.astype(float))
        s = x[:, cols] @ w
        p = 1 / (1 + np.exp(-np.clip((s - s.mean(0)) / (s.std(0) + 1e-9), -30, 30)))
        best = []
        for j in range(L):
            b = 0.0
            for t in CAL.FIT_GRID:
                pred = p[:, j] >= t
                tp, pp, ap = (pred & y[:, j]).sum(), pred.sum(), y[:, j].sum()
                b = max(b, 2 * tp / (pp + ap) if pp + ap else 0.0)
            best.append(b)
        assert f1[r] == pytest.approx(np.mean(best), abs=1e-12)
        assert fit[r] == pytest.approx(np.mean(best) - SEL.PARSIMONY * len(cols) / k, abs=1e-12)
    assert fit[2] == 0.0


def test_array_evaluation_matches_long_form(spark):
    from caseflow.operators.score import NetShape
    from caseflow.plans import pipeline as PL
    rng = np.random.default_rng(8)
    shape = NetShape(4, 3, 3)
    g = rng.normal(size=shape.n_params)
    rows = [(i, [float(v) for v in rng.normal(size=4)], [int(i % 3)] + ([0] if i % 5 == 0 else [])) for i in range(80)]
    df = spark.createDataFrame(rows, "case_id int, features array<double>, labels array<int>").repartition(3)
    fast = PL.evaluate_genome(df, df, g, shape)
    labels = spark.range(3).select(F.col("id").cast("int").alias("label_id"))
    thr = CAL.best_thresholds(PL.dense_scores(df, g, shape), CAL.FINE_GRID, labels=labels)
    from caseflow.operators import score as SC
    slow = M.summary(SC.predict_flags(PL.dense_scores(df, g, shape), thr), n_labels=3).first().asDict()
    for k, v in slow.items():
        assert fast[k] == pytest.approx(v, abs=1e-12), k


def peeled(pts):
    """Fronts by taking the undominated points away, again and again."""
    front, left, k = {}, set(range(len(pts))), 0
    while left:
        top = {i for i in left if not any((pts[j] >= pts[i]).all() and (pts[j] > pts[i]).any() for j in left)}
        front |= dict.fromkeys(top, k)
        left -= top
        k += 1
    return [front[i] for i in range(len(pts))]


def test_fronts_dominators_and_spacing(spark):
    rng = np.random.default_rng(4)
    for _ in range(20):
        pts = np.round(rng.random((60, 2)) * 5) / 5  # many ties and duplicates
        assert list(ST.layers(pts)) == peeled(pts)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "ind int, o1 double, o2 double").repartition(4)
    rows = {r["ind"]: r for r in PA.pareto_rank(df).collect()}
    assert [rows[i]["front"] for i in range(60)] == peeled(pts)
    assert [rows[i]["n_dominators"] for i in range(60)] == [sum((p >= q).all() and (p > q).any() for p in pts) for q in pts]
    crowd = {r["ind"]: r["crowd"] for r in PA.crowding(PA.pareto_rank(df)).collect()}
    assert np.allclose([crowd[i] for i in range(60)], ST.spacing(pts, ST.layers(pts)))
    assert [r["ind"] for r in PA.survivors(PA.crowding(PA.pareto_rank(df)), 60).collect()] == list(ST.by_front(pts))


def dominators(pts):
    return [sum((p >= q).all() and (p > q).any() for p in pts) for q in pts]


@pytest.mark.parametrize("shape", ["ties", "chain", "front", "spread"])
def test_fronts_over_many_strips(spark, shape):
    rng = np.random.default_rng(9)
    x = rng.random(90)
    pts = {"ties": np.round(rng.random((90, 2)) * 6) / 6, "chain": np.c_[x, x], "front": np.c_[x, -x], "spread": rng.random((90, 2))}[shape]
    if shape == "ties":
        pts[:30] = pts[0]  # a third of the rows are one point
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "ind int, o1 double, o2 double").repartition(3)
    rows = {r["ind"]: r for r in PA.pareto_rank(df, strip=25).collect()}
    assert len(rows) == 90
    assert [rows[i]["front"] for i in range(90)] == peeled(pts)
    assert [rows[i]["n_dominators"] for i in range(90)] == dominators(pts)


def test_points_without_objectives(spark):
    rows = [(1, 1.0, 2.0, "p"), (2, None, 5.0, "q"), (3, float("nan"), 5.0, None), (4, 0.0, 1.0, "r"), (5, -0.0, 1.0, "s"), (None, 0.5, 2.0, "t")]
    df = spark.createDataFrame(rows, "ind int, o1 double, o2 double, r string")  # r: a column of a name used inside
    want = sorted([(1, 0, 0), (2, None, None), (3, None, None), (4, 2, 2), (5, 2, 2), (None, 1, 1)], key=str)
    for strip in (2, 100):
        got = PA.pareto_rank(df, strip=strip)
        assert got.columns == ["ind", "o1", "o2", "r", "front", "n_dominators"]
        assert sorted([(x["ind"], x["front"], x["n_dominators"]) for x in got.collect()], key=str) == want
    assert PA.pareto_rank(df.limit(0)).count() == 0
    assert [x["front"] for x in PA.pareto_rank(df.where("ind in (2, 3)"), strip=1).collect()] == [None, None]


def test_step_equals_the_dataframe_operators(spark):
    """The step of the searches, gene by gene, against the operators on tables."""
    from caseflow.operators.score import NetShape

    shape, seed, gen = NetShape(3, 2, 2), 42, 5
    pop = ST.first_population(shape, np.arange(10), seed, 1.0)
    table = EV.init_population(spark, shape, 10, seed).orderBy("ind").collect()
    assert np.allclose([r["genome"] for r in table], pop, rtol=0, atol=1e-12)
    fitness = np.array([0.3, 0.1, 0.3, 0.9, 0.2, 0.2, 0.5, 0.1, 0.0, 0.4])
    fit = spark.createDataFrame([(i, float(f)) for i, f in enumerate(fitness)], "ind long, fitness double")
    probs = EV.rank_probs(fit, 1.7)
    assert np.allclose([r["prob"] for r in probs.orderBy("ind").collect()], ST.rank_share(fitness, 1.7))
    assert [r["ind"] for r in EV.roulette(probs, 40, seed, gen).orderBy("draw").collect()] == list(ST.roulette(ST.rank_share(fitness, 1.7), 40, seed, gen))
    assert [r["ind"] for r in EV.tournament(fit, 40, 3, seed, gen).orderBy("draw").collect()] == list(ST.tournament(ST.by_fitness(fitness), 40, 3, seed, gen))
    assert [r["ind"] for r in EV.elites(fit, 4).collect()] == list(ST.by_fitness(fitness)[:4])
    pairs = spark.createDataFrame([(i, pop[2 * i].tolist(), pop[2 * i + 1].tolist()) for i in range(5)], "pair long, g1 array<double>, g2 array<double>")
    for kind in ("uniform", "one_point", "arithmetic"):
        rows = EV.crossover(pairs, kind, seed, gen).orderBy("pair").collect()
        assert np.allclose([c for r in rows for c in (r["c1"], r["c2"])], ST.cross(pop[0::2], pop[1::2], kind, 1.0, seed, gen))
    with pytest.raises(ValueError):
        ST.cross(pop[:1], pop[:1], "nope", 1.0, seed, gen)
    both = spark.createDataFrame([(i + 3, g.tolist()) for i, g in enumerate(pop)], "ind long, genome array<double>")
    rows = EV.mutate(both, 0.3, 0.25, seed, gen).orderBy("ind").collect()
    assert np.allclose([r["genome"] for r in rows], ST.perturb(pop, 3, 0.3, 0.25, seed, gen), rtol=0, atol=1e-12)
    rows = EV.bitflip(both.select("ind", F.transform("genome", lambda x: x > 0).alias("mask")), 0.3, seed, gen).orderBy("ind").collect()
    assert [r["mask"] for r in rows] == ST.flip(pop > 0, 3, 0.3, seed, gen).tolist()


def test_exact_median(spark):
    rng = np.random.default_rng(2)
    for values in ([3.0], [1.0, 2.0], [5.0] * 9, rng.normal(size=1001).tolist(), np.round(rng.random(500) * 7).tolist(), [1e-300, 1e300, 2.0, 2.0], [0.0, 1.0] * 50):
        df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("inf")]], "x double").repartition(3)
        assert FT.exact_median(df, "x") == np.median(values)
    assert FT.exact_median(df.limit(0), "x") is None


def test_strip_matches_python(spark):
    vals = ["\t a b \n", "　x ", "\x1cy\x85", "  ", "z", "​q"]
    assert col(spark, vals, X.strip_ws) == [v.strip() for v in vals]


def test_hash_split_sizes_and_stability(spark):
    from caseflow.operators import split as SP
    assert SP.split_sizes(10) == (3, 0) and SP.split_sizes(101) == (31, 7)
    df = spark.range(1001).select(F.col("id").cast("string").alias("k"))
    a = {r["k"]: r["split"] for r in SP.hash_split(df.repartition(1), "k").collect()}
    b = {r["k"]: r["split"] for r in SP.hash_split(df.repartition(7), "k").collect()}
    assert a == b
    counts = {s: sum(1 for v in a.values() if v == s) for s in ("test", "val", "train")}
    assert counts == {"test": 301, "val": 70, "train": 630}


def test_positions_are_exact_without_shuffling_rows(spark, monkeypatch):
    from caseflow.functions import expr as X

    df = spark.range(3000).selectExpr("cast(id AS string) AS k", "id").unionByName(spark.range(3).selectExpr("cast(null AS string) AS k", "id"))
    order = [r["k"] for r in df.where("k IS NOT NULL").select("k", X.hash_bits(42, "k").alias("h")).orderBy("h", "k").collect()]
    for few in (50_000, 40, 0):
        monkeypatch.setattr(SP, "FEW_ROWS", few)
        for n in (0, 1, 7, 1500, 2999, 3000, 9000) if few else (1, 1500):
            got = SP.hash_sample(df, n, "k")
            assert sorted(r["k"] for r in got.collect()) == sorted(order[:n])
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    split = SP.hash_split(df, "k")
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
    by = {r["k"]: r["split"] for r in split.collect()}
    assert [by[k] for k in order] == ["test"] * 900 + ["val"] * 210 + ["train"] * 1890


def test_repeated_keys_stay_together(spark, monkeypatch):
    monkeypatch.setattr(SP, "FEW_ROWS", 3)
    df = spark.createDataFrame([("a",)] * 20 + [("b",)] * 20, "k string")
    assert SP.hash_sample(df, 5, "k").count() == 20
    assert SP.hash_sample(df, 20, "k").count() == 20
    assert SP.hash_sample(df.limit(0), 5, "k").count() == 0
