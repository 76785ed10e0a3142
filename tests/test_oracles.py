"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()
QUERIES = E.queries()
# whole searches, minutes long: their steps are held against SQL, their loops run below with small budgets
SEARCHES = {"evolve_run", "nsga2", "feature_select", "ablation", "sweep", "final_fit"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_once():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows_of(got, False) == rows_of(want, False)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SEARCHES))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label_id", "label", "n_cases"]
    assert len(rows) > 0


def test_fitness_does_not_depend_on_partitioning(spark):
    from caseflow.operators import evolve as EV
    from caseflow.operators import step as ST
    from caseflow.plans.q_evolve import EMB_SHAPE, emb_labelled

    data = emb_labelled(spark, SF)
    pop = ST.first_population(EMB_SHAPE, np.arange(4), 7, 1.0)
    a = EV.population_fitness(data.repartition(1), pop, EMB_SHAPE)
    b = EV.population_fitness(data.repartition(7), pop, EMB_SHAPE)
    assert np.allclose(a, b, rtol=0, atol=1e-12)


@pytest.fixture(scope="module")
def labelled(spark):
    from caseflow.plans.q_evolve import emb_labelled

    return emb_labelled(spark, SF).cache()


def test_elitism_keeps_running_best(labelled):
    from caseflow.operators import evolve as EV
    from caseflow.plans.q_evolve import EMB_SHAPE

    best, best_fitness, hist = EV.evolve(labelled, EMB_SHAPE, EV.GAConfig(pop_size=6, generations=3))
    bests = [r["best"] for r in hist.orderBy("gen").collect()]
    assert len(bests) == 3 and all(b2 >= b1 - 1e-12 for b1, b2 in zip(bests, bests[1:]))
    assert best_fitness >= max(bests) - 1e-12
    assert EV.population_fitness(labelled, best[None], EMB_SHAPE)[0] == pytest.approx(best_fitness)


def test_searches_in_lock_step_equal_searches_alone(labelled):
    from caseflow.operators import evolve as EV
    from caseflow.plans.q_evolve import EMB_SHAPE

    configs = [EV.GAConfig.plain(pop_size=5, generations=2), EV.GAConfig.plain(pop_size=4, generations=3, random=True),
               EV.GAConfig(pop_size=6, generations=1), EV.GAConfig.plain(pop_size=5, generations=2, p_crossover=0.0, elitism=0)]
    for together, cfg in zip(EV.run_searches(labelled, EMB_SHAPE, configs), configs):
        (alone,) = EV.run_searches(labelled, EMB_SHAPE, [cfg])
        assert np.array_equal(together.pop, alone.pop) and together.best_fitness == alone.best_fitness
        assert together.gen == cfg.generations == len(together.history)


def test_comparison_tables(labelled):
    from caseflow.plans import pipeline as PL
    from caseflow.plans.q_evolve import EMB_SHAPE

    rows = {r["config"]: r for r in PL.ablation(labelled, EMB_SHAPE, pop_size=5, generations=2).collect()}
    assert list(rows) == ["random_search", "mutation_only", "crossover_only", "no_elitism", "full"]
    first = min(r["best_fit"] for r in rows.values())
    assert all(0 < r["test_f1"] < 1 and r["best_fit"] >= first for r in rows.values())
    got = PL.sweep(labelled, EMB_SHAPE, pop_size=4, generations=1).collect()
    assert [(r["sweep"], r["param"]) for r in got] == [("mutation", "p_mutation")] * 6 + [("crossover_prob", "p_crossover")] * 4 + [("crossover_kind", "crossover")] * 3
    assert [r["value"] for r in got][-3:] == ["uniform", "one_point", "arithmetic"]
    (longer,) = PL.sweep(labelled, EMB_SHAPE, [("generations", "generations", [2])], pop_size=4).collect()
    assert longer["value"] == "2" and longer["best_fit"] > 0


def test_nsga2_front_is_undominated(labelled):
    from caseflow.plans import pipeline as PL
    from caseflow.plans.q_evolve import EMB_SHAPE

    rows = PL.nsga2(labelled, EMB_SHAPE, pop=8, gens=2).collect()
    assert rows and all(a["precision_macro"] <= b["precision_macro"] and a["recall_macro"] >= b["recall_macro"] for a, b in zip(rows, rows[1:]))


def test_feature_selection_beats_its_first_masks(labelled):
    from caseflow.operators import select as SEL
    from caseflow.plans.q_evolve import EMB_SHAPE

    mask, best, base, hist = SEL.feature_select(labelled, labelled, EMB_SHAPE.d, EMB_SHAPE.o, pop=6, gens=3)
    grams = [SEL.gram_arrays(labelled, EMB_SHAPE.d, EMB_SHAPE.o)] * 2
    fit, f1 = SEL.mask_fitness(labelled, np.stack([mask, np.ones_like(mask)]), *grams, EMB_SHAPE.o)
    assert fit[0] == pytest.approx(best) and f1[1] == pytest.approx(base) and hist[-1][3] == mask.sum()
    assert best >= max(h[1] for h in hist) - 1e-12


def test_final_fit(labelled):
    from caseflow.operators import evolve as EV
    from caseflow.plans import pipeline as PL
    from caseflow.plans.q_evolve import EMB_SHAPE

    _, best_fit, _, metrics, _ = PL.train_and_test(labelled, EMB_SHAPE, EV.GAConfig(pop_size=5, generations=2))
    assert 0 < best_fit < 1 and 0 < metrics["f1_macro"] < 1 and 0 <= metrics["hamming_loss"] < 1


def test_generation_study_is_the_main_trainer(spark, labelled, monkeypatch):
    from caseflow.operators import evolve as EV
    from caseflow.plans import pipeline as PL
    from caseflow.plans.q_evolve import EMB_SHAPE

    rows = PL.generation_study(labelled, EMB_SHAPE, [1, 3], pop_size=5).collect()
    for row, n in zip(rows, [1, 3]):
        _, best_fit, _, metrics, _ = PL.train_and_test(labelled, EMB_SHAPE, EV.GAConfig(pop_size=5, generations=n))
        assert (row["value"], row["best_fit"]) == (str(n), pytest.approx(best_fit)) and row["test_f1"] == pytest.approx(metrics["f1_macro"])

    ran = []
    monkeypatch.setattr(PL, "compare", lambda data, shape, configs, *a, **b: ran.extend(configs) or [(0.5, 0.5)] * len(configs))
    monkeypatch.setattr(PL, "train_and_test", lambda data, shape, cfg, *a, **b: ran.append(cfg) or (None, 0.5, None, {}, 1.0))
    assert [r["value"] for r in QUERIES["sweep"](spark, SF).where("sweep = 'generations'").collect()] == ["120", "300", "500"]
    assert ran[13:] == [EV.GAConfig(generations=n) for n in (120, 300, 500)]
    QUERIES["final_fit"](spark, SF)
    assert ran[-1] == EV.GAConfig() and ran[-1].generations == 300
