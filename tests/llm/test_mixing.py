import math
import re
from collections import Counter
from fractions import Fraction

import pytest

from caseflow.llm import mixing, queries
from caseflow.llm.registry import ORACLES

from .oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    assert spark_rows(queries.op3_mixing(spark, sf)) == duck_rows(ORACLES["op3_mixing"], sf)


def edf(weights):
    """One slot at a time for one period; sources by weight, then name."""
    d = math.gcd(*weights)
    weights = sorted((w // d for w in weights), reverse=True)
    total, had, out = sum(weights), [0] * len(weights), []
    for t in range(total):
        ready = [(-(-(had[i] + 1) * total // a), i) for i, a in enumerate(weights) if had[i] * total // a <= t]
        _, i = min(ready)
        out.append((i, had[i]))
        had[i] += 1
    return out


def scheduled(spark, weights):
    """(slot, place of the source by weight and name, block) of one period."""
    names = sorted(range(len(weights)), key=lambda i: (-weights[i], i))
    df = spark.createDataFrame([(f"s{i:06}", w) for i, w in enumerate(weights)], "source string, weight long")
    shared = {(r.slots, r.member): int(r.source[1:]) for r in mixing.shared_period(df).collect()}
    members = Counter(a for a, _ in shared)
    place = {i: p for p, i in enumerate(names)}
    got = mixing.period_schedule(mixing.shared_period(df)).collect()
    return sorted((r.slot, place[shared[r.slots, r.k % members[r.slots]]], r.k // members[r.slots]) for r in got), names


@pytest.mark.parametrize("weights", [[1], [1, 1], [5, 3, 2], [97, 1, 1, 1], [7] * 7, [1000, 1, 30, 30, 30, 400, 3], [99] + [1] * 99, [700, 700, 1, 1, 1, 13, 13, 999]])
def test_every_source_stays_within_one_block_of_its_target(spark, weights):
    got, names = scheduled(spark, weights)
    assert [(i, k) for _, i, k in got] == edf(weights)
    had, total = Counter(), sum(weights)
    for t, (_, source, _) in enumerate(got, 1):
        had[source] += 1
        for p, i in enumerate(names):
            assert abs(had[p] - Fraction(t * weights[i], total)) < 1


def test_ten_thousand_sources(spark):
    weights = [3 + i % 5 for i in range(10_000)] + [25_000]
    got, names = scheduled(spark, weights)
    total = sum(weights)
    assert len(got) == total == 75_000
    assert [t for t, _, _ in got] == list(range(total))
    for t, p, k in got:  # inside its window, which is what keeps the source within one block
        w = weights[names[p]]
        assert k * total // w <= t < -(-(k + 1) * total // w)


def places(mixed):
    return sorted(map(tuple, mixed.selectExpr("row.doc_id", "source", "block", "slot", "place", "in_mix").collect()), key=str)


def test_defined_rows_and_buckets_do_not_change_the_order(spark):
    rows = [(i, None if i % 3 else "b", "t", "x") for i in range(90)] + [(None, "c", None, "y"), (7, None, "t", "x"), (7, None, "t", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, slot string, key string")
    weights = spark.createDataFrame([(None, 4), (None, 2), ("b", 3), ("unused", 50)], "source string, weight long")
    a = places(mixing.mix(df, weights, block_rows=4))
    assert a == places(mixing.mix(df.repartition(9), weights, block_rows=4, bucket_rows=5)) and len(a) == len(rows)
    assert len({(s, p) for *_, s, p, _ in a}) == len(rows)  # no two rows share a place
    assert mixing.mix(df.limit(0)).count() == 0
    out = mixing.write_order(mixing.mix(df, weights, block_rows=4))
    assert out.columns == df.columns and sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)


def test_the_mix_is_true_to_given_weights_until_a_source_runs_out(spark):
    rows = [(i, "ab"[i % 10 == 0]) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("a", 97), ("b", 3)], "source string, weight long")
    got = mixing.mix(df, weights, block_rows=8).collect()
    inside = {(r.slot, r.source) for r in got if r.in_mix}
    slots = [s for _, s in sorted(inside)]
    assert sorted(x for x, _ in inside) == list(range(len(inside)))
    for t in range(1, len(slots) + 1):
        assert abs(slots[:t].count("a") - Fraction(97 * t, 100)) < 1
    blocks = Counter(r.source for r in {(x.source, x.block): x for x in got}.values())
    had = Counter(slots)
    assert any(had[s] == blocks[s] for s in blocks)  # it ends where a source has run out
    assert len(got) == len(rows)


def test_left_out_and_missing_sources(spark):
    df = spark.createDataFrame([(i, "abcd"[i % 4]) for i in range(400)], "doc_id long, source string")
    weights = spark.createDataFrame([("a", 0), ("b", 2), ("b", 7), ("c", None)], "source string, weight long")
    got = mixing.mix(df, weights, block_rows=5).collect()
    assert Counter(r.source for r in got) == {"b": 100, "d": 100}
    first = sorted({(r.slot, r.source) for r in got})[:10]
    assert Counter(s for _, s in first) == {"b": 9, "d": 1}


def test_targets_that_never_repeat_are_refused(spark):
    weights = spark.createDataFrame([("a", 1 << 40), ("b", 1)], "source string, weight long")
    with pytest.raises(ValueError, match="targets"):
        mixing.shared_period(weights)


def test_many_sources_without_weights(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "cast(id % 3000 AS string) AS source")
    got = mixing.mix(df).collect()
    assert len(got) == 6000 and len({r.slot for r in got}) == 3000 and all(r.block == 0 for r in got)


def test_no_python_in_the_plan(spark):
    assert not re.search("Python|Pandas|Arrow", queries.op3_mixing(spark, SF)._jdf.queryExecution().executedPlan().toString())
