import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import components, ngram_join, queries
from caseflow.llm.ngram_join import ListIndex, link_group

SF = "/root/testdata/sf0.01"


def shingles(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)])


def brute(rows):
    """[(id, text)] -> sorted [(id, n_shingles, component_id)] by all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    pairs = {(a, b) for w in where.values() for k, a in enumerate(w) for b in w[k + 1 :]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            up[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=str)


def run(df, **names):
    return sorted(((r[0], r.n_shingles, r.component_id) for r in ngram_join.similar_groups(df, **names).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=12))
def test_search_finds_exactly_the_linked_sets(raw):
    sets = [np.array(sorted(s), np.uint64) for s in raw]
    index = ListIndex(sets)
    for i, s in enumerate(raw):
        want = {(j, len(s & o)) for j, o in enumerate(raw) if 4 * len(s & o) >= 3 * len(s | o)}
        assert set(index.search(sets[i])) == want
    roots = link_group(sets)
    up = list(range(len(raw)))
    for a in range(len(raw)):
        for b in range(a):
            if 4 * len(raw[a] & raw[b]) >= 3 * len(raw[a] | raw[b]):
                old, new = up[a], up[b]
                up = [new if x == old else x for x in up]
    assert all((roots[a] == roots[b]) == (up[a] == up[b]) for a in range(len(raw)) for b in range(a))


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(50), rnd.randrange(50)) for _ in range(30)] + [(7, 7), (900, 901), (901, 900)]
    up = list(range(1000))
    for a, b in edges:
        up = [min(up[a], up[b]) if x in (up[a], up[b]) else x for x in up]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((x, up[x]) for x in nodes)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    assert sum(c != d for d, _, c in want) > 20
    assert sorted(map(tuple, queries.op6_ngram_join(spark, SF).collect()), key=str) == want


def changed(ws, rnd, n):
    ws = list(ws)
    for _ in range(n):
        ws[rnd.randrange(len(ws))] = f"new{rnd.randrange(10**6)}"
    return " ".join(ws)


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(5)
    word = lambda: f"w{rnd.randrange(3000)}"
    passage = " ".join(word() for _ in range(60))
    rows, k = [], 0
    for _ in range(40):  # groups of near copies around the threshold, many with a shared passage
        base = [word() for _ in range(rnd.randrange(40, 120))]
        for _ in range(rnd.randrange(1, 6)):
            rows.append((k := k + 1, changed(base, rnd, rnd.randrange(0, 5)) + (" " + passage if rnd.random() < 0.5 else "")))
    hot = [word() for _ in range(80)]
    for _ in range(150):  # one large group of different near copies
        rows.append((k := k + 1, changed(hot, rnd, rnd.randrange(1, 3))))
    rows += [(k + 1 + i, " ".join(hot)) for i in range(30)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "a b"), (1004, "A  B"), (1005, "a b c d e"), (1006, "b a"), (None, "a b"), (None, None), (1005, "other one"), (1010, "x y " * 20_000), (1011, "X y " * 19_000)]
    return rows


def test_planted_groups(spark, planted):
    df = spark.createDataFrame([(*r, 1, b"x") for r in planted], "key long, body string, node int, digest binary").repartition(5)
    assert run(df, id_col="key", text_col="body") == brute(planted)
    assert ngram_join.similar_groups(df.limit(0), "key", "body").count() == 0


def test_large_groups_and_shuffled_ids_give_the_same(spark, planted, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_NODES", 20)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    df = spark.createDataFrame(planted, "doc_id long, text string").repartition(3)
    assert run(df) == brute(planted)


def test_keep_one(spark):
    df = spark.createDataFrame([(3, "a b c d e f", "x"), (2, "A b c d e f", "y"), (9, None, "z"), (8, "other", "n")], "doc_id long, text string, id string")
    assert sorted(map(tuple, ngram_join.keep_one_of_each_group(df).collect())) == [(2, "A b c d e f", "y"), (8, "other", "n"), (9, None, "z")]


def test_keep_one_decides_by_row(spark):
    a, b, c, d = "a b c d e f", "g h i j k l", "m n o p q r", "s t u v w x"
    rows = [(1, a, "x"), (1, a, "x"), (2, a, "x"), (1, b, "y"), (0, b, "y"), (None, a, "x"), (None, c, "z"), (None, d, "w"), (None, d.upper(), "w"), (5, None, "n"), (5, " ", "n"), (7, "other", "o")]
    got = ngram_join.keep_one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)).collect()
    want = [(0, b, "y"), (1, a, "x"), (5, " ", "n"), (5, None, "n"), (7, "other", "o"), (None, c, "z"), (None, d, "w")]
    assert sorted(((r.doc_id, (r.text or "-").lower(), r.row) for r in got), key=str) == sorted(((i, (t or "-").lower(), o) for i, t, o in want), key=str)
