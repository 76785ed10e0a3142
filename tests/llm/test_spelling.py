import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def counted(rows, one_in=199, min_length=6):
    """One occurrence at a time."""
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= min_length
    return +out


def neighbours(words):
    """Near words by all deletions: equal after one deletion from the longer, or after one at the same place from both."""
    near = {w: set() for w in words}
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
            if (short := w[:i] + w[i + 1 :]) in near:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for a, b in combinations(group, 2):
            near[a].add(b)
            near[b].add(a)
    return near


def brute(rows, one_in=199):
    n = {w: c for w, c in counted(rows, one_in).items() if c >= 5}
    near = neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n.get(form[w], -1)) for w in n)


def told(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=4, max_size=8), min_size=2, max_size=30, unique=True))
def test_tile_finds_each_near_pair_once(words):
    found = []
    for m in range(4, 9):
        some = [w for w in words if len(w) in (m, m - 1)]
        found += [frozenset((some[i], some[j])) for i, j in zip(*spelling.tile(some, m, 0, 0, m + 1))]
    want = {frozenset(p) for p in combinations(words, 2) if distance_one(*p)}
    assert len(found) == len(set(found)) and set(found) == want


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = told(queries.op12_spelling_variants(spark, sf))
    assert got == want and any(f for _, f, *_ in want)


@pytest.mark.parametrize("group_words,broadcast_keys", [(1, 10**6), (2, 0), (7, 10**6), (10_000, 0)])
def test_group_sizes_do_not_change_the_pairs(spark, group_words, broadcast_keys):
    """Runs of one letter, shared halves and a hot prefix, where a pair fits several groups."""
    words = ["a" * k for k in range(4, 9)] + ["abcdef" + x + y for x in "abcdeé" for y in "abcdeé"] + ["bb" * 3, "bb" * 2 + "b", "abbbba", "abbba", "xabbba", "abab" * 2, "ababab", "bababa", "abababa"]
    words = sorted(set(words))
    n = {w: 5 + 3 * i for i, w in enumerate(words)}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    near = neighbours(words)
    want = sorted((w, len(near[w]), -n[b], b) for w in words if near[w] for b in [min(near[w], key=lambda x: (-n[x], x))])
    assert sorted(map(tuple, spelling.near_words(df, group_words, broadcast_keys).collect())) == want


def test_defined_rows(spark):
    rows = [(1, "Letter lettter " * 30), (1, "letter " * 5), (None, "lettre " * 6), (2, None), (3, ""), (4, "ÉCOLES écoles éCOLES " * 5), (5, "z" * 70_000 + " ")] * 5 + [(6, "short words only")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert told(spelling.group_variants(df)) == brute(rows)
    assert told(spelling.group_variants(df.repartition(5), one_in=3, group_words=1)) == brute(rows, 3)
    assert spelling.group_variants(df.limit(0)).count() == 0
    assert spelling.group_variants(df.where("doc_id IN (2, 3, 6)")).count() == 0


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("side", "w5"), ("x", "y")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()))
    assert got == {**{f"w{i}": "w13" for i in range(13)}, "side": "w13", "x": "y"}
