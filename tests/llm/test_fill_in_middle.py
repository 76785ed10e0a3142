import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from caseflow.llm import fill_in_middle as fim
from caseflow.llm import queries
from caseflow.llm.registry import ORACLES

from .oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf):
    assert spark_rows(queries.op11_fill_in_middle(spark, sf)) == duck_rows(ORACLES["op11_fill_in_middle"], sf)


def unit_starts(text, unit):
    if unit == "char":
        return list(range(len(text)))
    if unit == "word":
        return [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return [0] * bool(text) + [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)]


@given(st.text(alphabet="ab é日\U0001f600\n\t\x85", max_size=60), st.sampled_from(fim.UNITS), st.integers(1, 70), st.integers(1, 9))
def test_tree_finds_every_place(text, unit, k, block):
    starts = unit_starts(text, unit)
    tree = fim.BlockTree(text.encode(), unit, block)
    assert (tree.n_units, tree.n_chars) == (len(starts), len(text))
    want = starts[k] if k < len(starts) else len(text)
    assert tree.place(k) == (len(text[:want].encode()), want)


@given(st.text(alphabet="ab<>PSM é日", max_size=40), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4), st.sampled_from(fim.UNITS))
def test_every_output_gives_its_text_back(text, h, unit):
    n, form, prefix, middle, output = fim.transform(text.encode(), h, unit, block=3)
    assert fim.restore(output.decode(), form) == text
    assert n == len(unit_starts(text, unit))
    if form == "plain":
        assert output.decode() == text and prefix is middle is None
        assert not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90
        return
    places = [*unit_starts(text, unit), len(text)]
    a, b = sorted((places[h[0] % (n + 1)], places[h[1] % (n + 1)]))
    assert (prefix, middle) == (a, b - a)
    p, m, s = text[:a], text[a:b], text[b:]
    assert (form, output.decode()) == (("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}"))


def test_markers_at_the_cuts():
    for p, m, s in [("<", "<", "<"), ("<P", "S>", "<M"), ("x<S", "", ">"), ("<", "P>a<S", ">")]:
        for form, output in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            assert fim.restore(output, form) == p + m + s


ROWS = [(1, "a b", 5), (1, "a b", 6), (None, "cde", 7), (2, None, 8), (3, "", 9), (4, "é日 " * 100_000, 0), (5, "x<M>y", 1)]


@pytest.mark.parametrize("unit", fim.UNITS)
def test_defined_rows(spark, unit):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, n long")
    made = fim.transform_documents(df, unit=unit, restored=True)
    got = sorted(((r.doc_id, r.n, r.form, r.restored) for r in made.collect()), key=str)
    want = []
    for i, t, _ in ROWS:
        digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h3, h4 = int(digest[16:24], 16), int(digest[24:32], 16)
        form = "plain" if not t or "<M>" in t or h3 % 100 >= 90 else "spm" if h4 % 100 < 20 else "psm"
        want.append((i, len(unit_starts(t or "", unit)), form, t or ""))
    assert got == sorted(want, key=str)
    back = fim.restore_documents(made)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, _ in ROWS)
    assert fim.transform_documents(df.limit(0)).count() == 0


def test_unknown_unit(spark):
    with pytest.raises(ValueError, match="unit"):
        fim.transform_documents(spark.createDataFrame(ROWS, "doc_id long, text string, n long"), unit="page")
