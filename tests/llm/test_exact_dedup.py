import re

from hypothesis import given
from hypothesis import strategies as st

from caseflow.llm import exact_dedup, queries
from caseflow.llm.registry import ORACLES

from .oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@given(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85\xa0é", max_size=12))
def test_normalised_equals_pattern(text):
    assert exact_dedup.normalised(text).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", text)


def test_query_equals_sql(spark):
    assert spark_rows(queries.op2_exact_dedup(spark, SF)) == duck_rows(ORACLES["op2_exact_dedup"], SF)


def test_defined_rows(spark):
    rows = [(5, "a  b", 1), (3, "a\tb", 2), (9, None, 3), (8, "", 4), (7, " ", 5), (3, "a b", 6), (None, "a b", 7), (None, "z", 8), (1, "w " * 30_000, 9)]
    rows += [(100 + i, "hot text", 0) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id int").repartition(7)
    got = exact_dedup.exact_groups(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert sorted(by[3]) == [(3, 4, False), (3, 4, True)]
    assert by[5] == [(3, 4, False)]
    assert sorted(by[None], key=str) == [(3, 4, False), (None, 1, True)]
    assert by[9] == [(8, 2, False)] and by[8] == [(8, 2, True)] and by[7] == [(7, 1, True)]
    assert [by[100 + i] for i in range(500)] == [[(100, 500, i == 0)] for i in range(500)]
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_equal_digests_do_not_merge_different_texts(spark):
    """With a digest that always collides, full content still decides."""

    def all_collide(batches):
        import pyarrow as pa

        for b in exact_dedup._combine_locally(batches):
            yield pa.RecordBatch.from_arrays([pa.array([b"x"] * b.num_rows, pa.binary()), *b.columns[1:]], b.schema.names)

    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(30)], "doc_id long, text string").repartition(5)
    rows = df.selectExpr("doc_id AS id", "text")
    local = rows.mapInArrow(all_collide, exact_dedup._LOCAL)

    class Stub:
        def select(self, *a):
            return self

        def mapInArrow(self, *a):
            return local

    got = exact_dedup.exact_groups(Stub()).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {(i, i % 3, 10, i < 3) for i in range(30)}


def test_drop_copies_keeps_other_columns(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a ", "y"), (4, "a ", "z")], "doc_id long, text string, digest string")
    assert sorted(map(tuple, exact_dedup.drop_exact_copies(df).collect())) == [(1, "a ", "y"), (2, "a", "x")]


def test_drop_copies_decides_by_row(spark):
    rows = [(1, "t", "p"), (1, "t", "p"), (1, "other", "q"), (None, "t", "r"), (None, "alone", "s"), (None, "alone", "s"), (None, None, "u"), (9, " ", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(map(tuple, exact_dedup.drop_exact_copies(df).collect()), key=str)
    assert got == sorted([(1, "t", "p"), (1, "other", "q"), (None, "alone", "s"), (None, None, "u"), (9, " ", "v")], key=str)
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0
