import re

from caseflow.llm import line_templates, queries
from caseflow.llm.registry import ORACLES

from .oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    got = spark_rows(queries.op8_line_dedup(spark, SF))
    assert got == duck_rows(ORACLES["op8_line_dedup"], SF)
    assert any(r[2] for r in got[1])


def test_templates_generalise_variable_fields(spark):
    rows = [(i, f"own text of number {i} here\nLast login of user u{i} from host on day {i % 3}\n\nend", "x") for i in range(12)]
    rows += [(50 + i, f"Last login of user from somewhere quite other {i}", "x") for i in range(3)]
    rows += [(None, "Last login of user u77 from host on day 9\nLast login of user u78 from host on day 9", None), (90, None, "d"), (91, "", "d"), (92, "a b\na b", "e")]
    rows += [(11, rows[11][1], "again"), (95, "many lines here now\n" * 3000, "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_templates.drop_recurring_lines(df).selectExpr("row.doc_id", "text", "n_lines", "n_dropped").collect()), key=str)
    want = [(0, rows[0][1], 3, 0)] + [(i, f"own text of number {i} here\n\nend", 3, 1) for i in range(1, 12)] + [(11, "own text of number 11 here\n\nend", 3, 1)]
    want += [(50 + i, rows[12 + i][1], 1, 0) for i in range(3)] + [(None, "", 2, 2), (90, "", 0, 0), (91, "", 0, 0), (92, "a b\na b", 2, 0), (95, "many lines here now\n" * 3000, 3000, 0)]
    # "own text of number <*> here" is a template of twelve documents too: only its first document keeps it.
    want = [(i, t if i in (0, None) or i > 11 else "\nend", n, d if i in (0, None) or i > 11 else 2) for i, t, n, d in want]
    assert got == sorted(want, key=str)
    assert line_templates.drop_recurring_lines(df.limit(0)).count() == 0


def dropped(df):
    return sorted(((r.doc_id, r.text, r.n_dropped) for r in line_templates.drop_recurring_lines(df).selectExpr("row.doc_id", "text", "n_dropped").collect()), key=str)


def test_passages_and_short_lines(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(61))
    rows = [(i, f"{passage}\nown {'abcdefghi'[i]}") for i in range(9)]  # a passage of nine documents
    rows += [(100 + i, "Read more") for i in range(300)] + [(900 + i, "Home") for i in range(49)]
    other = passage.replace("word", "term")
    rows += [(1000, f"{other}\nRead more later"), (1001, f"{other[:-1]}\nx"), (1002, f"{other} \ny")]  # not the same line
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {i: (t, n) for i, t, n in dropped(df)}
    assert got[0] == (rows[0][1], 0) and all(got[i] == (f"own {'abcdefghi'[i]}", 1) for i in range(1, 9))
    assert got[100] == ("Read more", 0) and all(got[100 + i] == ("", 1) for i in range(1, 300))
    assert all(got[900 + i] == ("Home", 0) for i in range(49)) and got[1000][1] == got[1001][1] == got[1002][1] == 0


def test_rows_of_one_id_and_null_ids(spark):
    long = " ".join("abcdefghijklmnopqrstuvwxyz")
    only = " ".join("zyxwvutsrqponmlkjihgfedcba")
    rows = [(None, f"{long}\na"), (None, f"{long}\nb"), (None, only), (None, only), (3, long), (3, f"{long}\nc"), (3, long), (7, f"{long}\n{long}\nd")]
    got = dropped(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == sorted([(None, "a", 1), (None, "b", 1), (None, only, 0), (None, only, 0), (3, long, 0), (3, f"{long}\nc", 0), (3, long, 0), (7, "d", 2)], key=str)


def test_shuffled_leaves_give_the_same(spark, monkeypatch):
    want = spark_rows(queries.op8_line_dedup(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(line_templates, "BROADCAST_LEAVES", 0)
    monkeypatch.setattr(line_templates, "BROADCAST_TEMPLATES", 0)
    assert spark_rows(queries.op8_line_dedup(spark, "/root/testdata/sf0.001")) == want


def test_no_python_in_the_plan(spark):
    plan = queries.op8_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
