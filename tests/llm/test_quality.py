import re
from collections import Counter

from caseflow.llm import quality, queries
from caseflow.llm.registry import ORACLES

from .oracle import duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    rep = {k for i in range(len(ws) - 7) if wins[tuple(ws[i : i + 8])] > 1 for k in range(i, i + 8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep)


def test_query_equals_sql(spark):
    assert spark_rows(queries.op9_quality_rules(spark, SF)) == duck_rows(ORACLES["op9_quality_rules"], SF)


TEXTS = [None, "", " \n\t", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 30, "a b c d e f g h i j k " * 3 + "tail", "l1 a\nl1 a\n \nl1 a\r\nend",
         "# é|| $$ \x85 w\x0bw", "A B C\n" * 50_000, " ".join(f"w{i}" for i in range(60_000)), "abcdefgh " + " ".join(map(str, range(100, 140))), "#" * 20 + " a" * 30]


def test_measures_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ws int, n_words string")
    got = {r.doc_id: tuple(r)[1:6] for r in quality.measured(df, ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_rules_tried_follow_the_order(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, failed_rule int")
    order = quality.order_rules(df, quality.BASE_RULES + quality.MORE_RULES)
    wanted = list(quality.MEASURES)
    for names in ([], ["n_symbols"], wanted):  # which measures are wanted never changes a verdict
        for r in quality.measured(df, names).collect():
            m = quality._prepared(df.where(f"doc_id = {r.doc_id}"), "text")
            flags = m.select(*[quality._with_words(lambda m, ws, x=x: x.rejects(m)).alias(x.name) for x in order]).first()
            hits = [i for i, x in enumerate(order) if flags[x.name]]
            assert (r.failed_rule, r.n_rules_tried) == ((order[hits[0]].name, hits[0] + 1) if hits else (None, len(order)))
    assert quality.measured(df.limit(0), wanted).count() == 0


def test_cascade_keeps_what_no_rule_rejects(spark):
    rows = [(i, t, "n") for i, t in enumerate(TEXTS)] + [(None, "good words here are not many but they are twenty or more in this one text so it stays here for sure", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [10, 11, None, None]
    for order in (quality.BASE_RULES + quality.MORE_RULES, (quality.MORE_RULES + quality.BASE_RULES)[::-1]):
        flagged = quality._prepared(df, "text").select("row.doc_id", quality._with_words(lambda m, ws: quality.verdict(list(order), m)).alias("v")).collect()
        assert sorted((r.doc_id for r in flagged if r.v is None), key=str) == [10, 11, None, None]
    assert quality.keep_good(df.limit(0)).count() == 0


def test_order_is_by_rejections_per_work(spark):
    df = spark.createDataFrame([(i, "#" * 30 + " w" * 40) for i in range(20)], "doc_id long, text string")
    assert quality.order_rules(df, quality.MORE_RULES + quality.BASE_RULES)[0].name in ("symbols", "repeated_windows")
    assert [r.name for r in quality.order_rules(df.limit(0), quality.MORE_RULES)] == [r.name for r in quality.MORE_RULES]


def test_no_python_in_the_plan(spark):
    plan = queries.op9_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
