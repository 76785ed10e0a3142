"""Queries: ingest, cleaning, case assembly, labels, samples and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import cases as C
from ..operators import labels as L
from ..operators import split as SP
from ..session import ensure_checkpoint_dir
from ..sources import artefacts as A
from ..sources import delimited as D
from ..sources.driver_views import read_table, view
from . import sqlcte as Q
from .registry import query

# Label cut-off used on the driver tables (the reference's 300 is for 55,000 cases).
TEST_MIN_FREQ = 100
SEED = 42


def cases_from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1 over the case-shaped views: the assembled case table."""
    return C.build_cases(view(spark, sf_dir, "c_demo"), view(spark, sf_dir, "c_drug"),
                         view(spark, sf_dir, "c_reac"), view(spark, sf_dir, "c_indi"))


def label_frequency(spark: SparkSession, sf_dir: str, min_freq: int = TEST_MIN_FREQ) -> DataFrame:
    """Flagship: which labels occur in at least ``min_freq`` assembled cases."""
    return L.label_vocab(cases_from_views(spark, sf_dir), min_freq)


@query("label_frequency", "A1 A2 J1-J4 P5-P8 P10 F1 F2 A3 F3 T8 (flagship)",
       Q.cases_with() + f""",
       freq AS (SELECT label, count(*) AS n_cases FROM (SELECT unnest(reactions) AS label FROM cases) GROUP BY label)
       SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, label, n_cases
       FROM freq WHERE n_cases >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED})""")
def q_label_frequency(spark, sf_dir):
    return label_frequency(spark, sf_dir)


@query("unit_normalise", "P1 P2 P3 P4 S3",
       "WITH " + ",\n".join(Q.views("c_demo")) + f"""
       SELECT primaryid, sex, age_years, weight_kg FROM ({Q.demo_norm('c_demo')})""")
def q_unit_normalise(spark, sf_dir):
    d = C.normalise_demo(C.select_present(view(spark, sf_dir, "c_demo"), C.DEMO_COLUMNS))
    return d.select("primaryid", "sex", "age_years", "weight_kg")


@query("latest_version", "W1 P1 P4",
       "WITH " + ",\n".join(Q.views("c_versions")) + f""",
       {Q.demo_clean('c_versions')}
       SELECT primaryid, age_years, sex FROM demo_clean""")
def q_latest_version(spark, sf_dir):
    return C.clean_demo(view(spark, sf_dir, "c_versions")).select("primaryid", "age_years", "sex")


@query("union_batches", "U1 S3 A17",
       "WITH " + ",\n".join(Q.views("c_demo")) + """
       SELECT _file, count(*) AS n_rows, count(wt_cod) AS n_wt_cod, count(DISTINCT primaryid) AS n_cases
       FROM (SELECT primaryid, wt_cod, 'even' AS _file FROM c_demo WHERE _row % 2 = 0
             UNION ALL SELECT primaryid, NULL AS wt_cod, 'odd' AS _file FROM c_demo WHERE _row % 2 = 1)
       GROUP BY _file""")
def q_union_batches(spark, sf_dir):
    """Two batches with different column sets, aligned by name (missing -> null)."""
    demo = view(spark, sf_dir, "c_demo")
    even = demo.where(F.col("_row") % 2 == 0).select("primaryid", "wt_cod", F.lit("even").alias("_file"))
    odd = demo.where(F.col("_row") % 2 == 1).select("primaryid", F.lit("odd").alias("_file"))
    both = even.unionByName(odd, allowMissingColumns=True)
    return both.groupBy("_file").agg(F.count(F.lit(1)).alias("n_rows"), F.count("wt_cod").alias("n_wt_cod"),
                                     F.countDistinct("primaryid").alias("n_cases"))


@query("role_sets", "F1 A1 J4 P5 P6 P8 P10",
       "WITH " + ",\n".join(Q.views("c_drug") + [Q.DRUG_ROWS, Q.DRUG_SETS]) + """
       SELECT primaryid, array_to_string(drug, '|') AS drug, array_to_string(other_drugs, '|') AS other_drugs
       FROM drug_sets""")
def q_role_sets(spark, sf_dir):
    return C.export_cases(C.role_sets(view(spark, sf_dir, "c_drug")))


@query("title_terms", "P7 A2",
       "WITH " + ",\n".join(Q.views("c_reac", "c_indi") + [
           Q.term_sets("reac_sets", "c_reac", "pt", "reactions"),
           Q.term_sets("indi_sets", "c_indi", "indi_pt", "indications")]) + """
       SELECT primaryid, 'reactions' AS kind, array_to_string(reactions, '|') AS terms FROM reac_sets
       UNION ALL SELECT primaryid, 'indications' AS kind, array_to_string(indications, '|') AS terms FROM indi_sets""")
def q_title_terms(spark, sf_dir):
    r = C.term_sets(view(spark, sf_dir, "c_reac"), "pt", "reactions")
    i = C.term_sets(view(spark, sf_dir, "c_indi"), "indi_pt", "indications")
    return (r.select("primaryid", F.lit("reactions").alias("kind"), F.array_join("reactions", "|").alias("terms"))
            .unionByName(i.select("primaryid", F.lit("indications").alias("kind"),
                                  F.array_join("indications", "|").alias("terms"))))


@query("assemble_cases", "J1 J2 J3 F2 W1 P1-P10 A1 A2 S4",
       Q.cases_with() + """
       SELECT primaryid, sex, reporter_country, age_years, weight_kg,
              array_to_string(drug, '|') AS drug, array_to_string(other_drugs, '|') AS other_drugs,
              array_to_string(reactions, '|') AS reactions, array_to_string(indications, '|') AS indications
       FROM cases""")
def q_assemble_cases(spark, sf_dir):
    return C.export_cases(cases_from_views(spark, sf_dir))


@query("term_frequency", "A3 U4",
       "WITH " + ",\n".join(Q.views("c_drug") + [Q.DRUG_ROWS, Q.DRUG_SETS]) + """
       SELECT term, count(*) AS n FROM (SELECT unnest(drug) AS term FROM drug_sets) GROUP BY term""")
def q_term_frequency(spark, sf_dir):
    return L.term_frequency(C.role_sets(view(spark, sf_dir, "c_drug")), "drug")


@query("topk_terms", "T1",
       "WITH " + ",\n".join(Q.views("c_drug") + [Q.DRUG_ROWS, Q.DRUG_SETS]) + """,
       f AS (SELECT term, count(*) AS n FROM (SELECT unnest(drug) AS term FROM drug_sets) GROUP BY term)
       SELECT term, n, pos FROM (
           SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS INTEGER) AS pos FROM f)
       WHERE pos < 30""")
def q_topk_terms(spark, sf_dir):
    return L.topk_terms(L.term_frequency(C.role_sets(view(spark, sf_dir, "c_drug")), "drug"), 30)


@query("label_vocab", "F3 T8 A3",
       "WITH " + ",\n".join(Q.views("c_reac") + [Q.term_sets("reac_sets", "c_reac", "pt", "reactions")]) + f""",
       freq AS (SELECT label, count(*) AS n_cases FROM (SELECT unnest(reactions) AS label FROM reac_sets) GROUP BY label)
       SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, label, n_cases
       FROM freq WHERE n_cases >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED})""")
def q_label_vocab(spark, sf_dir):
    return L.label_vocab(C.term_sets(view(spark, sf_dir, "c_reac"), "pt", "reactions"), TEST_MIN_FREQ)


def _vocab_sql() -> str:
    return f"""freq AS (SELECT label, count(*) AS n_cases FROM (SELECT unnest(reactions) AS label FROM reac_sets) GROUP BY label),
       vocab AS (SELECT label FROM freq WHERE n_cases >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED}))"""


@query("label_cases", "J9 F4 M5",
       "WITH " + ",\n".join(Q.views("c_reac") + [Q.term_sets("reac_sets", "c_reac", "pt", "reactions")]) + f""",
       {_vocab_sql()}
       SELECT primaryid, array_to_string(list_sort(list(label)), '|') AS reaction_list, count(*) AS n_labels
       FROM (SELECT primaryid, unnest(reactions) AS label FROM reac_sets) x SEMI JOIN vocab USING (label)
       GROUP BY primaryid""")
def q_label_cases(spark, sf_dir):
    sets = C.term_sets(view(spark, sf_dir, "c_reac"), "pt", "reactions")
    lc = L.label_cases(sets, L.label_vocab(sets, TEST_MIN_FREQ))
    return lc.select("primaryid", F.array_join("reaction_list", "|").alias("reaction_list"),
                     F.size("reaction_list").cast("bigint").alias("n_labels"))


@query("label_imbalance", "T2",
       "WITH " + ",\n".join(Q.views("c_reac") + [Q.term_sets("reac_sets", "c_reac", "pt", "reactions")]) + f""",
       freq AS (SELECT label, count(*) AS n_cases FROM (SELECT unnest(reactions) AS label FROM reac_sets) GROUP BY label),
       v AS (SELECT label, n_cases FROM freq WHERE n_cases >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED}))
       (SELECT 'top' AS side, label, n_cases FROM v ORDER BY n_cases DESC, label LIMIT 15)
       UNION ALL (SELECT 'bottom' AS side, label, n_cases FROM v ORDER BY n_cases ASC, label LIMIT 15)""")
def q_label_imbalance(spark, sf_dir):
    sets = C.term_sets(view(spark, sf_dir, "c_reac"), "pt", "reactions")
    return L.label_imbalance(L.label_vocab(sets, TEST_MIN_FREQ), 15)


@query("hash_sample", "D1",
       f"""SELECT o_orderkey FROM (SELECT o_orderkey, {Q.rank_by_hash(SEED, 'o_orderkey')} AS r FROM orders)
       WHERE r < 5000""")
def q_hash_sample(spark, sf_dir):
    return C.hash_sample(read_table(spark, sf_dir, "orders").select("o_orderkey"), 5000, SEED, "o_orderkey")


@query("hash_split", "D2 D3 D4",
       f"""WITH r AS (SELECT o_orderkey, {Q.rank_by_hash(SEED, 'o_orderkey')} AS r, count(*) OVER () AS n FROM orders),
       s AS (SELECT o_orderkey, r, CAST(ceil(0.3 * n) AS BIGINT) AS n_test, n FROM r)
       SELECT o_orderkey, CASE WHEN r < n_test THEN 'test'
                               WHEN r < n_test + CAST(floor((n - n_test) * 0.1) AS BIGINT) THEN 'val'
                               ELSE 'train' END AS split
       FROM s""")
def q_hash_split(spark, sf_dir):
    return SP.hash_split(read_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SEED).select(
        "o_orderkey", "split")


LINE_COLUMNS = ["primaryid", "code", "note"]


@query("read_lines", "S2 H1 U1",
       """SELECT CAST(o_orderkey AS VARCHAR) AS primaryid,
              CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS code,
              CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS note
       FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 <> 0""")
def q_read_lines(spark, sf_dir):
    """Orders written as delimited lines, some short, some over-long, some with missing-value tokens, and read back."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    full = F.concat_ws("$", k, F.when(k % 5 == 0, "NA").otherwise(F.col("o_orderpriority")), "o_orderstatus")
    line = F.when(k % 13 == 0, k.cast("string")).when(k % 11 == 0, F.concat(full, F.lit("$x$y"))).otherwise(full)
    return D.parse_lines(o.select(line.alias("value")), LINE_COLUMNS)


# Notes as a batch file has them (quoted, doubled, over two lines, quotes inside) and as they are read.
NOTES = [('"x$y"', "x$y"), ('"say ""hi"""', 'say "hi"'), ('"two\nlines"', "two\nlines"), ('5" pipe', '5" pipe'), ('"q"tail', "qtail")]
NOTE_SQL = "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{read}'" for i, (_, read) in enumerate(NOTES)) + " ELSE o_orderstatus END"


def _note(k, which: int):
    out = F.col("o_orderstatus")
    for i, note in enumerate(NOTES):
        out = F.when(k % 7 == i, F.lit(note[which])).otherwise(out)
    return out


@query("read_batches", "S1 S2 U1 H1",
       f"""SELECT CAST(o_orderkey AS VARCHAR) AS primaryid, o_orderpriority AS code, {NOTE_SQL} AS note
       FROM orders WHERE o_orderkey % 13 <> 0""")
def q_read_batches(spark, sf_dir):
    """Orders written as a folder of batches, with two headers, quoted notes and over-long rows, and read back."""
    k = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders").select(k, "o_orderpriority", _note(k, 0).alias("note"), (k % 4).alias("p"))
    one, other = F.concat_ws("$", k, "o_orderpriority", "note"), F.concat_ws("$", "note", k, "o_orderpriority")
    line = F.concat(F.when(F.col("p") < 2, one).otherwise(other), F.when(k % 13 == 0, "$more").otherwise(""))
    heads = spark.createDataFrame([(p, -1, " PrimaryID$Code$note" if p < 2 else "note$primaryid$CODE") for p in range(4)], "p long, at long, line string")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/batches-{uuid.uuid4().hex}"
    rows = heads.unionByName(o.select(F.col("p").cast("long").alias("p"), k.alias("at"), line.alias("line")))
    rows.repartition(4, "p").sortWithinPartitions("p", "at").select("p", "line").write.partitionBy("p").text(folder)
    return D.read_batches(spark, f"{folder}/p=*", "part-").select("primaryid", "code", "note")


@query("case_table_csv", "S4 S5",
       f"""SELECT CAST(o_orderkey AS VARCHAR) AS primaryid, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 90 AS DOUBLE) END AS age_years,
              {NOTE_SQL} AS note, CAST(NULL AS DOUBLE) AS weight_kg FROM orders""")
def q_case_table_csv(spark, sf_dir):
    """Orders exported as a CSV case table without weights, notes with quotes and line breaks, and read back."""
    k = F.col("o_orderkey")
    age = F.when(k % 5 > 0, (k % 90).cast("string")).otherwise("NA")
    table = read_table(spark, sf_dir, "orders").select(k.cast("string").alias("primaryid"), age.alias("age_years"), _note(k, 1).alias("note"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cases-{uuid.uuid4().hex}"
    A.write_table(table, folder, "csv")
    return D.read_case_table(spark, folder)


@query("distinct_terms", "U4",
       "WITH " + ",\n".join(Q.views("c_drug") + [Q.DRUG_ROWS, Q.DRUG_SETS]) + """
       SELECT DISTINCT term FROM (SELECT unnest(drug) AS term FROM drug_sets)""")
def q_distinct_terms(spark, sf_dir):
    return L.distinct_terms(C.role_sets(view(spark, sf_dir, "c_drug")), "drug")


@query("raw_terms", "P9b P10",
       "WITH " + ",\n".join(Q.views("c_drug") + [Q.DRUG_ROWS, Q.DRUG_SETS]) + """
       SELECT primaryid, CAST(i - 1 AS INTEGER) AS pos, term FROM (
           SELECT primaryid, generate_subscripts(l, 1) AS i, unnest(l) AS term FROM (
               SELECT primaryid, string_split(array_to_string(drug, '|'), '|') AS l FROM drug_sets))""")
def q_raw_terms(spark, sf_dir):
    """An exported list split at the bar only."""
    ex = C.export_cases(C.role_sets(view(spark, sf_dir, "c_drug")))
    return ex.select("primaryid", F.posexplode(X.split_raw("drug")).alias("pos", "term"))


@query("contract_check", "J13 F3",
       "WITH " + ",\n".join(Q.views("c_reac") + [Q.term_sets("reac_sets", "c_reac", "pt", "reactions")]) + f""",
       freq AS (SELECT label, count(*) AS n FROM (SELECT unnest(reactions) AS label FROM reac_sets) GROUP BY label)
       SELECT count(*) AS n_labels, min(label) AS first_label, max(label) AS last_label FROM freq
       WHERE n >= {TEST_MIN_FREQ} AND label NOT IN ({Q.EXCLUDED})""")
def q_contract_check(spark, sf_dir):
    """The label table of a model (from the reaction sets) held against that of the data (from the raw rows)."""
    reac = view(spark, sf_dir, "c_reac")
    model = L.label_vocab(C.term_sets(reac, "pt", "reactions"), TEST_MIN_FREQ)
    data = L.label_vocab(C.term_sets(reac.repartition("primaryid"), "pt", "reactions"), TEST_MIN_FREQ)
    A.contract_check(model, data)
    return model.agg(F.count("*").alias("n_labels"), F.min("label").alias("first_label"), F.max("label").alias("last_label"))
