"""Case-shaped views over the driver's TPC-H-ish tables.

The library's operators consume raw case-report tables (demographics, drugs,
reactions, indications, knowledge base).  These views derive such tables from
the driver parquet files so that every operator runs on data that grows with
the scale factor.  The texts are portable between Spark SQL and DuckDB (the
oracle side uses the very same definitions); ``{name}`` marks a base table.

Raw case columns are strings, as in the delimited batch files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW_SQL: dict[str, str] = {
    # demographics: one version per order
    "c_demo": """
        SELECT CAST(o.o_orderkey AS STRING) AS primaryid,
               CAST(c.c_acctbal / 100 AS STRING) AS age,
               CASE c.c_mktsegment WHEN 'BUILDING' THEN 'YR' WHEN 'FURNITURE' THEN ' mon'
                    WHEN 'MACHINERY' THEN 'WK' WHEN 'HOUSEHOLD' THEN 'xx' END AS age_cod,
               CASE c.c_custkey % 4 WHEN 0 THEN 'm ' WHEN 1 THEN 'F' WHEN 2 THEN 'UNK' END AS sex,
               CAST(o.o_totalprice / 1000 AS STRING) AS wt,
               CASE c.c_nationkey % 3 WHEN 0 THEN 'KG' WHEN 1 THEN 'lbs' ELSE 'GMS' END AS wt_cod,
               CAST(c.c_nationkey AS STRING) AS reporter_country,
               'c_demo' AS _file, o.o_orderkey AS _row
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    # demographics with many versions per id (file order = ts, row order = event_id)
    "c_versions": """
        SELECT CAST(user_id AS STRING) AS primaryid, CAST(value AS STRING) AS age,
               event_type AS age_cod, CAST(NULL AS STRING) AS sex, CAST(NULL AS STRING) AS wt,
               CAST(NULL AS STRING) AS wt_cod, CAST(NULL AS STRING) AS reporter_country,
               ts AS _file, event_id AS _row
        FROM {events}""",
    "c_drug": """
        SELECT CAST(l.l_orderkey AS STRING) AS primaryid,
               CASE l.l_returnflag WHEN 'A' THEN 'PS' WHEN 'N' THEN 'ss ' WHEN 'R' THEN 'C' END AS role_cod,
               CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE p.p_name END AS prod_ai,
               p.p_brand AS drugname
        FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "c_reac": """
        SELECT CAST(l.l_orderkey AS STRING) AS primaryid,
               CASE p.p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'hospitalisation '
                    ELSE lower(p.p_type) || '-' || p.p_brand END AS pt
        FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "c_indi": """
        SELECT CAST(l.l_orderkey AS STRING) AS primaryid, CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE n.n_name END AS indi_pt
        FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
             JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    # knowledge base: (drug id, effect, type); LLT rows exercise the PT filter
    "c_known": """
        SELECT DISTINCT 'CID_' || p_name AS stitch_flat, lower(p_type) || '-' || p_brand AS side_effect,
               CASE WHEN p_size % 10 = 0 THEN 'LLT' ELSE 'PT' END AS meddra_type
        FROM {part}""",
    # knowledge-base names with duplicates (row order decides last-wins)
    "c_names": """
        SELECT p_partkey AS row_order, 'CID_' || p_name AS stitch_id, p_name AS drug_name
        FROM {part}""",
    # drug names as reports spell them, some with a salt suffix, some with one that the knowledge base does not know
    "c_probe": """
        SELECT DISTINCT upper(p_name) || CASE p_size % 4 WHEN 0 THEN ' SODIUM'
               WHEN 1 THEN ' HYDROCHLORIDE' WHEN 2 THEN ' FORTE' ELSE '' END AS drug
        FROM {part}""",
    # free text
    "c_text": """
        SELECT doc_id, lower(text) AS text FROM {documents}""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def base_tables(view: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(VIEW_SQL[view])))


def duckdb_text(view: str) -> str:
    """The view text with base-table placeholders replaced by plain names."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), VIEW_SQL[view]).replace(" STRING)", " VARCHAR)")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a case-shaped view as a lazy DataFrame (no temp view registered)."""
    if name == "c_score":
        return score_view(read_table(spark, sf_dir, "embeddings"))
    tables = {t: read_table(spark, sf_dir, t) for t in base_tables(name)}
    return spark.sql(VIEW_SQL[name], **tables)


# one label for each dimension of the embeddings, and their number of classes
SCORE_LABELS = 64
CLASSES = 10


def score_view(embeddings: DataFrame) -> DataFrame:
    """(case_id, label_id, y, p): a scored multi-label table with known truth, all dimensions of all rows.

    p = sigmoid(4 * embedding[label_id]); y = 1 where label_id % 10 is the row's class or, on every third case, class
    (label + 3) % 10.
    """
    e = embeddings.select("vec_id", "label", F.posexplode("embedding").alias("label_id", "x"))
    of = F.col("label_id") % CLASSES
    extra = (F.col("vec_id") % 3 == 0) & (((F.col("label") + 3) % CLASSES) == of)
    return e.select(
        F.col("vec_id").alias("case_id"),
        F.col("label_id").cast("int").alias("label_id"),
        F.when((F.col("label") == of) | extra, 1).otherwise(0).alias("y"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-4.0) * F.col("x").cast("double")))).alias("p"),
    )


SCORE_VIEW_DUCKDB = """
    SELECT e.vec_id AS case_id, CAST(g.i - 1 AS INTEGER) AS label_id,
           CASE WHEN e.label = (g.i - 1) % 10 OR (e.vec_id % 3 = 0 AND (e.label + 3) % 10 = (g.i - 1) % 10)
                THEN 1 ELSE 0 END AS y,
           1.0 / (1.0 + exp(-4.0 * CAST(e.embedding[g.i] AS DOUBLE))) AS p
    FROM embeddings e, (SELECT unnest(range(1, 65)) AS i) g"""


def duckdb_view(name: str) -> str:
    return SCORE_VIEW_DUCKDB if name == "c_score" else duckdb_text(name)


def duckdb_with(*names: str) -> str:
    """A WITH clause defining the given views for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_view(n)})" for n in names)
