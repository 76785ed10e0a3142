"""Queries: sketches kept by batch, held against exact counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import sketch as SK
from ..session import written
from ..sources.driver_views import read_table
from .registry import query


@query("sketch_ranges", "A4 A17",
       """WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_custkey FROM orders), u AS (SELECT DISTINCT y AS upto FROM o)
       SELECT upto, (SELECT count(*) FROM o WHERE y <= upto) AS n_rows,
              (SELECT count(DISTINCT o_custkey) FROM o WHERE y <= upto) AS n_customers, TRUE AS customers_within, TRUE AS median_within
       FROM u""")
def q_sketch_ranges(spark, sf_dir):
    """Customers and median price of all orders up to each year from the years' sketches, within their bounds of exact ones."""
    o = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), "o_custkey", "o_totalprice")
    kept = written(SK.batch_sketches(o, "y", ["o_custkey"], ["o_totalprice"]), "sketches")
    years = sorted(r["batch"] for r in kept.select("batch").collect())  # one for each batch
    ranges = reduce(lambda a, b: a.unionAll(b), [kept.where(F.col("batch") <= y).withColumn("upto", F.lit(y)) for y in years])
    told = SK.united(ranges, "upto").select("upto", "n_rows", SK.distinct_count("o_custkey").alias("customers"), SK.quantile("o_totalprice", 0.5).alias("median"))
    told = {r["upto"]: r for r in told.collect()}
    first = o.groupBy("o_custkey").agg(F.min("y").alias("first"))
    customers = first.agg(*[F.count(F.when(F.col("first") <= y, 1)).alias(f"c{y}") for y in years])
    below = o.agg(*[F.count(F.when((F.col("y") <= y) & (F.col("o_totalprice") <= F.lit(told[y]["median"])), 1)).alias(f"b{y}") for y in years])

    def by_year(counts, name: str, letter: str):
        each = [F.struct(F.lit(y).alias("upto"), F.col(f"{letter}{y}").alias(name)) for y in years]
        return counts.select(F.explode(F.array(*each)).alias("r")).select("r.*")

    estimates = spark.createDataFrame([(y, r["n_rows"], r["customers"]) for y, r in told.items()], "upto int, n_rows long, customers long")
    rows = by_year(customers, "n_customers", "c").join(by_year(below, "below", "b"), "upto").join(estimates, "upto")
    within = F.abs(F.col("n_customers") - F.col("customers")) <= SK.DISTINCT_ERROR * F.col("n_customers")
    median = F.abs(F.col("below") / F.col("n_rows") - 0.5) <= SK.RANK_ERROR
    return rows.select("upto", "n_rows", "n_customers", within.alias("customers_within"), median.alias("median_within"))
