"""Queries: population operators, Pareto analysis, distributed fitness, linear oracle.

Populations are derived from the driver tables: every embeddings row is an
individual whose genome is its vector (and whose fitness is the vector's
mean); Pareto points are customer groups (nation and market segment, so a
bounded population) scored over all their orders.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sqlfrag as S
from ..operators import calibrate as CAL
from ..operators import evolve as EV
from ..operators import explain as XP
from ..operators import pareto as PA
from ..operators import select as SEL
from ..operators import step as ST
from ..operators.split import hash_split
from ..session import written
from ..sources.driver_views import SCORE_VIEW_DUCKDB, read_table, view
from .q_scoring import EMB_SHAPE, EMB_X, embedding_features, forward_sql, genes_sql
from . import pipeline as PL
from .registry import query

SEED = 42
GEN = 1
RANK_S = 1.7
N_FIT_POP = EV.POP_SIZE  # population scored by the distributed fitness query

POP_SQL = """f AS (SELECT vec_id AS ind, CAST(embedding AS DOUBLE[]) AS genome,
                         round(list_sum(CAST(embedding AS DOUBLE[])) / 64, 9) AS fitness FROM embeddings)"""
POS_SQL = "pos AS (SELECT ind, fitness, genome, row_number() OVER (ORDER BY ind) - 1 AS pos FROM f)"
RANK_SQL = f"""r AS (SELECT ind, row_number() OVER (ORDER BY fitness, ind) - 1 AS rank, count(*) OVER () AS n FROM f),
    rp AS (SELECT ind, rank, ((2.0::DOUBLE - 1.7) + 2.0::DOUBLE * (1.7::DOUBLE - 1.0) * rank / (n - 1)) / n AS prob FROM r)"""
GENES_SQL = """gl AS (SELECT ind, CAST(generate_subscripts(genome, 1) - 1 AS BIGINT) AS gene, unnest(genome) AS v FROM f)"""


def emb_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    genome = F.col("embedding").cast("array<double>")
    mean = F.round(F.aggregate(genome, F.lit(0.0), lambda a, v: a + v) / 64, 9)
    return e.select(F.col("vec_id").alias("ind"), genome.alias("genome"), mean.alias("fitness"))


@contextmanager
def cached(df: DataFrame):
    """``df`` cached for as long as the searches read it."""
    df = df.cache()
    try:
        yield df
    finally:
        df.unpersist()


@query("rank_probs", "W2 E6", f"""WITH {POP_SQL}, {RANK_SQL}
       SELECT ind, CAST(rank AS BIGINT) AS rank, round(prob, 12) AS prob,
              1.7::DOUBLE AS sel_rank, round(ln(3.0::DOUBLE) + 1.0, 12) AS sel_tournament FROM rp""")
def q_rank_probs(spark, sf_dir):
    rp = EV.rank_probs(emb_population(spark, sf_dir).select("ind", "fitness"), RANK_S)
    return rp.select("ind", F.col("rank").cast("bigint").alias("rank"), F.round("prob", 12).alias("prob"),
                     F.lit(EV.selection_pressure("rank", s=RANK_S)).alias("sel_rank"),
                     F.round(F.lit(EV.selection_pressure("tournament", 3)), 12).alias("sel_tournament"))


@query("select_parents", "E4 E5", f"""WITH {POP_SQL}, {POS_SQL}, {RANK_SQL},
    n AS (SELECT count(*) AS n FROM f),
    asp AS (SELECT d.pos AS draw, s.slot,
                   CAST(floor({S.hash_unit(SEED, "'tour'", str(GEN), 'd.pos', 's.slot')} * (SELECT n FROM n)) AS BIGINT) AS apos
            FROM pos d, (VALUES (0), (1), (2)) s(slot)),
    tw AS (SELECT a.draw, p.ind, row_number() OVER (PARTITION BY a.draw ORDER BY p.fitness DESC, p.ind) AS rn
           FROM asp a JOIN pos p ON a.apos = p.pos),
    cum AS (SELECT ind, coalesce(sum(prob) OVER (ORDER BY ind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS lo,
                   prob FROM rp),
    iv AS (SELECT ind, lo, lo + prob AS hi FROM cum),
    dr AS (SELECT pos AS draw, {S.hash_unit(SEED, "'rank'", str(GEN), 'pos')} AS u FROM pos),
    hit AS (SELECT dr.draw, iv.ind FROM dr JOIN iv ON dr.u >= iv.lo AND dr.u < iv.hi)
    SELECT 'tournament' AS method, CAST(draw AS BIGINT) AS draw, ind FROM tw WHERE rn = 1
    UNION ALL
    SELECT 'roulette' AS method, CAST(dr.draw AS BIGINT) AS draw,
           coalesce(hit.ind, (SELECT ind FROM iv ORDER BY hi DESC LIMIT 1)) AS ind
    FROM dr LEFT JOIN hit ON dr.draw = hit.draw""")
def q_select_parents(spark, sf_dir):
    fit = emb_population(spark, sf_dir).select("ind", "fitness")
    n = fit.count()
    t = EV.tournament(fit, n, 3, SEED, GEN).select(F.lit("tournament").alias("method"), "draw", "ind")
    r = EV.roulette(EV.rank_probs(fit, RANK_S), n, SEED, GEN).select(F.lit("roulette").alias("method"), "draw", "ind")
    return t.unionByName(r)


def _pairs(spark, sf_dir):
    idx = EV.indexed(emb_population(spark, sf_dir).select("ind", "genome"))
    a = idx.where(F.col("pos") % 2 == 0).select((F.col("pos") / 2).cast("long").alias("pair"), F.col("genome").alias("g1"))
    b = idx.where(F.col("pos") % 2 == 1).select(((F.col("pos") - 1) / 2).cast("long").alias("pair"), F.col("genome").alias("g2"))
    return a.join(b, "pair")


@query("crossover_all", "E7", f"""WITH {POP_SQL}, {POS_SQL},
    gl AS (SELECT pos, CAST(generate_subscripts(genome, 1) - 1 AS BIGINT) AS gene, unnest(genome) AS v FROM pos),
    pr AS (SELECT a.pos // 2 AS pair, a.gene, a.v AS v1, b.v AS v2 FROM gl a JOIN gl b ON b.pos = a.pos + 1 AND a.gene = b.gene
           WHERE a.pos % 2 = 0),
    x AS (SELECT pair, gene, v1, v2, {S.hash_unit(SEED, "'ux'", str(GEN), 'pair', 'gene')} < 0.5 AS keep,
                 gene < CAST(floor({S.hash_unit(SEED, "'cut'", str(GEN), 'pair')} * 63) AS BIGINT) + 1 AS head,
                 {S.hash_unit(SEED, "'alpha'", str(GEN), 'pair')} AS al FROM pr)
    SELECT 'uniform' AS kind, pair, 'c1' AS child, gene, round(CASE WHEN keep THEN v1 ELSE v2 END, 9) AS value FROM x
    UNION ALL SELECT 'uniform', pair, 'c2', gene, round(CASE WHEN keep THEN v2 ELSE v1 END, 9) FROM x
    UNION ALL SELECT 'one_point', pair, 'c1', gene, round(CASE WHEN head THEN v1 ELSE v2 END, 9) FROM x
    UNION ALL SELECT 'one_point', pair, 'c2', gene, round(CASE WHEN head THEN v2 ELSE v1 END, 9) FROM x
    UNION ALL SELECT 'arithmetic', pair, 'c1', gene, round(al * v1 + (1.0 - al) * v2, 9) FROM x
    UNION ALL SELECT 'arithmetic', pair, 'c2', gene, round((1.0 - al) * v1 + al * v2, 9) FROM x""")
def q_crossover_all(spark, sf_dir):
    pairs = written(_pairs(spark, sf_dir), "pairs")
    out = None
    for kind in ("uniform", "one_point", "arithmetic"):
        ch = EV.crossover(pairs, kind, SEED, GEN)
        for c in ("c1", "c2"):
            part = ch.select(F.lit(kind).alias("kind"), "pair", F.lit(c).alias("child"),
                             F.posexplode(c).alias("gene", "value"))
            out = part if out is None else out.unionByName(part)
    return out.select("kind", "pair", "child", F.col("gene").cast("bigint").alias("gene"), F.round("value", 9).alias("value"))


@query("mutate_gauss", "E8", f"""WITH {POP_SQL}, {GENES_SQL}
    SELECT ind, gene, round(v + 0.25 * {S.hash_normal(SEED, "'mutn'", str(GEN), 'ind', 'gene')}, 9) AS value FROM gl
    WHERE {S.hash_unit(SEED, "'mut'", str(GEN), 'ind', 'gene')} < 0.04""")
def q_mutate_gauss(spark, sf_dir):
    pop = emb_population(spark, sf_dir).select("ind", "genome")
    m = EV.mutate(pop.withColumn("orig", F.col("genome")), 0.04, 0.25, SEED, GEN)
    z = m.select("ind", F.posexplode(F.arrays_zip("orig", "genome")).alias("gene", "pair"))
    return z.where(F.col("pair.orig") != F.col("pair.genome")).select(
        "ind", F.col("gene").cast("bigint").alias("gene"), F.round("pair.genome", 9).alias("value"))


@query("bitflip", "E9", f"""WITH {POP_SQL}, {GENES_SQL},
    b AS (SELECT ind, gene, (v > 0) <> ({S.hash_unit(SEED, "'flip'", str(GEN), 'ind', 'gene')} < 0.03) AS bit,
                 {S.hash_unit(SEED, "'flip'", str(GEN), 'ind', 'gene')} < 0.03 AS flipped FROM gl)
    SELECT ind, count(*) FILTER (WHERE bit) AS n_on, count(*) FILTER (WHERE flipped) AS n_flipped FROM b GROUP BY ind""")
def q_bitflip(spark, sf_dir):
    pop = emb_population(spark, sf_dir).select("ind", F.transform("genome", lambda x: x > 0).alias("mask"))
    fl = EV.bitflip(pop.withColumn("orig", F.col("mask")), 0.03, SEED, GEN)
    return fl.select("ind", F.size(F.filter("mask", lambda b: b)).cast("bigint").alias("n_on"),
                     F.size(F.filter(F.arrays_zip("orig", "mask"), lambda s: s["orig"] != s["mask"])).cast("bigint").alias("n_flipped"))


@query("diversity", "A20", f"""WITH {POP_SQL}, {GENES_SQL}
    SELECT round(avg(sd), 9) AS diversity FROM (SELECT gene, stddev_pop(v) AS sd FROM gl GROUP BY gene)""")
def q_diversity(spark, sf_dir):
    d = EV.diversity(emb_population(spark, sf_dir).select("ind", "genome"))
    return d.select(F.round("diversity", 9).alias("diversity"))


def _history(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    h = ev.groupBy(F.date_trunc("hour", "ts").alias("hr")).agg(
        F.max("value").alias("best"), F.avg("value").alias("mean"), (F.stddev_pop("value") / 100).alias("div"))
    from pyspark.sql import Window
    return h.withColumn("gen", F.row_number().over(Window.orderBy("hr")))  # one row per hour: bounded


S0, S1 = EV.SIGMA0, EV.SIGMA_END


@query("history_stats", "W3 W4 W7 W8 E11 A19", f"""WITH RECURSIVE
    h AS (SELECT date_trunc('hour', ts) AS hr, max(value) AS best, avg(value) AS mean, stddev_pop(value) / 100 AS div
          FROM events GROUP BY 1),
    g AS (SELECT row_number() OVER (ORDER BY hr) AS gen, best, div, div < 0.090 AS low FROM h),
    n AS (SELECT count(*) AS gn FROM g),
    s AS (SELECT gen, best, low, div, 0.25 + ((gen - 1) / greatest(1, (SELECT gn FROM n) - 1)) * (0.02::DOUBLE - 0.25::DOUBLE) AS base FROM g),
    t AS (SELECT gen, best, low,
                 CASE WHEN div < 0.090 THEN base * 3.0 WHEN div > 0.115 THEN base * 0.5 ELSE base END AS sigma,
                 CASE WHEN div < 0.090 THEN 'boost' WHEN div > 0.115 THEN 'damp' ELSE '-' END AS event FROM s),
    rec(gen, last, imm) AS (
        SELECT 0, -15, 0
        UNION ALL
        SELECT t.gen, CASE WHEN t.low AND t.gen - rec.last >= 15 THEN t.gen ELSE rec.last END,
               CASE WHEN t.low AND t.gen - rec.last >= 15 THEN 1 ELSE 0 END
        FROM rec JOIN t ON t.gen = rec.gen + 1)
    SELECT CAST(t.gen AS INTEGER) AS gen, max(t.best) OVER (ORDER BY t.gen ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far,
           round(t.sigma, 12) AS sigma, t.event,
           round(avg(t.sigma) OVER (ORDER BY t.gen ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING), 9) AS sigma_smooth,
           CAST(rec.imm AS INTEGER) AS immigrants
    FROM t JOIN rec ON t.gen = rec.gen""")
def q_history_stats(spark, sf_dir):
    h = written(_history(spark, sf_dir), "history")
    n = h.count()
    base = EV.sigma_base(F.col("gen"), n, S0, S1)
    sigma, event = EV.adaptive_sigma(F.col("div"), base)
    t = h.select("gen", "best", "div", (F.col("div") < EV.DIV_LOW).alias("low"), sigma.alias("sigma"), event.alias("event"))
    t = EV.rolling_mean(EV.running_best(t), "sigma")
    imm = EV.immigrant_gens(t).withColumn("immigrants", F.lit(1))
    out = t.join(imm, "gen", "left").fillna(0, subset=["immigrants"])
    return out.select(F.col("gen").cast("int").alias("gen"), "best_so_far", F.round("sigma", 12).alias("sigma"), "event",
                      F.round("sigma_smooth", 9).alias("sigma_smooth"), F.col("immigrants").cast("int").alias("immigrants"))


# --- Pareto over customer groups -------------------------------------------
PTS_SQL = """pts AS (SELECT c_nationkey * 10 + CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2
                            WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END AS ind,
                            CAST(count(*) AS DOUBLE) AS o1, -round(avg(o_totalprice), 2) AS o2
                     FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""
FRONT_SQL = """dom AS (SELECT p.ind AS a, q.ind AS b FROM pts p, pts q
                       WHERE p.o1 >= q.o1 AND p.o2 >= q.o2 AND (p.o1 > q.o1 OR p.o2 > q.o2)),
    chain(ind, depth) AS (SELECT ind, 0 FROM pts UNION SELECT d.b, c.depth + 1 FROM chain c JOIN dom d ON d.a = c.ind),
    rk AS (SELECT p.ind, p.o1, p.o2, CAST(max(c.depth) AS INTEGER) AS front FROM pts p JOIN chain c ON p.ind = c.ind
           GROUP BY p.ind, p.o1, p.o2)"""
CROWD_SQL = """cw AS (SELECT ind, front, o1, o2,
        CASE WHEN row_number() OVER w1 = 1 OR row_number() OVER w1 = count(*) OVER wf THEN 'inf'::DOUBLE
             WHEN max(o1) OVER wf - min(o1) OVER wf > 0 THEN (lead(o1) OVER w1 - lag(o1) OVER w1) / (max(o1) OVER wf - min(o1) OVER wf)
             ELSE 0.0 END
      + CASE WHEN row_number() OVER w2 = 1 OR row_number() OVER w2 = count(*) OVER wf THEN 'inf'::DOUBLE
             WHEN max(o2) OVER wf - min(o2) OVER wf > 0 THEN (lead(o2) OVER w2 - lag(o2) OVER w2) / (max(o2) OVER wf - min(o2) OVER wf)
             ELSE 0.0 END AS crowd
      FROM rk WINDOW w1 AS (PARTITION BY front ORDER BY o1, ind), w2 AS (PARTITION BY front ORDER BY o2, ind),
                     wf AS (PARTITION BY front))"""


def group_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per (nation, market segment): number of orders and (negated) mean order value."""
    segment = F.col("c_mktsegment")
    code = F.when(segment == "AUTOMOBILE", 0).when(segment == "BUILDING", 1).when(segment == "FURNITURE", 2).when(segment == "HOUSEHOLD", 3).otherwise(4)
    o = read_table(spark, sf_dir, "orders").join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy((F.col("c_nationkey") * 10 + code).alias("ind")).agg(
        F.count("*").cast("double").alias("o1"), (-F.round(F.avg("o_totalprice"), 2)).alias("o2"))


@query("pareto_rank", "W6 J12", f"""WITH RECURSIVE {PTS_SQL}, {FRONT_SQL}
    SELECT ind, front, CAST((SELECT count(*) FROM dom WHERE dom.b = rk.ind) AS BIGINT) AS n_dominators FROM rk""")
def q_pareto_rank(spark, sf_dir):
    return PA.pareto_rank(group_points(spark, sf_dir)).select("ind", "front", "n_dominators")


@query("crowding", "W5", f"""WITH RECURSIVE {PTS_SQL}, {FRONT_SQL}, {CROWD_SQL}
    SELECT ind, front, round(crowd, 9) AS crowd FROM cw""")
def q_crowding(spark, sf_dir):
    return PA.crowding(PA.pareto_rank(group_points(spark, sf_dir))).select("ind", "front", F.round("crowd", 9).alias("crowd"))


@query("survivors", "T7 U3", f"""WITH RECURSIVE {PTS_SQL}, {FRONT_SQL}, {CROWD_SQL}
    SELECT ind FROM cw ORDER BY front, crowd DESC, ind LIMIT (SELECT count(*) // 2 FROM pts)""")
def q_survivors(spark, sf_dir):
    pts = group_points(spark, sf_dir)
    both = pts.where("ind % 2 = 0").unionAll(pts.where("ind % 2 = 1"))  # parents and offspring
    return PA.survivors(PA.crowding(PA.pareto_rank(both)), both.count() // 2).select("ind")


@query("pareto_front", "T5 A19", f"""WITH RECURSIVE {PTS_SQL}, {FRONT_SQL}
    SELECT ind, o1, o2, s.* FROM rk, (SELECT count(*) FILTER (front = 0) AS front0_size, max(o1) AS max_o1, round(avg(o1), 6) AS mean_o1,
                                             max(o2) AS max_o2, round(avg(o2), 6) AS mean_o2 FROM rk) s WHERE front = 0""")
def q_pareto_front(spark, sf_dir):
    ranked = PA.pareto_rank(group_points(spark, sf_dir))
    stats = PA.front_stats(ranked)  # one row
    front = ranked.where("front = 0").orderBy("o1").select("ind", "o1", "o2")
    return front.join(F.broadcast(stats)).select("ind", "o1", "o2", "front0_size", "max_o1", F.round("mean_o1", 6).alias("mean_o1"),
                                                 "max_o2", F.round("mean_o2", 6).alias("mean_o2"))


# --- distributed fitness over embeddings ----------------------------------
def emb_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with their positive label ids (class, and class+3 on every third row)."""
    e = embedding_features(spark, sf_dir)
    extra = F.when(F.col("case_id") % 3 == 0, F.array(((F.col("label") + 3) % 10).cast("int"))).otherwise(F.array().cast("array<int>"))
    return e.select("case_id", "features", F.array_distinct(F.concat(F.array(F.col("label").cast("int")), extra)).alias("labels"))


def fit_population(n: int = N_FIT_POP) -> np.ndarray:
    return ST.first_population(EMB_SHAPE, np.arange(n), SEED, EV.INIT_SCALE)


FIT_Y = """y AS (SELECT vec_id AS case_id, CAST(label AS BIGINT) AS k FROM embeddings
                 UNION SELECT vec_id, CAST((label + 3) % 10 AS BIGINT) FROM embeddings WHERE vec_id % 3 = 0),
    py AS (SELECT p.ind, p.case_id, p.k, p.p, CASE WHEN y.k IS NULL THEN 0 ELSE 1 END AS yy
           FROM prob p LEFT JOIN y ON p.case_id = y.case_id AND p.k = y.k)"""


def _fitness_sql(recursive: str = "") -> str:
    return f"""WITH {recursive} w AS ({genes_sql(EMB_SHAPE, SEED, n_ind=N_FIT_POP)}), {EMB_X}, {forward_sql(EMB_SHAPE, 'x', 'w')}, {FIT_Y},
    c AS (SELECT ind, lab AS k, t, sum(CASE WHEN p >= t THEN 1 ELSE 0 END) AS pp, sum(CASE WHEN p >= t AND yy = 1 THEN 1 ELSE 0 END) AS tp,
                 sum(yy) AS ap FROM (SELECT ind, k AS lab, p, yy FROM py), {S.FIT_GRID} GROUP BY ind, lab, t),
    bf AS (SELECT ind, k, max(CASE WHEN pp + ap > 0 THEN 2.0::DOUBLE * tp / (pp + ap) ELSE 0.0 END) AS f1 FROM c GROUP BY ind, k),
    fit AS (SELECT ind, sum(f1) / 10.0 AS fitness FROM bf GROUP BY ind),
    o AS (SELECT ind, k, sum(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS pp, sum(CASE WHEN p >= 0.5 AND yy = 1 THEN 1 ELSE 0 END) AS tp,
                 sum(yy) AS ap FROM py GROUP BY ind, k),
    ob AS (SELECT ind, sum(CASE WHEN pp > 0 THEN tp::DOUBLE / pp ELSE 0.0 END) / 10.0 AS precision_macro,
                  sum(CASE WHEN ap > 0 THEN tp::DOUBLE / ap ELSE 0.0 END) / 10.0 AS recall_macro FROM o GROUP BY ind)"""


@query("population_fitness", "E1 E2 E3 M6", _fitness_sql() + """
    SELECT CAST(fit.ind AS INTEGER) AS ind, round(fitness, 9) AS fitness, round(precision_macro, 9) AS precision_macro,
           round(recall_macro, 9) AS recall_macro FROM fit JOIN ob ON fit.ind = ob.ind""")
def q_population_fitness(spark, sf_dir):
    data = emb_labelled(spark, sf_dir)
    pop = fit_population()
    # one pass over the data: coarse-grid bucket counts serve both the fitness
    # and the objectives at 0.5 (a grid value: predict when bucket > its index)
    counts = written(EV.population_counts(data, pop, EMB_SHAPE, CAL.FIT_GRID), "counts")
    f = EV.fitness_from_counts(counts, CAL.FIT_GRID, EMB_SHAPE.o)
    o = EV.objectives_from_counts(counts, EMB_SHAPE.o, CAL.FIT_GRID.index(0.5))
    return f.join(o, "ind").select(F.col("ind").cast("int").alias("ind"), F.round("fitness", 9).alias("fitness"),
                                   F.round("precision_macro", 9).alias("precision_macro"),
                                   F.round("recall_macro", 9).alias("recall_macro"))


@query("feature_importance", "A23 T3", _fitness_sql() + f""",
    best AS (SELECT ind FROM fit ORDER BY round(fitness, 12) DESC, ind LIMIT 1),
    wb AS (SELECT w.gene, abs(w.w) AS a FROM w JOIN best ON w.ind = best.ind),
    infl AS (SELECT (gene - {EMB_SHAPE.d * EMB_SHAPE.h + EMB_SHAPE.h}) // {EMB_SHAPE.o} AS h, sum(a) AS s FROM wb
             WHERE gene >= {EMB_SHAPE.d * EMB_SHAPE.h + EMB_SHAPE.h}
               AND gene < {EMB_SHAPE.d * EMB_SHAPE.h + EMB_SHAPE.h + EMB_SHAPE.h * EMB_SHAPE.o} GROUP BY 1),
    imp AS (SELECT gene // {EMB_SHAPE.h} AS feature_id, sum(a * s) AS importance FROM wb
            JOIN infl ON wb.gene % {EMB_SHAPE.h} = infl.h WHERE gene < {EMB_SHAPE.d * EMB_SHAPE.h} GROUP BY 1)
    SELECT CAST(feature_id AS INTEGER) AS feature_id, 'emb_' || feature_id AS feature, round(importance, 9) AS importance,
           CAST(row_number() OVER (ORDER BY importance DESC, feature_id) AS INTEGER) AS rank
    FROM imp ORDER BY importance DESC, feature_id LIMIT 20""")
def q_feature_importance(spark, sf_dir):
    data = emb_labelled(spark, sf_dir)
    pop = fit_population()
    f = EV.fitness_from_counts(EV.population_counts(data, pop, EMB_SHAPE, CAL.FIT_GRID), CAL.FIT_GRID, EMB_SHAPE.o)
    best = f.orderBy(F.desc(F.round("fitness", 12)), "ind").first()["ind"]
    genes = spark.createDataFrame([(i, float(v)) for i, v in enumerate(pop[best])], "gene long, value double")
    names = spark.range(EMB_SHAPE.d).select(F.col("id").cast("int").alias("feature_id"),
                                             F.concat(F.lit("emb_"), F.col("id")).alias("feature"))
    top = XP.top_features(XP.importance(genes, EMB_SHAPE, names), 20)
    return top.select("feature_id", "feature", F.round("importance", 9).alias("importance"), F.col("rank").cast("int").alias("rank"))


@query("gram_matrix", "A21", f"""WITH {EMB_X},
    yl AS (SELECT vec_id AS case_id, CAST(label AS BIGINT) AS j FROM embeddings
           UNION SELECT vec_id, CAST((label + 3) % 10 AS BIGINT) FROM embeddings WHERE vec_id % 3 = 0)
    SELECT 'xx' AS block, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(sum(a.v * b.v), 6) AS value
    FROM x a JOIN x b ON a.case_id = b.case_id GROUP BY a.i, b.i
    UNION ALL
    SELECT 'xy', CAST(x.i AS INTEGER), CAST(yl.j AS INTEGER), round(sum(x.v), 6) FROM x JOIN yl ON x.case_id = yl.case_id
    GROUP BY x.i, yl.j""")
def q_gram_matrix(spark, sf_dir):
    g = SEL.gram_parts(emb_labelled(spark, sf_dir), EMB_SHAPE.d, EMB_SHAPE.o)
    # label columns that no case carries have all-zero sums; the long SQL form omits them
    g = g.where((F.col("block") == "xx") | (F.col("value") != 0))
    return g.select("block", "i", "j", F.round("value", 6).alias("value"))


@query("zscore", "A22", f"""WITH c_score AS ({SCORE_VIEW_DUCKDB}),
    st AS (SELECT label_id, avg(p) AS m, stddev_pop(p) AS sd FROM c_score GROUP BY label_id)
    SELECT s.case_id, s.label_id, round((s.p - st.m) / (st.sd + 1e-9), 6) AS z FROM c_score s JOIN st USING (label_id)""")
def q_zscore(spark, sf_dir):
    z = SEL.zscore(view(spark, sf_dir, "c_score"), s="p")
    return z.select("case_id", "label_id", F.round("z", 6).alias("z"))


@query("ridge_fit", "M12", f"""WITH {EMB_X},
    yl AS (SELECT vec_id AS case_id, CAST(label AS BIGINT) AS j FROM embeddings
           UNION SELECT vec_id, CAST((label + 3) % 10 AS BIGINT) FROM embeddings WHERE vec_id % 3 = 0)
    SELECT CAST(x.i AS INTEGER) AS i, CAST(yl.j AS INTEGER) AS j, round(sum(x.v), 5) AS xy FROM x JOIN yl ON x.case_id = yl.case_id
    GROUP BY x.i, yl.j""")
def q_ridge_fit(spark, sf_dir):
    """The fitted weights put back into the normal equations: (XᵀX + αI) W, which must be XᵀY.

    W comes from the operator; XᵀX is summed here from the table itself.
    """
    data = emb_labelled(spark, sf_dir)
    xx, xy, _, _ = SEL.gram_arrays(data, EMB_SHAPE.d, EMB_SHAPE.o)
    w = SEL.ridge_weights(xx, xy)
    weights = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(w)], "k int, w array<double>")  # feature width
    cells = data.select("case_id", F.posexplode("features").alias("k", "v"))
    z = cells.join(F.broadcast(weights), "k").select("case_id", F.posexplode("w").alias("j", "w"), "v").groupBy("case_id", "j").agg(F.sum(F.col("v") * F.col("w")).alias("z"))
    xxw = cells.withColumnRenamed("k", "i").join(z, "case_id").groupBy("i", "j").agg(F.sum(F.col("v") * F.col("z")).alias("s"))
    own = weights.select(F.col("k").alias("i"), F.posexplode("w").alias("j", "w"))
    out = xxw.join(own, ["i", "j"]).select("i", "j", F.round(F.col("s") + SEL.RIDGE_ALPHA * F.col("w"), 5).alias("xy"))
    present = data.select(F.explode("labels").alias("j")).distinct()
    return out.join(F.broadcast(present), "j", "left_semi").select("i", "j", "xy")


CHILD_SQL = f"""pairs AS (SELECT a.draw // 2 AS pair, a.ind AS m, b.ind AS f FROM chosen a JOIN chosen b ON b.draw = a.draw + 1 WHERE a.draw % 2 = 0),
    kid AS (SELECT pair, c.c, FIRST_KID + 2 * pair + c.c AS ind, gm.gene,
                   CASE WHEN ({S.hash_unit(SEED, "'px'", str(GEN), 'pair')} >= 0.9 OR {S.hash_unit(SEED, "'ux'", str(GEN), 'pair', 'gm.gene')} < 0.5) = (c.c = 0)
                        THEN gm.w ELSE gf.w END AS v
            FROM pairs JOIN w gm ON gm.ind = m JOIN w gf ON gf.ind = f AND gf.gene = gm.gene, (VALUES (0), (1)) c(c)),
    mut AS (SELECT ind, gene, v + CASE WHEN {S.hash_unit(SEED, "'mut'", str(GEN), 'ind', 'gene')} < 0.04
                                       THEN 0.25 * {S.hash_normal(SEED, "'mutn'", str(GEN), 'ind', 'gene')} ELSE 0.0 END AS v FROM kid)"""
IMM = EV.IMMIGRANTS


@query("ga_step", "E4 E5 E7 E8 E10 E12 W2 T6", _fitness_sql() + f""",
    rf AS (SELECT ind, round(fitness, 9) AS fitness FROM fit),
    r AS (SELECT ind, fitness, row_number() OVER (ORDER BY fitness, ind) - 1 AS rank FROM rf),
    cum AS (SELECT ind, sum((2.0::DOUBLE - 1.7 + 2.0 * (1.7 - 1.0) * rank / 79) / 80) OVER (ORDER BY ind) AS hi FROM r),
    chosen AS (SELECT d.draw, coalesce(min(cum.ind), 79) AS ind
               FROM (SELECT range AS draw, {S.hash_unit(SEED, "'rank'", str(GEN), 'range')} AS u FROM range(0, 78)) d
               LEFT JOIN cum ON cum.hi > d.u GROUP BY d.draw),
    {CHILD_SQL.replace("FIRST_KID", "2")},
    el AS (SELECT row_number() OVER (ORDER BY fitness DESC, ind) - 1 AS place, ind FROM rf ORDER BY fitness DESC, ind LIMIT 2),
    new AS (SELECT place AS ind, gene, w AS v FROM el JOIN w USING (ind) UNION ALL SELECT ind, gene, v FROM mut WHERE ind < 72
            UNION ALL SELECT i.range, g.range, {S.hash_normal(SEED, "'init'", str(GEN), 'i.range', 'g.range')} * {EV.segment_std_sql(EMB_SHAPE, 'g.range')}
                      FROM range(72, 80) i, range(0, {EMB_SHAPE.n_params}) g)
    SELECT CAST(ind AS INTEGER) AS ind, CAST(gene AS INTEGER) AS gene, round(v, 9) AS value FROM new""")
def q_ga_step(spark, sf_dir):
    """The step that every search takes, on the scored first population: rank selection, crossover, mutation, elites and
    immigrants."""
    pop = fit_population()
    fitness = np.round(EV.population_fitness(emb_labelled(spark, sf_dir), pop, EMB_SHAPE), 9)
    new = ST.next_generation(pop, fitness, EV.GAConfig(), EV.SIGMA0, SEED, GEN)
    return gene_rows(spark, ST.with_immigrants(new, IMM, EMB_SHAPE, EV.INIT_SCALE, SEED, GEN))


def gene_rows(spark: SparkSession, pop: np.ndarray) -> DataFrame:
    rows = spark.createDataFrame([(i, g.tolist()) for i, g in enumerate(pop)], "ind int, genome array<double>")
    return rows.select("ind", F.posexplode("genome").alias("gene", "v")).select("ind", "gene", F.round("v", 9).alias("value"))


@query("nsga_step", "E2 E14 W5 W6 T7", _fitness_sql("RECURSIVE") + f""",
    pts AS (SELECT ind, round(precision_macro, 9) AS o1, round(recall_macro, 9) AS o2 FROM ob WHERE ind < 60),
    {FRONT_SQL}, {CROWD_SQL},
    pl AS (SELECT ind, row_number() OVER (ORDER BY front, crowd DESC, ind) - 1 AS place FROM cw),
    asp AS (SELECT d.range AS draw, CAST(floor({S.hash_unit(SEED, "'tour'", str(GEN), 'd.range', 's.range')} * 60) AS BIGINT) AS ind FROM range(0, 60) d, range(0, 3) s),
    chosen AS (SELECT draw, arg_min(pl.ind, place) AS ind FROM asp JOIN pl ON asp.ind = pl.ind GROUP BY draw),
    {CHILD_SQL.replace("FIRST_KID", "0")}
    SELECT CAST(ind AS INTEGER) AS ind, CAST(gene AS INTEGER) AS gene, round(v, 9) AS value FROM mut""")
def q_nsga_step(spark, sf_dir):
    """NSGA-II's step on the first 60 individuals: fronts, spacing, tournament, crossover, mutation."""
    pop = fit_population(60)
    objectives = np.round(EV.population_objectives(emb_labelled(spark, sf_dir), pop, EMB_SHAPE), 9)
    return gene_rows(spark, ST.next_front_children(pop, objectives, EV.GAConfig(selection="tournament"), EV.SIGMA0, SEED, GEN))


@query("evolve_run", "E10 E11 E12 W3")
def q_evolve_run(spark, sf_dir):
    """The whole search: 80 individuals, 300 generations; history with running best."""
    _, _, hist = EV.evolve(emb_labelled(spark, sf_dir), EMB_SHAPE, EV.GAConfig())
    return EV.running_best(hist)


@query("nsga2", "E14 T5 U3")
def q_nsga2(spark, sf_dir):
    """NSGA-II: 60 individuals, 40 generations; the final front (precision_macro, recall_macro)."""
    return PL.nsga2(emb_labelled(spark, sf_dir), EMB_SHAPE, seed=SEED)


@query("feature_select", "E13 E9 A21 A22 M12")
def q_feature_select(spark, sf_dir):
    """Feature masks: 40 masks, 30 generations (train / validation by hash split); the base line with all features first."""
    split = hash_split(emb_labelled(spark, sf_dir), "case_id", SEED, 0.0, 0.3)
    with cached(split) as data:
        tr, va = data.where("split = 'train'"), data.where("split = 'val'")
        mask, _, base, hist = SEL.feature_select(tr, va, EMB_SHAPE.d, EMB_SHAPE.o)
    rows = [("all_features", 0, base, EMB_SHAPE.d)] + [("search", g, f1, n) for g, _, f1, n in hist]
    rows += [(f"emb_{i}", len(hist), None, 1) for i in np.flatnonzero(mask).tolist()]
    return spark.createDataFrame(rows, "item string, gen int, f1 double, n_features int")


@query("ablation", "E15 E16")
def q_ablation(spark, sf_dir):
    """Five configurations, 40 individuals and 50 generations each."""
    with cached(emb_labelled(spark, sf_dir)) as data:
        return PL.ablation(data, EMB_SHAPE)


@query("sweep", "E17 E18")
def q_sweep(spark, sf_dir):
    """Thirteen settings, 40 individuals and 50 generations each; the main trainer (80 individuals) with 120, 300 and 500 generations."""
    with cached(emb_labelled(spark, sf_dir)) as data:
        return PL.sweep(data, EMB_SHAPE).unionByName(PL.generation_study(data, EMB_SHAPE))


@query("elites", "T6", f"""WITH {POP_SQL}
    SELECT ind, fitness FROM f ORDER BY fitness DESC, ind LIMIT 2""")
def q_elites(spark, sf_dir):
    return EV.elites(emb_population(spark, sf_dir).select("ind", "fitness"), EV.ELITISM)


MASK_SQL = """mk AS (SELECT i, avg(v) > 0 AS keep FROM (SELECT CAST(generate_subscripts(genome, 1) - 1 AS BIGINT) AS i,
                     unnest(genome) AS v FROM f) GROUP BY i)"""


@query("masked_features", "F10", f"""WITH {POP_SQL}, {GENES_SQL}, {MASK_SQL},
    kept AS (SELECT gl.ind, gl.gene, gl.v FROM gl JOIN mk ON gl.gene = mk.i WHERE mk.keep)
    SELECT ind, CAST(count(*) AS INTEGER) AS n_features, round(sum(v), 9) AS total FROM kept GROUP BY ind""")
def q_masked_features(spark, sf_dir):
    """The mask keeps dimensions whose mean over the population is positive."""
    pop = emb_population(spark, sf_dir)
    means = EV.genes_of(pop.select("ind", "genome")).groupBy("gene").agg(F.avg("value").alias("m"))
    mask_rows = means.collect()  # one row per dimension (bounded by the genome width)
    mask = [False] * len(mask_rows)
    for r in mask_rows:
        mask[int(r["gene"])] = r["m"] > 0
    m = SEL.apply_mask(pop.select("ind", F.col("genome").alias("features")), mask)
    return m.select("ind", F.size("features").cast("int").alias("n_features"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, v: a + v), 9).alias("total"))


@query("final_fit", "E19 M13 A8-A11")
def q_final_fit(spark, sf_dir):
    """Search on train (80 individuals, 300 generations), thresholds on validation, the metrics record on test."""
    with cached(emb_labelled(spark, sf_dir)) as data:
        _, best_fit, _, metrics, seconds = PL.train_and_test(data, EMB_SHAPE, EV.GAConfig())
    rows = [("best_fitness_train", float(best_fit))] + [(k, float(v)) for k, v in metrics.items()] + [("seconds", seconds)]
    return spark.createDataFrame(rows, "metric string, value double")
