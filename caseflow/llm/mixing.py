"""Mixing sources to target weights by Pfair scheduling.

A mix is a row of slots, one block of documents in each. A source of weight w, of W in all, gives its block j (from 0) a release
time floor(j*W/w) and a deadline ceil((j+1)*W/w); in each slot the released block with the earliest deadline goes (ties: the
larger weight, then the source's name). One slot at a time this meets every deadline, so after any number of slots t each source
has had its t*w/W blocks to within less than one block, for the weights as they are given.

The schedule repeats after W slots (W and the weights divided by their greatest common divisor). Sources of equal weight have the
same windows and take turns by name, so one period is folded over the different weights, of which there are at most about
sqrt(2*W): neither the number of sources nor that of documents bounds it or is bounded by it, only how finely the targets are
stated (MAX_SLOTS). Every document keeps its slot: when a source has run out its slots stay empty and the others go on in their
order, at the same ratios to each other.

Everything is DataFrame functions. Documents are numbered inside a source without gathering it: an even hash cuts the source
into buckets, a count of each bucket gives its offset, and rows are numbered inside their bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Documents in a block, rows that a numbering bucket holds on average at most.
BLOCK_ROWS = 16
BUCKET_ROWS = 2000
#: Weights without given targets are whole parts of this.
PARTS = 1000
#: Slots of a period at most (targets stated more finely are refused), slots folded at once, rows of a schedule that is broadcast.
MAX_SLOTS = 1 << 22
FRAME = 1 << 10
BROADCAST_ROWS = 100_000


def source_weights(docs: DataFrame, source_col: str = "source", power_thousandths: int = 500, parts: int = PARTS) -> DataFrame:
    """``source, rows, weight``: sizes to the given power (thousandths) as whole parts of ``parts``, at least 1.

    With 500, the square root: the usual tempering, which gives small sources more and large ones less than their share.
    Null sources are one source; repeated rows count each; an empty table gives no rows; other columns are not read.
    """
    sizes = docs.groupBy(docs[source_col].cast("string").alias("source")).agg(F.count("*").alias("rows"))
    sizes = cut(sizes.withColumn("size", F.pow("rows", F.lit(power_thousandths / 1000))), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 1.0
    return sizes.select("source", "rows", F.greatest(F.lit(1), F.round(parts * F.col("size") / total).cast("long")).alias("weight"))


def shared_period(weights: DataFrame) -> DataFrame:
    """``source, weight, slots, members, member, period``: the weights in lowest terms and each source's place among its equals.

    ``weights`` has one row a source with a weight over 0. ``members`` sources have the same ``slots`` of a ``period``; ``member``
    (from 0, by name, null last) is this one's turn. An empty table gives no rows.
    """
    kinds = weights.groupBy("weight").agg(F.count("*").alias("members"))
    n, total = kinds.agg(F.count("*"), F.sum(F.col("weight") * F.col("members"))).first()
    divisor = 1
    if n and n <= math.isqrt(8 * MAX_SLOTS) + 1:  # so many different weights can sum to MAX_SLOTS in lowest terms at most
        divisor = math.gcd(*(r.weight for r in kinds.select("weight").collect()))
    period = (total or 0) // divisor
    if period > MAX_SLOTS:
        raise ValueError(f"the targets repeat after {period} slots only, {MAX_SLOTS} at most: state the weights in larger parts")
    turn = Window.partitionBy("weight").orderBy(F.col("source").isNull(), "source")
    rows = weights.join(kinds, "weight").withColumn("member", F.row_number().over(turn) - 1)
    return rows.select("source", "weight", F.expr(f"weight div {divisor}").alias("slots"), "members", "member", F.lit(period).cast("long").alias("period"))


def period_schedule(shared: DataFrame) -> DataFrame:
    """``slots, k, slot``: of the sources with ``slots`` slots of a period, the slot of their k-th block (from 0) together.

    Earliest deadline first over the period's slots, folded in frames over the different weights: the state is how many blocks
    the sources of each weight have had, the step picks among their next blocks that are released.
    """
    kinds = shared.groupBy("slots").agg(F.max("members").alias("m"), F.max("period").alias("period"))
    row = kinds.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.col("slots").alias("a"), "m")), asc=False).alias("c"), F.max("period").alias("w"))
    row = row.where("size(c) > 0").withColumn("n", F.size("c"))
    # The next block of a weight is number (had div m) of its member (had % m); due, if released, as (deadline, place).
    due = """transform(c, (x, i) -> if(s.had[i] < x.a * x.m AND (s.had[i] div x.m) * w div x.a <= t,
                                      ((s.had[i] div x.m + 1) * w + x.a - 1) div x.a * n + i, null))"""
    step = f"""transform(array(cast(array_min({due}) % n AS int)),
                         p -> named_struct('had', transform(s.had, (h, i) -> h + if(i = p, 1L, 0L)), 'out', concat(s.out, array(p))))[0]"""
    frame = f"""aggregate(sequence(f * {FRAME}, least((f + 1) * {FRAME}, w) - 1),
                          named_struct('had', g.had, 'out', cast(array() AS array<int>)), (s, t) -> {step})"""
    fold = f"""aggregate(sequence(0L, (w - 1) div {FRAME}), named_struct('had', transform(c, x -> 0L), 'out', cast(array() AS array<array<int>>)),
                         (g, f) -> transform(array({frame}), r -> named_struct('had', r.had, 'out', concat(g.out, array(r.out))))[0], g -> flatten(g.out))"""
    slots = row.select("c", F.posexplode(F.expr(fold)).alias("slot", "i")).select(F.expr("c[i].a").alias("slots"), F.col("slot").cast("long").alias("slot"))
    return slots.withColumn("k", F.row_number().over(Window.partitionBy("slots").orderBy("slot")) - F.lit(1).cast("long"))


def _key(source: Column) -> Column:
    """Source as a string that is never null, so that plain equality joins it."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _numbered(docs: DataFrame, per_source: DataFrame, id_col: str, source_col: str, bucket_rows: int) -> DataFrame:
    """``row, key, n``: each row's number (from 0) in its source by md5 of the id, then id, then the whole row."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _key(docs[source_col]).alias("key"), docs[id_col].alias("id"))
    rows = rows.withColumn("h", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
    rows = rows.join(per_source.select("key", "rows"), "key")
    # The first 32 bits of the hash, scaled to the source's number of buckets, keep the hash's order.
    rows = rows.withColumn("buckets", F.expr(f"(rows + {bucket_rows} - 1) div {bucket_rows}"))
    rows = rows.withColumn("bucket", F.expr("(cast(conv(substring(h, 1, 8), 16, 10) as bigint) * buckets) div 4294967296"))
    counts = rows.groupBy("key", "bucket").agg(F.count("*").alias("c"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("key", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("key", "bucket").orderBy("h", F.col("id").isNull(), "id", F.xxhash64("row"))
    rows = rows.withColumn("i", F.row_number().over(inside)).join(offsets, ["key", "bucket"])
    return rows.select("row", "key", (F.col("offset") + F.col("i") - 1).alias("n"))


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with ``source, block, slot, place, in_mix``.

    ``weights`` has ``source, weight`` (whole numbers); a source's weights are added up, sources that it lacks get weight 1, and the
    rows of a source whose weight is 0, negative or null are left out. Without it weights come from ``source_weights`` and every
    row has a slot. A source is cut into blocks of ``block_rows`` in md5 order of the ids; ``slot`` is the block's place in the mix
    and ``place`` the row's in the block. ``in_mix``: up to here no source has run out, so the mix so far is true to its targets.
    Null sources are one source; null ids come last among equal hashes; repeated rows take places of their own; texts of any
    length stay whole; an empty table gives no rows. The row is a struct, so column names cannot clash.
    """
    sizes = source_weights(docs, source_col)
    if weights is not None:
        given = weights.groupBy(_key(F.col("source")).alias("key")).agg(F.coalesce(F.sum(F.col("weight").cast("long")), F.lit(0)).alias("w"))
        sizes = sizes.withColumn("key", _key(F.col("source"))).join(given, "key", "left")
        sizes = sizes.select("source", "rows", F.coalesce("w", F.lit(1)).alias("weight")).where("weight > 0")
    sizes = cut(sizes, "weights")
    shared = shared_period(sizes.select("source", "weight"))
    schedule = cut(period_schedule(shared), "schedule")
    n_sources, n_slots = sizes.count(), schedule.count()
    per_source = sizes.select(_key(F.col("source")).alias("key"), "rows")
    per_source = cut(per_source.join(shared.withColumn("key", _key(F.col("source"))), "key"), "shares")

    def placed(blocks: DataFrame) -> DataFrame:
        """Blocks with their source's shares and ``slot``."""
        turn = blocks.withColumn("turn", F.col("block") * F.col("members") + F.col("member")).withColumn("k", F.expr("turn % (slots * members)"))
        at = schedule.select("slots", "k", F.col("slot").alias("at"))
        return turn.join(_small(at, n_slots), ["slots", "k"]).withColumn("slot", F.expr("turn div (slots * members) * period + at"))

    # The mix is true to its targets up to the first block that a source does not have.
    ends = placed(per_source.withColumn("block", F.expr(f"(rows + {block_rows} - 1) div {block_rows}")))
    horizon = ends.agg(F.min("slot")).first()[0]
    rows = _numbered(docs, _small(per_source, n_sources), id_col, source_col, bucket_rows)
    rows = rows.withColumn("block", F.expr(f"n div {block_rows}")).withColumn("place", F.expr(f"n % {block_rows}"))
    shares = per_source.select("key", "source", "slots", "members", "member", "period")
    slots = placed(rows.join(_small(shares, n_sources), "key"))
    return slots.select("row", "source", "block", "slot", "place", (F.col("slot") < F.lit(horizon)).alias("in_mix"))


def write_order(mixed: DataFrame) -> DataFrame:
    """The mix's rows, columns as they were, ranged and sorted by slot: files written from it hold the mix in order.

    All rows of ``mixed`` stay, those behind a source that has run out too; repeated rows stay; an empty table gives no rows. The
    rows are written first, so that finding the ranges reads two of their columns and does not number them again.
    """
    rows = cut(mixed.select("slot", "place", "row"), "mix").repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return rows.select("row.*")
