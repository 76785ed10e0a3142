"""Delimited batch files.

Quarterly batches are ``$``-separated text files with a header.  A row means the same whichever columns a query selects: a
row with more fields than its header is dropped, one with fewer is padded with nulls, blank lines are no rows, the first line
of a file is its header, and the missing-value tokens become null.  Batches are aligned by name (a column that a batch lacks is
null).  Every row carries its version order: ``_file`` (file name; later name = later batch) and ``_row`` (position inside the
file).

A field that begins with a quote ends at the next single quote; a doubled quote inside is one, separators and line breaks
inside are text, what follows the closing quote belongs to the field, and a quote elsewhere is an ordinary character.  Files are
still read in splits: each line that has a quote tells how it ends when it begins outside quotes and when it begins inside; these
two-state maps are composed along each split, then along the splits of a file, which gives the state at every split and the
lines that belong to one row.  Lines meet those marks in a sort-merge join; files without such lines are read in one pass after the scan.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import null_tokens, num_or_null
from ..session import written
from . import files as FS

SEP = "$"

# Column names of the headerless knowledge-base files.
EFFECT_COLUMNS = ["stitch_flat", "stitch_stereo", "umls_se", "meddra_type", "umls_meddra", "side_effect"]
NAME_COLUMNS = ["stitch_id", "drug_name"]


def batch_files(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """All files of one kind, by name (later name = later batch)."""
    return FS.matching(spark, f"{folder.rstrip('/')}/{prefix}*.txt")


def header_columns(line: str, sep: str = SEP) -> list[str]:
    return [c.strip().lower() for c in next(csv.reader([line], delimiter=sep))]


def _field(sep: str) -> str:
    """A field: quoted and what follows the closing quote, or without a quote in front, or empty."""
    s = re.escape(sep)
    return f'(?:"(?:[^"]++|"")*+"[^{s}]*+|[^"{s}][^{s}]*+|)'


def _opens(line: Column, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return line.contains('"') & ~line.rlike(f"(?s)\\A{_field(sep)}(?:{re.escape(sep)}{_field(sep)})*+\\z")


def _stays_open(line: Column, sep: str) -> Column:
    """Whether a line that begins inside quotes ends inside."""
    s = re.escape(sep)
    return ~(line.contains('"') & line.rlike(f'(?s)\\A(?:[^"]++|"")*+"[^{s}]*+(?:{s}{_field(sep)})*+\\z'))


def _unquoted(field: Column) -> Column:
    quoted = r'(?s)\A"((?:[^"]++|"")*+)"(.*)\z'
    inside = F.replace(F.regexp_extract(field, quoted, 1), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), F.concat(inside, F.regexp_extract(field, quoted, 2))).otherwise(field)


def split_fields(row: Column, sep: str = SEP) -> Column:
    """The fields of a row (null: null); quotes as above, a row that ends inside quotes ends the field."""
    s = re.escape(sep)
    closed = F.when(_opens(row, sep), F.concat(row, F.lit('"'))).otherwise(row)
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), closed), F.lit(f"(?s){s}({_field(sep)})"), F.lit(1))
    return F.when(row.contains('"'), F.transform(quoted, _unquoted)).otherwise(F.split(row, s, -1))


def parse_lines(lines: DataFrame, columns: list[str], sep: str = SEP, value: str = "value") -> DataFrame:
    """S2 / H1 on any table (also a stream) with a row in ``value``: the columns by position, other columns kept."""
    rest = [c for c in lines.columns if c != value]
    rows = lines.where(F.trim(value) != "").select(*rest, split_fields(F.col(value), sep).alias("_parts")).where(F.size("_parts") <= len(columns))
    return rows.select(*[null_tokens(F.get("_parts", F.lit(i))).alias(c) for i, c in enumerate(columns)], *rest)


def file_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``value, _path, _file, _block, _at`` of all lines; a split's lines are numbered one after the other."""
    meta = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    return spark.read.text(paths).select("value", *meta, F.monotonically_increasing_id().alias("_at"))


def _composed(maps: DataFrame, part: list[str], order: str) -> DataFrame:
    """Two-state maps ``a`` (where state 0 goes) and ``b`` (where 1 goes), each composed with all before it: adds ``fa, fb``.

    A map that sends both states to one decides; after the last of these only the number of swaps counts.
    """
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.sum(F.when(F.col("a") > F.col("b"), 1).otherwise(0)).over(w)
    m = maps.withColumn("_swaps", swaps)
    m = m.withColumn("_set", F.last(F.when(F.col("a") == F.col("b"), F.struct("a", "_swaps")), ignorenulls=True).over(w))
    odd = (F.col("_swaps") - F.coalesce(F.col("_set._swaps"), F.lit(0))) % 2
    return m.withColumn("fa", (F.coalesce(F.col("_set.a"), F.lit(0)) + odd) % 2).withColumn("fb", (F.coalesce(F.col("_set.a"), F.lit(1)) + odd) % 2).drop("_swaps", "_set")


def _lines_of_long_rows(lines: DataFrame, sep: str) -> DataFrame:
    """``_path, _block, _at, _start`` of the lines of rows that span lines; ``_start`` is the position of the row's first line."""
    split = ["_path", "_block"]
    value = F.col("value")
    maps = lines.where(value.contains('"')).select(*split, "_at", _opens(value, sep).cast("int").alias("a"), _stays_open(value, sep).cast("int").alias("b"))
    events = written(_composed(maps.where("a = 1 OR b = 0"), split, "_at").drop("a", "b"), "events")
    whole = events.groupBy(*split).agg(F.max_by(F.struct(F.col("fa").alias("a"), F.col("fb").alias("b")), "_at").alias("m"))
    splits = lines.groupBy(*split).agg(F.min("_at").alias("lo"), F.max("_at").alias("hi")).join(whole, split, "left")
    splits = splits.select(*split, "lo", "hi", F.coalesce("m.a", F.lit(0)).alias("a"), F.coalesce("m.b", F.lit(1)).alias("b"))
    in_file = Window.partitionBy("_path").orderBy("_block")
    splits = written(_composed(splits, ["_path"], "_block").withColumn("state", F.coalesce(F.lag("fa").over(in_file), F.lit(0))).drop("a", "b", "fb"), "splits")
    open_files = splits.groupBy("_path").agg(F.max_by("fa", "_block").alias("end")).where("end = 1").select("_path").take(3)
    if open_files:
        raise ValueError(f"a quote is not closed in {', '.join(r[0] for r in open_files)}")
    after = events.join(splits.select(*split, "state"), split).select(*split, "_at", F.when(F.col("state") == 1, F.col("fb")).otherwise(F.col("fa")).alias("s"), F.lit(True).alias("event"))
    marks = after.unionByName(splits.select(*split, (F.col("lo") - 1).alias("_at"), F.col("state").alias("s"), F.lit(False).alias("event")))
    w = Window.partitionBy(*split).orderBy("_at")
    marks = marks.withColumn("opener", F.col("event") & (F.col("s") == 1) & (F.lag("s").over(w) == 0)).withColumn("next", F.lead("_at").over(w))
    own = F.last(F.when(F.col("opener"), F.struct("_block", "_at")), ignorenulls=True).over(w)
    marks = written(marks.withColumn("_start", own).where("s = 1"), "marks")
    # A row that goes on from an earlier split starts at the last opener of those before.
    last = marks.groupBy(*split).agg(F.max("_start").alias("last"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.join(last, split, "left").select(*split, "hi", F.last("last", ignorenulls=True).over(before).alias("carried"))
    rows = marks.join(carried, split).withColumn("_start", F.coalesce("_start", "carried"))
    first = F.when(F.col("opener"), F.col("_at")).otherwise(F.col("_at") + 1)
    until = F.coalesce("next", "hi")
    spans = rows.select(*split, "_start", first.alias("first"), until.alias("until")).where("first <= until")
    return spans.select(*split, "_start", F.explode(F.sequence("first", "until")).alias("_at"))


def file_rows(spark: SparkSession, paths: list[str], sep: str = SEP, header: str | None = None) -> DataFrame:
    """``value, _file, _row``: the rows of the files as text, those that span lines put together; without each file's header line.

    One scan before the reading finds the header's place in each file and whether any row spans lines. A file that ends inside
    quotes is an error.
    """
    lines = file_lines(spark, paths)
    at = F.struct("_block", "_at")
    head = F.min(F.when(F.col("value") == F.lit(header), at)) if header is not None else F.lit(None)
    found = lines.groupBy("_path").agg(head.alias("head"), F.max(_opens(F.col("value"), sep)).alias("opens")).collect()  # a row for each listed file
    heads = [(r["_path"], r["head"]["_block"], r["head"]["_at"]) for r in found if r["head"] is not None]
    if heads:
        table = spark.createDataFrame(heads, "_path string, _block long, _at long")
        lines = lines.join(F.broadcast(table), ["_path", "_block", "_at"], "left_anti")
    if not any(r["opens"] for r in found):
        return lines.select("value", "_file", at.alias("_row"))
    members = written(_lines_of_long_rows(lines, sep), "members").hint("merge")  # as many as the files have such lines: shuffled, never broadcast
    keys = ["_path", "_block", "_at"]
    alone = lines.join(members, keys, "left_anti").select("value", "_file", at.alias("_row"))
    parts = lines.join(members, keys).groupBy("_path", "_file", "_start").agg(F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("p"))
    return alone.unionByName(parts.select(F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"), "_file", F.col("_start").alias("_row")))


def read_files(spark: SparkSession, paths: list[str], sep: str = SEP) -> DataFrame:
    """Files with headers, all columns strings, aligned by name, with ``_file`` and ``_row``.

    Headers are read one line a file without a job; files with the same header are one scan, so the plan grows with the
    number of distinct headers and not with that of the files.
    """
    by_header = defaultdict(list)
    for path in paths:
        by_header[FS.first_line(spark, path)].append(path)
    tables = []
    for header, same in by_header.items():
        if header is not None:  # an empty file has no rows
            tables.append(parse_lines(file_rows(spark, same, sep, header), header_columns(header, sep), sep))
    if not tables:
        raise ValueError(f"all of these files are empty: {', '.join(paths[:3])}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_batches(spark: SparkSession, folder: str, prefix: str, sep: str = SEP) -> DataFrame:
    """S1 + S2 + U1: every batch of one kind."""
    paths = batch_files(spark, folder, prefix)
    if not paths:
        raise FileNotFoundError(f"no {prefix}*.txt files in {folder}")
    return read_files(spark, paths, sep)


def read_headerless(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """A headerless delimited file with fixed column names, all strings, missing-value tokens null."""
    return parse_lines(file_rows(spark, [path], sep).select("value"), columns, sep)


def optional(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """The file if it exists, on whatever file system the path names, else an empty table with the same columns."""
    if path and FS.exists(spark, path):
        return read_headerless(spark, path, columns, sep)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_case_table(spark: SparkSession, path: str) -> DataFrame:
    """Re-read an exported case table (CSV) as strings, missing-value tokens null, the numbers coerced;
    a missing weight column is tolerated. ``path`` is a file, or a folder of part files that each have the header."""
    df = read_files(spark, FS.files(spark, path), ",").drop("_file", "_row").withColumn("age_years", num_or_null("age_years"))
    return df.withColumn("weight_kg", num_or_null("weight_kg") if "weight_kg" in df.columns else F.lit(None).cast("double"))
