"""Line dedup by a fixed-depth log-template tree.

A line goes down the tree by its token count and its leading tokens (tokens with a digit count as a variable). In a leaf, a
position's token is constant if enough documents have it there, else the position is a variable field; the line with its
variable fields generalised is its template. A template that is mostly constant and found in enough documents is
furniture of the corpus: the document with the smallest id keeps its lines, every other document loses them.

Where a line leaves no doubt by itself, its own text is the template: a long line (a passage) recurs from two documents on, and a
line of one or two tokens, which has no structure to generalise, from many.

Built-in functions throughout. Rows are told apart by a hash of id and text. Text is shuffled twice: candidate lines by leaf
(unless the recurring leaves are few enough to broadcast) and documents by row. Counting is combined before each shuffle, so a
line of a third of all documents is one row a task; nothing gathers a leaf's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WS, cut, let, words

#: Least number of documents of a template; of a line of one or two tokens; of a long line.
MIN_DOCS = 10
SHORT_DOCS = 50
LONG_DOCS = 2
DEPTH = 3
#: Lines of fewer tokens are short; lines of so many or more are long.
MIN_TOKENS = 3
LONG_TOKENS = 20
#: Least share of constant positions, in tenths.
CONSTANT_TENTHS = 8
VARIABLE = "<*>"
#: Recurring leaves are broadcast up to this many rows (16 bytes each), else joined by a shuffle.
BROADCAST_LEAVES = 500_000
#: Recurring templates and recurring short and long lines likewise (50 bytes each).
BROADCAST_TEMPLATES = 200_000


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))


def _lines(rows: DataFrame) -> DataFrame:
    """``rid, id, line, n, leaf``: the distinct lines of each row that have a token."""
    lines = rows.select("rid", "id", F.explode(F.array_distinct(F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_WS)))).alias("line"))
    placed = let(words(F.col("line")), lambda ws: F.struct(F.size(ws).alias("n"), F.xxhash64(F.size(ws), _masked(F.slice(ws, 1, DEPTH))).alias("leaf")))
    return lines.select("rid", "id", "line", placed.alias("p")).select("rid", "id", "line", "p.n", "p.leaf")


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def _row_key(id_col: Column, text: Column) -> Column:
    """Rows with the same id and text have the same lines, so they may share a key."""
    return F.xxhash64(id_col, text)


def _few(table: DataFrame, most: int) -> DataFrame:
    return F.broadcast(table) if table.count() <= most else table


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``rid, id, lid, tid, first_id, n_docs`` of every row's distinct line (md5) whose template (md5) recurs.

    ``tid`` is null where the line itself recurs as a short or long one. A line may be there in both ways.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("rid", _row_key(F.col("id"), F.col("text")))
    lines = _lines(rows)
    # One pass over the text gives what both ways count: the leaf, and the digest of lines that stand for themselves.
    alone = (F.col("n") < MIN_TOKENS) | (F.col("n") >= LONG_TOKENS)
    narrow = lines.select("rid", "id", F.when(F.col("n") >= MIN_TOKENS, F.col("leaf")).alias("leaf"), F.when(alone, _digest(F.col("line"))).alias("lid"), (F.col("n") < MIN_TOKENS).alias("short"))
    narrow = cut(narrow, "narrow")
    return _templates(lines, narrow, min_docs).unionByName(_alone(narrow))


def _alone(narrow: DataFrame) -> DataFrame:
    """Short and long lines that recur word for word."""
    told = narrow.where(F.col("lid").isNotNull())
    known = told.groupBy("lid", "short").agg(F.count("*").alias("n_docs"), F.min("id").alias("first_id"))
    known = cut(known.where(F.col("n_docs") >= F.when(F.col("short"), SHORT_DOCS).otherwise(LONG_DOCS)).drop("short"), "alone")
    found = told.select("rid", "id", "lid").join(_few(known, BROADCAST_TEMPLATES), "lid")
    return found.select("rid", "id", "lid", F.lit(None).cast("binary").alias("tid"), "first_id", "n_docs")


def _templates(lines: DataFrame, narrow: DataFrame, min_docs: int) -> DataFrame:
    """Lines whose template recurs."""
    leaves = narrow.where(F.col("leaf").isNotNull()).groupBy("leaf").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs).select("leaf")
    leaves = _few(cut(leaves, "leaves"), BROADCAST_LEAVES)
    found = lines.where(F.col("n") >= MIN_TOKENS).join(leaves, "leaf")
    found = cut(found.select("rid", "id", "leaf", "line", _digest(F.col("line")).alias("lid")), "lines")

    distinct = found.groupBy("lid", "leaf", "line").agg(F.count("*").alias("docs"))
    at = distinct.select("lid", "leaf", "docs", F.posexplode(_masked(words(F.col("line")))).alias("pos", "token"))
    at = cut(at, "positions")
    constant = at.where(F.col("token") != VARIABLE).groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("n")).where(F.col("n") >= min_docs)
    constant = constant.select("leaf", "pos", "token", F.lit(True).alias("fixed"))
    at = at.join(constant, ["leaf", "pos", "token"], "left").withColumn("fixed", F.coalesce("fixed", F.lit(False)))
    field = F.struct("pos", F.when(F.col("fixed"), F.col("token")).otherwise(VARIABLE).alias("token"))
    # A group here is one line's positions.
    lists = at.groupBy("lid", "leaf").agg(F.sort_array(F.collect_list(field)).alias("fields"), F.sum(F.col("fixed").cast("int")).alias("n_fixed"))
    template = F.array_join(F.transform("fields", lambda f: f["token"]), " ")
    lists = lists.where(10 * F.col("n_fixed") >= CONSTANT_TENTHS * F.size("fields"))
    templates = cut(lists.select("lid", _digest(template).alias("tid")), "templates")

    members = cut(found.select("rid", "id", "lid").join(templates, "lid"), "members")
    documents = members.select("tid", "id").distinct().groupBy("tid")
    recurring = documents.agg(F.count("*").alias("n_docs"), F.min("id").alias("first_id")).where(F.col("n_docs") >= min_docs)
    # A written table, so that the join below is one of plain tables, which Spark splits where a template is very common.
    recurring = _few(cut(recurring, "recurring"), BROADCAST_TEMPLATES)
    return members.join(recurring, "tid").select("rid", "id", "lid", "tid", "first_id", "n_docs")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with ``text`` (without the dropped lines), ``n_lines`` and ``n_dropped``.

    ``n_lines``: lines with a word; ``n_dropped``: lines taken out, repeats within the text included. Lines are split at
    ``\\n`` and the others stay as they are. A short or long line counts the rows that have it, a template the different ids. Null
    text gives an empty text; rows with the first id keep the line, whichever texts they have; null ids never count as first, and
    a line that only they have stays; an empty table gives no rows; the row is a struct, so column names cannot clash.
    """
    drops = recurring_lines(docs, id_col, text_col, min_docs).where(F.col("id").isNull() & F.col("first_id").isNotNull() | (F.col("id") > F.col("first_id")))
    drops = drops.groupBy("rid").agg(F.collect_set("lid").alias("drop"))  # a row's own lines
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", _row_key(F.col("id"), F.col("text"))).join(drops, "rid", "left")
    lines = F.split("text", "\n")
    stay = F.filter(lines, lambda x: ~F.array_contains(F.col("drop"), _digest(x)))
    kept = let(stay, lambda s: F.struct(F.array_join(s, "\n").alias("text"), F.size(s).alias("n")))
    rows = rows.select("row", "text", F.when(F.col("drop").isNotNull(), kept).alias("kept"))
    return rows.select(
        "row",
        F.coalesce("kept.text", "text").alias("text"),
        F.size(F.filter(lines, lambda x: x.rlike(NOT_WS))).cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), 0).otherwise(F.size(lines) - F.col("kept.n")).cast("long").alias("n_dropped"),
    )
