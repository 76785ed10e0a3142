"""Quality rules as a short-circuit cascade.

A sample tells what share of documents each rule rejects and how much work it takes; rules are then tried in the order
of rejections per unit of work, and a document that one rule rejects is not shown to the next. The order changes what a
verdict costs and which rule is named first, never the verdict. Everything is built-in SQL functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WS, let, words

#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2000
WINDOW = 8


def word_chars(text: Column, ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def n_symbols(text: Column, ws: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long")


def n_capitals(text: Column, ws: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, r"[A-Z]+", ""))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_WS))


def n_lines(text: Column, ws: Column) -> Column:
    return F.size(_lines(text)).cast("long")


def n_dup_lines(text: Column, ws: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    return let(_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def n_repeat_words(text: Column, ws: Column) -> Column:
    """Words that lie in an 8-word window found twice or more in the text, the first finding included.

    Window hashes that are all distinct end it. Otherwise the windows are sorted by hash, those with an equal neighbour
    give their positions, and the union of the positions' windows is summed in order: n log n for any text.
    """
    n = F.size(ws)
    hashes = F.when(n > WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(ws, i, WINDOW)))).otherwise(
        F.array().cast("array<bigint>")
    )

    def covered(hs: Column) -> Column:
        by_hash = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def repeated(s: Column) -> Column:
            at = lambda k: F.get(s, k)
            same = lambda k: (F.coalesce(at(k - 1)["h"] == at(k)["h"], F.lit(False))) | (F.coalesce(at(k + 1)["h"] == at(k)["h"], F.lit(False)))
            return F.sort_array(F.filter(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.when(same(k), at(k)["p"])), lambda p: p.isNotNull()))

        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        step = lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total"))
        return F.aggregate(let(by_hash, repeated), start, step, lambda a: a["total"])

    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), 0).otherwise(covered(hs))).cast("long")


#: Measure -> expression of the text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, ws: F.size(ws).cast("long"),
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_capitals": n_capitals,
    "n_lines": n_lines,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets a function from a measure's name to its column; ``work`` is a document's work in nanoseconds,
    from its code points and words (unit costs of one core, rounded)."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]
    work: Callable[[Column, Column], Column]


#: Fewer than 20 words, or over 30 % of them in repeated windows.
BASE_RULES = (
    Rule("few_words", lambda m: m("n_words") < 20, lambda chars, n: n * 1),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words"), lambda chars, n: n * 600),
)
#: Symbols over a tenth of the words, over half of the lines repeated, over half of the word characters capitals, or a mean
#: word length outside 2 to 20.
MORE_RULES = (
    Rule("symbols", lambda m: 100 * m("n_symbols") > 10 * m("n_words"), lambda chars, n: chars * 5),
    Rule("repeated_lines", lambda m: 2 * m("n_dup_lines") > m("n_lines"), lambda chars, n: chars * 4),
    Rule("capitals", lambda m: 2 * m("n_capitals") > m("word_chars"), lambda chars, n: chars * 6),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words")), lambda chars, n: n * 30),
)


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` as a struct beside its text, so that its column names cannot clash with the measures'."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def _with_words(body: Callable[[Callable[[str], Column], Column], Column]) -> Column:
    """``body(measure, words)``; the words are bound by ``let``, for a filter on a projected array would be pushed below
    the projection and split the text again for every element of a lambda."""
    text = F.col("text")
    return let(words(text), lambda ws: body(lambda name: MEASURES[name](text, ws), ws))


def order_rules(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by estimated rejections per unit of work, the best first (ties: as given).

    The sample is the first ``sample_rows`` rows that Spark finds; only their flags and work reach the driver.
    """
    flags = [_with_words(lambda m, ws, r=r: F.coalesce(r.rejects(m), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)]
    work = [_with_words(lambda m, ws, r=r: r.work(F.length("text"), F.size(ws)).cast("double")).alias(f"w{i}") for i, r in enumerate(rules)]
    seen = _prepared(docs, text_col).limit(sample_rows).select(*flags, *work).collect()
    if not seen:
        return list(rules)
    rate = [sum(s[f"r{i}"] for s in seen) / len(seen) for i in range(len(rules))]
    cost = [sum(s[f"w{i}"] for s in seen) / len(seen) + 1 for i in range(len(rules))]
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-rate[i] / cost[i], i))]


def verdict(rules: list[Rule], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, or null; later rules are not evaluated."""
    out = None
    for r in rules:
        out = F.when(r.rejects(measure), r.name) if out is None else out.when(r.rejects(measure), r.name)
    return out if out is not None else F.lit(None).cast("string")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected rows, columns as they were.

    Null and empty texts have no words and are rejected by the first base rule; repeated rows get the same verdict; an
    empty table stays empty. The measures sit inside the cascade, so a rejected document costs nothing further.
    """
    ordered = order_rules(docs, rules, text_col)
    return _prepared(docs, text_col).where(_with_words(lambda m, ws: verdict(ordered, m)).isNull()).select("row.*")


def measured(docs: DataFrame, names: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the named measures of every document, with the cascade's verdict beside them.

    ``failed_rule``: the first rejecting rule in the estimated order, or null; ``n_rules_tried``: rules that the cascade looked at.
    The named measures are wanted for every document and are taken once; all others are taken inside the cascade, where a
    rule that is not reached costs nothing. Null and empty texts measure 0; repeated rows get equal rows; other columns are
    left out, whatever their names; an empty table gives an empty table.
    """
    ordered = order_rules(docs, BASE_RULES + MORE_RULES, text_col)
    rows = _prepared(docs, text_col).withColumn("ws", words(F.col("text")))
    inline = lambda n: MEASURES[n](F.col("text"), F.col("ws")).alias(n)
    rows = rows.select(F.col("row")[id_col].alias("id"), "text", "ws", *map(inline, names))
    failed = verdict(ordered, lambda n: F.col(n) if n in names else inline(n))
    rows = rows.select(F.col("id"), *names, failed.alias("failed_rule"))
    place = F.array_position(F.array(*[F.lit(r.name) for r in ordered]), F.col("failed_rule"))
    tried = F.coalesce(place, F.lit(len(ordered))).cast("int")
    return rows.select(F.col("id").alias(id_col), *names, "failed_rule", tried.alias("n_rules_tried"))
