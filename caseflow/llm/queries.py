"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, fill_in_middle, line_templates, mixing, ngram_join, page_diff, pii, quality, rank_bpe, spelling, suffix_tree, token_counts
from .registry import query

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def coded_digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 from an encoder's ids and what they decode to."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_digests(bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER)))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


@query(
    "op2_exact_dedup",
    r"""
    WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)
    """,
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def joined_spans(spans) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


@query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select("doc_id", *map(count, pii.BASE_KINDS), F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


@query(
    "op9_quality_rules",
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    g AS (SELECT rid, i, list_slice(ws, i, i + 7) AS win FROM w, unnest(range(1, len(ws) - 6)) AS u(i)),
    p AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n > 1),
    r AS (SELECT rid, count(DISTINCT k) AS n_repeat_words FROM p, unnest(range(i, i + 8)) AS u(k) GROUP BY rid),
    m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                 length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                 length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS caps,
                 len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
    b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 2 * caps > word_chars
                OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM b
    """,
)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = quality.measured(documents(spark, sf_dir), counts)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select("doc_id", *counts, base_failed.alias("base_failed"), (~base_failed & F.col("failed_rule").isNull()).alias("kept"))


@query("op10_page_text")
def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = page_diff.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(
    "op3_mixing",
    """
    WITH RECURSIVE sizes AS (SELECT source, count(*) AS rows FROM documents GROUP BY source),
    w AS (SELECT source, rows, greatest(1, CAST(round(1000 * pow(rows, 0.5) / sum(pow(rows, 0.5)) OVER ()) AS BIGINT)) AS weight FROM sizes),
    g AS (SELECT list_reduce(list(weight), lambda a, b: gcd(a, b)) AS divisor FROM w),
    v AS (SELECT source, rows, weight // divisor AS slots, row_number() OVER (ORDER BY weight DESC, source IS NULL, source) AS rank FROM w, g),
    s AS (SELECT list(slots ORDER BY rank) AS sl, CAST(sum(slots) AS BIGINT) AS d FROM v),
    e(slot, had, pick) AS (
        SELECT CAST(-1 AS BIGINT), list_transform(sl, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM s
        UNION ALL
        SELECT slot + 1, list_transform(had, lambda n, i: CASE WHEN i = p THEN n + 1 ELSE n END), p
        FROM (SELECT e.slot, e.had, s.d,
                     list_min(list_transform(sl, lambda a, i: CASE WHEN had[i] * d // a <= slot + 1 THEN ((had[i] + 1) * d + a - 1) // a * 100000 + i END)) % 100000 AS p
              FROM e, s WHERE e.slot + 1 < s.d)),
    sched AS (SELECT pick, slot AS in_period, had[pick] - 1 AS k FROM e WHERE slot >= 0),
    ends AS (SELECT (rows + 15) // 16 AS b, slots, rank FROM v),
    h AS (SELECT min(b // slots * d + in_period) AS horizon FROM ends JOIN sched ON pick = rank AND k = b % slots, s),
    n AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS n FROM documents),
    b AS (SELECT n.doc_id, n.source, n // 16 AS block, n % 16 AS place, (n // 16) // slots * d + in_period AS slot
          FROM n JOIN v ON n.source IS NOT DISTINCT FROM v.source JOIN sched ON pick = rank AND k = (n // 16) % slots, s)
    SELECT doc_id, source, block, place, slot, slot < horizon AS in_mix FROM b, h
    """,
)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir).select("doc_id", "source"))
    return mixed.select("row.doc_id", "source", "block", "place", "slot", "in_mix")


LINES_SQL = r"""
    l0 AS (SELECT DISTINCT rid, doc_id, line FROM (SELECT rid, doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    l1 AS (SELECT *, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens FROM l0),
    y AS (SELECT line, min(doc_id) AS first_id FROM l1 GROUP BY line, tokens HAVING tokens < 3 AND count(*) >= 50 OR tokens >= 20 AND count(*) >= 2),
    l AS (SELECT rid, doc_id, line FROM l1 WHERE tokens >= 3),
    k AS (SELECT *, list_transform(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> ''),
                                   lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS tk FROM l),
    f AS (SELECT *, len(tk) AS n, list_slice(tk, 1, 3) AS lead, count(*) OVER (PARTITION BY len(tk), list_slice(tk, 1, 3)) AS c FROM k),
    g AS (SELECT n, lead, line, tk, count(*) AS docs FROM f WHERE c >= 10 GROUP BY ALL),
    a AS (SELECT n, lead, line, docs, i, tk[i] AS tok FROM g, unnest(range(1, n + 1)) AS u(i)),
    x AS (SELECT *, tok <> '<*>' AND sum(docs) OVER (PARTITION BY n, lead, i, tok) >= 10 AS fixed FROM a),
    m AS (SELECT n, lead, line, list(CASE WHEN fixed THEN tok ELSE '<*>' END ORDER BY i) AS template FROM x GROUP BY ALL HAVING 10 * count(*) FILTER (fixed) >= 8 * n),
    p AS (SELECT rid, doc_id, line, template FROM f JOIN m USING (n, lead, line)),
    r AS (SELECT template, min(doc_id) AS first_id FROM p GROUP BY template HAVING count(DISTINCT doc_id) >= 10),
    z AS (SELECT rid, line FROM p JOIN r USING (template) WHERE doc_id > first_id UNION SELECT rid, line FROM l1 JOIN y USING (line) WHERE doc_id > first_id),
    o AS (SELECT rid, generate_subscripts(string_split(t, chr(10)), 1) AS i, unnest(string_split(t, chr(10))) AS line FROM d),
    q AS (SELECT o.rid, count(*) FILTER (regexp_matches(o.line, '[^\x20\x09-\x0D]')) AS n_lines, count(z.rid) AS n_dropped,
                 coalesce(string_agg(o.line, chr(10) ORDER BY i) FILTER (z.rid IS NULL), '') AS kept FROM o LEFT JOIN z ON o.rid = z.rid AND o.line = z.line GROUP BY o.rid)
"""


@query(
    "op8_line_dedup",
    f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {LINES_SQL}
    SELECT doc_id, n_lines, n_dropped, kept AS text FROM d JOIN q USING (rid)
    """,
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(documents(spark, sf_dir)).select("row.doc_id", "n_lines", "n_dropped", "text")


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir))


@query("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_documents(documents(spark, sf_dir))


@query(
    "op11_fill_in_middle",
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
    h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
                 CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p
    """,
)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform_documents(documents(spark, sf_dir), restored=True)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


@query("op13_rank_bpe")
def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_digests(rank_bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded=True))
