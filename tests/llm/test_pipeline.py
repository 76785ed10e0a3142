"""Each stage, and all of them, against brute force."""

import hashlib

import pandas as pd
import pytest
from tokenizers import Tokenizer

import public_tokenizers

from caseflow.llm import queries
from caseflow.llm.common import cut
from caseflow.llm.registry import ORACLES, QUERIES

from . import test_ngram_join, test_quality
from .oracle import duck_rows

corpus_pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(row):
    text = row["text"] or ""
    n, chars, symbols, dup, rep = test_quality.brute(text)
    lines = sum(bool(test_quality.re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    caps = sum("A" <= c <= "Z" for c in text)
    return not (n < 20 or 100 * rep > 30 * n or 10 * symbols > n or 2 * dup > lines or 2 * caps > chars or not 2 * n <= chars <= 20 * n)


def frame(rows):
    return pd.DataFrame(rows, columns=COLUMNS)


def deduped_lines(rows):
    sql = f"WITH d AS (SELECT doc_id AS rid, doc_id, coalesce(text, '') AS t FROM docs), {queries.LINES_SQL} SELECT doc_id, n_dropped, kept FROM d JOIN q USING (rid)"
    _, found = duck_rows(sql, tables={"docs": frame(rows)})
    kept = {doc: (n, text) for doc, text, n in ((r[0], r[1], r[2]) for r in found)}
    out = []
    for r in rows:
        n, text = kept[r["doc_id"]]
        if n and text.split():
            out.append(r | {"text": text, "n_chars": len(text)})
        elif not n:
            out.append(r)
    return out


def one_of_each(rows):
    groups = {d: c for d, _, c in test_ngram_join.brute([(r["doc_id"], r["text"]) for r in rows])}
    return [r for r in rows if groups[r["doc_id"]] == r["doc_id"]]


def mixed(rows):
    """Every row, in slot order."""
    names, found = duck_rows(ORACLES["op3_mixing"], tables={"documents": frame(rows)})
    at = {r[names.index("doc_id")]: (r[names.index("slot")], r[names.index("place")]) for r in found}
    return sorted(rows, key=lambda r: at[r["doc_id"]])


def test_stages_and_run_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    steps = [lambda rows: [r for r in rows if good(r)], deduped_lines, one_of_each, mixed]
    assert [name for name, _ in corpus_pipeline.STAGES][:1] == ["quality rules"] and len(corpus_pipeline.STAGES) == 5
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        docs = cut(stage(spark, docs, sf), "test")
        assert docs.columns == COLUMNS
        want = step(rows)
        assert 0 < len(want) < len(rows) or name in ("line dedup", "mixing sources to target weights"), name
        assert want != rows
        rows = want
        key = lambda r: r["doc_id"]
        assert sorted((r.asDict() for r in docs.collect()), key=key) == sorted(rows, key=key), name
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: (tok.encode(r["text"], add_special_tokens=False).ids, hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows}
    got = QUERIES["pipeline"](spark, sf).collect()
    assert {r.doc_id: (list(r.token_ids), r.text_sha256) for r in got} == want
    assert all(r.n_tokens == len(r.token_ids) for r in got) and len(got) == len(want)


def test_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_mix_is_written_in_slot_order(spark):
    from caseflow.llm import mixing

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = mixing.write_order(mixing.mix(docs)).collect()
    slots = {r.row.doc_id: (r.slot, r.place) for r in mixing.mix(docs).collect()}
    order = [slots[r.doc_id] for r in out]
    assert order == sorted(order)
