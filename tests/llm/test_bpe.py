import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseflow.llm import bpe, queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"
TEXTS = ["", " ", "\n\n a", "it's we'll  tabs\t\tand\r\nlines ", "a<|endoftext|>b <|endoftext|>", "x" * 5000, "é　ü  nb\x1c\x1dx\x85y",
         "日本語 テスト 12345 ½ ²", "\U0001f600 ok\U0001f600‍", "don't DON'T 'sx", "  \n  \n", "a" * 70 + " " * 300 + "b"]


def lib(text):
    ids = TOK.encode(text, add_special_tokens=False).ids
    return ids, TOK.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_equals_library(text):
    codec = bpe.codec(PATH)
    ids, back = lib(text)
    assert codec.encode(text) == ids
    assert codec.decode(ids) == back


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoder_equals_library_on_any_text(text):
    ids, back = lib(text)
    assert bpe.codec(PATH).encode(text) == ids
    assert bpe.codec(PATH).decode(ids) == back == text


@given(st.lists(st.integers(0, 50256), max_size=12))
@settings(max_examples=200, deadline=None)
def test_decoder_equals_library_on_any_ids(ids):
    assert bpe.codec(PATH).decode(ids) == TOK.decode(ids, skip_special_tokens=False)


def test_small_cache_gives_the_same_ids():
    small = bpe.ByteBpe(PATH, cache_entries=3)
    for text in TEXTS * 2:
        assert small.encode(text) == lib(text)[0]


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in queries.op1_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, back = lib(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


ROWS = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (2, None, "y"), (3, "", "z"), (4, "w " * 40_000, "v")]


def test_defined_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.encode_documents(df, PATH).collect()), key=str)
    want = sorted(((i, *lib(t or "")) for i, t, _ in ROWS), key=str)
    assert got == want
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(df, PATH), PATH).collect()
    assert sorted((r.decoded for r in back)) == sorted(t or "" for _, t, _ in ROWS)


def brute_sums(lengths):
    total = sum(lengths)
    return sorted((n, lengths.count(n), sum(x >= n for x in lengths), sum(x <= n for x in lengths), sum(x > n for x in lengths), total,
                   sum(x for x in lengths if x < n), sum(min(x, n) for x in lengths), total - sum(min(x, n) for x in lengths)) for n in set(lengths))


def test_token_counts_query(spark):
    lengths = [len(lib(d.text or "")[0]) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op5_token_counts(spark, SF).collect())) == brute_sums(lengths)


def test_token_counts_defined_rows(spark):
    lengths = [0, 0, 3, 5, 5, 4095, 4096, 9000, 100_000]
    sums = token_counts.suffix_sums(token_counts.length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens long")))
    assert sorted(map(tuple, sums.collect())) == brute_sums(lengths)
    for r in token_counts.answer_limits(sums, [1, 4, 5, 10**6]).collect():
        assert r.docs_over == sum(x > r.context_limit for x in lengths)
        assert r.truncated_total == sum(min(x, r.context_limit) for x in lengths) == r.total_tokens - r.lost_tokens
    got = {r.share: r.n_tokens for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect()}
    assert got == {0.1: 0, 0.5: 5, 1.0: 100_000}
    empty = spark.createDataFrame([], "text string")
    assert token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(empty, PATH))).count() == 0
    odd = spark.createDataFrame([(None, 1), ("", 2), ("a b", 3)], "text string, n_tokens int")
    assert sorted(r.n_tokens for r in token_counts.token_lengths(odd, PATH).collect()) == [0, 0, 2]
    assert token_counts.length_histogram(token_counts.token_lengths(odd, PATH)).agg(F.sum("n_docs")).first()[0] == 3
