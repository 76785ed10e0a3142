import base64
import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import queries, rank_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
SF = "/root/testdata/sf0.001"
TEXTS = ["", " ", "a", "it's we'll 'sx don'TS", " \n\t x", "a1b22!?c'd", "<|endoftext|> <P>", "日本語 テスト ½²", "\U0001f600 ok‍", "\x1c \x85y", "no-cut" * 400, "'s" * 700, "x " * 900,
         " " * 5000, "a" + "\n" * 5000 + " b", "　" * 4200 + "'s", ("ab1!" * 50 + " \t ") * 40, "1'a" * 900]


def by_hand(text):
    """Merges by the lowest rank, one pair at a time, of each match."""
    ids = []
    for part in regex.findall(PATTERN, text):
        symbols = [bytes([b]) for b in part.encode()]
        while True:
            pairs = [(RANKS[x + y], i) for i, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in RANKS]
            if not pairs:
                break
            _, i = min(pairs)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        ids += [RANKS[s] for s in symbols]
    return ids


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("size", [1, 7, 300, rank_bpe.PART])
def test_parts_do_not_change_the_ids(text, size):
    codec = rank_bpe.codec(PATH, PATTERN)
    assert "".join(p for _, p in rank_bpe.parts(text, size)) == text
    ids = codec.encode(text, size)
    assert ids == LIBRARY.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("a b'\n\t 1!.\x85　é日Ⅷ\x1c"), st.characters(codec="utf-8")), max_size=60), st.integers(1, 9))
def test_any_text_and_part_size(text, size):
    ids = [i for _, p in rank_bpe.parts(text, size) for i in LIBRARY.encode_ordinary(p)]
    assert ids == LIBRARY.encode_ordinary(text)
    assert rank_bpe.codec(PATH, PATTERN).decode(ids) == text.encode()


@pytest.mark.parametrize("text", TEXTS[1:9])
def test_library_equals_merging_by_hand(text):
    if "\x1c" not in text:  # white space to Python's patterns alone
        assert LIBRARY.encode_ordinary(text) == by_hand(text)


@pytest.mark.parametrize("text", [" " * 1_200_000 + "b", "x" + "\n" * 1_500_000, "a" * 1_000_000, "word " * 300_000, "\t" * 1_100_000])
def test_very_long_texts(text):
    codec = rank_bpe.codec(PATH, PATTERN)
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    if text[0] == "w":
        assert ids == LIBRARY.encode_ordinary(text)


def test_raw_bytes_of_partial_characters():
    codec = rank_bpe.codec(PATH, PATTERN)
    ids = codec.encode("\U0001f9ff日")
    assert b"".join(codec.decode([i]) for i in ids) == "\U0001f9ff日".encode()
    assert codec.decode([50_256, -1, None]) == "�".encode() * 3


def test_query_equals_library(spark):
    got = {r.doc_id: r for r in queries.op13_rank_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = LIBRARY.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


ROWS = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (2, None, "y"), (3, "", "z"), (4, "w " * 40_000, "v")]


def test_defined_rows(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, ids string")
    coded = rank_bpe.encode_documents(df, PATH, PATTERN, decoded=True)
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in coded.collect()), key=str)
    assert got == sorted(((i, LIBRARY.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in ROWS), key=str)
    assert rank_bpe.encode_documents(df.limit(0), PATH, PATTERN).count() == 0
    back = rank_bpe.decode_documents(coded, PATH, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t, _ in ROWS)
    odd = spark.createDataFrame([(1, None), (2, [None, 0])], "doc_id long, ids array<int>")
    assert sorted(bytes(r.decoded) for r in rank_bpe.decode_documents(odd, PATH, PATTERN).collect()) == [b"", "�".encode() + codec_string(0)]


def codec_string(i):
    return next(s for s, rank in RANKS.items() if rank == i)
