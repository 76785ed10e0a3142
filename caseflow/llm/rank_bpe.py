"""Byte-level BPE by the tiktoken library with a local rank file.

A rank file lists byte strings and their ranks; the ranks are the ids. Each match of the split pattern is encoded by itself and
no string is special. The library's pattern engine keeps a place to come back to for every character of a run of white space and
gives up on runs of about a million, so long texts are cut first, at places where the pattern ends a match whatever stands
around them:

* between a character that is not white space and white space (no match holds both in this order, and the only look-ahead
  stands behind white space);
* between ASCII letters, digits and marks, in any order but an apostrophe before a letter (contractions);
* before the last character of a run of white space that other characters follow, and at the run's end: the run up to there is
  one match, which goes to the library as a piece of its own.

A text without such a place goes to the library whole. Decoding joins the bytes of the ids; no text is decoded in between, so
ids that end inside a character give its bytes back.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import SPACE
from .common import column, slices

#: Characters that a part of a long text has at least, and white space that goes to the library as one piece.
PART = 1 << 16
LONG_RUN = 1 << 12

_WHITE = re.compile(rf"[{SPACE}]{{{LONG_RUN},}}")
_MARK = r"!-/:-@\[-`{-~"
_CUT = re.compile(rf"[^{SPACE}](?=[{SPACE}])|[A-Za-z](?=[0-9{_MARK}])|[0-9](?=[A-Za-z{_MARK}])|[{_MARK}](?=[0-9])|(?!')[{_MARK}](?=[A-Za-z])")
#: What an id outside the vocabulary decodes to.
UNKNOWN = "\ufffd".encode()


def parts(text: str, size: int = PART) -> Iterator[tuple[bool, str]]:
    """``(whole, part)`` in order: parts of a text that are encoded apart with the same ids; a ``whole`` one is a single match."""
    at = 0
    for run in _WHITE.finditer(text):
        yield from ((False, p) for p in _cut(text, at, run.start(), size))
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield True, text[run.start() : at]
    yield from ((False, p) for p in _cut(text, at, len(text), size))


def _cut(text: str, start: int, end: int, size: int) -> Iterator[str]:
    while end - start > size:
        found = _CUT.search(text, start + size - 1, end)
        if found is None:
            break
        yield text[start : found.end()]
        start = found.end()
    if end > start:
        yield text[start:end]


class RankBpe:
    """The library's encoder over one rank file, safe on texts of any length."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.strings = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str, size: int = PART) -> list[int]:
        if len(text) <= min(size, LONG_RUN):
            return self.library.encode_ordinary(text)
        ids: list[int] = []
        for whole, part in parts(text, size):
            ids += self.library._encode_single_piece(part) if whole else self.library.encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.strings.__getitem__, ids))
        except KeyError:
            return b"".join(self.strings.get(i, UNKNOWN) for i in ids)


_CODECS: dict[tuple[str, str], RankBpe] = {}


def codec(path: str, pattern: str) -> RankBpe:
    """The worker's codec for a rank file and pattern (read once a worker)."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = RankBpe(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Encode every whole text; returns id, ``ids array<int>`` and, if asked, ``decoded binary`` made from the ids.

    One narrow pass without a shuffle; a batch of texts is worked in slices of bounded size. Null and empty texts have no ids
    and decode to no bytes; rows with a null or repeated id are kept as they are; an empty table gives an empty result; other
    columns are not carried, so their names cannot clash. Texts of any length keep all their ids.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.binary())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                coded, back, ends = [], [], [0]
                for text in column(batch, "text").to_pylist():
                    ids = bpe.encode(text) if text else []
                    if decoded:
                        back.append(bpe.decode(ids))
                    coded.append(np.array(ids, np.int32))
                    ends.append(ends[-1] + len(ids))
                flat = pa.array(np.concatenate(coded) if coded else np.empty(0, np.int32))
                out = [column(batch, "id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
                yield pa.RecordBatch.from_arrays(out + [pa.array(back, pa.binary())] * decoded, schema=schema)

    out = rows.mapInArrow(run, "id long, ids array<int>" + ", decoded binary" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode arrays of ids to raw bytes; returns id and ``decoded binary``.

    A null array gives no bytes; a null id or one that the vocabulary lacks gives the bytes of U+FFFD. Rows with a null or repeated
    id are kept; an empty table gives an empty result; other columns are not carried.
    """
    rows = coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for batch in batches:
            raw = [bpe.decode(ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(raw, pa.binary())], ["id", "decoded"])

    return rows.mapInArrow(run, "id long, decoded binary").withColumnRenamed("id", id_col)
