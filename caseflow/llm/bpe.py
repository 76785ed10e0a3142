"""Byte-level BPE encoding and decoding.

Encoding splits a text into pre-tokens and merges each one's bytes by rank: the symbols form a
doubly linked list, a priority queue holds (merge rank, position) of every adjacent pair that the
vocabulary can merge, and a popped entry is skipped if the pair at its position has changed since.
Decoding concatenates the vocabulary's byte strings.

Text in any language repeats its pre-tokens, so each Python worker keeps the ids of recent pieces in
two generations of bounded dictionaries; what is evicted is merged again when it comes back.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, slices

#: Fixed values of byte-level BPE: the pre-token pattern and Unicode's white space.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The coarser pieces that every pre-token lies within: a run of non-white characters with at most one blank before it,
#: or white space.
PIECE = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

_LOW32 = (1 << 32) - 1


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Recent(dict):
    """Bounded memory of ``make(key)``: a full young generation becomes the old one, and the old one goes."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:  # long pieces do not come back; keeping them would not be bounded
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder for a byte-level BPE vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str, cache_entries: int = 500_000):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.strings: dict[int, bytes] = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        self.byte_ids = [0] * 256
        for char, b in to_byte.items():
            self.byte_ids[b] = vocab[char]
        self.pairs: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.pieces = _Recent(self._piece, cache_entries)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_ids[b] for b in raw]
        n = len(ids)
        if n < 2:
            return ids
        pairs = self.pairs
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i in range(n - 1):
            found = pairs.get(ids[i] << 32 | ids[i + 1])
            if found is not None:
                queue.append((found >> 32) << 32 | i)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i = entry & _LOW32
            left, j = ids[i], after[i]
            if left < 0 or j < 0:
                continue
            found = pairs.get(left << 32 | ids[j])
            if found is None or found >> 32 != entry >> 32:
                continue  # stale: the pair that was queued here is gone
            ids[i], ids[j] = found & _LOW32, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                found = pairs.get(ids[i] << 32 | ids[k])
                if found is not None:
                    heapq.heappush(queue, (found >> 32) << 32 | i)
            h = before[i]
            if h >= 0:
                found = pairs.get(ids[h] << 32 | ids[i])
                if found is not None:
                    heapq.heappush(queue, (found >> 32) << 32 | h)
        return [i for i in ids if i >= 0]

    def _piece(self, piece: str) -> bytes:
        parts = self.pre_tokens(piece)
        if len(parts) == 1:
            ids = self.merge(piece.encode())
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.pieces.__getitem__, parts))

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        look_up = self.pieces.__getitem__
        if self.special_at is None or not self.special_at.search(text):
            return b"".join(map(look_up, PIECE.findall(text)))
        out = []
        for part in self.special_at.split(text):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            else:
                out += map(look_up, PIECE.findall(part))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return memoryview(self.encode_bytes(text)).cast("i").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, ByteBpe] = {}


def codec(path: str) -> ByteBpe:
    """The worker's codec for a vocabulary file (read once a worker)."""
    if path not in _CODECS:
        _CODECS[path] = ByteBpe(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """Encode every whole text; returns id, ``ids array<int>`` and, if asked, ``decoded string``.

    One narrow pass without a shuffle. Nulls and empty texts have no ids and decode to the empty string;
    rows with a null or repeated id are kept as they are; an empty table gives an empty result; other columns are not
    carried, so their names cannot clash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                coded = [bpe.encode_bytes(t) if t else b"" for t in column(batch, "text").to_pylist()]
                ends = [0]
                for c in coded:
                    ends.append(ends[-1] + len(c) // 4)
                flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(coded))])
                out = [column(batch, "id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
                if decoded:
                    out.append(pa.array([bpe.decode(memoryview(c).cast("i").tolist()) for c in coded], pa.string()))
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    out = rows.mapInArrow(run, "id long, ids array<int>" + ", decoded string" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode_documents(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode arrays of ids; returns id and ``decoded string`` (null array: empty string)."""
    rows = coded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            texts = [bpe.decode(ids or []) for ids in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(texts, pa.string())], ["id", "decoded"])

    return rows.mapInArrow(run, "id long, decoded string").withColumnRenamed("id", id_col)
