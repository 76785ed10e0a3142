"""Fill-in-middle transformation of texts.

A text is cut at two places into prefix, middle and suffix, and written with markers so that the middle comes last. Places are
counted in units: code points, words or lines. A text is a row of blocks of a fixed number of bytes; a Fenwick tree over the
blocks holds how many units start and how many code points start in each. The block of the k-th unit is found by binary lifting
down the tree, its place inside the block by a scan of that block alone; the code points before a place are a prefix sum of the
tree and a count inside one block. Cutting thus reads a text once, whatever the number of cuts.

The draws come from a SHA-256 of the document's id, so they do not depend on the order of rows or on partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, slices

#: Bytes of a block.
BLOCK = 4096
#: Markers, and the forms of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
UNITS = ("char", "word", "line")

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def char_starts(raw: np.ndarray) -> np.ndarray:
    """Whether a code point starts at each byte of UTF-8."""
    return (raw & 0xC0) != 0x80


def unit_starts(raw: np.ndarray, unit: str) -> np.ndarray:
    """Whether a unit starts at each byte: a code point, a word (run without white space) or a line (after a line feed)."""
    if unit == "char":
        return char_starts(raw)
    first = np.empty(len(raw), bool)
    if unit == "word":
        white = _WHITE[raw]
        first[:1] = True
        first[1:] = white[:-1]
        return first & ~white
    if unit == "line":
        first[:1] = True
        first[1:] = raw[:-1] == 0x0A
        return first
    raise ValueError(f"unit {unit!r}: one of {', '.join(UNITS)}")


class BlockTree:
    """Fenwick tree over a text's blocks with two counts a block: units and code points."""

    def __init__(self, raw: bytes, unit: str = "char", block: int = BLOCK):
        self.raw, self.block = np.frombuffer(raw, np.uint8), block
        chars = char_starts(self.raw)
        self.chars, self.units = chars, chars if unit == "char" else unit_starts(self.raw, unit)
        at = np.arange(0, max(len(self.raw), 1), block)
        counts = np.zeros((len(at) + 1, 2), np.int64)
        if len(self.raw):
            counts[1:, 0] = np.add.reduceat(self.units, at, dtype=np.int64)
            counts[1:, 1] = counts[1:, 0] if unit == "char" else np.add.reduceat(self.chars, at, dtype=np.int64)
        self.size = len(at)
        tree = counts.tolist()
        for i in range(1, self.size + 1):  # every node passes its sums to the node above it
            up = i + (i & -i)
            if up <= self.size:
                tree[up][0] += tree[i][0]
                tree[up][1] += tree[i][1]
        self.tree = tree
        self.n_units, self.n_chars = (int(x) for x in counts.sum(axis=0))

    def place(self, k: int) -> tuple[int, int]:
        """``(byte, code points before it)`` of where unit ``k`` (from 0) starts; the text's end for ``k`` = the number of units."""
        if k >= self.n_units:
            return len(self.raw), self.n_chars
        node, left, before = 0, k, 0
        step = 1 << (self.size.bit_length() - 1)
        while step:  # descend to the last block with at most k units before it
            down = node + step
            if down <= self.size and self.tree[down][0] <= left:
                node = down
                left -= self.tree[down][0]
                before += self.tree[down][1]
            step >>= 1
        start = node * self.block
        inside = int(np.flatnonzero(self.units[start : start + self.block])[left])
        return start + inside, before + int(np.count_nonzero(self.chars[start : start + inside]))


def draws(seed: str, doc_id: int | None) -> list[int]:
    """Four 32-bit numbers of a document: the first groups of eight digits of SHA-256 of ``<seed>:<id>`` (null id: empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(raw: bytes, h: list[int], unit: str = "char", plain_share: int = 10, spm_share: int = 20, block: int = BLOCK) -> tuple[int, str, int | None, int | None, bytes]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text in UTF-8 and its four draws.

    A text is left plain where it is empty, holds a marker, or its third draw falls into ``plain_share`` hundredths; of the others
    ``spm_share`` hundredths have the suffix first.
    """
    tree = BlockTree(raw, unit, block)
    n = tree.n_units
    if not raw or any(m.encode() in raw for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - plain_share:
        return n, PLAIN, None, None, raw
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, chars_a), (b, chars_b) = tree.place(a), tree.place(b)
    p, m, s = raw[:a], raw[a:b], raw[b:]
    if h[3] % 100 < spm_share:
        return n, SPM, chars_a, chars_b - chars_a, b"".join((SUFFIX.encode(), s, PREFIX.encode(), p, MIDDLE.encode(), m))
    return n, PSM, chars_a, chars_b - chars_a, b"".join((PREFIX.encode(), p, SUFFIX.encode(), s, MIDDLE.encode(), m))


def restore(output: str, form: str) -> str:
    """The text that an output of ``form`` was made from.

    A marker cannot overlap itself or another, and texts that hold one are plain, so the first marker of each kind is the one
    that was written.
    """
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    x, _, rest = output[len(first) :].partition(second)
    y, _, middle = rest.partition(MIDDLE)
    return x + middle + y if form == PSM else y + middle + x


def transform_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "char",
    seed: str = "1",
    plain_share: int = 10,
    spm_share: int = 20,
    restored: bool = False,
) -> DataFrame:
    """id, ``n long, form, prefix_chars long, middle_chars long, output`` and, if asked, ``restored``, rebuilt from output and form.

    ``n`` is the number of units (``char``, ``word`` or ``line``), also of plain texts. One narrow pass without a shuffle. Null and
    empty texts are plain with an empty output; a null id draws from the empty string; rows with a repeated id are cut alike; texts
    of any length are cut whole; an empty table gives an empty result; other columns are not carried, so names cannot clash.
    """
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r}: one of {', '.join(UNITS)}")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = [("id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
    schema = pa.schema(fields + [("restored", pa.string())] * restored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                out = []
                for i, raw in zip(column(batch, "id").to_pylist(), column(batch, "text").cast(pa.binary()).to_pylist()):
                    row = transform(raw or b"", draws(seed, i), unit, plain_share, spm_share)
                    text = row[4].decode()
                    out.append((i, *row[:4], text, *([restore(text, row[1])] * restored)))
                cols = list(zip(*out)) or [[]] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    kinds = "id long, n long, form string, prefix_chars long, middle_chars long, output string" + ", restored string" * restored
    return rows.mapInArrow(run, kinds).withColumnRenamed("id", id_col)


def restore_documents(made: DataFrame, id_col: str = "doc_id", output_col: str = "output", form_col: str = "form") -> DataFrame:
    """id and ``text``, rebuilt from outputs and their forms (null output: empty; null form: plain).

    Rows with null or repeated ids are kept; an empty table gives an empty result; other columns are not carried.
    """
    rows = made.select(F.col(id_col).cast("long").alias("id"), F.col(output_col).cast("string").alias("output"), F.col(form_col).cast("string").alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "output", 8 << 20):
                texts = [restore(o or "", f or PLAIN) for o, f in zip(column(batch, "output").to_pylist(), column(batch, "form").to_pylist())]
                yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)
