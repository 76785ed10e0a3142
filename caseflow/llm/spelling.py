"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Dense prefix-suffix tiling. Words become rows of code-point matrices, two blocks of rows are compared column by column from the
front and from the back, and a pair is near if its common prefix and suffix together reach the longer length minus one (equal
words are one word). Which blocks meet is decided exactly: of a near pair with a longer length of m, the common prefix or the
common suffix has at least m div 2 code points, so words are grouped by (m, first half) and by (m, last half), each word once as
the longer and once as the shorter of a pair. A group over ``GROUP_WORDS`` is split the same way again: the part not yet fixed is
halved, and its words are grouped by one half more. Where all but one code point is fixed a group holds as many words as the
alphabet letters, so every group ends small, whatever the words. A pair belongs to the prefix group of each split if its prefix
reaches that far, else to the suffix group, and is thus found once.

Group sizes are counted with partial sums before the shuffle; a group meets in one task, in bounded memory, only when it is small.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, slices

#: Letters that words consist of after A-Z are lower-cased.
LETTERS = r"[a-zÀ-ÿ]"
#: A run whose hash this number divides loses a code point.
MISSPELT_ONE_IN = 199
#: Code points and occurrences that a word has at least; how many times as frequent a form is.
MIN_LENGTH, MIN_COUNT, FORM_RATIO = 6, 5, 5
#: Words of a group that is compared; larger ones are split.
GROUP_WORDS = 256
#: Words that a task holds before it gives partial counts, and split groups whose keys are broadcast at most.
HELD_WORDS, BROADCAST_KEYS = 400_000, 100_000


def spelt(doc_id: int | None, run: str, crc: int, one_in: int = MISSPELT_ONE_IN) -> str:
    """The word of a lower-cased run, given the CRC-32 of the document's id and a colon."""
    h = zlib.crc32(run.encode(), crc)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, one_in: int = MISSPELT_ONE_IN) -> DataFrame:
    """``word, n``: the words of at least ``min_length`` code points of all whole texts with their occurrences.

    Counted in each task in bounded memory, then summed. Null texts have no words; a null id counts as the empty string;
    repeated rows count each; an empty table has no words.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    long_runs = re.compile(f"{LETTERS}{{{min_length},}}")

    def emit(held: Counter) -> Iterator[pa.RecordBatch]:
        words = list(held)
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())], ["word", "n"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                for i, raw in zip(column(batch, "id").to_pylist(), column(batch, "text").cast(pa.binary()).to_pylist()):
                    if not raw:
                        continue
                    crc = zlib.crc32(b":" if i is None else b"%d:" % i)
                    # bytes.lower() changes A-Z alone
                    for found, n in Counter(long_runs.findall(raw.lower().decode())).items():
                        if zlib.crc32(found.encode(), crc) % one_in:
                            held[found] += n
                        elif len(word := spelt(i, found, crc, one_in)) >= min_length:
                            held[word] += n
                    if len(held) > HELD_WORDS:
                        yield from emit(held)
        yield from emit(held)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _halves(m: Column, lo: Column, hi: Column, cap: Column) -> Column:
    """The groups that a group is split into: ``lo`` code points fixed in front, ``hi`` behind, pairs with a prefix under ``cap``."""
    q = F.floor((m - lo - hi) / 2).cast("int")
    one = lambda lo, hi, cap: F.struct(m.alias("m"), lo.alias("lo"), hi.alias("hi"), cap.alias("cap"))
    front = F.when(lo + q < cap, one(lo + q, hi, cap))
    return F.array_compact(F.array(front, one(lo, hi + q, F.least(cap, lo + q))))


def _keyed(rows: DataFrame) -> DataFrame:
    """``key, word, n, m, lo, hi, cap`` of rows with a struct ``g``; the key names the group."""
    rows = rows.select("word", "n", "g.m", "g.lo", "g.hi", "g.cap")
    fixed = [F.expr("substring(word, 1, lo)"), F.expr("substring(word, length(word) - hi + 1, hi)")]
    return rows.withColumn("key", F.concat_ws(":", "m", "lo", "hi", "cap", *fixed))


def tile(words: list[str], m: int, lo: int, hi: int, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the near pairs of one group: ``longer`` of m code points, other of m or m - 1, each pair once.

    All words share their first ``lo`` and last ``hi`` code points, so only the part between is compared.
    """
    longer = [i for i, w in enumerate(words) if len(w) == m]
    shorter = [i for i, w in enumerate(words) if len(w) == m - 1]
    matrix = lambda some, width: np.array([words[i] for i in some], f"<U{width}").view(np.uint32).reshape(len(some), width)
    a, found = matrix(longer, m), []
    for others, width in ((longer, m), (shorter, m - 1)):
        if not others or not longer:
            continue
        b = a if others is longer else matrix(others, width)
        between = width - lo - hi
        prefix, suffix = (_agree(a, b, between, lo, hi, back) for back in (False, True))
        near = prefix + suffix >= m - lo - hi - 1
        if others is longer:
            near &= np.tri(len(longer), k=-1, dtype=bool)
        i, j = np.nonzero(near)
        if cap < m:  # a prefix that goes on past the compared part puts the pair into another group
            p, alive = prefix[i, j] + lo, prefix[i, j] == between
            for at in range(lo + between, min(width, cap)):
                if not alive.any():
                    break
                alive &= a[i, at] == b[j, at]
                p = p + alive
            i, j = i[p < cap], j[p < cap]
        found.append((np.array(longer, int)[i], np.array(others, int)[j]))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return tuple(np.concatenate(x) for x in zip(*found))


def _agree(a: np.ndarray, b: np.ndarray, between: int, lo: int, hi: int, back: bool) -> np.ndarray:
    """Common code points of every pair of rows from the front (or the back) of the ``between`` columns inside the fixed ends."""
    alive = np.ones((len(a), len(b)), bool)
    n = np.zeros((len(a), len(b)), np.int32)
    for k in range(between):
        x, y = (a[:, -1 - hi - k], b[:, -1 - hi - k]) if back else (a[:, lo + k], b[:, lo + k])
        alive &= x[:, None] == y[None, :]
        if not alive.any():
            break
        n += alive
    return n


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n_near, less_n, near`` of rows sorted by group: near words counted, and the best of them, by task."""
    held: dict[str, list] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        cols = [list(held), *zip(*held.values())] if held else [[], [], [], []]
        names = ["word", "n_near", "less_n", "near"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        held.clear()

    def note(word: str, less_n: int, near: str) -> None:
        had = held.get(word)
        if had is None:
            held[word] = [1, less_n, near]
            return
        had[0] += 1
        if (less_n, near) < (had[1], had[2]):
            had[1:] = less_n, near

    def one(key: str, words: list[str], counts: list[int]) -> None:
        m, lo, hi, cap = map(int, key.split(":", 4)[:4])
        for i, j in zip(*(x.tolist() for x in tile(words, m, lo, hi, cap))):
            note(words[i], -counts[j], words[j])
            note(words[j], -counts[i], words[i])

    key, words, counts = None, [], []
    for batch in batches:
        for k, w, n in zip(*(column(batch, c).to_pylist() for c in ("key", "word", "n"))):
            if k != key:
                if len(words) > 1:
                    one(key, words, counts)
                    if len(held) > HELD_WORDS:
                        yield from emit()
                key, words, counts = k, [], []
            words.append(w)
            counts.append(n)
    if len(words) > 1:
        one(key, words, counts)
    yield from emit()


def near_words(vocabulary: DataFrame, group_words: int = GROUP_WORDS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``word, n_near, less_n, near`` of the words that have near ones in ``vocabulary`` (distinct ``word``, ``n``).

    ``near`` is the near word of largest n (ties: smallest in code-point order) and ``less_n`` its n, negated. An empty
    vocabulary gives no rows; null and empty words are near to nothing; other columns are not carried.
    """
    words = vocabulary.select("word", "n").where("word <> ''")
    zero, length = F.lit(0), F.length("word")
    starts = F.transform(F.array(length, length + 1), lambda m: _halves(m, zero, zero, m + 1))
    rows = _keyed(words.select("word", "n", F.explode(F.flatten(starts)).alias("g")))
    small = []
    while True:
        large = cut(rows.where("m - lo - hi > 1").groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > group_words).select("key"), "large")
        many = large.count()
        if not many:
            small.append(rows)
            break
        keys = F.broadcast(large) if many <= broadcast_keys else large
        small.append(rows.join(keys, "key", "left_anti"))
        halves = _halves(F.col("m"), F.col("lo"), F.col("hi"), F.col("cap"))
        rows = cut(_keyed(rows.join(keys, "key", "left_semi").select("word", "n", F.explode(halves).alias("g"))), "halves")
    groups = small[0]
    for more in small[1:]:
        groups = groups.unionByName(more)
    dealt = groups.select("key", "word", "n").repartition("key").sortWithinPartitions("key")
    found = dealt.mapInArrow(_compare, "word string, n_near long, less_n long, near string")
    best = F.min(F.struct("less_n", "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "best.less_n", "best.near")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` pairs: from each word along the forms to the last one.

    A form is more frequent than its word, so there are no circles; each round doubles the way that a row has gone, and the
    ways are short (the counts multiply along them), so there are a few rounds, each written.
    """
    cur = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = cur.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cur.join(on, "root", "left")
        if step.where("further IS NOT NULL").isEmpty():
            return cur
        cur = cut(step.select("word", F.coalesce("further", "root").alias("root")), "roots")


def group_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = FORM_RATIO,
    one_in: int = MISSPELT_ONE_IN,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """``word, form, root string, n, n_near, form_n long`` of every word with ``min_count`` occurrences.

    ``form`` is the most frequent near word (ties: smallest in code-point order) if its n is ``ratio`` times the word's at least,
    else null; ``root`` follows the forms to the last (the word itself if it has none). Null and empty texts have no words, a null
    id counts as the empty string, repeated rows count each, an empty table gives no rows, words of any length are compared whole;
    other columns are not carried, so names cannot clash.
    """
    counts = word_counts(docs, id_col, text_col, min_length, one_in)
    vocabulary = cut(counts.where(F.col("n") >= min_count), "words")
    near = near_words(vocabulary, group_words)
    good = -F.col("less_n") >= ratio * F.col("n")
    rows = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("near")).alias("form"), F.when(good, -F.col("less_n")).alias("form_n")
    )
    rows = cut(rows, "forms")
    last = roots(rows.where("form IS NOT NULL"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
