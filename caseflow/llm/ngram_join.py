"""N-gram Jaccard join: documents whose shingle sets have a Jaccard similarity of 0.75 or more, and their groups.

Shingles are 64-bit hashes of five words; a document's set is their distinct values. The steps, all on keys that spread:

1. Which shingles occur in another document? Tasks sort the shingles of a chunk of documents, send each distinct one to a
   bucket of the hash range (48 bits and the document's number in the chunk, packed), and buckets answer with counts.
   A linked document shares three quarters of its set at least, so all others are done here.
2. Documents with equal sets become one node; only different sets are compared.
3. Shingles are ordered by rarity among the nodes (the same exchange again). A node's rarest quarter must meet that of
   each node it links to, so nodes that share one of these shingles are candidates; candidate groups are the components.
4. Within a group, T-occurrence search by DivideSkip: a set needs T shingles in common, its L longest inverted lists
   are set aside, the short ones are merged by a heap that skips what cannot reach T - L, and the long ones are probed by
   binary search. Nodes reaching the required overlap are linked. Once all nodes not yet searched for lie in one group,
   the rest cannot add anything and is left out.
5. Groups over GROUP_NODES are split into blocks, each an index of its own; a few nodes are searched for in all blocks, and
   then every node outside the largest group found so. Which links exist is decided the same way at any size.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .bpe import _Recent
from .common import column, cut, slices, tidy
from .components import connected_components
from .packed import Out, bucket_bits, chunk_numbers, emit, from_planes, planes, rows_by_key

WORDS = 5
#: Similarity as a fraction: links have NUM / DEN or more.
NUM, DEN = 3, 4
#: Shingles of a packed chunk, nodes and shingles of a group or block that one task indexes.
CHUNK = 1 << 19
GROUP_NODES = 1000
GROUP_SHINGLES = 1 << 20
#: Nodes of a large group that are searched for in each round before the rest, and such rounds at most.
PIVOTS = 16
PIVOT_ROUNDS = 3
#: Ids of candidate documents, and labels of nodes, are broadcast up to this many rows (24 bytes each), else joined by a shuffle.
BROADCAST_IDS = 1_000_000


# ---------------------------------------------------------------- shingles


class Shingler:
    """Distinct shingle hashes of a text, sorted.

    Words are hashed with xxh3, five in a row combined by a polynomial and mixed. Different shingles of two documents with
    equal 64-bit hashes would count as one common shingle; over n shingles that is n squared / 2**65 expected cases.
    """

    def __init__(self, cache_entries: int = 150_000):
        self.words = _Recent(xxhash.xxh3_64_intdigest, cache_entries)

    def set_of(self, text: str | None) -> np.ndarray:
        ws = (text or "").encode().lower().split()
        n = len(ws)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, ws), np.uint64, n)
        k = min(n, WORDS)
        out = np.full(n - k + 1, 0x9E3779B97F4A7C15 * k % 2**64, np.uint64)
        for i in range(k):
            out = out * np.uint64(0xD6E8FEB86659FD93) + h[i : n - k + 1 + i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
        return np.unique(out)


_SHINGLER: list[Shingler] = []


def shingler() -> Shingler:
    if not _SHINGLER:
        _SHINGLER.append(Shingler())
    return _SHINGLER[0]


def required_overlap(a: int, b: int) -> int:
    """Least common shingles for which sets of these sizes link: DEN * o >= NUM * (a + b - o)."""
    return -(-NUM * (a + b) // (NUM + DEN))


def least_overlap(a: int) -> int:
    """Least common shingles with any set that a set of this size links to."""
    return -(-NUM * a // DEN)


# ---------------------------------------------------------------- packed exchange


_EXCHANGE = "key long, chunk long, payload binary"
_EXCHANGE_NAMES, _EXCHANGE_KINDS = ["key", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()]


def _send(chunk: int, sets: list[np.ndarray], bits: int, docs: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """A chunk's distinct shingles, how often each occurs in it, the set numbers of all, and the rows for the buckets."""
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    keys, first, counts = np.unique(flat[order], return_index=True, return_counts=True)
    short = keys >> np.uint64(16)
    tag = np.where(counts > 1, 0, owner[order][first] + 1) if docs else counts  # 0: in several of the chunk's sets
    edges = np.searchsorted(short >> np.uint64(48 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    rows = []
    for b in range(1 << bits):
        lo, hi = edges[b], edges[b + 1]
        if hi > lo:
            rows.append((b, chunk, pickle.dumps((planes(np.diff(short[lo:hi], prepend=np.uint64(0))), planes(tag[lo:hi])))))
    return keys, counts, owner, rows


def shared_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, shared, digest`` of each row: set size, shingles that another row (or chunk) has too, digest of the set."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    bits = bucket_bits(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_numbers()
        ids: list = []
        sets: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = next(chunks)
            _, _, owner, out = _send(chunk, sets, bits, True)
            flat = np.concatenate(sets)
            keys, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
            local = np.bincount(owner[counts[place] > 1], minlength=len(sets))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            # The chunk's own row goes by a negative key, which no bucket has.
            out.append((-1 - chunk % (1 << bits), chunk, pickle.dumps((list(ids), [len(s) for s in sets], local.tolist(), digests))))
            for i in range(0, len(out), 64):
                yield emit(out[i : i + 64], _EXCHANGE_NAMES, _EXCHANGE_KINDS)

        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                for i, t in zip(column(batch, "id").to_pylist(), column(batch, "text").to_pylist()):
                    ids.append(i)
                    sets.append(shingler().set_of(t))
                    size += len(sets[-1]) + 16
                    if size >= CHUNK:
                        yield from flush()
                        ids.clear(), sets.clear()
                        size = 0
        if ids:
            yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_EXCHANGE_NAMES, _EXCHANGE_KINDS)
        for key, group in rows_by_key(batches, "key"):
            if key < 0:  # a chunk's own row passes through
                for r in group:
                    yield from out.add(1, r["chunk"], r["payload"])
                continue
            chunks, parts, tags, sizes = [], [], [], []
            for r in group:
                deltas, tag = pickle.loads(r["payload"])
                chunks.append(r["chunk"])
                parts.append(np.cumsum(from_planes(deltas), dtype=np.uint64))
                tags.append(from_planes(tag).astype(np.int64))
                sizes.append(len(parts[-1]))
            keys, tag, place = np.concatenate(parts), np.concatenate(tags), np.repeat(np.arange(len(chunks)), sizes)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            same = np.zeros(len(keys) + 1, bool)
            same[1:-1] = keys[1:] == keys[:-1]
            hit = order[same[1:] | same[:-1]]
            hit = hit[tag[hit] > 0]
            pair, n = np.unique(place[hit] << 32 | tag[hit] - 1, return_counts=True)
            owner = pair >> 32
            for c in np.unique(owner):
                mine = owner == c
                yield from out.add(0, chunks[c], pickle.dumps((planes(pair[mine] & 0xFFFFFFFF), planes(n[mine]))))
        yield from out.rest()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in rows_by_key(batches, "chunk"):
            hits: list[tuple[np.ndarray, np.ndarray]] = []
            for r in group:  # answers first, then the chunk's own row
                if r["key"] == 0:
                    docs_, n = pickle.loads(r["payload"])
                    hits.append((from_planes(docs_).astype(np.int64), from_planes(n).astype(np.int64)))
                    continue
                ids, sizes, local, digests = pickle.loads(r["payload"])
                shared = np.array(local, np.int64)
                for d, n in hits:
                    shared[d] += n
                cols = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "shared", "digest"])

    sent = rows.mapInArrow(tidy(send), _EXCHANGE).repartition("key").sortWithinPartitions("key")
    answered = sent.mapInArrow(tidy(answer), _EXCHANGE).repartition("chunk").sortWithinPartitions("chunk", "key")
    return answered.mapInArrow(tidy(settle), "id long, n long, shared long, digest binary")


# ---------------------------------------------------------------- nodes


_NODES = "chunk long, payload binary"


def packed_nodes(docs: DataFrame, candidates: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Nodes of the candidate documents in chunks: ``chunk, payload`` with digests, smallest ids and sets.

    ``candidates`` has the ids and set sizes ``n``. Rows that share an id with a candidate come along, which does no harm.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = candidates.select(F.col("id").alias("c")).distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = rows.join(ids, F.col("id").eqNullSafe(F.col("c")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                out = [(i, shingler().set_of(t)) for i, t in zip(column(batch, "id").to_pylist(), column(batch, "text").to_pylist())]
                out = [(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), i, s.tobytes()) for i, s in out if len(s)]
                yield emit(out, ["digest", "id", "members"], [pa.binary(), pa.int64(), pa.binary()])

    # Copies are combined before and after the shuffle: the set is part of the grouping key, equal digests alone do not merge.
    nodes = rows.mapInArrow(tidy(sets), "digest binary, id long, members binary").groupBy("digest", "members").agg(F.min("id").alias("id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunk_numbers()
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                held.append((r["digest"], r["id"], r["members"]))
                size += len(r["members"]) // 8 + 16
                if size >= CHUNK:
                    yield emit([(next(chunks), pickle.dumps(held))], ["chunk", "payload"], [pa.int64(), pa.binary()])
                    held, size = [], 0
        if held:
            yield emit([(next(chunks), pickle.dumps(held))], ["chunk", "payload"], [pa.int64(), pa.binary()])

    # As many tasks as chunks, or cores: a chunk asks every bucket, so small chunks would ask in vain.
    shingles = candidates.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tasks = max(shingles // CHUNK + 1, docs.sparkSession.sparkContext.defaultParallelism)
    return cut(nodes.select("digest", "id", "members").coalesce(tasks).mapInArrow(tidy(pack), _NODES), "nodes")


def node_rows(nodes: DataFrame) -> DataFrame:
    """``node, digest, id, members`` of the packed nodes; a node's number is its chunk's and its place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                held = pickle.loads(r["payload"])
                for at in range(0, len(held), 256):
                    out = [(r["chunk"] << 21 | (at + j), *x) for j, x in enumerate(held[at : at + 256])]
                    yield emit(out, ["node", "digest", "id", "members"], [pa.int64(), pa.binary(), pa.int64(), pa.binary()])

    return nodes.mapInArrow(tidy(run), "node long, digest binary, id long, members binary")


def rare_prefixes(nodes: DataFrame) -> DataFrame:
    """``shingle, node``: of each node that shares enough, the rarest shingles of which a linked node must have one too."""
    bits = bucket_bits(nodes.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sets = [np.frombuffer(m, np.uint64) for _, _, m in pickle.loads(r["payload"])]
                _, _, _, out = _send(r["chunk"], sets, bits, False)
                for i in range(0, len(out), 64):
                    yield emit(out[i : i + 64], _EXCHANGE_NAMES, _EXCHANGE_KINDS)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Number of nodes that have each shingle, back to each chunk in the order it asked."""
        out = Out(_EXCHANGE_NAMES, _EXCHANGE_KINDS)
        for key, group in rows_by_key(batches, "key"):
            chunks, parts, counts = [], [], []
            for r in group:
                deltas, n = pickle.loads(r["payload"])
                chunks.append(r["chunk"])
                parts.append(np.cumsum(from_planes(deltas), dtype=np.uint64))
                counts.append(from_planes(n).astype(np.int64))
            _, place = np.unique(np.concatenate(parts), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)[place]
            at = 0
            for chunk, part in zip(chunks, parts):
                yield from out.add(key, chunk, planes(total[at : at + len(part)]))
                at += len(part)
        yield from out.rest()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, group in rows_by_key(batches, "chunk"):
            answers = []
            for r in group:  # answers by bucket, then the chunk itself
                if r["key"] < 1 << bits:
                    answers.append(from_planes(r["payload"]))
                    continue
                sets = [np.frombuffer(m, np.uint64) for _, _, m in pickle.loads(r["payload"])]
                df = np.concatenate(answers).astype(np.int64)
                keys = np.unique(np.concatenate(sets))  # the order of the answers
                fronts, nodes_ = [], []
                for i, s in enumerate(sets):
                    n = len(s)
                    d = df[np.searchsorted(keys, s)]
                    if int((d > 1).sum()) < least_overlap(n):
                        continue
                    front = np.lexsort((s, d))[: n - least_overlap(n) + 1]
                    front = front[d[front] > 1]
                    fronts.append(s[front].view(np.int64))
                    nodes_.append(np.full(len(front), chunk << 21 | i, np.int64))
                if fronts:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(fronts)), pa.array(np.concatenate(nodes_))], ["shingle", "node"])

    sent = nodes.mapInArrow(tidy(send), _EXCHANGE).repartition("key").sortWithinPartitions("key", "chunk")
    back = sent.mapInArrow(tidy(answer), _EXCHANGE).unionByName(nodes.select(F.lit(1 << bits).cast("long").alias("key"), "chunk", "payload"))
    return back.repartition("chunk").sortWithinPartitions("chunk", "key").mapInArrow(tidy(choose), "shingle long, node long")


# ---------------------------------------------------------------- T-occurrence search


class ListIndex:
    """Inverted lists over some sets, searched by DivideSkip. Sets are numbered by size, so a size range is a range of numbers."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        self.sizes = [len(sets[i]) for i in self.order]
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        flat = np.concatenate([sets[i] for i in self.order]) if sets else np.empty(0, np.uint64)
        by = np.argsort(flat, kind="stable")  # owners ascend in each list
        self.keys, self.starts = np.unique(flat[by], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))
        self.postings = owner[by].tolist()

    def lists_of(self, query: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
        """(start, end) in the postings of each of the query's lists, cut to set numbers lo..hi-1, the empty ones left out."""
        at = np.searchsorted(self.keys, query)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == query)] if len(self.keys) else at[:0]
        out = []
        for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist()):
            s, e = bisect_left(self.postings, lo, s, e), bisect_left(self.postings, hi, s, e)
            if e > s:
                out.append((s, e))
        return out

    def search(self, query: np.ndarray) -> list[tuple[int, int]]:
        """(set, overlap) of every set that the query links to, itself included if it is indexed."""
        n = len(query)
        t = least_overlap(n)
        lo, hi = bisect_left(self.sizes, t), bisect_left(self.sizes, DEN * n // NUM + 1)
        lists = self.lists_of(query, lo, hi)
        if not n or len(lists) < t:
            return []
        lists.sort(key=lambda x: x[0] - x[1])  # longest first
        longest = lists[0][1] - lists[0][0]
        n_long = min(t - 1, int(t / (0.01 * math.log2(longest) + 1))) if longest > 1 else 0
        long, short = lists[:n_long], lists[n_long:]
        found = []
        for i, count in self._merge(short, t - n_long):
            need = required_overlap(n, self.sizes[i])
            for left, (s, e) in enumerate(long):
                if count + len(long) - left < need:
                    break
                at = bisect_left(self.postings, i, s, e)
                count += at < e and self.postings[at] == i
            if count >= need:
                found.append((self.order[i], count))
        return found

    def _merge(self, lists: list[tuple[int, int]], t: int) -> Iterator[tuple[int, int]]:
        """(set number, count) of the sets in at least ``t`` of the lists, by a heap of list heads with skips."""
        post = self.postings
        heap = [(post[s], s, e) for s, e in lists]
        heapq.heapify(heap)
        while len(heap) >= t and heap:
            i = heap[0][0]
            popped = []
            while heap and heap[0][0] == i:
                popped.append(heapq.heappop(heap))
            if len(popped) >= t:
                yield i, len(popped)
                for _, s, e in popped:
                    if s + 1 < e:
                        heapq.heappush(heap, (post[s + 1], s + 1, e))
                continue
            # Fewer than t lists can end below the new head: they jump to it.
            while heap and len(popped) < t - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            head = heap[0][0]
            for _, s, e in popped:
                s = bisect_left(post, head, s, e)
                if s < e:
                    heapq.heappush(heap, (post[s], s, e))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.size = [1] * n

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            if self.size[a] < self.size[b]:
                a, b = b, a
            self.up[b] = a
            self.size[a] += self.size[b]


def link_group(sets: list[np.ndarray]) -> list[int]:
    """Group number (a member's place) of each set, all links among them followed.

    Sets are searched for until those not yet searched for lie in one group: a link between two of them would join what is
    one already, and every other link has an end that was searched for.
    """
    n = len(sets)
    forest = Forest(n)
    if n > 1:
        index = ListIndex(sets)
        waiting = set(range(n))
        while len(waiting) > 1:
            roots: dict[int, list[int]] = {}
            for i in waiting:
                roots.setdefault(forest.root(i), []).append(i)
            if len(roots) == 1:
                break
            largest = max(roots, key=lambda r: (len(roots[r]), -r))
            batch = [members[0] for r, members in roots.items() if r != largest] if len(roots[largest]) > 1 else [min(waiting)]
            for i in batch:
                waiting.discard(i)
                for j, _ in index.search(sets[i]):
                    forest.join(i, j)
    return [forest.root(i) for i in range(n)]


def _small_groups(members: DataFrame) -> DataFrame:
    """``a, b`` links that connect the nodes of each group; ``members`` has ``comp, node, members``, a group in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, group in rows_by_key(batches, "comp"):
            rows = [(r["node"], np.frombuffer(r["members"], np.uint64)) for r in group]
            for (node, _), root in zip(rows, link_group([s for _, s in rows])):
                if node != rows[root][0]:
                    out.append((node, rows[root][0]))
            if len(out) > 4096:
                yield emit(out, ["a", "b"], [pa.int64(), pa.int64()])
                out = []
        if out:
            yield emit(out, ["a", "b"], [pa.int64(), pa.int64()])

    return members.repartition("comp").sortWithinPartitions("comp", "node").mapInArrow(tidy(run), "a long, b long")


def _search_blocks(index: DataFrame, queries: DataFrame) -> DataFrame:
    """``a, b`` links of the queries with the nodes of all blocks of their group.

    ``index``: ``comp, block, node, members``; ``queries``: ``comp, blocks, node, members``, sent to each block. A task holds
    one block's index and reads the queries one by one.
    """
    wide = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = index.select("comp", "block", F.lit(0).alias("kind"), "node", "members").unionByName(wide.select("comp", "block", F.lit(1).alias("kind"), "node", "members"))
    rows = rows.withColumn("place", F.concat_ws(":", "comp", "block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in rows_by_key(batches, "place"):
            nodes, sets, lists = [], [], None
            out: list[tuple] = []
            for r in group:
                s = np.frombuffer(r["members"], np.uint64)
                if r["kind"] == 0:
                    nodes.append(r["node"])
                    sets.append(s)
                    continue
                lists = lists or ListIndex(sets)
                out += [(r["node"], nodes[j]) for j, _ in lists.search(s) if nodes[j] != r["node"]]
                if len(out) > 4096:
                    yield emit(out, ["a", "b"], [pa.int64(), pa.int64()])
                    out = []
            if out:
                yield emit(out, ["a", "b"], [pa.int64(), pa.int64()])

    return rows.repartition("comp", "block").sortWithinPartitions("place", "kind").mapInArrow(tidy(run), "a long, b long")


def _large_groups(members: DataFrame) -> DataFrame:
    """``a, b`` links that connect the nodes of each large group; ``members``: ``comp, nodes, shingles, node, members``.

    A few rounds search for PIVOTS nodes of each group in all its blocks; what hangs together with the one that links most is
    one part, and then every node outside it is searched for. Two nodes that were never searched for lie in that part, so no
    link between parts is missed.
    """
    blocks = F.greatest(F.ceil(F.col("nodes") / GROUP_NODES), F.ceil(F.col("shingles") / GROUP_SHINGLES)).cast("long")
    index = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    index = cut(index.select("comp", "blocks", "block", "node", "members"), "blocks")
    links = None
    outside = index.select("comp", "node")
    last = False
    for turn in range(PIVOT_ROUNDS + 1):
        # Each group's pivots: the smallest number of each lot, combined in each task by the aggregate.
        lot = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(PIVOTS))
        chosen = outside if last else outside.select("comp", lot.alias("lot"), "node").groupBy("comp", "lot").agg(F.min("node").alias("node"))
        queries = index.join(chosen.select("comp", "node"), ["comp", "node"]).select("comp", "blocks", "node", "members")
        new = cut(_search_blocks(index.select("comp", "block", "node", "members"), queries), "links")
        links = new if links is None else links.unionByName(new)
        if last:
            break
        # The pivot with most links, what it links to, and what pivots among those link to: one part of the group.
        reach = links.select(F.col("a").alias("pivot"), F.col("b").alias("node")).distinct()
        comp_of = index.select("comp", F.col("node").alias("pivot"))
        top = reach.groupBy("pivot").agg(F.count("*").alias("c")).join(comp_of, "pivot").groupBy("comp").agg(F.max(F.struct("c", "pivot")).alias("m"))
        top = top.select(F.col("m.pivot").alias("node"))
        star = top.unionByName(reach.join(top.withColumnRenamed("node", "pivot"), "pivot").select("node"))
        inside = star.unionByName(reach.join(star.withColumnRenamed("node", "pivot"), "pivot", "left_semi").select("node"))
        outside = cut(index.select("comp", "node").join(inside.distinct(), "node", "left_anti"), "outside")
        left = outside.count()
        if not left:
            break
        last = left <= GROUP_NODES or turn == PIVOT_ROUNDS - 1
    return links


# ---------------------------------------------------------------- operator


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``.

    A text's set: distinct shingles of five words (words lower-cased A-Z, split at the six white characters); with fewer words
    the whole sequence is one; null, empty or blank texts have none and link with nothing. ``component_id`` is the smallest
    id among the documents reachable by links, the row's own included (null only if all of them are null). Rows with
    the same id are documents of their own; an empty table gives no rows; other columns are not carried.
    """
    out = _grouped(docs, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.least("id", "first_id").alias("component_id"))


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, shared, digest, first_id, own`` of each row: the smallest id of its group, and whether the group's first document
    (by id, null ids last, then digest) has the row's set; both null where the row has no candidates."""
    counted = cut(shared_counts(docs, id_col, text_col), "counted")
    near = counted.where((F.col("n") > 0) & (DEN * F.col("shared") >= NUM * F.col("n")))
    nodes = packed_nodes(docs, near, id_col, text_col)

    prefixes = cut(rare_prefixes(nodes), "prefixes")
    centres = prefixes.groupBy("shingle").agg(F.min("node").alias("b"), F.count("*").alias("c")).where("c > 1").select("shingle", "b")
    edges = prefixes.join(centres, "shingle").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    comps = connected_components(edges).select("node", F.col("component").alias("comp"))
    members = comps.join(node_rows(nodes).select("node", "members"), "node")
    sizes = members.groupBy("comp").agg(F.count("*").alias("nodes"), F.sum(F.expr("octet_length(members) div 8")).alias("shingles"))
    members = cut(members.join(sizes, "comp"), "members")
    fits = (F.col("nodes") <= GROUP_NODES) & (F.col("shingles") <= GROUP_SHINGLES)
    links = _small_groups(members.where(fits).select("comp", "node", "members"))
    large = members.where(~fits)
    if not large.isEmpty():
        links = links.unionByName(_large_groups(large))

    groups = connected_components(links)
    named = node_rows(nodes).select("node", "digest", "id").join(groups, "node", "left").select("digest", "id", F.coalesce("component", "node").alias("component"))
    named = cut(named, "named")
    first = named.groupBy("component").agg(F.min("id").alias("first_id"), F.min(F.struct(F.col("id").isNull(), "id", "digest"))["digest"].alias("of"))
    label = cut(named.join(first, "component").groupBy("digest").agg(F.min("first_id").alias("first_id"), F.max(F.col("digest") == F.col("of")).alias("own")), "labels")
    if label.count() <= BROADCAST_IDS:
        label = F.broadcast(label)  # else a join of written tables, split where very many documents have one set
    return counted.join(label, "digest", "left")


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, _id, _digest`` of each row, the row as a struct; the digest is that of ``shared_counts``, null without shingles."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("_id"), docs[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                sets = [shingler().set_of(t) for t in column(batch, "text").to_pylist()]
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([column(batch, "row"), column(batch, "_id"), pa.array(digests, pa.binary())], ["row", "_id", "_digest"])

    schema = StructType([rows.schema["row"], rows.schema["_id"], StructField("_digest", BinaryType())])
    return rows.mapInArrow(tidy(run), schema)


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, columns as they were: the one with the smallest id (null ids last).

    Among rows of the same id and set one stays, by the hash of the row. Rows without shingles are alone and stay. An id that
    one row has decides by itself; rows that share an id, or have none, are told apart by the digests of their sets.
    """
    found = cut(_grouped(docs, id_col, text_col).select("id", "n", "digest", "first_id", "own"), "grouped")
    kept = found.where(F.col("own").isNull() | F.col("own") & F.col("id").eqNullSafe(F.col("first_id"))).select(F.col("id").alias("_kept"), "digest")
    shared = found.groupBy("id").agg(F.count("*").alias("c")).where(F.col("id").isNull() | (F.col("c") > 1)).select(F.col("id").alias("_shared"))
    shared = cut(shared, "shared_ids")
    same_id = docs[id_col].cast("long").eqNullSafe(kept["_kept"])
    if shared.isEmpty():
        return docs.join(kept, same_id, "left_semi")
    is_shared = docs[id_col].cast("long").eqNullSafe(shared["_shared"])
    rows = _digested(docs.join(shared, is_shared, "left_semi"), id_col, text_col)
    rows = cut(rows, "shared_rows")
    stay = kept.where("digest is not null").distinct()
    one = rows.join(stay, rows["_id"].eqNullSafe(stay["_kept"]) & (rows["_digest"] == stay["digest"]), "left_semi")
    one = one.groupBy("_id", "_digest").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    alone = rows.where("_digest is null").select("row")
    return docs.join(shared, is_shared, "left_anti").join(kept, same_id, "left_semi").unionAll(one.select("row.*")).unionAll(alone.select("row.*"))
