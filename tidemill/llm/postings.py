"""Which documents hold the same hash: combined in each task, dealt out by hash, told to the documents.

A posting is (hash, rank and text hash of the document, position).  A task sends one document per
hash and step, the first, and settles the others itself; a small memory of repeated hashes does
the same across steps.  A hash that a third of all documents hold so reaches the shuffle about once a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import batch_of, mixed, pack, runs, slots, unpack

BLOCKS = "pid int, block binary, settled boolean"
HITS = "rank long, th long, hits binary"
_BLOCKS = pa.schema([("pid", pa.int32()), ("block", pa.binary()), ("settled", pa.bool_())])
_HITS = pa.schema([("rank", pa.int64()), ("th", pa.int64()), ("hits", pa.binary())])
#: repeated hashes that a task remembers
REMEMBERED = 1 << 18
#: postings that one step of a reducer sorts
SLICE_ROWS = 1 << 20


def steps_of(ascending: np.ndarray) -> np.ndarray:
    """The first value and the differences: smaller numbers than the values."""
    return np.concatenate((ascending[:1], np.diff(ascending)))


class Combiner:
    """Settles in a task what a smaller document of the same task decides already.

    ``need_earlier``: a posting counts as a hit if a smaller document has the hash; otherwise it counts
    as soon as another document has it, and then the hit reports the lower half of the hash.
    """

    def __init__(self, partitions: int, need_earlier: bool):
        self.n, self.need_earlier = partitions, need_earlier
        self.known = np.zeros(0, np.uint64)
        self.known_rank = np.zeros(0, np.int64)

    def step(
        self, h: np.ndarray, doc: np.ndarray, rank: np.ndarray, th: np.ndarray, value: np.ndarray | None = None
    ) -> Iterator[pa.RecordBatch]:
        """Postings of one step; ``doc`` indexes ``rank`` and ``th``; ``value`` is what a hit reports."""
        order = np.argsort(h)
        h, doc = h[order], doc[order]
        value = short_key(h) if value is None else value[order]
        r = rank[doc]
        first = runs(h)
        length = np.diff(np.append(first, len(h)))
        least = np.minimum.reduceat(r, first) if len(h) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(r, first) if len(h) else np.zeros(0, np.int64)
        keys = h[first]
        sent = np.full(len(keys), np.iinfo(np.int64).max)  # the smallest document of the key that was sent before
        if len(self.known) and len(keys):
            at = np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)
            sent = np.where(self.known[at] == keys, self.known_rank[at], sent)
        if self.need_earlier:
            later = r > np.repeat(np.minimum(least, sent), length)
            hit, send = later, ~later
        else:
            # two documents here, or two in an earlier step, which were sent
            new = np.repeat(sent == np.iinfo(np.int64).max, length)
            hit = ~new | np.repeat(least < most, length)
            send = new & ((r == np.repeat(least, length)) | (r == np.repeat(most, length)))
        hot = np.flatnonzero(least < most)
        if len(hot):
            k, kr = keys[hot][:REMEMBERED], np.minimum(least, sent)[hot][:REMEMBERED]
            if len(k) + len(self.known) <= REMEMBERED:  # forgetting costs shuffle bytes, never a result
                k, kr = np.concatenate((k, self.known)), np.concatenate((kr, self.known_rank))
            o = np.lexsort((kr, k))
            keep = o[runs(k[o])]
            self.known, self.known_rank = k[keep], kr[keep]
        yield from hit_blocks(rank[doc[hit]], th[doc[hit]], value[hit], self.n)
        h, doc, value = h[send], doc[send], value[send]
        pid = slots(h, self.n)
        edge = np.searchsorted(pid, np.arange(self.n + 1))
        ids, blocks = [], []
        for p in np.flatnonzero(np.diff(edge)):
            part = slice(edge[p], edge[p + 1])
            docs, local = np.unique(doc[part], return_inverse=True)
            ids.append(p)
            places = [value[part]] if self.need_earlier else []
            blocks.append(pack(steps_of(h[part]), local.astype(np.uint32), rank[docs], th[docs], *places))
        yield batch_of(_BLOCKS, [ids, blocks, [False] * len(ids)])


def short_key(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def hit_blocks(rank: np.ndarray, th: np.ndarray, value: np.ndarray, partitions: int) -> Iterator[pa.RecordBatch]:
    """Hits as one block for each partition of documents; a document's hits may lie in many blocks."""
    if not len(rank):
        return
    pid = slots(mixed(rank.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + th.view(np.uint64)), partitions)
    order = np.lexsort((th, rank, pid))
    pid, rank, th, value = pid[order], rank[order], th[order], value[order]
    edge = np.searchsorted(pid, np.arange(partitions + 1))
    ids = np.flatnonzero(np.diff(edge))
    blocks = []
    for p in ids:
        part = slice(edge[p], edge[p + 1])
        r, t = rank[part], th[part]
        first = np.flatnonzero(np.concatenate(([True], (r[1:] != r[:-1]) | (t[1:] != t[:-1]))))
        blocks.append(pack(r[first], t[first], np.diff(np.append(first, len(r))).astype(np.uint32), value[part]))
    yield batch_of(_BLOCKS, [ids, blocks, [True] * len(ids)])


def _per_document(dtype: type):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [unpack(b.as_py(), np.int64, np.int64, np.uint32, dtype) for batch in batches for b in batch.column("block")]
        if not parts:
            return
        rank, th, count, value = map(np.concatenate, zip(*parts))
        del parts
        ends = np.cumsum(count, dtype=np.int64)
        order = np.lexsort((th, rank))
        rank, th, begins, ends = rank[order], th[order], (ends - count)[order], ends[order]
        edge = np.flatnonzero(np.concatenate(([True], (rank[1:] != rank[:-1]) | (th[1:] != th[:-1]))))
        stop = np.append(edge[1:], len(rank))
        for a in range(0, len(edge), 5_000):
            e = edge[a : a + 5_000]
            cells = [
                b"".join([value[begins[k] : ends[k]].tobytes() for k in range(i, j)]) for i, j in zip(e, stop[a : a + 5_000])
            ]
            yield batch_of(_HITS, [rank[e], th[e], cells])

    return run


def told(blocks: DataFrame, partitions: int, decide, dtype: type) -> DataFrame:
    """Deal blocks out, decide in each partition, and gather one row of hits for each document."""
    decided = blocks.repartitionById(partitions, F.col("pid")).mapInArrow(decide, BLOCKS)
    return decided.repartitionById(partitions, F.col("pid")).mapInArrow(_per_document(dtype), HITS)


def unsettled(batches: Iterable[pa.RecordBatch], blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Pass settled blocks on and put the others into ``blocks``."""
    for batch in batches:
        done = batch.column("settled")
        if done.true_count:
            yield batch.filter(done)
        blocks.extend(batch.column("block").filter(pc.invert(done)).to_pylist())


def settle(partitions: int, need_earlier: bool):
    """All postings of one partition: which documents get a hit."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[bytes] = []
        yield from unsettled(batches, blocks)
        yield from _settle(blocks, partitions, need_earlier)

    return run


def _settle(blocks: list[bytes], partitions: int, need_earlier: bool) -> Iterator[pa.RecordBatch]:
    kinds = [np.uint64, np.uint32, np.int64, np.int64, *([np.uint32] if need_earlier else [])]
    parts = []
    for block in blocks:
        h, local, rank, th, *value = unpack(block, *kinds)
        h = np.cumsum(h, dtype=np.uint64)
        parts.append((h, local, value[0] if value else short_key(h), rank, th))
    total = sum(len(p[0]) for p in parts)
    steps = -(-total // SLICE_ROWS)
    if not total:
        return
    low, high = min(int(p[0][0]) for p in parts), max(int(p[0][-1]) for p in parts)
    edges = [low + (high - low) * s // steps for s in range(steps)] + [high + 1]
    for a, b in zip(edges[:-1], edges[1:]):
        h, rank, th, value = [], [], [], []
        for ph, local, v, r, t in parts:  # each block is sorted by hash
            i = np.searchsorted(ph, np.uint64(a))
            j = len(ph) if b > np.iinfo(np.uint64).max else np.searchsorted(ph, np.uint64(b))
            if i < j:
                h.append(ph[i:j]), rank.append(r[local[i:j]]), th.append(t[local[i:j]]), value.append(v[i:j])
        if h:
            hit = _hits(*map(np.concatenate, (h, rank, th, value)), need_earlier)
            yield from hit_blocks(*hit, partitions)


def _hits(h, rank, th, value, need_earlier):
    order = np.argsort(h)
    h, rank, th, value = h[order], rank[order], th[order], value[order]
    first = runs(h)
    length = np.diff(np.append(first, len(h)))
    least = np.repeat(np.minimum.reduceat(rank, first), length)
    if need_earlier:
        hit = rank > least
    else:
        hit = np.repeat(np.maximum.reduceat(rank, first), length) > least
    return rank[hit], th[hit], value[hit]


def hit_values(cell: bytes | None, dtype: type) -> np.ndarray:
    """The hits of one document."""
    return np.frombuffer(cell or b"", dtype)
