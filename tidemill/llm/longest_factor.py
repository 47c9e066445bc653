"""Removal of byte strings that an earlier document holds already, by longest previous factors.

A position is covered if the longest factor that starts there and also starts in a smaller document has
``length`` bytes or more.  In suffix order that factor is found with the previous or the next entry of
a smaller document, whichever shares more.

Not every suffix of the corpus is shuffled.  Each string of ``length`` bytes names its seed, the
least hash among its seed-sized substrings; equal strings have equal seeds.  First the documents
learn which of their seeds others hold too (a few bytes for each seed, of which there is one in
about sixteen places).  Only strings with such a seed are then dealt out by seed, with their bytes, and put
in suffix order where they meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemill.llm.common import batch_of, chunks, keyed, mixed, pack, runs, shuffle_partitions, slots, spread, unpack, with_row
from tidemill.llm.postings import BLOCKS, Combiner, hit_blocks, hit_values, settle, short_key, steps_of, told, unsettled
from tidemill.llm.token_windows import SPANS, SPANS_TYPE, intervals

_BLOCKS = pa.schema([("pid", pa.int32()), ("block", pa.binary()), ("settled", pa.bool_())])
#: the place of an interval: start and end
_SPAN = np.dtype("<u4,<u4")
#: bytes of segments that a task gathers before it sends them, and that it remembers
FLUSH_BYTES = 8 << 20
REMEMBERED_BYTES = 24 << 20
#: strings that one step of a reducer sorts
SLICE_ROWS = 1 << 19


def seed_size(length: int) -> int:
    return max(1, min(20, length * 2 // 5))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def seeds(data: np.ndarray, length: int) -> np.ndarray:
    """The seed of the string of ``length`` bytes at every position (``len(data) - length + 1`` of them)."""
    k = seed_size(length)
    n = len(data) - k + 1
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1)).copy().view(np.uint64).ravel()
    h = np.zeros(n, np.uint64)
    for at in sorted({*range(0, max(k - 7, 1), 8), max(k - 8, 0)}):
        piece = word[at : at + n]
        if k < 8:
            piece = piece & np.uint64((1 << (8 * k)) - 1)
        h = mixed(h ^ piece) if at else mixed(piece + np.uint64(0x9E3779B97F4A7C15))
    return mixed(sliding_min(h, length - k + 1))  # minima are small: scrambled again, they spread evenly


def _post_seeds(length: int, partitions: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner(partitions, need_earlier=False)
        for rows, data, offsets in chunks(batches):
            if len(data) < length:
                continue
            h = seeds(data, length)
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            inside = doc[: len(h)] == doc[length - 1 :]
            change = inside.copy()
            change[1:] &= (h[1:] != h[:-1]) | (doc[1 : len(h)] != doc[: len(h) - 1]) | ~inside[:-1]
            at = np.flatnonzero(change)
            rank, th = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("rank", "th"))
            yield from combiner.step(h[at], doc[at], rank, th)

    return run


def _segments(length: int, partitions: int, text_col: str):
    """Strings whose seed another document holds too, as runs of neighbours with the same seed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        seen_bytes = 0
        waiting: list[tuple] = []
        waiting_bytes = 0

        def flush():
            if not waiting:
                return
            h = np.array([w[0] for w in waiting], np.uint64)
            order = np.argsort(h, kind="stable")
            pid = slots(h[order], partitions)
            edge = np.searchsorted(pid, np.arange(partitions + 1))
            ids, blocks = [], []
            for p in np.flatnonzero(np.diff(edge)):
                part = [waiting[i] for i in order[edge[p] : edge[p + 1]]]
                docs: dict[tuple[int, int], int] = {}
                local = [docs.setdefault(w[3:], len(docs)) for w in part]
                rank, th = zip(*docs)
                head = pack(
                    steps_of(h[order[edge[p] : edge[p + 1]]]),
                    np.array([len(w[1]) for w in part], np.uint32),
                    np.array([w[2] for w in part], np.uint32),
                    np.array(local, np.uint32),
                    np.array(rank, np.int64),
                    np.array(th, np.int64),
                )
                body = zstandard.ZstdCompressor(level=3).compress(b"".join([w[1] for w in part]))
                ids.append(p)
                blocks.append(len(head).to_bytes(8, "little") + head + body)
            yield batch_of(_BLOCKS, [ids, blocks, [False] * len(ids)])
            waiting.clear()

        for rows, data, offsets in chunks(batches, text_col):
            settled: list[tuple] = []
            cells = rows.column("hits").to_pylist()
            ranks, ths = rows.column("rank").to_pylist(), rows.column("th").to_pylist()
            for i, cell in enumerate(cells):
                own = data[offsets[i] : offsets[i + 1]]
                if not cell or len(own) < length:
                    continue
                h = seeds(own, length)
                shared = np.isin(short_key(h), hit_values(cell, np.uint32))
                first = runs(h)
                first = first[shared[first]]
                last = np.searchsorted(runs(h), first, "right")
                ends = np.append(runs(h)[1:], len(h))[last - 1]
                raw, rank = own.tobytes(), ranks[i]
                for a, b, key in zip(first.tolist(), ends.tolist(), h[first].tolist()):
                    piece = raw[a : b + length - 1]
                    if seen.get(piece, rank) < rank:  # all of it starts in a smaller document
                        settled.append((rank, ths[i], a, b + length - 1))
                        continue
                    if piece not in seen:
                        seen_bytes += len(piece) + 100
                    seen[piece] = rank
                    waiting.append((key, piece, a, rank, ths[i]))
                    waiting_bytes += len(piece)
                if seen_bytes > REMEMBERED_BYTES:
                    seen, seen_bytes = {}, 0
                if waiting_bytes > FLUSH_BYTES:
                    yield from flush()
                    waiting_bytes = 0
            if settled:
                r, t, a, b = (np.array(x) for x in zip(*settled))
                yield from hit_blocks(r, t, _spans(a, b), partitions)
        yield from flush()

    return run


def previous_smaller(rank: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each place, the nearest earlier place of the same class with a smaller rank, or -1.

    ``begins`` marks the first place of each class.  Links jump over places that cannot be
    the answer, so their reach doubles.
    """
    n = len(rank)
    link = np.arange(n) - 1
    link[begins] = -1
    todo = np.flatnonzero(link >= 0)
    todo = todo[rank[link[todo]] >= rank[todo]]
    while len(todo):
        link[todo] = link[link[todo]]
        todo = todo[link[todo] >= 0]
        todo = todo[rank[link[todo]] >= rank[todo]]
    return link


def has_previous_factor(strings: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Whether the suffix that begins with each string shares all of it with one of a smaller rank.

    Suffixes are ordered by their first ``length`` bytes, which is as far as the question goes: a class
    of equal strings is a stretch of suffix order with common prefixes of that length.
    """
    order = np.argsort(strings, kind="stable")
    s, r = strings[order], rank[order]
    begins = np.concatenate(([True], s[1:] != s[:-1]))
    ends = np.concatenate((begins[1:], [True]))
    before = previous_smaller(r, begins) >= 0
    after = previous_smaller(r[::-1], ends[::-1])[::-1] >= 0
    out = np.zeros(len(rank), bool)
    out[order] = before | after
    return out


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.stack((starts, ends), axis=1).astype(np.uint32).view(_SPAN).ravel()


def _order(length: int, partitions: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[bytes] = []
        yield from unsettled(batches, blocks)
        parts = []
        for raw in blocks:
            size = int.from_bytes(raw[:8], "little")
            h, sizes, starts, local, rank, th = unpack(raw[8 : 8 + size], np.uint64, *[np.uint32] * 3, *[np.int64] * 2)
            body = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[8 + size :]), np.uint8)
            edges = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            parts.append((np.cumsum(h, dtype=np.uint64), sizes, starts, rank[local], th[local], edges, body))
        del blocks
        total = sum(int(p[1].sum()) - len(p[1]) * (length - 1) for p in parts)
        steps = -(-total // SLICE_ROWS)
        if not total:
            return
        low, high = min(int(p[0][0]) for p in parts), max(int(p[0][-1]) for p in parts)
        for s in range(steps):
            a = low + (high - low) * s // steps
            b = low + (high - low) * (s + 1) // steps if s + 1 < steps else high + 1
            texts, sizes, starts, rank, th = [], [], [], [], []
            for ph, n, at, r, t, edge, body in parts:  # sorted by seed
                i, j = int(np.searchsorted(ph, np.uint64(a))), len(ph) if b > high else int(np.searchsorted(ph, np.uint64(b)))
                if i < j:
                    texts.append(body[edge[i] : edge[j]])
                    sizes.append(n[i:j]), starts.append(at[i:j]), rank.append(r[i:j]), th.append(t[i:j])
            if texts:
                spans = _covered(length, *map(np.concatenate, (texts, sizes, starts, rank, th)))
                yield from hit_blocks(*spans, partitions)

    return run


def _covered(length, text, sizes, starts, rank, th) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank, text hash and interval of what an earlier document holds."""
    sizes = sizes.astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    n = sizes - length + 1
    segment = np.repeat(np.arange(len(sizes)), n)
    within = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    # one byte more than the string: numpy would take trailing zero bytes for padding
    table = np.empty((len(segment), length + 1), np.uint8)
    table[:, :length] = np.lib.stride_tricks.as_strided(text, (len(text) - length + 1, length), (1, 1))[begin[segment] + within]
    table[:, length] = 1
    gone = has_previous_factor(table.view(f"S{length + 1}").ravel(), rank[segment])
    del table
    segment, at = segment[gone], (starts[segment] + within)[gone].astype(np.int64)
    if not len(segment):
        return rank[:0], th[:0], _spans(at, at)
    order = np.lexsort((at, th[segment], rank[segment]))
    r, t, at = rank[segment][order], th[segment][order], at[order]
    new_doc = np.concatenate(([True], (r[1:] != r[:-1]) | (t[1:] != t[:-1])))
    new_run = new_doc.copy()
    new_run[1:] |= at[1:] > at[:-1] + length  # runs that touch or overlap become one interval
    first = np.flatnonzero(new_run)
    last = np.append(first[1:], len(at)) - 1
    return r[first], t[first], _spans(at[first], at[last] + length)


def _strip(text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text_col):
            yield _stripped(rows, data, offsets)

    return run


def _stripped(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    n_bytes, n_removed, kept, spans = [], [], [], []
    for i, cell in enumerate(rows.column("hits").to_pylist()):
        own = data[offsets[i] : offsets[i + 1]]
        pairs = hit_values(cell, np.uint32).reshape(-1, 2).astype(np.int64)
        change = np.zeros(len(own) + 1, np.int32)
        np.add.at(change, pairs[:, 0], 1)
        np.add.at(change, pairs[:, 1], -1)
        mask = np.cumsum(change[:-1]) > 0
        a, b = intervals(mask)
        n_bytes.append(len(own))
        n_removed.append(int(mask.sum()))
        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
        kept.append(own[~mask].tobytes())
    return pa.RecordBatch.from_arrays(
        [rows.column("row"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(spans, SPANS_TYPE), pa.array(kept, pa.binary())],
        names=["row", "n_bytes", "n_removed", "removed_spans", "kept_bytes"],
    )


def remove_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """The input with ``n_bytes``, ``n_removed``, ``removed_spans`` (maximal byte intervals, end
    exclusive) and ``kept_bytes`` (what is left; a cut may fall inside a character).

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller id;
    strings are judged on the input, never across documents, and compared byte by byte.

    * Null text is empty; a text shorter than ``length`` stays whole.
    * Null id: the row comes after all rows with an id; such rows do not remove from one another.
    * Rows with the same id do not remove from one another; each is judged by itself.
    * An empty table gives an empty result; input columns named like a result column are replaced.
    * Memory of a task: one step of text (3 MB, or the longest document) times about thirty, and one partition of
      packed segments.  ``length`` is at least 8.
    """
    if length < 8:
        raise ValueError("length must be 8 or more")
    rows = keyed(docs, id_col, text_col)
    n = shuffle_partitions(docs.sparkSession)

    posted = rows.select("rank", "th", "text").mapInArrow(_post_seeds(length, n), BLOCKS)
    shared = told(posted, n, settle(n, False), np.uint32)
    whole = rows.select("rank", "th", "row")  # shuffled once for both joins
    segments = whole.join(shared, ["rank", "th"]).mapInArrow(_segments(length, n, text_col), BLOCKS)
    spans = told(segments, n, _order(length, n), _SPAN)
    joined = whole.join(spans, ["rank", "th"], "left").select("row", "hits")
    schema = with_row(joined, f"n_bytes long, n_removed long, {SPANS}, kept_bytes binary")
    return spread(joined.mapInArrow(_strip(text_col), schema), "n_bytes", "n_removed", "removed_spans", "kept_bytes")
