"""SimHash fingerprints and their near pairs by bit-sliced comparison.

Two fingerprints within ``radius`` bits agree on at least ``b - radius`` of any ``b`` blocks, so fingerprints meet
in a bucket for each choice of that many blocks; no near pair is missed.  Inside a bucket the
fingerprints are stored as vertical bit planes: one machine word holds one bit of 64 candidates, and
carry-save counters add up 64 distances at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import NO_ID, chunks, keyed
from tidemill.llm.components import EDGES, Forest, components
from tidemill.plans.shared import materialize

BITS = 64
SEED = 42
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
#: chance members of a bucket that the number of blocks is chosen for
BUCKET_MEMBERS = 2
#: blocks that a pair must agree on at most: 210 buckets for each fingerprint, enough for 10^12 of them
MOST_BLOCKS = 6
#: members above which a bucket is cut into finer ones
LARGE_BUCKET = 20_000
#: members up to which the pairs of many buckets are compared together
SMALL_BUCKET = 24
#: nodes of a task's forest before it is sent on
FOREST_NODES = 500_000


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one text; zero without words."""
    words = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(h), 1 << 16):
        part = h[a : a + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches):
            raw = data.tobytes()
            found = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [rows.column("rank"), rows.column("th"), pa.array(found.view(np.int64))], names=["rank", "th", "fp"]
            )

    return run


def planes_of(values: np.ndarray) -> np.ndarray:
    """Plane j holds bit j of every value, 64 values to a word; the last word is filled up with zeros."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    fill = -len(values) % 64
    if fill:
        bits = np.concatenate((bits, np.zeros((fill, BITS), np.uint8)))
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _add(a, b, c):
    """A carry-save adder: the sum bit and the carry of three planes."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def _above(ones, twos, fours, over, radius: int):
    """Lanes whose count is above ``radius`` (at most 7); ``over`` marks counts of 8 and more."""
    more, same = over, ~over
    for place, plane in ((4, fours), (2, twos), (1, ones)):
        if radius & place:
            same = same & plane
        else:
            more, same = more | (same & plane), same & ~plane
    return more


def within(planes: np.ndarray, n: int, radius: int, query: int = 0) -> np.ndarray:
    """Which of the ``n`` lanes have at most ``radius`` bits unlike ``query``.

    Eight planes at a time go through the counters; then words in which every lane is
    above the radius are left out of the rest.
    """
    width = planes.shape[1]
    active = np.arange(width)
    result = np.zeros(width, np.uint64)
    ones, twos, fours = (np.zeros(width, np.uint64) for _ in range(3))
    over = np.zeros(width, np.uint64)
    if n % 64:
        over[-1] = ONES << np.uint64(n % 64)
    for j in range(0, BITS, 8):
        p = [planes[j + i, active] ^ (ONES if query >> (j + i) & 1 else np.uint64(0)) for i in range(8)]
        ones, t1 = _add(ones, p[0], p[1])
        ones, t2 = _add(ones, p[2], p[3])
        twos, f1 = _add(twos, t1, t2)
        ones, t1 = _add(ones, p[4], p[5])
        ones, t2 = _add(ones, p[6], p[7])
        twos, f2 = _add(twos, t1, t2)
        fours, e = _add(fours, f1, f2)
        over = over | e
        more = _above(ones, twos, fours, over, radius)
        alive = np.flatnonzero(more != ONES)
        if not len(alive):
            return np.zeros(n, bool)
        if len(alive) < len(active):
            active, ones, twos, fours, over, more = (x[alive] for x in (active, ones, twos, fours, over, more))
    result[active] = ~more
    return np.unpackbits(result.view(np.uint8), bitorder="little")[:n].astype(bool)


def _link_bucket(values: np.ndarray, radius: int, forest: Forest) -> None:
    """Link a bucket by search: what lies near a reached member is reached, and is compared no more."""
    rest = values
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        planes = planes_of(rest)
        while queue and len(rest):
            query = queue.pop()
            near = within(planes, len(rest), radius, query)
            if near.any():
                for x in rest[near].tolist():
                    forest.link(query, x)
                    queue.append(x)
                rest = rest[~near]
                planes = planes_of(rest) if len(rest) else planes


def _links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        left_key, left_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def compare(key, fp):
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            for a, m in zip(first[size > SMALL_BUCKET].tolist(), size[size > SMALL_BUCKET].tolist()):
                _link_bucket(np.unique(fp[a : a + m]), radius, forest)
            few = np.repeat((size > 1) & (size <= SMALL_BUCKET), size)
            key, fp = key[few], fp[few]
            for lag in range(1, SMALL_BUCKET):
                at = np.flatnonzero(key[lag:] == key[:-lag])
                if not len(at):
                    break
                near = within(planes_of(fp[at] ^ fp[at + lag]), len(at), radius)
                for x, y in zip(fp[at[near]].tolist(), fp[at[near] + lag].tolist()):
                    forest.link(x, y)

        for batch in batches:  # sorted by key
            key = np.concatenate((left_key, batch.column("key").to_numpy(zero_copy_only=False)))
            fp = np.concatenate((left_fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)))
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0
            compare(key[:cut], fp[:cut])
            left_key, left_fp = key[cut:], fp[cut:]
            if len(forest.parent) > FOREST_NODES:
                yield from _signed(forest)
                forest = Forest()
        if len(left_key):
            compare(left_key, left_fp)
        yield from _signed(forest)

    return run


def _signed(forest: Forest) -> Iterator[pa.RecordBatch]:
    """Links as Spark's signed 64-bit integers; which end is the smaller does not matter."""
    ends = (np.array(list(x), np.uint64).view(np.int64) for x in (forest.parent.keys(), forest.parent.values()))
    yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], names=["u", "v"])


def _to_signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(blocks: int, agree: int) -> list[int]:
    """One mask for each choice of ``agree`` of ``blocks`` parts of the 64 bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:])]
    return [sum(c) for c in combinations(parts, agree)]


def _keys(masks: list[int]) -> Column:
    """The bucket of a fingerprint for each mask."""
    return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_to_signed(m)))) for i, m in enumerate(masks)])


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links between distinct fingerprints (column ``fp``) within ``radius`` bits: enough of them
    that the components are those of all near pairs."""
    n = prints.count()
    agree = 1
    while agree < MOST_BLOCKS and n > BUCKET_MEMBERS << (BITS * agree // (agree + radius)):
        agree += 1
    keys = prints.select("fp", F.explode(_keys(block_masks(agree + radius, agree))).alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # a near pair of a large bucket also agrees on more, smaller blocks
    large = sizes.filter(F.col("n") > LARGE_BUCKET).select("key")
    finer = keys.join(large, "key", "left_semi").select("fp").distinct()
    fine = finer.select("fp", F.explode(_keys(block_masks(2 * radius + 2, radius + 2))).alias("key"))
    paired = sizes.filter((F.col("n") > 1) & (F.col("n") <= LARGE_BUCKET)).select("key")
    usual = keys.join(paired, "key", "left_semi")
    by_key = usual.select("key", "fp").unionByName(fine.select("key", "fp")).repartition("key").sortWithinPartitions("key")
    return by_key.mapInArrow(_links(radius), EDGES)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row for each document: the id column, ``th`` (hash of the text), ``fingerprint`` (16 hex digits),
    ``component_id`` (the least id reachable over links of ``radius`` bits or fewer) and ``is_first``
    (true for the row that stands for its component: least id, then least ``th``).

    Words are runs of bytes other than ASCII white space after lower-casing A-Z; shingles are ``shingle``
    words joined by a space, counted with repetition; a text with fewer words is one shingle.

    * Null and empty texts have fingerprint zero, which links like any other.
    * Null id: such rows are linked; ``component_id`` is null if no reachable row has an id.
    * Rows with equal ids and texts are equal in everything, ``is_first`` included.
    * An empty table gives an empty result; further input columns do not matter.  ``radius`` is 0 to 7.
    """
    if not 0 <= radius <= 7:
        raise ValueError("radius must be 0 to 7")
    rows = keyed(docs, id_col, text_col).select("rank", "th", "text")
    found = materialize(rows.mapInArrow(_fingerprints(shingle), "rank long, th long, fp long"))
    prints = found.groupBy("fp").agg(F.min(F.struct("rank", "th")).alias("least"))
    roots = components(near_links(prints.select("fp"), radius))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    firsts = named.groupBy("root").agg(F.min("least").alias("first"))
    members = named.join(firsts, "root").select("fp", "first")
    return found.join(members, "fp").select(
        F.nullif(F.col("rank"), F.lit(NO_ID)).alias(id_col),
        "th",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.nullif(F.col("first.rank"), F.lit(NO_ID)).alias("component_id"),
        (F.col("first") == F.struct("rank", "th")).alias("is_first"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one for each; of fully equal rows one stays."""
    first = near_duplicates(docs, id_col, text_col, shingle, radius).filter("is_first")
    keys = first.select(F.coalesce(id_col, F.lit(NO_ID)).alias("rank"), "th").distinct()
    rows = keyed(docs, id_col, text_col).select("rank", "th", "row")
    return rows.join(keys, ["rank", "th"]).dropDuplicates(["rank", "th"]).select("row.*")
