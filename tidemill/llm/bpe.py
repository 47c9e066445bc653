"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap over linked bytes.

The first tier answers pre-tokens that are vocabulary entries: a minimal perfect hash gives each
entry a slot of its own without a gap, and the slot's entry is compared with the pre-token.  The second tier
merges the bytes of a miss pair by pair in rank order.  Vocabularies are read, never trained.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import chunks, mixed, spread, with_row

#: A vocabulary goes to every task; above this it is refused.
VOCABULARY_BYTES = 64 << 20
#: distinct pre-tokens whose ids a task remembers
REMEMBERED = 200_000
#: bytes of text whose pre-tokens are looked up together
STEP_BYTES = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    ranks = {}
    size = 0
    with open(path, "rb") as lines:
        for line in lines:
            size += len(line)
            if size > VOCABULARY_BYTES:
                raise ValueError(f"{path} is larger than a vocabulary may be")
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class PerfectHash:
    """Hash and displace: keys fall into buckets, and each bucket gets the first displacement
    that puts its keys into free slots; buckets of one key take the slots that are left."""

    KEYS_PER_BUCKET = 2

    def __init__(self, size: int, shift: np.ndarray, slot_key: np.ndarray):
        self.size, self.shift, self.slot_key = size, shift, slot_key

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        h = cls.hashes(keys)
        if len(np.unique(h)) < n:
            raise ValueError("two keys have the same 64-bit hash")
        made = cls(n, np.zeros(max(1, n // cls.KEYS_PER_BUCKET), np.int64), np.full(n, -1, np.int64))
        groups: list[list] = [[] for _ in made.shift]
        for key, (bucket, base, step) in enumerate(zip(*(x.tolist() for x in made._parts(h)))):
            groups[bucket].append((key, base, step))
        slot = [-1] * n
        largest_first = sorted(range(len(groups)), key=lambda b: -len(groups[b]))
        for b in (b for b in largest_first if len(groups[b]) > 1):
            d = 0
            while True:
                at = {(base + d * step) % n: key for key, base, step in groups[b]}
                if len(at) == len(groups[b]) and all(slot[a] < 0 for a in at):
                    break
                d += 1
            made.shift[b] = d
            for a, key in at.items():
                slot[a] = key
        free = (a for a in range(n) if slot[a] < 0)
        for b in (b for b in largest_first if len(groups[b]) == 1):
            a = next(free)
            made.shift[b] = -1 - a
            made.slot_key[a] = groups[b][0][0]
        taken = np.array(slot, np.int64)
        made.slot_key = np.where(taken >= 0, taken, made.slot_key)
        return made

    @staticmethod
    def hashes(keys: Iterable[bytes]) -> np.ndarray:
        return np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)

    def _parts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bucket = (h % np.uint64(len(self.shift))).astype(np.int64)
        other = mixed(h)
        return bucket, (other >> np.uint64(33)).astype(np.int64), ((other & np.uint64(0x7FFFFFF)) | np.uint64(1)).astype(np.int64)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The number of the only key that can have each hash."""
        bucket, base, step = self._parts(h)
        shift = self.shift[bucket]
        return self.slot_key[np.where(shift < 0, -1 - shift, (base + shift * step) % self.size)]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank is joined, leftmost first, until none is left."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 once it is joined to the one before
    back = list(range(-1, n - 1))  # where the part before starts
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        middle = end[i]
        if not middle or middle >= n or middle >= stop or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            back[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                push(heap, (rank, i, end[stop]))
        before = back[i]
        if before >= 0:
            rank = ranks.get(piece[before:stop])
            if rank is not None:
                push(heap, (rank, before, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Pre-tokens to packed ids, remembering what the task has met lately."""

    def __init__(self, ranks: dict[bytes, int], tokens: list[bytes], perfect: PerfectHash, pattern: str):
        self.ranks, self.tokens, self.perfect = ranks, tokens, perfect
        self.ids = np.array([ranks[t] for t in tokens], np.uint32)
        self.split = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        raw = [x.encode() for x in new]
        found = self.perfect.lookup(self.perfect.hashes(raw))
        for text, piece, key in zip(new, raw, found.tolist()):
            if self.tokens[key] == piece:
                self.known[text] = self.ids[key].tobytes()
            else:
                self.known[text] = np.array(merge(piece, self.ranks), np.uint32).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        needed = set().union(*pieces)
        new = needed - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {x: self.known[x] for x in needed & self.known.keys()}
        if new:
            self._learn(list(new))
        known = self.known
        return [b"".join([known[p] for p in own]) for own in pieces]


def _encode(shipped, pattern: str, text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, tokens, *perfect = shipped.value
        encoder = Encoder(ranks, tokens, PerfectHash(*perfect), pattern)
        for rows, data, offsets in chunks(batches, text_col, STEP_BYTES):
            raw = data.tobytes()
            packed = encoder.encode([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary())],
                names=["row", "n_tokens", "tokens"],
            )

    return run


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """The input with ``n_tokens`` and ``tokens`` (ids as little-endian unsigned 32-bit integers).

    ``vocabulary`` is the path of a rank file on the driver, ``pattern`` what splits a text; each match is
    encoded by itself.  Special tokens are ordinary text.

    * Null and empty texts have no tokens.  Texts are encoded whole, whatever their length.
    * Every byte is a token of a byte-level vocabulary; one without some byte fails on it with ``KeyError``.
    * Equal rows get equal results; an empty table gives an empty result; input columns named like a
      result column are replaced.
    """
    ranks = read_ranks(vocabulary)
    tokens = list(ranks)
    perfect = PerfectHash.build(tokens)
    shipped = docs.sparkSession.sparkContext.broadcast((ranks, tokens, perfect.size, perfect.shift, perfect.slot_key))
    rows = docs.select(F.struct("*").alias("row"))
    done = rows.mapInArrow(_encode(shipped, pattern, text_col), with_row(rows, "n_tokens long, tokens binary"))
    return spread(done, "n_tokens", "tokens")


def _decode(shipped, column: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = shipped.value
        for batch in batches:
            packed = batch.column("row").field(column).to_pylist()
            texts = [b"".join([by_id[i] for i in np.frombuffer(p or b"", np.uint32).tolist()]) for p in packed]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.binary())], names=["row", "decoded"])

    return run


def decode(coded: DataFrame, vocabulary: str, tokens_col: str = "tokens") -> DataFrame:
    """The input with ``decoded``, the bytes of the packed ids in ``tokens_col``; null and empty give no bytes,
    an unknown id fails with ``KeyError``."""
    by_id = {rank: token for token, rank in read_ranks(vocabulary).items()}
    shipped = coded.sparkSession.sparkContext.broadcast(by_id)
    rows = coded.select(F.struct("*").alias("row"))
    done = rows.mapInArrow(_decode(shipped, tokens_col), with_row(rows, "decoded binary"))
    return spread(done, "decoded")
