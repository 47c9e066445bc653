"""Removal of word windows that an earlier document holds already.

Rabin-Karp hashes of every window of ``window`` words are counted across the corpus; windows of
the same hash meet in one partition, and all but those of the first document are removed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemill.llm.common import chunks, keyed, mixed, shuffle_partitions, spread, with_row
from tidemill.llm.postings import BLOCKS, Combiner, hit_values, settle, told

#: Seed of the words' hashes, and the odd multiplier of the windows' polynomial over them.
SEED = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
#: Space, tab, line feed, vertical tab, form feed, carriage return: also what ``bytes.split`` takes.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

SPANS = "removed_spans array<struct<start:long,end:long>>"
SPANS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def word_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of the concatenated texts; texts are not joined to one another."""
    word = ~_IS_SPACE[data]
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    edges = offsets[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The XXH64 of each word's bytes; a word that comes again is hashed once."""
    numbers: dict[bytes, int] = {}
    words = [numbers.setdefault(data[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist())]
    return np.array([xxhash.xxh64_intdigest(w, SEED) for w in numbers], np.uint64)[np.array(words, np.int64)]


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """The rolling polynomial hash of every ``window`` consecutive word hashes."""
    total = np.zeros(len(words) - window + 1, np.uint64)
    for j in range(window):
        total = total * np.uint64(WORD_BASE) + words[j : j + len(total)]
    return mixed(total)


def _post(window: int, partitions: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        combiner = Combiner(partitions, need_earlier=True)
        for rows, data, offsets in chunks(batches):
            starts, ends = word_edges(data, offsets)
            if len(starts) < window:
                continue
            doc = np.searchsorted(offsets, starts, "right") - 1
            first = np.searchsorted(starts, offsets[:-1])  # the number of each text's first word
            whole = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
            hashes = window_hashes(word_hashes(data.tobytes(), starts, ends), window)[whole]
            owner = doc[whole]
            rank, th = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("rank", "th"))
            yield from combiner.step(hashes, owner, rank, th, (whole - first[owner]).astype(np.uint32))

    return run


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in an interval of ``length`` from one of ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts.astype(np.int64) + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _strip(window: int, text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in chunks(batches, text_col):
            raw = data.tobytes()
            n_words, n_removed, kept, spans = [], [], [], []
            for i, cell in enumerate(rows.column("hits").to_pylist()):
                words = raw[offsets[i] : offsets[i + 1]].split()
                mask = covered(hit_values(cell, np.uint32), window, len(words))
                a, b = intervals(mask)
                n_words.append(len(words))
                n_removed.append(int(mask.sum()))
                spans.append([{"start": int(i), "end": int(j)} for i, j in zip(a, b)])
                kept.append(b" ".join([w for w, gone in zip(words, mask) if not gone] if len(a) else words).decode())
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(spans, SPANS_TYPE), pa.array(kept, pa.string())],
                names=["row", "n_words", "n_removed", "removed_spans", "kept_text"],
            )

    return run


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """The input with ``n_words``, ``n_removed``, ``removed_spans`` (maximal word intervals, end
    exclusive) and ``kept_text`` (kept words joined by one space).

    A word goes if a window over it also starts in a document with a smaller id; windows are judged on
    the input.  Words are runs of bytes other than ASCII white space, case and marks included.

    * Null text: no words, empty ``kept_text``.  Fewer than ``window`` words: nothing is removed.
    * Null id: the row comes after all rows with an id; such rows do not remove from one another.
    * Rows with the same id do not remove from one another; each is judged by itself.
    * An empty table gives an empty result; input columns named like a result column are replaced.
    * Memory of a task: one step of text (3 MB, or the longest document) and one partition of packed
      windows, about 12 bytes each; raise ``spark.sql.shuffle.partitions`` with the data.

    Windows are compared by 64-bit hashes over the XXH64 of their words: among n distinct windows about n^2 / 2^65
    pairs agree by chance (10^-3 at 2*10^8 windows).  Words are not compared once more.
    """
    rows = keyed(docs, id_col, text_col)
    n = shuffle_partitions(docs.sparkSession)
    blocks = rows.select("rank", "th", "text").mapInArrow(_post(window, n), BLOCKS)
    hits = told(blocks, n, settle(n, True), np.uint32)
    joined = rows.select("rank", "th", "row").join(hits, ["rank", "th"], "left").select("row", "hits")
    schema = with_row(joined, f"n_words long, n_removed long, {SPANS}, kept_text string")
    done = joined.mapInArrow(_strip(window, text_col), schema)
    return spread(done, "n_words", "n_removed", "removed_spans", "kept_text")
