"""Language-model scores from a log-frequency Bloom filter of the corpus's own n-grams.

An n-gram whose count has the logarithmic level ``q`` is in the filter once for each of the levels 1 to ``q``; probing
level after level until one is absent gives the level back, never too low and seldom too high.  Probabilities
are interpolated from the order of the model down to single words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tidemill.llm.common import chunks, mixed, pack, runs, slots, unpack
from tidemill.plans.shared import run_dir

#: bytes of text whose words share one dictionary
CHUNK_BYTES = 8 << 20
#: n-grams, before equal ones are added up, that one segment of the filter is made from on average
SEGMENT_NGRAMS = 2 << 20
#: segments at most, and the bits of a hash that tell n-grams of a segment apart
MOST_SEGMENTS = 1 << 24
KEY_BITS = 40
#: bytes of the filter that go to the workers at a time; a larger filter is probed in several passes
FILTER_BYTES = 192 << 20
#: counts are told apart by powers of this
LEVEL_BASE = 1.5
#: keys that are probed together, whose arrays stay in a core's own cache, and the levels up to which they are
PROBED_KEYS, FIRST_LEVELS = 1 << 16, 6
#: share of present keys below which the absent ones are left out of further probes
PROBED_SHARE = 0.8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_IN_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
_BEGIN = np.uint64(0x5851F42D4C957F2D)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: least count of each level, and what a level stands for: the middle of its counts
_LEAST = np.unique(np.ceil(LEVEL_BASE ** np.arange(105)))
VALUE = np.concatenate(([0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2))


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.searchsorted(_LEAST, counts, "right"), len(VALUE) - 1)


def keys_of(h: np.ndarray, segments: int) -> np.ndarray:
    """The segment of each n-gram in the upper bits, by the upper half of its hash, and its key there, by the lower bits."""
    return (slots(h, segments).astype(np.uint64) << np.uint64(KEY_BITS)) | (h & np.uint64((1 << KEY_BITS) - 1))


def places(keys: np.ndarray, level: int, probes: int, bits: int) -> Iterator[np.ndarray]:
    """The bits, among ``bits``, that the probes of a level look at, probe after probe."""
    at, step = _first(keys, level)
    for _ in range(probes):
        yield _place(at, np.uint64(bits))
        at = at + step


def _first(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of a level's first probe, and the step from probe to probe."""
    at = mixed(keys + np.uint64(level * int(_ODD) & 0xFFFFFFFFFFFFFFFF))
    return at, (at << np.uint64(32)) | np.uint64(1 << 31)


def _place(at: np.ndarray, bits: np.ndarray | np.uint64) -> np.ndarray:
    return (((at >> np.uint64(32)) * bits) >> np.uint64(32)).astype(np.int64)


def bits_for(insertions: int, probes: int) -> int:
    """Bits of a segment: half of them will be set."""
    return max(64, -(-int(insertions * probes / np.log(2)) // 64) * 64)


def segment(keys: np.ndarray, counts: np.ndarray, probes: int) -> np.ndarray:
    """The packed bits of a segment."""
    levels = level_of(counts)
    size = bits_for(int(levels.sum()), probes)
    marks = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys = keys[levels >= level]
        levels = levels[levels >= level]
        for at in places(keys, level, probes, size):
            marks[at] = True
    return np.packbits(marks, bitorder="little")


def _distinct(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``width`` bits by segment, equal ones once, and where each one of ``keys`` is among them.

    Sorted by as many upper bits as fit beside a number, which is far quicker than a sort of numbers by keys; a key whose lower
    bits alone differ from another's may come twice, which does no harm."""
    small = np.uint64(len(keys).bit_length())
    order = keys >> np.uint64(max(0, width + int(small) - 64)) << small
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order = (order & ((np.uint64(1) << small) - np.uint64(1))).view(np.int64)
    keys = keys[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)]
    places_ = np.empty(len(keys), np.int64)
    places_[order] = np.cumsum(new) - 1
    return keys[new], places_


class Filter:
    """Segments ``low`` up to ``low + len(sizes)`` of ``total``: their bits one after another in ``data``."""

    def __init__(self, data: bytes | bytearray, low: int, sizes: np.ndarray, total: int, probes: int):
        self.data, self.low, self.total, self.probes = np.frombuffer(data, np.uint8), low, total, probes
        self.bits = sizes * 8
        self.start = np.concatenate(([0], np.cumsum(self.bits)))[:-1]

    def levels(self, h: np.ndarray) -> np.ndarray:
        """The level of each n-gram; 0 if it is absent or in a segment that is not here.

        Equal n-grams are probed once and those of one segment together, which its bits stay in the cache for."""
        keys, places_ = _distinct(keys_of(h, self.total), KEY_BITS + (self.total - 1).bit_length())
        return self._levels(keys)[places_]

    def _levels(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.uint8)
        own = (keys >> np.uint64(KEY_BITS)).astype(np.int64) - self.low
        active = np.flatnonzero((own >= 0) & (own < len(self.bits)))
        active = active[self.bits[own[active]] > 0]
        keys = keys & np.uint64((1 << KEY_BITS) - 1)
        # most end at a low level; the few that go on are probed all at once
        parts = [active[a : a + PROBED_KEYS] for a in range(0, len(active), PROBED_KEYS)]
        parts = [self._climb(keys, own, part, out, 1, FIRST_LEVELS) for part in parts]
        if parts:
            self._climb(keys, own, np.concatenate(parts), out, FIRST_LEVELS + 1, len(VALUE) - 1)
        return out

    def _climb(self, keys: np.ndarray, own: np.ndarray, active: np.ndarray, out: np.ndarray, low: int, high: int) -> np.ndarray:
        """Probe level after level from ``low`` to ``high``; returns what of ``active`` reaches ``high``."""
        for level in range(low, high + 1):
            if not len(active):
                break
            seg = own[active]
            (at, step), bits, start = _first(keys[active], level), self.bits[seg].astype(np.uint64), self.start[seg]
            alive = np.ones(len(active), bool)
            for _ in range(self.probes):
                place = _place(at, bits)
                place += start
                alive &= ((self.data[place >> 3] >> (place & 7).astype(np.uint8)) & 1).view(bool)
                at = at + step
                # each probe misses half of what is absent, which is probed no more once it is many
                if np.count_nonzero(alive) < PROBED_SHARE * len(alive):
                    left = np.flatnonzero(alive)
                    active, at, step, bits, start = (x[left] for x in (active, at, step, bits, start))
                    alive = np.ones(len(active), bool)
            active = active[alive]
            out[active] = level
        return active


def _tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: ids, words and their training counts, and every token as the number of its word."""
    task, number = TaskContext.get().partitionId(), 0
    for rows, data, offsets in chunks(batches, limit=CHUNK_BYTES):
        words, lengths, tokens = _numbered(data, offsets)
        train = rows.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
        n = np.bincount(tokens[np.repeat(train, lengths) > 0], minlength=len(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) | number]), _one_list(rows.column("id")), pa.array([pack(lengths, train, tokens)], pa.binary()),
             _one_list(words), _one_list(pa.array(n)), pa.array([int(n.sum())]), pa.array([int(train.sum())])],
            names=["chunk", "ids", "body", "words", "n", "n_train", "n_texts"],
        )
        number += 1


def _numbered(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words as they come, the empty one first, the tokens of each text, and every token as the number of its word."""
    data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    lengths = np.diff(np.searchsorted(np.flatnonzero(begins), offsets)) + 1
    # the bytes of all words side by side
    starts = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside))
    buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data[inside])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers).dictionary_encode()
    tokens = np.zeros(int(lengths.sum()), np.uint32)  # the end of a text is the empty word
    word = np.ones(len(tokens), bool)
    word[np.cumsum(lengths) - 1] = False
    tokens[word] = coded.indices.to_numpy() + 1
    return pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary.cast(pa.binary())]), lengths.astype(np.uint32), tokens


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays([0, len(values)], values)


class Chunk:
    """The tokens of a chunk, each text led by a begin mark."""

    def __init__(self, body: bytes, words: pa.Array):
        lengths, train, tokens = unpack(body, np.uint32, np.uint8, np.uint32)
        self.lengths = lengths.astype(np.int64)
        self.train = train > 0
        ends = np.cumsum(self.lengths)
        self.begins = ends - self.lengths + np.arange(len(ends))
        self.text = np.repeat(np.arange(len(ends)), self.lengths)
        self.at = np.arange(len(tokens)) + self.text + 1  # where the tokens are once begin marks are among them
        self.tokens = tokens.astype(np.int64)
        self.words = np.fromiter(map(xxhash.xxh64_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))
        self.hashes = mixed(self.words + _ODD)  # of each word as an n-gram

    def ngrams(self, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length from 2 up to ``order``: the places where such an n-gram ends, and its hash.

        The begin mark counts as a word of context, and no n-gram ends at it."""
        words = np.zeros(len(self.tokens) + len(self.begins), np.uint64)
        words[self.at] = self.words[self.tokens]
        h = np.full(len(words), _BEGIN)
        h[self.at] = self.hashes[self.tokens]
        depth = np.arange(len(words)) - np.repeat(self.begins, self.lengths + 1)
        out = []
        for n in range(2, order + 1):
            longer = h.copy()
            longer[1:] = mixed(h[:-1] * _ODD + words[1:] + np.uint64(n))
            h = longer
            at = np.flatnonzero(depth >= n - 1)
            out.append((at, h[at]))
        return out


def _post(order: int, segments: int):
    """The training n-grams of a chunk as sorted blocks, one for each segment."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk(batch.column("body")[k].as_py(), batch.column("words").slice(k, 1).flatten())
                trained = np.zeros(len(chunk.tokens) + len(chunk.begins), bool)
                trained[chunk.at] = chunk.train[chunk.text]
                n = batch.column("n").slice(k, 1).flatten().to_numpy()
                known = np.flatnonzero(n)  # single words are counted already
                keys = keys_of(chunk.hashes[known], segments)
                by_key = np.argsort(keys)
                parts = [blocks(keys[by_key], n[known][by_key])]
                for at, h in chunk.ngrams(order):
                    keys = keys_of(h[trained[at]], segments)
                    keys.sort()
                    first = runs(keys)
                    parts.append(blocks(keys[first], np.diff(np.append(first, len(keys)))))
                yield from parts

    def blocks(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        edge = np.append(runs(keys >> np.uint64(KEY_BITS)), len(keys))
        own = (keys[edge[:-1]] >> np.uint64(KEY_BITS)).astype(np.int32)
        keys = keys & np.uint64((1 << KEY_BITS) - 1)
        packed = [pack(np.diff(keys[a:b], prepend=np.uint64(0)), n[a:b].astype(np.uint32)) for a, b in zip(edge[:-1], edge[1:])]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(packed, pa.binary())], names=["segment", "block"])

    return run


def _fill(probes: int):
    """Blocks, sorted by segment, to the bits of each segment."""

    def made(number: int, blocks: list[bytes]) -> pa.RecordBatch:
        parts = [unpack(b, np.uint64, np.uint32) for b in blocks]
        h = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
        n = np.concatenate([p[1] for p in parts])
        order = np.argsort(h)
        h = h[order]
        first = runs(h)
        bits = segment(h[first], np.add.reduceat(n[order].astype(np.int64), first), probes).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([len(bits)], pa.int64()), pa.array([bits], pa.binary())], names=["segment", "size", "bits"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, blocks = -1, []
        for batch in batches:
            for s, block in zip(batch.column("segment").to_pylist(), batch.column("block").to_pylist()):
                if s != number and blocks:
                    yield made(number, blocks)
                    blocks = []
                number = s
                blocks.append(block)
        if blocks:
            yield made(number, blocks)

    return run


def _probe(shipped, order: int, score=None):
    """Adds to the levels of each chunk what the shipped segments know; with ``score`` all is known then, and the
    scores of the chunk's texts take the place of words and levels."""

    def levels_of(part: Filter, chunk: Chunk, known: bytes | None) -> list[np.ndarray]:
        width = len(chunk.tokens) + len(chunk.begins)
        old = unpack(known, *[np.uint8] * order) if known else [np.zeros(width, np.uint8)] * order
        levels = [x.copy() for x in old]
        single = part.levels(chunk.hashes)
        levels[0][chunk.at] = np.maximum(levels[0][chunk.at], single[chunk.tokens])
        for out, (at, h) in zip(levels[1:], chunk.ngrams(order)):
            out[at] = np.maximum(out[at], part.levels(h))
        return levels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = Filter(*shipped.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                chunk = Chunk(row.column("body")[0].as_py(), row.column("words").flatten())
                levels = levels_of(part, chunk, row.column("levels")[0].as_py())
                if score is None:
                    yield row.set_column(row.schema.get_field_index("levels"), "levels", pa.array([pack(*levels)], pa.binary()))
                    continue
                p = probabilities(levels, chunk.begins, *score)[chunk.at]
                scores = np.bincount(chunk.text, weights=np.log10(p), minlength=len(chunk.lengths))
                kept = [row.column(c) for c in ("chunk", "ids", "body")]
                yield pa.RecordBatch.from_arrays([*kept, _one_list(pa.array(scores))], names=["chunk", "ids", "body", "scores"])

    return run


def probabilities(levels: list[np.ndarray], begins: np.ndarray, texts: int, tokens: int, kinds: int, prior: float) -> np.ndarray:
    """The probability of every place from the levels of its n-grams; ``texts`` is the count of the begin mark."""
    p = np.minimum((VALUE[levels[0]] + 1) / (tokens + kinds + 1), 1.0)
    depth = np.arange(len(p)) - np.repeat(begins, np.diff(np.append(begins, len(p))))
    for n in range(2, len(levels) + 1):
        at = np.flatnonzero(depth >= n - 1)
        before = levels[n - 2][at - 1]
        context = VALUE[before]
        seen = VALUE[np.minimum(levels[n - 1][at], before)]  # no n-gram is more frequent than its context
        if n == 2:
            first = depth[at] == 1
            context = np.where(first, texts, context)
            seen = np.where(first, np.minimum(VALUE[levels[1][at]], texts), seen)
        p[at] = (seen + prior * p[at]) / (context + prior)
    return p


def _exact(tokens: int, kinds: int):
    """The word counts of a chunk to the results of its texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                chunk = Chunk(batch.column("body")[k].as_py(), pa.array([], pa.binary()))
                found = batch.column("found").slice(k, 1).flatten()
                count = np.zeros(int(chunk.tokens.max(initial=0)) + 1, np.int64)
                count[found.field("place").to_numpy(zero_copy_only=False)] = found.field("total").to_numpy(zero_copy_only=False)
                own = count[chunk.tokens]
                total = lambda x: np.bincount(chunk.text, weights=x, minlength=len(chunk.lengths))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(k, 1).flatten(), pa.array(~chunk.train), pa.array(chunk.lengths),
                     pa.array(total(own > 0).astype(np.int64)), pa.array(np.full(len(chunk.lengths), tokens)),
                     pa.array(total(np.log10((own + 1) / (tokens + kinds + 1)))), batch.column("scores").slice(k, 1).flatten()],
                    names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_texts(
    docs: DataFrame,
    train: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
    probes: int = 6,
    prior: float = 4.0,
) -> DataFrame:
    """For every row its ``id_col`` and ``held_out`` (not trained on), ``n_tokens``, ``n_known`` (tokens that training
    texts hold), ``train_tokens``, ``base_score`` (single words with exact counts, one added to each) and ``score``: log10
    probabilities of the whole text.

    Tokens are runs of bytes other than ASCII white space, A-Z in lower case, and one end.  The model learns from rows where
    ``train`` is true.  P(w | h) = (c(h w) + prior * P(w | shorter h)) / (c(h) + prior), down to
    (c(w) + 1) / (N + V + 1), with counts c read from the filter; the begin of a text is context for its first words.

    * Null and empty texts are an end alone.  A null ``train`` is false.  Rows without an id, rows with the same id and
      equal rows count each by itself.  Without training texts all scores are 0.  An empty table gives an empty result.
      Other input columns are not returned, so no name can clash.
    * Word counts are exact: words travel as themselves.  N-grams are hashes (of ``KEY_BITS`` bits in their segment); an absent one is taken
      for present with probability ``2 ** -probes`` about, which raises a level, never lowers it.
    * The filter has about ``1.44 * probes`` bits for each level of each distinct n-gram, so it grows with the corpus.  It
      is made in segments of bounded size and broadcast ``FILTER_BYTES`` at a time: a larger one takes several passes over
      the packed tokens, with the levels written in between.
    * Memory of a task: a chunk (8 MB of text, or the longest text) or a segment, beside the part of the filter.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    folder = run_dir(spark, "ngrams")
    rows = docs.select(
        docs[id_col].alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    plain = StructType.fromDDL("chunk long, body binary, words array<binary>, n array<long>, n_train long, n_texts long").fields
    rows.mapInArrow(_tokenize, StructType([plain[0], StructField("ids", ArrayType(id_type)), *plain[1:]])).write.parquet(f"{folder}/tokens")
    packed = spark.read.parquet(f"{folder}/tokens")
    sums = packed.agg(F.sum("n_train").alias("tokens"), F.sum("n_texts").alias("texts")).first()
    tokens, texts = sums["tokens"] or 0, sums["texts"] or 0

    # exact word counts: one row for each word and chunk is shuffled, and the total goes back to the chunk
    entries = packed.select("chunk", F.posexplode(F.arrays_zip("words", "n")).alias("place", "e"))
    entries = entries.select("chunk", "place", F.col("e.words").alias("word"), F.col("e.n").alias("n"))
    by_word = Window.partitionBy("word")
    counted = entries.withColumn("first", F.row_number().over(by_word.orderBy("chunk")) == 1).withColumn("total", F.sum("n").over(by_word))
    back = counted.groupBy("chunk").agg(
        F.collect_list(F.struct("place", "total")).alias("found"), F.count_if(F.col("first") & (F.col("total") > 0)).alias("n_new")
    )
    back.write.parquet(f"{folder}/counts")
    back = spark.read.parquet(f"{folder}/counts")
    kinds = back.agg(F.sum("n_new")).first()[0] or 0

    segments = min(max(1, -(-order * tokens // SEGMENT_NGRAMS)), MOST_SEGMENTS)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = packed.select("body", "words", "n").mapInArrow(_post(order, segments), "segment int, block binary")
    filled = blocks.repartition(parts, "segment").sortWithinPartitions("segment")
    filled.mapInArrow(_fill(probes), "segment int, size long, bits binary").write.parquet(f"{folder}/filter")
    made = spark.read.parquet(f"{folder}/filter")

    levels = packed.select("chunk", "ids", "body", "words", F.lit(None).cast("binary").alias("levels"))
    slim = StructType([*[levels.schema[c] for c in ("chunk", "ids", "body")], *StructType.fromDDL("scores array<double>").fields])
    cuts, sizes = _cuts(made, segments)
    for number, (low, high) in enumerate(cuts):
        part = _part(made, low, sizes[low:high], segments, probes)
        if number == len(cuts) - 1:
            scored = levels.mapInArrow(_probe(part, order, (texts, tokens, kinds, prior)), slim)
        else:
            levels.mapInArrow(_probe(part, order), levels.schema).write.parquet(f"{folder}/levels-{number}")
            levels = spark.read.parquet(f"{folder}/levels-{number}")
    none = F.array().cast("array<struct<place:int,total:long>>")
    both = scored.join(back.select("chunk", "found"), "chunk", "left").select("ids", "body", "scores", F.coalesce("found", none).alias("found"))
    ddl = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = StructType([StructField("id", id_type), *StructType.fromDDL(ddl).fields])
    return both.mapInArrow(_exact(tokens, kinds), out).withColumnRenamed("id", id_col)


def _cuts(made: DataFrame, segments: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Runs of segments of at most ``FILTER_BYTES`` together, or one segment; and the bytes of each segment."""
    sizes = np.zeros(segments, np.int64)
    for r in made.select("segment", "size").toLocalIterator():
        sizes[r["segment"]] = r["size"]
    cuts, low = [], 0
    while low < segments:
        high = low + max(1, int(np.searchsorted(np.cumsum(sizes[low:]), FILTER_BYTES, "right")))
        cuts.append((low, high))
        low = high
    return cuts, sizes


def _part(made: DataFrame, low: int, sizes: np.ndarray, segments: int, probes: int):
    """The segments from ``low`` on as a broadcast of the arguments of :class:`Filter`."""
    part, start = bytearray(int(sizes.sum())), np.concatenate(([0], np.cumsum(sizes)))
    for r in made.filter(F.col("segment").between(low, low + len(sizes) - 1)).select("segment", "bits").toLocalIterator():
        a = int(start[r["segment"] - low])
        part[a : a + len(r["bits"])] = r["bits"]
    return made.sparkSession.sparkContext.broadcast((part, low, sizes, segments, probes))
