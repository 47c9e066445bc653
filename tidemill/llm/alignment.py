"""Two tokenizers' tokens of the same text, linked where they share bytes.

Token-byte incidence matrices in compressed sparse rows: the row products of A and the transpose of B
(Gustavson's algorithm) have an entry for every pair of tokens that overlap, and the products of
the token-group incidence matrices one for every pair in the same group.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tidemill.llm.common import chunks, pack, runs, spread, unpack, with_row
from tidemill.plans.shared import run_dir

#: A vocabulary goes to every task; above this it is refused.
VOCABULARY_BYTES = 64 << 20
#: text stretches whose tokens a task remembers, and their characters together
REMEMBERED = 250_000
REMEMBERED_CHARS = 24 << 20
#: entries of a matrix product that are expanded at a time
BLOCK_ENTRIES = 1 << 18
#: (document, pair) entries that one row of the packed table holds, unless one document has more
CHUNK_LINKS = 1 << 19
#: The pattern that a byte-level pre-tokenizer of this kind splits by.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_PIECE = "▁"


@dataclass
class CSR:
    """A sparse matrix of counts: row ``i`` has the columns ``cols[start[i]:start[i + 1]]``, ascending."""

    start: np.ndarray
    cols: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def incidence(cls, lengths: np.ndarray) -> CSR:
        """Rows that own consecutive columns: tokens and their bytes."""
        start = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        n = int(start[-1])
        return cls(start, np.arange(n), np.ones(n, np.int64), n)

    @classmethod
    def choice(cls, cols: np.ndarray, width: int) -> CSR:
        """One entry in each row: tokens and their groups."""
        return cls(np.arange(len(cols) + 1), np.asarray(cols, np.int64), np.ones(len(cols), np.int64), width)

    def transposed(self) -> CSR:
        rows = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        order = np.argsort(self.cols, kind="stable")
        start = np.concatenate(([0], np.cumsum(np.bincount(self.cols, minlength=self.width), dtype=np.int64)))
        return CSR(start, rows[order], self.data[order], len(self.start) - 1)

    def times(self, other: CSR) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of the product, row by row: each row of ``self`` gathers the rows of
        ``other`` that its columns name and adds them up.  Rows are expanded together up to
        ``BLOCK_ENTRIES``; memory is that, or one row's expansion."""
        size = np.diff(other.start)[self.cols]
        upto = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        i, n = 0, len(self.start) - 1
        while i < n:
            full = upto[self.start[i]] + BLOCK_ENTRIES
            j = max(int(np.searchsorted(upto[self.start], full, "right")) - 1, i + 1)
            a, b = self.start[i], self.start[j]
            own = size[a:b]
            total = int(own.sum())
            inside = np.arange(total) - np.repeat(np.cumsum(own) - own, own)
            at = np.repeat(other.start[self.cols[a:b]], own) + inside
            row = np.repeat(np.repeat(np.arange(i, j), np.diff(self.start[i : j + 1])), own)
            col, value = other.cols[at], np.repeat(self.data[a:b], own) * other.data[at]
            key = (row - i) * other.width + col
            if total and (np.diff(key) < 0).any():
                order = np.argsort(key, kind="stable")
                row, col, value, key = row[order], col[order], value[order], key[order]
            first = runs(key)
            if len(first):
                yield row[first], col[first], np.add.reduceat(value, first)
            i = j


def _before_blanks(tokens: Iterable[bytes]) -> set[str] | None:
    """The characters after which some token goes on with a blank, other than a blank; none known if a token
    has part of a character there."""
    found = {c for t in tokens for c in re.findall("([^ ]) ", t.decode(errors="replace"))}
    return None if "\ufffd" in found else found


def _bytes_of_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes stand for themselves,
    the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, spec: str):
        made = json.loads(spec)
        letters = _bytes_of_letters()
        model, added = made["model"], {t["content"] for t in made["added_tokens"]}
        tokens = {t: bytes(letters[c] for c in t) for t in model["vocab"] if t not in added}
        self.bytes_of = {model["vocab"][t]: b for t, b in tokens.items()}
        joined = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in joined]
        splitter = made["pre_tokenizer"] or {}
        plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        self.before_blanks = _before_blanks(self.bytes_of.values())
        if plain and made["normalizer"] is None and ids == sorted(set(ids)) and len(ids) + 256 == len(tokens):
            # merges in the order of their ids: the ranks say the same
            ranks = {b: i for i, b in self.bytes_of.items()}
            fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode: Callable = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_str(spec)
            slow.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
            self.before_blanks = None


class Pieces:
    """Ids and token bytes of a SentencePiece model."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(len(self.model))]
        self.bytes_of = {
            i: bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_PIECE, " ").encode()
            for i, p in enumerate(names)
        }
        self.blank = [self.model.piece_to_id(SPACE_PIECE)]
        alone = self.blank[0] != self.model.unk_id()
        self.before_blanks = _before_blanks(self.bytes_of.values()) if alone else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Each text without its first blank, which the model adds; of nothing else it would make nothing."""
        got = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [ids if len(t) > 1 else self.blank for t, ids in zip(texts, got)]


def cut(ids_a: np.ndarray, ids_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray) -> tuple:
    """Links and groups of two tokenizations of the same bytes: (rows and columns of the overlap
    product, the group of each A token, of each B token, pairs of the shared-group product)."""
    a, b = CSR.incidence(len_a), CSR.incidence(len_b)
    overlap = [(i, j) for i, j, _ in a.times(b.transposed())]
    common = np.intersect1d(a.start[1:], b.start[1:])
    group_a, group_b = np.searchsorted(common, a.start[1:]), np.searchsorted(common, b.start[1:])
    shared = [(i, j) for i, j, _ in CSR.choice(group_a, len(common)).times(CSR.choice(group_b, len(common)).transposed())]
    empty = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    i, j = map(np.concatenate, zip(*(overlap or empty)))
    si, sj = map(np.concatenate, zip(*(shared or empty)))
    return i, j, group_a, group_b, si, sj


class Aligner:
    """Aligns stretches of text and remembers those that the task has met lately.

    No token goes on with a blank after most characters, so a text's tokens are those of its stretches: a blank and
    what follows it up to the next blank behind such a character.  If that cannot be told, a text is one stretch.
    """

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        self.len_a, self.len_b = _lengths(a.bytes_of), _lengths(b.bytes_of)
        # every id as text, followed by each mark that can come after it
        self.marks = [f"{i}{m}" for n, marks in ((len(self.len_a), ",|"), (len(self.len_b), ",;")) for m in marks for i in range(n)]
        self.mark_size = np.array([len(m) for m in self.marks])
        self.stretches = a.before_blanks is not None and b.before_blanks is not None
        self.open_ends = tuple({" "} | (a.before_blanks or set()) | (b.before_blanks or set()))
        inside = "".join(re.escape(c) for c in self.open_ends)
        self.split = re.compile(f" (?:[^ ]|(?<=[{inside}]) )*" if self.stretches else "(?s).+").findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.texts: list[str] = []
        self.counts = np.zeros((0, 6), np.int64)
        self.links, self.link_ends = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _encode(self, side: ByteLevel | Pieces, lengths: np.ndarray, parts: list[str], raw: list[bytes]) -> tuple:
        """Ids of all parts, the part of each id, and which parts the ids give back byte by byte."""
        if self.stretches and parts and not any(p.endswith(self.open_ends) for p in parts):
            ids = side.encode(["".join(parts)])[0]
            if b"".join(map(side.bytes_of.__getitem__, ids)) == b"".join(raw):
                flat = np.array(ids, np.int64)
                ends = np.cumsum([len(r) for r in raw])
                return flat, np.searchsorted(ends, np.cumsum(lengths[flat])), np.ones(len(parts), bool)
        lists = side.encode(parts)
        ok = np.array([b"".join(map(side.bytes_of.__getitem__, x)) == r for x, r in zip(lists, raw)], bool)
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in lists])
        return np.array([i for x in lists for i in x], np.int64), owner, ok

    def _learn(self, new: list[str]) -> None:
        raw = [t.encode() for t in new]
        fa, owner_a, ok_a = self._encode(self.a, self.len_a, new, raw)
        fb, owner_b, ok_b = self._encode(self.b, self.len_b, new, raw)
        ok = ok_a & ok_b
        fa, owner_a, fb, owner_b = fa[ok[owner_a]], owner_a[ok[owner_a]], fb[ok[owner_b]], owner_b[ok[owner_b]]
        i, j, group_a, group_b, si, _ = cut(fa, fb, self.len_a[fa], self.len_b[fb])
        tail_a, tail_b = np.append(group_a[1:], -1) != group_a, np.append(group_b[1:], -1) != group_b
        many = lambda owner: np.bincount(owner, minlength=len(new))
        n_links = many(owner_a[i])
        counts = [many(owner_a), many(owner_b), many(owner_a[tail_a]), n_links, many(owner_a[si]), ok.astype(np.int64)]
        na, nb = len(self.len_a), len(self.len_b)
        marks = np.concatenate((fa + na * tail_a, fb + nb * tail_b + 2 * na))
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        marks, owner = marks[order], np.concatenate((owner_a, owner_b))[order]
        line = "".join([self.marks[m] for m in marks.tolist()])
        stops = np.cumsum(np.bincount(owner, weights=self.mark_size[marks], minlength=len(new)).astype(np.int64)).tolist()
        self.known.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
        self.texts += [line[u:v] for u, v in zip([0, *stops], stops)]
        self.chars += len(line) + sum(map(len, new))
        self.counts = np.concatenate((self.counts, np.stack(counts, 1)))
        self.links = np.concatenate((self.links, fa[i] * nb + fb[j]))
        self.link_ends = np.concatenate((self.link_ends, self.link_ends[-1] + np.cumsum(n_links)))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[bytes]]:
        """Counts, groups and links of each text."""
        own = [self.split(" " + t) if t else [] for t in texts]
        needed = set().union(*own)
        new = list(needed - self.known.keys())
        if new and (len(self.known) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS):
            self.forget()
            new = list(needed)
        last = [t for t in new if t.endswith(self.open_ends)]  # the end of a text: never before another stretch
        for part in ([t for t in new if not t.endswith(self.open_ends)], last):
            if part:
                self._learn(part)
        get = self.known.__getitem__
        at = [list(map(get, parts)) for parts in own]
        text = np.repeat(np.arange(len(texts)), [len(x) for x in at])
        flat = np.array([i for x in at for i in x], np.int64)
        bad = np.zeros(len(texts), bool)
        bad[text[self.counts[flat, 5] == 0]] = True
        good = ~bad[text]
        flat, text = flat[good], text[good]
        counts = np.zeros((len(texts), 6), np.int64)
        np.add.at(counts, text, self.counts[flat])
        groups = ["" if wrong else "".join([self.texts[p] for p in parts])[:-1] for parts, wrong in zip(at, bad)]
        # the links of all stretches, counted for each text
        size = self.link_ends[flat + 1] - self.link_ends[flat]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        key = (np.repeat(text, size) << 32) | self.links[np.repeat(self.link_ends[flat], size) + inside]
        key.sort()
        first = runs(key)
        n = np.diff(np.append(first, len(key)))
        a, b = np.divmod(key[first] & 0xFFFFFFFF, len(self.len_b))
        edges = np.searchsorted(key[first] >> 32, np.arange(len(texts) + 1)).tolist()
        both = (a << 32) | b
        links = [pack_links(both[u:v], n[u:v]) if v > u else b"" for u, v in zip(edges[:-1], edges[1:])]
        return counts, groups, links


def _lengths(bytes_of: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(max(bytes_of, default=-1) + 1, np.int64)
    out[list(bytes_of)] = [len(b) for b in bytes_of.values()]
    return out


def pack_links(pairs: np.ndarray, n: np.ndarray) -> bytes:
    """Distinct pairs (A id in the upper half), ascending, and their numbers."""
    return pack(np.diff(pairs, prepend=0), n.astype(np.uint32))


def unpack_links(cell: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    if not cell:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    steps, n = unpack(cell, np.int64, np.uint32)
    return np.cumsum(steps), n


def link_rows(cell: bytes) -> list[tuple[int, int, int]]:
    """The content of ``links``: (A id, B id, how many links)."""
    return [(k >> 32, k & 0xFFFFFFFF, m) for k, m in zip(*(x.tolist() for x in unpack_links(cell)))]


#: tokenizers that this worker has made, with what they remember
_MADE: dict[int, Aligner] = {}


def _aligner(spec: str, model: bytes) -> Aligner:
    key = hash((spec, model))
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Aligner(ByteLevel(spec), Pieces(model))
    return _MADE[key]


def _align(shipped, text_col: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shipped.value)
        for rows, data, offsets in chunks(batches, text_col, 2 << 20):
            raw = data.tobytes()
            counts, groups, links = aligner.align([raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])])
            columns = [pa.array(counts[:, k]) for k in range(5)]
            names = ["row", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups", "links"]
            yield pa.RecordBatch.from_arrays([rows.column("row"), *columns, pa.array(groups), pa.array(links, pa.binary())], names=names)

    return run


def _small_file(path: str) -> bytes:
    with open(path, "rb") as file:
        got = file.read(VOCABULARY_BYTES + 1)
    if len(got) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be")
    return got


def align(docs: DataFrame, byte_level: str, pieces: str, text_col: str = "text") -> DataFrame:
    """The input with the alignment of each text, in one pass without a shuffle.

    Tokenizer A (``byte_level``, a file of the ``tokenizers`` library) encodes a blank and the text, B (``pieces``, a
    SentencePiece model that adds the blank itself) the text; both paths are on the driver.  Special tokens are
    ordinary text.  Byte offsets where tokens of both end cut them into groups.

    * ``n_a``, ``n_b``: tokens; ``n_groups``; ``n_links``: pairs of tokens with a byte in common; ``n_shared``: pairs
      in the same group.
    * ``groups``: ids as ``a1,a2|b1;a3|b2,b3``.
    * ``links``: the distinct id pairs with their numbers, packed; :func:`link_rows` reads them.

    Null and empty texts, and texts whose A or B bytes do not give the blank and the text back (a piece for a blank in the
    text itself, a model that rewrites texts), have no tokens: zeros and empty values.  Texts are
    aligned whole; equal rows get equal results; an empty table gives an empty result; input columns named like
    a result column are replaced.  Memory of a task: 2 MB of text (or the longest text) and what it remembers.
    """
    shipped = docs.sparkSession.sparkContext.broadcast((_small_file(byte_level).decode(), _small_file(pieces)))
    rows = docs.select(F.struct("*").alias("row"))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_shared", "groups", "links"]
    ddl = "n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string, links binary"
    return spread(rows.mapInArrow(_align(shipped, text_col), with_row(rows, ddl)), *names)


def _packed(links_col: str):
    """Documents packed together: their distinct pairs once, and the entries of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        waiting: list[tuple[pa.Array, list[tuple]]] = []
        size = 0

        def chunk():
            cells = [c for _, own in waiting for c in own]
            pairs, n = (np.concatenate(x) for x in zip(*cells))
            keys, place = np.unique(pairs, return_inverse=True)
            total = np.bincount(place, weights=n, minlength=len(keys)).astype(np.int64)
            body = pack(np.array([len(c[0]) for c in cells], np.uint32), place.astype(np.uint32), n)
            rows = pa.concat_arrays([r for r, _ in waiting])
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) | number]), pa.ListArray.from_arrays([0, len(rows)], rows),
                 pa.ListArray.from_arrays([0, len(keys)], pa.array(keys)), pa.ListArray.from_arrays([0, len(keys)], pa.array(total)),
                 pa.array([body], pa.binary())],
                names=["chunk", "rows", "pairs", "n", "body"],
            )

        for batch in batches:
            rows, start, own = batch.column("row"), 0, []
            for k, cell in enumerate(rows.field(links_col)):
                got = unpack_links(cell.as_py())
                if size and size + len(got[0]) > CHUNK_LINKS:
                    waiting.append((rows.slice(start, k - start), own))
                    yield chunk()
                    waiting, size, number, start, own = [], 0, number + 1, k, []
                own.append(got)
                size += len(got[0])
            waiting.append((rows.slice(start), own))
        if size or any(own for _, own in waiting):
            yield chunk()

    return run


def _score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            rows = batch.column("rows").slice(k, 1).flatten()
            sizes, place, n = unpack(batch.column("body")[k].as_py(), np.uint32, np.uint32, np.uint32)
            found = batch.column("found").slice(k, 1).flatten()
            place, n = place.astype(np.int64), n.astype(np.int64)
            total, best = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
            at = found.field("place").to_numpy(zero_copy_only=False)
            total[at] = found.field("total").to_numpy(zero_copy_only=False)
            best[at] = found.field("best").to_numpy(zero_copy_only=False)
            ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            summed = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[ends])
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(summed(n * best[place])), pa.array(summed(n * total[place]))], names=["row", "n_best", "count_sum"]
            )


def score_links(aligned: DataFrame, links_col: str = "links") -> DataFrame:
    """The input without ``links_col``, with ``n_best`` and ``count_sum``.

    A pair of ids counts as often as links in the whole table hold it.  ``count_sum`` adds up the counts of a row's
    links; ``n_best`` are the links whose count is the highest that their B id has, ties included.

    Rows are packed together and written to the shared folder, each pack with its distinct pairs; only (pair, pack)
    rows are shuffled to be counted, and their totals go back to the pack.  The highest count of a B id is one row
    for each entry of B's vocabulary.  Memory of a task: a pack (2 million entries, or the largest row).

    Rows without links (null or empty) get zeros; equal rows count each by itself; an empty table gives an empty
    result; input columns named like a result column are replaced.
    """
    spark = aligned.sparkSession
    folder = run_dir(spark, "alignment")
    # written before they are packed: a task that aligns and packs would hold two Python workers
    aligned.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows").select(F.struct("*").alias("row"))
    whole = rows.schema["row"].dataType
    kept = StructType([f for f in whole.fields if f.name.lower() != links_col.lower()])
    plain = StructType.fromDDL("chunk long, pairs array<long>, n array<long>, body binary").fields
    packed = rows.mapInArrow(_packed(links_col), StructType([plain[0], StructField("rows", ArrayType(whole)), *plain[1:]]))
    without = F.transform("rows", lambda r: F.struct(*[r[f.name].alias(f.name) for f in kept.fields]))
    packed.withColumn("rows", without).write.parquet(f"{folder}/packs")
    packed = spark.read.parquet(f"{folder}/packs")

    entries = packed.select("chunk", F.posexplode(F.arrays_zip("pairs", "n")).alias("place", "e"))
    entries = entries.select("chunk", "place", F.col("e.pairs").alias("pair"), F.col("e.n").alias("n"))
    counted = entries.withColumn("total", F.sum("n").over(Window.partitionBy("pair")))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # at most one row for each entry of a vocabulary, whose file is bounded
    highest = F.broadcast(counted.groupBy(b_id.alias("b")).agg(F.max("total").alias("most")))
    judged = counted.join(highest, b_id == F.col("b")).select(
        "chunk", F.struct("place", "total", (F.col("total") == F.col("most")).cast("long").alias("best")).alias("f")
    )
    back = judged.groupBy("chunk").agg(F.collect_list("f").alias("found"))
    none = F.array().cast("array<struct<place:int,total:long,best:long>>")
    both = packed.select("chunk", "rows", "body").join(back, "chunk", "left").select("rows", "body", F.coalesce("found", none).alias("found"))
    out = StructType([StructField("row", kept), *StructType.fromDDL("n_best long, count_sum long").fields])
    return spread(both.mapInArrow(_score, out), "n_best", "count_sum")
