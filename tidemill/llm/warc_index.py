"""WARC archives, their capture indexes, and the merge of sorted index runs into capture histories.

Pages become WARC/1.0 records, written by Spark's own writer, so that a lost task leaves no half
archive.  Reading an archive back gives a run of captures sorted by URL key and time.  The runs are dealt out
by key range, and in each range a loser tree merges the slices of all runs.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import NO_ID, shuffle_partitions
from tidemill.plans.shared import run_dir

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Fixed value: the profile of a revisit with an identical payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: What ends a record; as the writer's line separator it follows every record.
RECORD_END = "\r\n\r\n"
#: records of one archive
ARCHIVE_RECORDS = 4000
#: bytes of an archive that are unpacked at a time
STEP = 1 << 20
CAPTURES = (
    "run long, seq long, url_key string, captured string, id long, url string, payload_bytes long,"
    "payload_digest string, record_type string, refers_to long"
)
_CAPTURES = pa.schema(
    [("run", pa.int64()), ("seq", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("id", pa.int64()),
     ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64())]
)
HISTORY = CAPTURES.replace("run long, seq long", "slice int, place long")


def base32_of_hex(digest: Column) -> Column:
    """A hexadecimal digest of 160 bits in base32: five hex digits are four characters."""

    def four(bits: Column) -> Column:
        places = [F.shiftright(bits, 15 - 5 * i).bitwiseAND(F.lit(31)) + 1 for i in range(4)]
        return F.concat(*[F.substr(F.lit(ALPHABET), p, F.lit(1)) for p in places])

    groups = F.array(*[F.conv(F.substr(digest, F.lit(i), F.lit(5)), 16, 10).cast("int") for i in range(1, 41, 5)])
    return F.array_join(F.transform(groups, four), "")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (``id``, ``payload`` and more) with ``sha1`` (hexadecimal), ``size`` and ``first``: the least id with an
    equal payload, where that is another one and the payload has ``min_bytes`` or more.

    Digests are grouped and joined without the payloads; a payload that very many pages share is
    combined before the shuffle, and its join is one that adaptive execution may split.
    """
    sized = pages.withColumns(
        {"sha1": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long")}
    )
    rank = F.coalesce("id", F.lit(NO_ID))
    ids = sized.filter(F.col("size") >= min_bytes).select(rank.alias("rank"), "sha1")
    least = ids.groupBy("sha1").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    revisits = ids.join(least.filter("n > 1"), "sha1").filter("rank <> first").select("rank", "sha1", "first").distinct()
    joined = sized.withColumn("rank", rank).join(revisits, ["rank", "sha1"], "left").drop("rank")
    return joined.withColumn("first", F.nullif("first", F.lit(NO_ID)))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write a record for each row of ``pages`` (``id`` long, ``url`` string, ``captured`` timestamp, ``payload`` string).

    The first of equal payloads is a response, the others are revisits without a block that name it.
    """
    rows = with_revisits(pages, min_bytes)
    revisit = F.col("first").isNotNull()
    clean = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")  # a header holds no line break
    header = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        F.when(revisit, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        header("WARC-Record-ID", F.concat(F.lit("<urn:x-page:"), F.col("id").cast("string"), F.lit(">"))),
        header("WARC-Target-URI", clean),
        header("WARC-Date", F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        header("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:x-page:"), F.col("first").cast("string"), F.lit(">")))),
        header("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        header("X-Payload-Length", F.when(revisit, F.col("size").cast("string"))),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string"),
        F.lit("\r\n\r\n"),
        F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", ARCHIVE_RECORDS).text(folder)


class _Unpacked:
    """The bytes of an archive, unpacked as they are read."""

    def __init__(self, packed: bytes):
        self.packed, self.at, self.data = packed, 0, b""
        self.stream = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.stream.eof:
            rest = self.stream.unused_data
            if not rest:
                return False
            self.stream = zlib.decompressobj(31)  # the next member
            piece = rest
        elif self.at < len(self.packed):
            piece = self.packed[self.at : self.at + STEP]
            self.at += STEP
        else:
            return False
        self.data += self.stream.decompress(piece)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``, which is skipped; none at the end."""
        while (i := self.data.find(mark)) < 0:
            if not self._more():
                if self.data:
                    raise ValueError("an archive ends inside a record header")
                return None
        out, self.data = self.data[:i], self.data[i + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self._more():
                raise ValueError("an archive ends inside a record block")
        out, self.data = self.data[:n], self.data[n:]
        return out


def url_key(url: str | None) -> str:
    """Host parts reversed, then path and sorted query, in lower case; scheme, ``www.``, default ports
    and fragments do not count."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    if port and (parts.scheme, port) not in (("http", 80), ("https", 443)):
        host = f"{host}:{port}"
    query = "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    path = (parts.path or "/").rstrip("/") or "/"
    return f"{','.join(reversed(host.split('.')))}){path}{'?' + query if query else ''}".lower()


def records(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record; a damaged record is an error."""
    archive = _Unpacked(packed)
    while (head := archive.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode().split("\r\n")
        if first != "WARC/1.0":
            raise ValueError(f"not a record: {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = archive.take(int(fields["Content-Length"]))
        if archive.take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        yield fields, block


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:x-page:") : -1]) if urn else None


def _capture(fields: dict[str, str], block: bytes) -> tuple:
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and b32encode(hashlib.sha1(block).digest()).decode() != digest:
        raise ValueError("a payload does not have its digest")
    url = fields.get("WARC-Target-URI")
    size = int(fields["X-Payload-Length"]) if kind == "revisit" else len(block)
    return (url_key(url), fields.get("WARC-Date", ""), _page(fields.get("WARC-Record-ID")), url, size, digest, kind,
            _page(fields.get("WARC-Refers-To")))


def order_of(capture: tuple) -> tuple:
    """URL key, time, id; a capture without an id comes last."""
    return capture[0], capture[1], NO_ID if capture[2] is None else capture[2]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            run = int.from_bytes(hashlib.sha1(path.as_py().encode()).digest()[:8], "big", signed=True)
            found = sorted((_capture(*r) for r in records(content.as_py())), key=order_of)
            columns = list(zip(*found)) if found else [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip([[run] * len(found), range(len(found)), *columns], _CAPTURES)], schema=_CAPTURES
            )


def write_runs(spark: SparkSession, archives: str, folder: str) -> None:
    """Write the sorted captures of every archive below ``archives`` as one run each."""
    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    files.mapInArrow(_runs, CAPTURES).write.parquet(folder)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, so the next smallest takes one
    match on each level of the path from the winner's leaf."""

    def __init__(self, sources: list[Iterator], key: Callable):
        self.sources, self.key, self.k = sources, key, len(sources)
        self.heads = [next(s, None) for s in sources]
        self.tree = [-1] * self.k
        for i in reversed(range(self.k)):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (self.key(x), a) < (self.key(y), b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.tree[node]
            if other < 0:  # first match of this node: wait for the opponent
                self.tree[node] = winner
                return
            if self._beats(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while self.k:
            w = self.tree[0]
            head = self.heads[w]
            if head is None:
                return
            yield head
            self.heads[w] = next(self.sources[w], None)
            self._play(w)


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: dict[int, list[tuple]] = {}
    slice_id = None
    for batch in batches:
        for number, run, *row in zip(*(c.to_pylist() for c in batch.columns)):
            slice_id = number
            runs.setdefault(run, []).append(tuple(row))
    for rows in runs.values():
        rows.sort()  # by place in the run: the pieces of a run may come in any order
    merged = LoserTree([iter(runs[r]) for r in sorted(runs)], key=lambda row: order_of(row[1:]))
    schema = pa.schema([("slice", pa.int32()), ("place", pa.int64()), *list(_CAPTURES)[2:]])
    out, place = [], 0
    for row in merged:
        out.append((slice_id, place, *row[1:]))
        place += 1
        if len(out) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def merge_runs(spark: SparkSession, runs: str) -> DataFrame:
    """Capture histories: all captures of the runs below ``runs``, ordered by URL key, time and id.

    ``slice`` and ``place`` give the global order.  Slices are ranges of the whole key, id included, so a URL
    with very many captures is cut into several slices; a task holds one slice of the index.
    """
    index = spark.read.parquet(runs)
    rank = F.coalesce("id", F.lit(NO_ID))
    parts = index.repartitionByRange(shuffle_partitions(spark), "url_key", "captured", rank)
    columns = [f.name for f in _CAPTURES]
    return parts.select(F.spark_partition_id().alias("slice"), *columns).mapInArrow(_merge, HISTORY)


def capture_histories(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    captured: Column | None = None,
    min_bytes: int = 0,
) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, index them, and merge the indexes.

    Result: ``slice``, ``place``, ``url_key``, ``captured`` (text, UTC), ``id``, ``url``, ``payload_bytes``,
    ``payload_digest`` (base32 SHA-1), ``record_type`` and ``refers_to``, one row for each page.

    * Null payload: empty, and equal to other empty ones.  Null URL: no target, empty key, first in order.
      Null id: the record has none, comes last among equals, and stays a response unless a page with an id
      has the same payload.
    * Equal rows give equal records.  Rows with the same id and payload refer to the same first page.
    * ``captured`` is when a page was fetched; without it the time is the epoch.
    * An empty table gives an empty result; further input columns do not matter.
    * Memory: an archive (at most :data:`ARCHIVE_RECORDS` records, unpacked record by record) and one index slice.
    """
    spark = pages.sparkSession
    folder = run_dir(spark, "captures")
    rows = pages.select(
        pages[id_col].cast("long").alias("id"),
        pages[url_col].cast("string").alias("url"),
        (F.lit(0).cast("timestamp") if captured is None else captured).alias("captured"),
        F.coalesce(pages[payload_col].cast("string"), F.lit("")).alias("payload"),
    )
    write_archives(rows, f"{folder}/archives", min_bytes)
    write_runs(spark, f"{folder}/archives", f"{folder}/runs")
    return merge_runs(spark, f"{folder}/runs")
