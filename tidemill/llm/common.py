"""Rows with a key, Arrow text buffers and packed blocks: what several operators share."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rank of a row without an id: after every other row.
NO_ID = 2**63 - 1
#: Bytes of text that one step in a task works on; a longer document is a step of its own.
CHUNK_BYTES = 3 << 20


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all input columns, so that no name can clash), ``rank`` (the id; rows without one
    come last), ``th`` (a hash of the text, which tells rows with the same id apart) and ``text``
    (null becomes empty)."""
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("rank"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    ).withColumn("th", F.xxhash64("text"))


def spread(df: DataFrame, *names: str) -> DataFrame:
    """The columns of ``row`` followed by ``names``, which replace input columns of the same name."""
    taken = {n.lower() for n in names}
    own = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col("row")[n].alias(n) for n in own], *names)


def with_row(df: DataFrame, ddl: str) -> StructType:
    """The schema of ``row`` and the columns of ``ddl``."""
    return StructType([df.schema["row"], *StructType.fromDDL(ddl).fields])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows, without a copy."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32) if len(column) else np.zeros(1, np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(
    batches: Iterable[pa.RecordBatch], in_row: str | None = None, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with at most ``limit`` bytes of text at a time: (rows, bytes, offsets from 0).

    The text is the column ``text`` or, so that it travels once, the field ``in_row`` of ``row``.
    """
    for batch in batches:
        if in_row is None:
            column = batch.column("text")
        else:
            column = batch.column("row").field(in_row)
            if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
                column = column.cast(pa.string())
        data, off = text_buffers(column)
        i = 0
        while i < batch.num_rows:
            j = max(int(np.searchsorted(off, off[i] + limit, "right")) - 1, i + 1)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, bytes of equal significance together: sorted and small
    numbers shrink."""
    parts = [struct.pack("<B", len(arrays))]
    for a in arrays:
        parts.append(struct.pack("<Q", len(a)))
        parts.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(block: bytes, *dtypes: type) -> list[np.ndarray]:
    """The arrays of :func:`pack`."""
    raw = zstandard.ZstdDecompressor().decompress(block)
    at, out = 1, []
    for dtype in dtypes:
        (n,) = struct.unpack_from("<Q", raw, at)
        at += 8
        size = np.dtype(dtype).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(n))
        at += n * size
    return out


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def slots(hashes: np.ndarray, n: int) -> np.ndarray:
    """The partition of each hash, in the order of the hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def batch_of(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
