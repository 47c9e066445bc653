"""Documents: text of pages, chunks, messages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.chunking import SEPARATORS, chunk_spans
from tidemill.functions.text import html_to_text, mask_emails
from tidemill.plans.skew import lookup_join

# --- fixed values -----------------------------------------------------------------------
CHUNK_SIZE = 2000
CHUNK_OVERLAP = 200
PREVIEW_CHARS = 500
# ----------------------------------------------------------------------------------------


def pages_to_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Replace a page by its visible text."""
    return df.withColumn(out, html_to_text(F.col(html))).drop(html)


def mask_emails_in(df: DataFrame, column: str = "text") -> DataFrame:
    """Hide the user part of e-mail addresses in free text."""
    return df.withColumn(column, mask_emails(F.col(column)))


def chunk_recursive(
    df: DataFrame,
    text: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that works,
    each starting up to ``overlap`` characters before the end of the previous one.

    Adds ``chunk_no``, ``start`` (offset in the text) and ``chunk``; drops the text.  One
    narrow pass over Arrow batches: documents are independent, whole texts are read.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    keep = [c for c in df.columns if c != text]
    schema = T.StructType(
        [df.schema[c] for c in keep]
        + [
            T.StructField("chunk_no", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("chunk", T.StringType()),
        ]
    )
    seps = tuple(separators)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, starts, chunks = [], [], [], []
            for row, doc in enumerate(batch.column(text).to_pylist()):
                for no, (lo, hi) in enumerate(chunk_spans(doc, size, overlap, seps) if doc else ()):
                    rows.append(row)
                    numbers.append(no)
                    starts.append(lo)
                    chunks.append(doc[lo:hi])
            others = [batch.column(c).take(pa.array(rows, pa.int64())) for c in keep]
            made = [pa.array(numbers, pa.int64()), pa.array(starts, pa.int64()), pa.array(chunks, pa.string())]
            yield pa.RecordBatch.from_arrays([*others, *made], names=schema.names)

    return df.select(*keep, text).mapInArrow(run, schema)


def chunk_fixed(
    df: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Windows of ``size`` characters, one every ``size - overlap``; the last one reaches
    the end of the text.  JVM-side."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    step = size - overlap
    n = F.char_length(text)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), last))
    return (
        df.withColumn("chunk_no", F.explode(starts))
        .withColumn("start", F.col("chunk_no").cast("bigint") * step)
        .withColumn("chunk_no", F.col("chunk_no").cast("bigint"))
        .withColumn("chunk", F.substr(text, F.col("start").cast("int") + 1, F.lit(size)))
        .drop(text)
    )


def document_messages(df: DataFrame, metadata: Sequence[str], text: str = "chunk") -> DataFrame:
    """One ``{"text", "metadata"}`` JSON message per chunk; metadata values are strings."""
    meta = F.struct(*[F.col(c).cast("string").alias(c) for c in metadata])
    body = F.to_json(F.struct(F.col(text).alias("text"), meta.alias("metadata")), {"ignoreNullFields": "false"})
    return df.withColumn("value", body)


def document_rows(text: Column, metadata: Column, embedding: Column) -> Column:
    """The row of a vector store: text, metadata and embedding."""
    return F.struct(text.alias("text"), metadata.alias("metadata"), embedding.alias("embedding"))


def attach_embeddings(df: DataFrame, vectors: DataFrame, on: str, vector: str = "embedding") -> DataFrame:
    """Each row with its vector from a table keyed by ``on``; rows without one keep null."""
    return lookup_join(df, vectors.select(on, vector), [on], "left")


def preview(df: DataFrame, text: str = "text", chars: int = PREVIEW_CHARS) -> DataFrame:
    """The first characters of a text for display; the text column is left whole."""
    return df.withColumn("preview", F.substring(text, 1, chars))
