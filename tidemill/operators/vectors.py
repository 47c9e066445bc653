"""Nearest-neighbour retrieval over an embedding table, and what is built from the hits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.vectors import Nearest, RandomProjection, ids_of, matrix_of
from tidemill.operators.vector_cells import knn_join
from tidemill.plans.ordered import top_per_key
from tidemill.plans.shared import materialize
from tidemill.plans.skew import fits_broadcast, small_side

# --- fixed values -----------------------------------------------------------------------
TOP_K = 10
SCORE_THRESHOLD = 0.75
# ----------------------------------------------------------------------------------------

#: a query table up to these limits is sent to all tasks; a larger one is joined by cells
MAX_QUERIES = 20_000
MAX_QUERY_BYTES = 256 << 20


def top_k(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    corpus_id: str = "vec_id",
    corpus_vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query",
    lsh: tuple[int, float, int] | None = None,
    max_queries: int = MAX_QUERIES,
) -> DataFrame:
    """Exact ``k`` nearest corpus rows of each query by Euclidean distance.

    Result: query id, corpus id, ``distance``, ``score`` = 1 / (1 + distance), ``rank``
    (ties by id).  Every task reads its part of the corpus once and keeps ``k`` rows per
    query, so no pairs are written and only ``queries * k`` rows per task are shuffled.

    More queries than ``max_queries`` are answered by :func:`~tidemill.operators.vector_cells.knn_join`, exactly as well.

    ``lsh`` = (tables, bucket length, seed) makes it approximate: only corpus rows that
    share a random-projection bucket with a query are measured.  An index that prunes is
    :func:`~tidemill.operators.vector_cells.index_top_k`.
    """
    c = corpus.select(corpus_id, F.col(corpus_vector).cast("array<double>").alias(corpus_vector)).filter(
        F.col(corpus_vector).isNotNull()
    )
    q = queries.select(query_id, F.col(query_vector).cast("array<double>").alias(query_vector)).filter(
        F.col(query_vector).isNotNull()
    )
    hits_schema = T.StructType(
        [q.schema[query_id], c.schema[corpus_id], T.StructField("distance", T.DoubleType())]
    )
    if not fits_broadcast(q, max_queries, MAX_QUERY_BYTES):
        return knn_join(c, q, k, None, corpus_id, corpus_vector, query_id, query_vector)
    pairs = _by_broadcast(c, q.toArrow(), k, hits_schema, lsh)
    ranked = top_per_key(pairs, [query_id], ["distance", corpus_id], k)
    return ranked.withColumn("score", 1.0 / (1.0 + F.col("distance")))


def _measure(near: Nearest, vectors: np.ndarray, ids: np.ndarray, projection, query_buckets) -> None:
    if projection is None:
        near.add(vectors, ids)
        return
    buckets = projection(vectors)

    def shares_bucket(lo: int, hi: int) -> np.ndarray:
        same = np.zeros((hi - lo, len(vectors)), bool)
        for t in range(buckets.shape[1]):
            same |= query_buckets[lo:hi, t][:, None] == buckets[:, t][None, :]
        return same

    near.add(vectors, ids, shares_bucket)


def _emit(near: Nearest, query_ids: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    rows, ids, dist = near.result()
    arrays = [
        pa.array(query_ids[rows]).cast(schema.field(0).type),
        pa.array(ids).cast(schema.field(1).type),
        pa.array(dist, pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.DoubleType: pa.float64()}
    return pa.schema([pa.field(f.name, kinds[type(f.dataType)]) for f in schema.fields])


def _by_broadcast(corpus: DataFrame, head: pa.Table, k: int, schema: T.StructType, lsh) -> DataFrame:
    out = _arrow(schema)
    if not head.num_rows:
        return corpus.sparkSession.createDataFrame([], schema)
    query_ids = ids_of(head.column(0).combine_chunks())
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, matrix_of(head.column(1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        near = Nearest(matrix, k)
        projection = RandomProjection(matrix.shape[1], *lsh) if lsh else None
        query_buckets = projection(matrix) if lsh else None
        for batch in batches:
            _measure(near, matrix_of(batch.column(1)), ids_of(batch.column(0)), projection, query_buckets)
        yield _emit(near, ids, out)

    return corpus.mapInArrow(run, schema)


def above_threshold(hits: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Hits with at least the given score.  The score falls with the distance, so the first
    ``k`` above the threshold are among the first ``k`` of all."""
    return hits.filter(F.col("score") >= threshold)


def recall(approximate: DataFrame, exact: DataFrame, query_id: str = "query_id", hit_id: str = "vec_id") -> DataFrame:
    """Share of the exact hits that the approximate search found; one row."""
    found = approximate.select(query_id, hit_id, F.lit(1).alias("_found"))
    both = exact.join(found, [query_id, hit_id], "left")
    return both.agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("_found").alias("n_found"),
        (F.count("_found") / F.count(F.lit(1))).alias("recall"),
    )


def context_rows(
    hits: DataFrame,
    texts: DataFrame,
    query_id: str = "query_id",
    hit_id: str = "vec_id",
    text_id: str = "doc_id",
    text: str = "text",
    sep: str = "\n",
) -> DataFrame:
    """The texts of each query's hits, joined in rank order; hits without a text are left out.

    The hits are few (queries times ``k``): they are kept once and, their size
    checked, sent to the texts; each list holds at most ``k`` texts.
    """
    found = materialize(hits.select(query_id, "rank", F.col(hit_id).alias(text_id)))
    joined = texts.select(text_id, text).join(small_side(found), text_id)
    parts = F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("t"))))
    context = F.array_join(F.transform(parts, lambda p: p["t"]), sep)
    return joined.groupBy(query_id).agg(F.count(F.lit(1)).alias("n_hits"), context.alias("context"))


def prompt_rows(contexts: DataFrame, questions: DataFrame, template: str, query_id: str = "query_id") -> DataFrame:
    """One prompt per question: ``template`` with ``{context}`` and ``{question}`` filled in."""
    pieces, rest = [], template
    while rest:
        at = {name: rest.find("{" + name + "}") for name in ("context", "question")}
        here = {name: i for name, i in at.items() if i >= 0}
        if not here:
            pieces.append(F.lit(rest))
            break
        name = min(here, key=here.get)
        pieces += [F.lit(rest[: here[name]]), F.coalesce(F.col(name), F.lit(""))]
        rest = rest[here[name] + len(name) + 2 :]
    return questions.join(contexts, query_id, "left").withColumn("prompt", F.concat(*pieces))


def class_means(df: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """The mean vector of each class; sums are combined before the shuffle."""
    cells = df.select(label, F.posexplode(F.col(vector)).alias("pos", "x"))
    means = cells.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy(label).agg(F.transform(ordered, lambda s: s["x"]).alias("query"))
