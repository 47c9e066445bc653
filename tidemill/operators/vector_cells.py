"""Vectors in cells: an inverted-list index, exact nearest-neighbour joins and distance range joins.

Centers are trained on a bounded sample.  Every vector belongs to its nearest center's cell and keeps its distance
``r`` to it, so by the triangle inequality a vector ``q`` at distance ``d`` of a center is no nearer than ``|d - r|`` to a
member.  Queries are sent only to cells that can matter, and a cell with many rows is met in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.vectors import Nearest, ids_of, matrix_of, nearest_centers, trained_centers
from tidemill.plans.ordered import top_per_key
from tidemill.plans.shared import materialize

#: cells at most, and rows of the sample for each of them: what the driver trains on is bounded
MAX_CELLS = 4096
SAMPLE_PER_CELL = 48
#: bytes of vectors that one block of a cell may hold per side
BLOCK_BYTES = 8 << 20
#: bytes of vectors that a task sends on at a time: a vector that goes to many cells is copied for each
SEND_BYTES = 4 << 20
#: neighbours of a vector that the number of cells is chosen by, how many of them should be found, and sampled vectors that are asked
TUNING_K, TARGET_RECALL, TUNING_ROWS = 10, 0.95, 1000
#: rounding of distances that are compared by the triangle inequality
SLACK = 1e-9


@dataclass(frozen=True)
class Cells:
    """Trained centers, one row each, and the vectors they were trained on."""

    centers: np.ndarray
    sample: np.ndarray

    def _places(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For every neighbour of sampled vectors, looked up by brute force in the sample, at which place its cell is among
        the cells by distance; and how many vectors the first, the first two, ... cells hold on average."""
        asked = self.sample[:TUNING_ROWS]
        near = Nearest(asked, k + 1)  # the vector itself is among them
        near.add(self.sample, np.arange(len(self.sample)))
        rows, ids, _ = near.result()
        _, home = nearest_centers(self.sample, self.centers, 1)
        _, order = nearest_centers(asked, self.centers, len(self.centers))
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
        size = np.bincount(home[:, 0], minlength=len(self.centers))
        others = rows != ids
        return place[rows, home[ids, 0]][others], np.cumsum(size[order], axis=1).mean(0)

    def tuned(self, k: int, target: float = TARGET_RECALL) -> tuple[int, float]:
        """The fewest cells to probe that find ``target`` of the ``k`` nearest of the sample's vectors, and the share of
        the sample that they hold."""
        if len(self.sample) <= k + 1 or len(self.centers) <= 1:
            return max(1, len(self.centers)), 1.0
        places, held = self._places(k)
        probes = int(np.quantile(places, target, method="inverted_cdf")) + 1
        return probes, float(held[probes - 1] / len(self.sample))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    return df.select(F.col(id_col).alias("id"), vector.alias("v")).filter(F.col("v").isNotNull())


def train_cells(corpus: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cells: int | None = None, seed: int = 7) -> Cells:
    """Centers by k-means over a sample: the ``SAMPLE_PER_CELL`` rows per cell that come first by a hash of the id.

    Without a number of ``cells`` those from a quarter to twice the square root of the number of vectors (``MAX_CELLS`` at most) are tried, and
    what has to be measured least for the same recall wins.  The sample is the same whatever the partitioning.  No
    vectors: no centers.
    """
    rows = _vectors(corpus, id_col, vector_col)
    n = rows.count()
    root = math.sqrt(n)
    tried = [cells] if cells else [round(root * f) for f in (0.25, 0.5, 1, 2)]
    tried = sorted({min(MAX_CELLS, max(1, c)) for c in tried})
    picked = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(min(n, max(2000, tried[-1] * SAMPLE_PER_CELL))).select("v").toArrow()
    sample = matrix_of(picked.column(0))
    made = [Cells(trained_centers(sample, c, seed), sample) for c in tried]
    return made[0] if len(made) == 1 else min(made, key=lambda c: c.tuned(TUNING_K)[1])


def in_cells(df: DataFrame, cells: Cells, n: int = 1) -> DataFrame:
    """``id`` and ``v`` with the ``n`` nearest cells of each vector: a row each, ``cell`` and distance ``d`` to its center."""

    def pick(d: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
        keep = np.zeros(d.shape, bool)
        np.put_along_axis(keep, np.argsort(d, axis=1, kind="stable")[:, :n], True, axis=1)
        return keep

    return _sent(df, cells, pick)


def _sent(df: DataFrame, cells: Cells, pick: Callable[[np.ndarray, pa.RecordBatch], np.ndarray]) -> DataFrame:
    """A row for each vector and cell that ``pick`` chooses from the distances to all centers."""
    shared = df.sparkSession.sparkContext.broadcast(cells.centers)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL("cell int, d double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = shared.value
        step = max(1, 500_000 // max(1, len(centers)))
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                vectors = matrix_of(batch.column("v"))
                if len(centers) and vectors.shape[1] != centers.shape[1]:
                    raise ValueError("vectors of different lengths")
                d, _ = nearest_centers(vectors, centers, 0)
                row, cell = np.nonzero(pick(d, batch))
                yield from _copies(batch, row, cell, d[row, cell])

    return df.mapInArrow(run, schema)


def _copies(batch: pa.RecordBatch, row: np.ndarray, cell: np.ndarray, d: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The given rows of a batch with their cells and distances, in batches of bounded bytes."""
    step = max(1, SEND_BYTES // max(1, batch.nbytes // max(1, batch.num_rows)))
    for i in range(0, len(row), step):
        part = slice(i, i + step)
        out = batch.take(pa.array(row[part]))
        columns = [*out.columns, pa.array(cell[part].astype(np.int32)), pa.array(d[part])]
        yield pa.RecordBatch.from_arrays(columns, names=[*out.schema.names, "cell", "d"])


def _blocks(sizes: DataFrame, width: int) -> Column:
    """How many blocks each cell is cut into, as a map: one entry for each cell, ``MAX_CELLS`` at most."""
    rows = max(1, BLOCK_BYTES // max(8, width * 8))
    counted = sizes.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.map_from_entries(F.collect_list(F.struct("cell", F.ceil(F.col("n") / rows).cast("int").alias("n"))))
    return counted.agg(pairs.alias("m")).scalar()


def _meet(members: DataFrame, asked: DataFrame, width: int, kernel, schema: T.StructType) -> DataFrame:
    """``kernel(queries, members)`` for every block of each cell that has both; a block's size is bounded."""
    m_blocks, q_blocks = _blocks(members, width), _blocks(asked, width)
    own = lambda blocks: F.coalesce(F.try_element_at(blocks, F.col("cell")), F.lit(1))
    place = lambda blocks: F.pmod(F.xxhash64("id"), own(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), own(blocks) - 1))
    m = members.withColumn("mb", place(m_blocks)).withColumn("qb", every(q_blocks))
    q = asked.withColumn("qb", place(q_blocks)).withColumn("mb", every(m_blocks))
    out = T.StructType([T.StructField("query", asked.schema["id"].dataType), T.StructField("hit", members.schema["id"].dataType), *schema.fields])
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.DoubleType: pa.float64()}
    arrow = pa.schema([pa.field(f.name, kinds[type(f.dataType)]) for f in out.fields])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return pa.Table.from_batches([], schema=arrow)
        found = kernel(queries.combine_chunks(), rows.combine_chunks())
        return pa.Table.from_arrays([pa.array(c).cast(f.type) for c, f in zip(found, arrow)], schema=arrow)

    by = ["cell", "qb", "mb"]
    return q.groupBy(*by).cogroup(m.groupBy(*by)).applyInArrow(run, out)


def _nearest(k: int):
    """The ``k`` nearest of a block, of those that a query's bound lets through."""

    def kernel(queries: pa.Table, rows: pa.Table) -> tuple:
        matrix, ids = matrix_of(queries.column("v")), ids_of(queries.column("id").combine_chunks())
        near = Nearest(matrix, k)
        vectors, hits = matrix_of(rows.column("v")), ids_of(rows.column("id").combine_chunks())
        allowed = None
        if "bound" in queries.column_names:
            bound, d, r = (t.column(c).to_numpy() for t, c in ((queries, "bound"), (queries, "d"), (rows, "d")))
            # a row may be as near as |d - r|
            allowed = lambda lo, hi: np.abs(d[lo:hi, None] - r[None, :]) <= bound[lo:hi, None] * (1 + SLACK) + SLACK
        near.add(vectors, hits, allowed)
        row, found, distance = near.result()
        return ids[row], found, distance

    return kernel


_DISTANCE = T.StructType([T.StructField("distance", T.DoubleType())])


def _named(hits: DataFrame, k: int, query_id: str, corpus_id: str) -> DataFrame:
    ranked = top_per_key(hits.withColumnsRenamed({"query": query_id, "hit": corpus_id}), [query_id], ["distance", corpus_id], k)
    return ranked.withColumn("score", 1.0 / (1.0 + F.col("distance")))


def index_top_k(
    corpus: DataFrame, queries: DataFrame, k: int, cells: Cells, probes: int | None = None, corpus_id: str = "vec_id",
    corpus_vector: str = "embedding", query_id: str = "query_id", query_vector: str = "query",
) -> DataFrame:
    """The ``k`` nearest rows of each query among the members of its ``probes`` nearest cells, by exact distance.

    Every corpus row is in the index.  ``probes`` defaults to what finds ``TARGET_RECALL`` of the sample's neighbours.  Columns as in
    :func:`~tidemill.operators.vectors.top_k`.  Null vectors are left out; no queries or no corpus give no rows.
    """
    rows, asked = _vectors(corpus, corpus_id, corpus_vector), _vectors(queries, query_id, query_vector)
    members, sent = in_cells(rows, cells), in_cells(asked, cells, probes or cells.tuned(k)[0])
    width = cells.centers.shape[1]
    return _named(_meet(members, sent, width, _nearest(k), _DISTANCE), k, query_id, corpus_id)


def pairs_met(
    corpus: DataFrame, queries: DataFrame, cells: Cells, probes: int, corpus_id: str = "vec_id", corpus_vector: str = "embedding",
    query_id: str = "query_id", query_vector: str = "query",
) -> DataFrame:
    """One row: how many pairs :func:`index_top_k` measures, and how many there are."""
    rows, asked = _vectors(corpus, corpus_id, corpus_vector), _vectors(queries, query_id, query_vector)
    a = in_cells(rows, cells).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    b = in_cells(asked, cells, probes).groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    met = a.join(b, "cell").agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("n_measured"))
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return met.select("n_measured", (count(rows) * count(asked)).alias("n_pairs"))


def knn_join(
    corpus: DataFrame, queries: DataFrame, k: int, cells: Cells | None = None, corpus_id: str = "vec_id",
    corpus_vector: str = "embedding", query_id: str = "query_id", query_vector: str = "query",
) -> DataFrame:
    """The exact ``k`` nearest corpus rows of every query, for any number of queries.

    First each query is answered from its two nearest cells; its ``k``-th distance bounds the rest.  Then it goes to the
    other cells only where the triangle inequality cannot rule all members out, and there only the rows are
    measured whose distance to the center leaves them possible.  Ties by id.
    """
    cells = train_cells(corpus, corpus_id, corpus_vector) if cells is None else cells
    rows, asked = _vectors(corpus, corpus_id, corpus_vector), _vectors(queries, query_id, query_vector)
    if not len(cells.centers):
        return _named(_none(rows, asked), k, query_id, corpus_id)
    width, first = cells.centers.shape[1], min(2, len(cells.centers))
    members = materialize(in_cells(rows, cells))
    near = materialize(_meet(members, in_cells(asked, cells, first), width, _nearest(k), _DISTANCE))
    best = top_per_key(near, ["query"], ["distance", "hit"], k).groupBy("query").agg(F.max("distance").alias("most"), F.count(F.lit(1)).alias("n"))
    bound = F.when(F.col("n") >= k, F.col("most")).otherwise(F.lit(math.inf))
    bounded = asked.join(best.withColumnRenamed("query", "id"), "id", "left").select("id", "v", F.coalesce(bound, F.lit(math.inf)).alias("bound"))
    low, high = _edges(members, len(cells.centers))

    def pick(d: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        limit = batch.column("bound").to_numpy()[:, None] * (1 + SLACK) + SLACK
        possible = (d - high[None, :] <= limit) & (low[None, :] - d <= limit)
        np.put_along_axis(possible, np.argsort(d, axis=1, kind="stable")[:, :first], False, axis=1)
        return possible

    rest = _meet(members, _sent(bounded, cells, pick), width, _nearest(k), _DISTANCE)
    return _named(near.unionByName(rest), k, query_id, corpus_id)


def _none(rows: DataFrame, asked: DataFrame) -> DataFrame:
    empty = asked.limit(0).select(F.col("id").alias("query"))
    return empty.join(rows.limit(0).select(F.col("id").alias("hit")), F.lit(False)).withColumn("distance", F.lit(0.0))


def _edges(members: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest distance to the center in each cell; one row for each cell."""
    low, high = np.full(n, np.inf), np.full(n, -np.inf)
    for r in members.groupBy("cell").agg(F.min("d").alias("low"), F.max("d").alias("high")).collect():
        low[r["cell"]], high[r["cell"]] = r["low"], r["high"]
    return low, high


def range_join(
    corpus: DataFrame, queries: DataFrame, distance: float, cells: Cells | None = None, corpus_id: str = "vec_id",
    corpus_vector: str = "embedding", query_id: str = "query_id", query_vector: str = "query",
) -> DataFrame:
    """Every pair of a query and a corpus row that are at most ``distance`` apart, with ``distance`` and ``score``.

    A query goes to the cells whose members can be so near; there the distance to the center rules rows out before
    they are measured.  There is no limit on partners.
    """
    cells = train_cells(corpus, corpus_id, corpus_vector) if cells is None else cells
    rows, asked = _vectors(corpus, corpus_id, corpus_vector), _vectors(queries, query_id, query_vector)
    if not len(cells.centers):
        pairs = _none(rows, asked)
    else:
        members = materialize(in_cells(rows, cells))
        low, high = _edges(members, len(cells.centers))
        limit = distance * (1 + SLACK) + SLACK

        def pick(d: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
            return (d - high[None, :] <= limit) & (low[None, :] - d <= limit)

        pairs = _meet(members, _sent(asked, cells, pick), cells.centers.shape[1], _within(distance), _DISTANCE)
    named = pairs.withColumnsRenamed({"query": query_id, "hit": corpus_id})
    return named.withColumn("score", 1.0 / (1.0 + F.col("distance")))


def _within(distance: float):
    def kernel(queries: pa.Table, rows: pa.Table) -> tuple:
        matrix, vectors = matrix_of(queries.column("v")), matrix_of(rows.column("v"))
        d, r = queries.column("d").to_numpy(), rows.column("d").to_numpy()
        order = np.argsort(r)
        vectors, r = vectors[order], r[order]
        ids, hits = ids_of(queries.column("id").combine_chunks()), ids_of(rows.column("id").combine_chunks())[order]
        limit = distance * (1 + SLACK) + SLACK
        out = [[], [], []]
        for i, (a, b) in enumerate(zip(np.searchsorted(r, d - limit), np.searchsorted(r, d + limit, "right"))):
            gap = vectors[a:b] - matrix[i]
            far = np.sqrt((gap * gap).sum(axis=1))
            found = np.flatnonzero(far <= distance)
            out[0].append(np.repeat(ids[i : i + 1], len(found)))
            out[1].append(hits[a:b][found])
            out[2].append(far[found])
        return tuple(np.concatenate(c) for c in out)

    return kernel
