"""Numpy kernels for nearest neighbours: small helpers that run inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: upper bound for the cells of one distance matrix (8 MB of doubles)
_CELLS = 1_000_000


def matrix_of(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a double matrix; all lists must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0:
        return flat.reshape(0, 0)
    if len(flat) % n:
        raise ValueError("vectors of different lengths")
    return flat.reshape(n, len(flat) // n)


def ids_of(column: pa.Array) -> np.ndarray:
    """Ids as a sortable array (integers or text)."""
    values = column.to_numpy(zero_copy_only=False)
    return values.astype(np.str_) if values.dtype == object else values


class Nearest:
    """The ``k`` nearest rows of every query, over batches that arrive one by one.

    Holds ``k`` rows per query at any time.  Ties are decided by id.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.norms = (queries * queries).sum(axis=1)
        self.rows = np.empty(0, np.int64)  # query index
        self.dist = np.empty(0, np.float64)  # squared distance
        self.ids: np.ndarray | None = None
        self.worst = np.full(len(queries), np.inf)  # k-th squared distance so far

    def add(self, vectors: np.ndarray, ids: np.ndarray, allowed=None) -> None:
        """Take in a batch; ``allowed(lo, hi)`` may give a mask of (query, row) candidates."""
        if not len(vectors):
            return
        if vectors.shape[1] != self.queries.shape[1]:
            raise ValueError("queries and vectors differ in length")
        step = max(1, _CELLS // len(vectors))
        norms = (vectors * vectors).sum(axis=1)
        found = []
        for lo in range(0, len(self.queries), step):
            hi = min(lo + step, len(self.queries))
            part = self.norms[lo:hi, None] + norms[None, :]
            # rounding error of the expanded form; the pairs let through are measured again
            slack = 1e-12 * vectors.shape[1] * (part.max() + 1.0)
            part -= 2.0 * (self.queries[lo:hi] @ vectors.T)
            if allowed is not None:
                part[~allowed(lo, hi)] = np.inf
            bound = self.worst[lo:hi]
            if len(vectors) > self.k:
                bound = np.minimum(bound, np.partition(part, self.k - 1, axis=1)[:, self.k - 1])
            q, r = np.nonzero((part <= (bound + 2 * slack)[:, None]) & np.isfinite(part))
            gap = self.queries[lo + q] - vectors[r]
            found.append((lo + q, (gap * gap).sum(axis=1), ids[r]))
        self._merge(found)

    def _merge(self, found: list) -> None:
        rows = np.concatenate([self.rows, *[f[0] for f in found]])
        dist = np.concatenate([self.dist, *[f[1] for f in found]])
        ids = np.concatenate([*([] if self.ids is None else [self.ids]), *[f[2] for f in found]])
        order = np.lexsort((ids, dist, rows))
        rows, dist, ids = rows[order], dist[order], ids[order]
        first = np.searchsorted(rows, rows, side="left")
        keep = np.arange(len(rows)) - first < self.k
        self.rows, self.dist, self.ids = rows[keep], dist[keep], ids[keep]
        full, counts = np.unique(self.rows, return_counts=True)
        ends = np.cumsum(counts) - 1
        done = counts == self.k
        self.worst[full[done]] = self.dist[ends[done]]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, id, distance) of all kept rows."""
        ids = np.empty(0, np.int64) if self.ids is None else self.ids
        return self.rows, ids, np.sqrt(self.dist)


class RandomProjection:
    """Bucketed random projections: near vectors share a bucket in some table."""

    def __init__(self, dims: int, tables: int, bucket: float, seed: int):
        planes = np.random.default_rng(seed).standard_normal((dims, tables))
        self.planes = planes / np.linalg.norm(planes, axis=0)
        self.bucket = bucket

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        return np.floor(vectors @ self.planes / self.bucket).astype(np.int64)


def nearest_centers(vectors: np.ndarray, centers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all centers, and the numbers of the ``n`` nearest ones (ties: the first)."""
    if not len(centers) or not len(vectors):
        return np.zeros((len(vectors), len(centers))), np.zeros((len(vectors), 0), np.int64)
    square = (vectors * vectors).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2.0 * (vectors @ centers.T)
    d = np.sqrt(np.maximum(square, 0.0))
    # the expanded form loses digits near zero: what is near is measured again
    row, col = np.nonzero(square < 1e-4 * (1.0 + (vectors * vectors).sum(1)[:, None]))
    gap = vectors[row] - centers[col]
    d[row, col] = np.sqrt((gap * gap).sum(1))
    return d, np.argsort(d, axis=1, kind="stable")[:, :n] if n else np.zeros((len(d), 0), np.int64)


def trained_centers(sample: np.ndarray, n: int, seed: int, rounds: int = 12) -> np.ndarray:
    """At most ``n`` centers of a sample by k-means; each first center is far from those before it, in proportion."""
    if not len(sample):
        return sample
    rng = np.random.default_rng(seed)
    centers = sample[rng.integers(len(sample), size=1)]
    left = ((sample - centers[0]) ** 2).sum(1)
    while len(centers) < n and left.sum() > 0:
        pick = min(int(np.searchsorted(np.cumsum(left), rng.random() * left.sum())), len(sample) - 1)
        centers = np.vstack((centers, sample[pick]))
        left = np.minimum(left, ((sample - sample[pick]) ** 2).sum(1))
    for _ in range(rounds):
        _, home = nearest_centers(sample, centers, 1)
        size = np.bincount(home[:, 0], minlength=len(centers))
        total = np.zeros_like(centers)
        np.add.at(total, home[:, 0], sample)
        moved = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centers)
        if np.allclose(moved, centers):
            break
        centers = moved
    return centers
