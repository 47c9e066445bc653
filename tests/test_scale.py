"""Skew, ordering and nearest neighbours against brute force on small fixtures."""

import random

import numpy as np
import pyarrow as pa
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemill.operators import compare, keyed, vector_cells, vectors
from tidemill.plans import ordered, skew
from tidemill.plans.shared import run_dir, shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """2000 rows; key 0 holds a third of them; times repeat."""
    rng = random.Random(1)
    rows = [(i, 0 if rng.random() < 0.34 else rng.randrange(1, 300), rng.randrange(50), f"v{i}") for i in range(2000)]
    return spark.createDataFrame(rows, "id bigint, k int, t bigint, v string").repartition(6).cache()


def test_hot_keys(spark, skewed):
    hot = skew.hot_keys(skewed, ["k"], rows=200)
    assert [r["k"] for r in hot.collect()] == [0]
    assert skew.hot_keys(skewed, ["k"]) is None  # no key too large for one task
    assert skew.hot_keys(skewed.limit(0), ["k"], rows=0) is None
    many, few = skew.split_hot(skewed, ["k"], hot)
    assert many.filter("k != 0").count() == 0 and many.count() + few.count() == 2000


def test_null_keys_are_not_lost(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [(i, i) for i in range(50)], "k int, i int")
    hot = skew.hot_keys(df, ["k"], rows=30)
    many, few = skew.split_hot(df, ["k"], hot)
    assert (many.count(), few.count()) == (50, 50)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_a_plain_join(spark, skewed, how):
    dim = spark.range(0, 200).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("d"))
    got = skew.lookup_join(skewed, dim, ["k"], how, rows=200, max_dim_rows=10)
    want = skewed.join(dim, ["k"], how)
    assert "Union" in plan_of(got) and "Union" not in plan_of(skew.lookup_join(skewed, dim, ["k"], how, max_dim_rows=10))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))


def test_broadcast_needs_a_proven_size(spark):
    small, large = spark.range(10), spark.range(1000)
    assert skew.fits_broadcast(small) and not skew.fits_broadcast(large, rows=500)
    assert not skew.fits_broadcast(large, size=100)
    assert "ResolvedHint (strategy=broadcast)" in skew.small_side(small)._jdf.queryExecution().analyzed().toString()


def test_broadcast_counts_bytes(spark):
    text = spark.createDataFrame([("é" * 500,)] * 20, "t string")  # 20 kB in UTF-8
    assert not skew.fits_broadcast(text, size=11_000) and skew.fits_broadcast(text, size=30_000)
    arrays = spark.createDataFrame([([1.0] * 1000,)] * 10, "v array<double>")
    assert not skew.fits_broadcast(arrays, size=50_000)


def test_history_of_one_large_key_among_many(spark):
    """A key of five slices among keys of one row each: found by its size, whatever its share."""
    many = spark.range(20_000).selectExpr("id + 1 AS k", "id AS t", "id")
    large = spark.range(1000).selectExpr("CAST(0 AS BIGINT) AS k", "id % 90 AS t", "id")
    df = many.unionByName(large)
    got = keyed.history_intervals(df, ["k"], ["t", "id"], rows=200)
    assert "Union" in plan_of(got)
    want = keyed.history_intervals(df, ["k"], ["t", "id"])
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(got.columns).collect()))


def test_global_index(spark, skewed):
    rows = sorted((r["t"], r["id"]) for r in skewed.collect())
    got = ordered.with_global_index(skewed, ["t", "id"], slices=5).collect()
    assert sorted((r["row_index"], r["t"], r["id"]) for r in got) == [(i, t, n) for i, (t, n) in enumerate(rows)]


def test_history_of_hot_keys_equals_the_window(spark, skewed):
    want = {r["id"]: r["valid_to"] for r in keyed.history_intervals(skewed, ["k"], ["t", "id"]).collect()}
    out = keyed.history_intervals(skewed, ["k"], ["t", "id"], rows=20)
    got = {r["id"]: r["valid_to"] for r in out.collect()}
    assert got == want and len(got) == 2000


def test_history_when_every_key_is_hot(spark):
    df = spark.range(200).select("id", (F.col("id") % 2).alias("k"), (F.col("id") * 3).alias("t"))
    out = keyed.history_intervals(df, ["k"], ["t", "id"], rows=20)
    assert {r["id"]: r["valid_to"] for r in out.collect()} == {i: (i + 2) * 3 if i < 198 else None for i in range(200)}


def test_top_per_key_limits_before_the_shuffle(spark, skewed):
    top = ordered.top_per_key(skewed, ["k"], ["t", "id"], 2)
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    by_key = {}
    for r in sorted(skewed.collect(), key=lambda r: (r["t"], r["id"])):
        by_key.setdefault(r["k"], []).append(r["id"])
    got = {}
    for r in top.orderBy("rank").collect():
        got.setdefault(r["k"], []).append(r["id"])
    assert got == {k: v[:2] for k, v in by_key.items()}


def test_latest_is_combined_before_the_shuffle(skewed):
    plan = plan_of(keyed.latest_by_key(skewed, ["k"], ["t", "id"]))
    assert "partial_max_by" in plan and "Window" not in plan


def test_compaction_sorts_no_whole_records(spark, sf):
    from tidemill.queries.base import event_records

    plan = plan_of(keyed.compact(event_records(spark, sf)))
    assert "SortAggregate" not in plan and "Sort " not in plan and "HashAggregate" in plan
    assert "partial_max(" in plan and "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def test_latest_of_hot_and_null_keys(spark):
    rows = [(i % 3 if i % 7 else None, i, f"v{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    want = {k: max(r for r in rows if r[0] == k) if k is not None else max((r for r in rows if r[0] is None), key=lambda r: r[1]) for k in {r[0] for r in rows}}
    for reread in (True, False):
        assert sorted(map(tuple, keyed.latest_by_key(df, ["k"], ["t"], reread).collect()), key=str) == sorted(want.values(), key=str)


def test_reconciliation_joins_reduced_rows_only(spark, sf):
    from tidemill.queries.base import event_records

    rec = event_records(spark, sf)
    plan = plan_of(compare.lag_by_topic(rec, rec.filter("offset < 10")))
    assert "partial_max" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_shared_folder_follows_the_session(spark):
    base = shared_dir(spark)
    assert run_dir(spark, "x").startswith(base) and run_dir(spark, "x") != run_dir(spark, "x")
    wanted = spark.conf.get("spark.checkpoint.dir", None)
    assert wanted is None or base == wanted.rstrip("/")


# -- nearest neighbours ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def space(spark):
    rng = np.random.default_rng(5)
    corpus = rng.integers(-3, 4, (400, 6)).astype(float)  # many exact ties
    queries = rng.integers(-3, 4, (30, 6)).astype(float)
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec_id bigint, embedding array<float>")
    q = spark.createDataFrame([(f"q{i}", v.tolist()) for i, v in enumerate(queries)], "query_id string, query array<double>")
    want = {}
    for i, v in enumerate(queries):
        d = np.sqrt(((corpus - v) ** 2).sum(axis=1))
        want[f"q{i}"] = [(int(j), float(d[j])) for j in sorted(range(400), key=lambda j: (d[j], j))[:7]]
    return c.repartition(5), q, want


def hits_of(df):
    out = {}
    for r in df.orderBy("rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["distance"]))
    return out


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert [i for i, _ in a[k]] == [i for i, _ in b[k]]
        assert np.allclose([d for _, d in a[k]], [d for _, d in b[k]])


def test_top_k_by_broadcast(space):
    c, q, want = space
    close(hits_of(vectors.top_k(c, q, 7)), want)


def test_top_k_by_cells(space, monkeypatch):
    c, q, want = space
    close(hits_of(vectors.top_k(c, q, 7, max_queries=5)), want)
    monkeypatch.setattr(vector_cells, "BLOCK_BYTES", 6 * 8 * 11)  # 11 rows of a cell at a time
    close(hits_of(vectors.top_k(c, q, 7, max_queries=5)), want)


def test_top_k_with_fewer_rows_than_k(space):
    c, q, _ = space
    assert {len(v) for v in hits_of(vectors.top_k(c.filter("vec_id < 3"), q, 7)).values()} == {3}
    assert vectors.top_k(c, q.limit(0), 7).count() == 0


def test_lsh_finds_most_and_is_exact_with_one_bucket(space):
    c, q, want = space
    exact = vectors.top_k(c, q, 7)
    assert vectors.recall(vectors.top_k(c, q, 7, lsh=(10, 4.0, 1)), exact).first()["recall"] > 0.8
    wide = vectors.recall(vectors.top_k(c, q, 7, lsh=(8, 1e6, 1)), exact).first()["recall"]
    assert wide > 0.99


def test_vectors_of_different_lengths_fail(spark, space):
    c, _, _ = space
    q = spark.createDataFrame([(1, [1.0, 2.0])], "query_id int, query array<double>")
    with pytest.raises(Exception, match="length"):
        vectors.top_k(c, q, 3).collect()


def test_contexts_and_prompts(spark):
    hits = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (2, 99, 1)], "query_id int, vec_id int, rank int")
    texts = spark.createDataFrame([(10, "ten"), (11, "eleven")], "doc_id int, text string")
    out = vectors.context_rows(hits, texts)
    assert [tuple(r) for r in out.collect()] == [(1, 2, "eleven\nten")]
    asked = spark.createDataFrame([(1, "why?"), (2, "{context}?")], "query_id int, question string")
    prompts = vectors.prompt_rows(out, asked, "C: {context} Q: {question}.")
    assert {r["query_id"]: r["prompt"] for r in prompts.collect()} == {1: "C: eleven\nten Q: why?.", 2: "C:  Q: {context}?."}


# -- vectors in cells ----------------------------------------------------------------------------


def test_vectors_sent_to_many_cells_leave_in_small_batches(monkeypatch):
    monkeypatch.setattr(vector_cells, "SEND_BYTES", 10_000)
    batch = pa.RecordBatch.from_pydict({"id": list(range(50)), "v": [[float(i)] * 16 for i in range(50)]})
    row, cell = np.nonzero(np.ones((50, 40), bool))
    parts = list(vector_cells._copies(batch, row, cell, row + cell / 100))
    assert max(p.select(["id", "v"]).nbytes for p in parts) < 12_000
    whole = pa.Table.from_batches(parts)
    assert whole["id"].to_pylist() == row.tolist() and whole["cell"].to_pylist() == cell.tolist()
    assert [v[0] for v in whole["v"].to_pylist()] == row.tolist() and whole["d"].to_pylist() == (row + cell / 100).tolist()
    assert not list(vector_cells._copies(batch, row[:0], cell[:0], row[:0].astype(float)))


@pytest.fixture(scope="module")
def clusters(spark):
    """Clustered vectors, one of them very common, and queries near and far."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, 8)) * 6
    corpus = centers[rng.integers(20, size=3000)] + rng.normal(size=(3000, 8))
    corpus[2000:] = corpus[2000]  # a third are copies
    asked = np.vstack((centers[rng.integers(20, size=300)] + rng.normal(size=(300, 8)), corpus[1990:2010], rng.normal(size=(5, 8)) * 40))
    c = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(corpus)], "vec_id long, embedding array<double>, cell string")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, query array<double>")
    d = np.sqrt(((asked[:, None] - corpus[None]) ** 2).sum(-1))
    return c.repartition(6), q.repartition(3), d


def test_exact_join_prunes_and_equals_brute_force(spark, clusters, monkeypatch):
    c, q, d = clusters
    cells = vector_cells.train_cells(c)
    want = {(i, int(j), r + 1) for i in range(len(d)) for r, j in enumerate(np.lexsort((np.arange(d.shape[1]), d[i]))[:9])}
    assert {(r.query_id, r.vec_id, r["rank"]) for r in vector_cells.knn_join(c, q, 9, cells).collect()} == want
    measured = spark.sparkContext.accumulator(0)
    kernel = vector_cells._nearest

    def counted(k):
        inner = kernel(k)

        def run(queries, rows):
            measured.add(queries.num_rows * rows.num_rows)
            return inner(queries, rows)

        return run

    monkeypatch.setattr(vector_cells, "_nearest", counted)
    monkeypatch.setattr(vector_cells, "BLOCK_BYTES", 8 * 8 * 100)  # the hot cell in blocks of 100 rows
    assert {(r.query_id, r.vec_id, r["rank"]) for r in vector_cells.knn_join(c, q, 9, cells).collect()} == want
    assert measured.value < 0.5 * d.size


def test_index_finds_most_and_measures_little(clusters):
    c, q, d = clusters
    near = q.filter("query_id < 300")
    cells = vector_cells.train_cells(c)
    probes, share = cells.tuned(9)
    got = vectors.recall(vector_cells.index_top_k(c, near, 9, cells, probes), vectors.top_k(c, near, 9)).first()
    met = vector_cells.pairs_met(c, near, cells, probes).first()
    assert got["recall"] >= 0.9 and met["n_pairs"] == 300 * 3000 and met["n_measured"] < 0.5 * met["n_pairs"] and share < 0.7
    whole = vector_cells.index_top_k(c, near, 9, cells, len(cells.centers))
    assert vectors.recall(whole, vectors.top_k(c, near, 9)).first()["recall"] == 1


@pytest.mark.parametrize("distance", [0.0, 2.5, 11.0])
def test_range_join_equals_brute_force(clusters, distance):
    c, q, d = clusters
    some = q.filter("query_id % 7 = 0 OR query_id > 318")
    ids = [r.query_id for r in some.select("query_id").collect()]
    got = {(r.query_id, r.vec_id) for r in vector_cells.range_join(c, some, distance).collect()}
    assert got == {(i, int(j)) for i in ids for j in np.flatnonzero(d[i] <= distance)}


def test_cells_of_odd_tables(spark, clusters):
    c, q, _ = clusters
    none, one = c.limit(0), spark.createDataFrame([("a", [1.0, 2.0]), ("b", None), ("c", [1.0, 2.0])], "vec_id string, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "query_id int, query array<double>")
    assert vector_cells.knn_join(none, q, 3).count() == 0 == vector_cells.range_join(none, q, 5.0).count() == vector_cells.knn_join(c, q.limit(0), 3).count()
    assert [tuple(r) for r in vector_cells.knn_join(one, asked, 5).orderBy("rank").collect()] == [(1, "a", 0.0, 1, 1.0), (1, "c", 0.0, 2, 1.0)]
    assert vector_cells.range_join(one, asked, 0.0).count() == 2
    with pytest.raises(Exception, match="length"):
        vector_cells.knn_join(c, asked, 3).collect()


def test_many_queries(spark):
    """More queries than are ever broadcast."""
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(30, 6)) * 5
    corpus, asked = (centers[rng.integers(30, size=n)] + rng.normal(size=(n, 6)) for n in (1500, 30_000))
    rows = [spark.createDataFrame(pd.DataFrame({"i": np.arange(len(x)), "v": list(x)}), "i long, v array<double>").repartition(4) for x in (corpus, asked)]
    got = vectors.top_k(rows[0].toDF("vec_id", "embedding"), rows[1].toDF("query_id", "query"), 2).toPandas().sort_values(["query_id", "rank"])
    d = np.sqrt(np.maximum((asked**2).sum(1)[:, None] + (corpus**2).sum(1)[None] - 2 * asked @ corpus.T, 0))
    want = np.argsort(d, axis=1, kind="stable")[:, :2]
    assert (got["vec_id"].to_numpy().reshape(-1, 2) == want).mean() > 0.9999
