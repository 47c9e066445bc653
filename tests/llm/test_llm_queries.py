"""The registered queries against their SQL twins, and the pipeline against its stages one by one."""

import random
import sys

import pytest
from oracle import compare, connect

import corpus_pipeline
from tidemill.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert compare(duck, df, ORACLES[name]) is None
    else:
        table = "pages" if name == "op1_warc_index" else "documents"
        assert df.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


def test_all_are_registered():
    sys.modules.pop("__spark_entry__", None)
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert set(entry.oracle_sql()) <= names


def test_pipeline(spark, sf):
    """Every stage against a plain version over the rows that the stage before kept."""
    from test_links import plain_lines, plain_near
    from test_texts import plain_hits

    from tidemill.llm.quality_rules import apply_rules

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {n: f for n, f in corpus_pipeline.STAGES}
    good = kept["quality rules"](spark, docs, sf)
    assert good.columns == columns
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in apply_rules(docs).filter("kept").collect())
    lines = kept["line dedup"](spark, good, sf)
    rows = [(r.doc_id, r.text) for r in good.collect()]
    texts = {i: t for i, _, _, t in plain_lines(rows, shingle=5)}
    assert lines.columns == columns and {r.doc_id: r.text for r in lines.collect()} == texts
    assert all(r.n_chars == len(r.text) for r in lines.join(good.select("doc_id", good.text.alias("t")), "doc_id").filter("text <> t").collect())
    near = kept["simhash near-dedup"](spark, lines, sf)
    rows = sorted(texts.items())
    firsts = {c for _, _, c in plain_near(rows)}
    assert near.columns == columns and {r.doc_id for r in near.collect()} == firsts
    clean = kept["benchmark decontamination"](spark, near, sf)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i for i in firsts if not plain_hits(texts[i], items)[3]}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want
    done = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in done.collect()} == want


def test_pipeline_holds_texts_once_and_one_python_worker_a_task(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert "text" not in corpus_pipeline._apart(docs).schema["_doc"].dataType.fieldNames()
    coded = corpus_pipeline.tokenize(spark, docs, sf)
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_pipeline_of_odd_tables(spark, sf, tmp_path):
    """Columns named like what the operators add, null and repeated rows, long texts, and empty tables."""
    from corpus import prose

    rng = random.Random(3)
    text = "\n".join(prose(rng, 30) + " stone." for _ in range(4))
    rows = [(1, text), (2, text), (2, text), (3, None), (None, text + " end"), (4, ""), (5, prose(rng, 180_000)), (None, None)]
    wide = "doc_id long, text string, n_chars int, n_removed int, kept_text string, n_words long, row int, th long, kept string, hits int, n_hit long, is_first string"
    docs = spark.createDataFrame([(i, t, len(t or ""), 7, "IN", 3, 8, 9, "k", 10, 11, "f") for i, t in rows], wide)
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns, name
        found = got.collect()
        assert found and all(tuple(r)[3:] == (7, "IN", 3, 8, 9, "k", 10, 11, "f") for r in found), name
        assert stage(spark, docs.limit(0), sf).collect() == []
    done = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert len(done) == len(rows) and sum(r.n_tokens == 0 for r in done) == 3
    lines = {(r.doc_id, r.text): r.n_chars for r in corpus_pipeline.lines(spark, docs, sf).collect()}
    assert all(n == len(t or "") for (_, t), n in lines.items()) and lines[2, ""] == 0
    spark.createDataFrame([], "doc_id long, text string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).count() == len(rows)
