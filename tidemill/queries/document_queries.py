"""Documents and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import documents as D
from tidemill.operators import vector_cells as V
from tidemill.operators import vectors as N
from tidemill.plans.shared import run_dir
from tidemill.queries.base import query, table, text
from tidemill.sources.sinks import write_vectors

PROMPT = "Use the context to answer.\n\n{context}\n\nQuestion: {question}\nAnswer:"


@query(
    r"""WITH t AS (SELECT page_id, url, html AS h FROM pages),
    a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
      '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'),
      '<[^>]*>', ' ', 'g') AS h FROM t),
    b AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(h, '&copy;', '©'), '&middot;', '·'),
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS h FROM a)
    SELECT page_id, url, trim(regexp_replace(h, '[ \t\r\n\f]+', ' ', 'g')) AS text FROM b"""
)
def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return D.pages_to_text(table(spark, sf, "pages"))


@query(
    """WITH s AS (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 2000) / 1800.0) AS BIGINT), 0) + 1))
      AS chunk_no FROM documents WHERE length(text) > 0)
    SELECT doc_id, chunk_no, chunk_no * 1800 AS start, md5(substring(text, chunk_no * 1800 + 1, 2000)) AS chunk_md5 FROM s"""
)
def chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    chunks = D.chunk_fixed(table(spark, sf, "documents").select("doc_id", "text"))
    return chunks.select("doc_id", "chunk_no", "start", F.md5("chunk").alias("chunk_md5"))


@query()
def chunk_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """No SQL twin: the cut points depend on each other.  The tests check the invariants."""
    chunks = D.chunk_recursive(table(spark, sf, "documents").select("doc_id", "text"))
    return chunks.select("doc_id", "chunk_no", "start", F.char_length("chunk").alias("n_chars"), F.md5("chunk").alias("md5"))


@query(
    """WITH s AS (SELECT doc_id, lang, source, text,
      unnest(range(0, greatest(CAST(ceil((length(text) - 2000) / 1800.0) AS BIGINT), 0) + 1)) AS n
      FROM documents WHERE length(text) > 0)
    SELECT doc_id, n AS chunk_no, md5(substring(text, n * 1800 + 1, 2000)) AS text_md5, lang, source FROM s"""
)
def document_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON messages of text and metadata, read back."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    messages = D.document_messages(D.chunk_fixed(docs), ["lang", "source"]).select("doc_id", "chunk_no", "value")
    doc = F.from_json("value", "text string, metadata map<string,string>")
    return messages.select(
        "doc_id", "chunk_no", F.md5(doc["text"]).alias("text_md5"),
        doc["metadata"]["lang"].alias("lang"), doc["metadata"]["source"].alias("source"),
    )


@query("SELECT doc_id, left(text, 500) AS preview FROM documents")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return D.preview(table(spark, sf, "documents")).select("doc_id", "preview")


@query(
    """SELECT doc_id, n_chars, CAST(embedding[1] AS DOUBLE) AS first_value, len(embedding) AS dims
    FROM documents LEFT JOIN embeddings ON vec_id = doc_id"""
)
def attach_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    out = D.attach_embeddings(docs, vectors, "doc_id")
    return out.select(
        "doc_id", "n_chars", F.get("embedding", F.lit(0)).cast("double").alias("first_value"),
        F.array_size("embedding").cast("bigint").alias("dims"),
    )


@query(
    """SELECT md5(text) AS text_md5, lang, CAST(embedding[1] AS DOUBLE) AS first_value
    FROM documents JOIN embeddings ON vec_id = doc_id"""
)
def vector_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Text, metadata and embedding landed as a table and read back."""
    vectors = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    docs = D.attach_embeddings(table(spark, sf, "documents"), vectors, "doc_id").filter(F.col("embedding").isNotNull())
    path = run_dir(spark, "vectors")
    write_vectors(docs.withColumn("metadata", F.create_map(F.lit("lang"), F.col("lang"))), path)
    back = spark.read.parquet(path)
    return back.select(
        F.md5("text").alias("text_md5"), F.col("metadata")["lang"].alias("lang"), F.col("embedding")[0].cast("double").alias("first_value")
    )


# -- retrieval: one question per class, its mean vector ------------------------------------------

_HITS = """
cells AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(x) AS x FROM cells GROUP BY 1, 2),
q AS (SELECT label AS query_id, list(x ORDER BY pos) AS v FROM means GROUP BY 1),
d AS (SELECT query_id, vec_id, list_distance(CAST(embedding AS DOUBLE[]), v) AS distance FROM q, embeddings),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d
  QUALIFY rank <= 10)
"""


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    return N.class_means(table(spark, sf, "embeddings")).withColumnRenamed("label", "query_id")


def _hits(spark: SparkSession, sf: str, **how) -> DataFrame:
    return N.top_k(table(spark, sf, "embeddings"), _questions(spark, sf), **how)


@query(f"WITH {_HITS} SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM hits")
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf).select("query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


@query(
    """WITH d AS (SELECT q.vec_id AS query_id, e.vec_id, list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance
      FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0),
    hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d QUALIFY rank <= 10)
    SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(1 / (1 + distance), 6) AS score FROM hits WHERE 1 / (1 + distance) >= 0.75"""
)
def vector_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """The neighbours of every fiftieth vector that are near enough: most of the ten are cut."""
    vectors = table(spark, sf, "embeddings")
    asked = vectors.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    hits = N.above_threshold(N.top_k(vectors, asked))
    return hits.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


_ASKED = """d AS (SELECT q.vec_id AS query_id, e.vec_id, list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance
      FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0)"""


def _fiftieth(vectors: DataFrame) -> DataFrame:
    return vectors.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))


@query(
    f"""WITH {_ASKED} SELECT query_id, vec_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
    round(distance, 6) AS distance FROM d QUALIFY rank <= 10"""
)
def vector_knn(spark: SparkSession, sf: str) -> DataFrame:
    """The exact neighbours of every fiftieth vector by a join of cells."""
    vectors = table(spark, sf, "embeddings")
    hits = V.knn_join(vectors, _fiftieth(vectors), 10)
    return hits.select("query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


@query(f"WITH {_ASKED} SELECT query_id, vec_id, round(distance, 6) AS distance FROM d WHERE distance <= 1.15")
def vector_range(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors within a distance of every fiftieth one, however many."""
    vectors = table(spark, sf, "embeddings")
    return V.range_join(vectors, _fiftieth(vectors), 1.15).select("query_id", "vec_id", F.round("distance", 6).alias("distance"))


@query(
    """SELECT count(*) AS n_queries, count(*) * least(10, (SELECT count(*) FROM embeddings)) AS n_exact,
    count(*) * (SELECT count(*) FROM embeddings) AS n_pairs, true AS recall_reached, true AS pruned FROM embeddings WHERE vec_id % 50 = 0"""
)
def vector_index(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth vector asked of the inverted lists: whether nine of ten true neighbours are found, and
    fewer than nine of ten pairs measured."""
    vectors = table(spark, sf, "embeddings")
    asked = _fiftieth(vectors)
    cells = V.train_cells(vectors)
    probes, _ = cells.tuned(10)
    exact = V.knn_join(vectors, asked, 10, cells)
    got = N.recall(V.index_top_k(vectors, asked, 10, cells, probes), exact)
    met = V.pairs_met(vectors, asked, cells, probes)
    return got.select(
        asked.agg(F.count(F.lit(1))).scalar().alias("n_queries"), "n_exact", met.select("n_pairs").scalar().alias("n_pairs"),
        (F.col("recall") >= 0.9).alias("recall_reached"), (met.select(F.col("n_measured") / F.col("n_pairs")).scalar() < 0.9).alias("pruned"),
    )


@query()
def vector_lsh(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate search and its recall; no SQL twin for the random projections."""
    return N.recall(_hits(spark, sf, lsh=(12, 1.0, 7)), _hits(spark, sf))


@query(
    f"""WITH {_HITS} SELECT query_id, count(*) AS n_hits, md5(string_agg(text, chr(10) ORDER BY rank)) AS context_md5
    FROM hits JOIN documents ON doc_id = vec_id GROUP BY 1"""
)
def context_rows(spark: SparkSession, sf: str) -> DataFrame:
    out = N.context_rows(_hits(spark, sf), table(spark, sf, "documents"))
    return out.select("query_id", "n_hits", F.md5("context").alias("context_md5"))


@query(
    f"""WITH {_HITS}, c AS (SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context
      FROM hits JOIN documents ON doc_id = vec_id GROUP BY 1),
    l AS (SELECT DISTINCT label AS query_id FROM embeddings)
    SELECT query_id, md5('Use the context to answer.' || chr(10) || chr(10) || coalesce(context, '') || chr(10) || chr(10)
      || 'Question: What is class ' || query_id || '?' || chr(10) || 'Answer:') AS prompt_md5
    FROM l LEFT JOIN c USING (query_id)"""
)
def prompt_rows(spark: SparkSession, sf: str) -> DataFrame:
    contexts = N.context_rows(_hits(spark, sf), table(spark, sf, "documents"))
    labels = table(spark, sf, "embeddings").select(F.col("label").alias("query_id")).distinct()
    asked = labels.withColumn("question", text("What is class ", F.col("query_id"), "?"))
    return N.prompt_rows(contexts, asked, PROMPT).select("query_id", F.md5("prompt").alias("prompt_md5"))
