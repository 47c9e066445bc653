"""The operators over the given tables, with SQL twins where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.entropy_scan import ACCESS, ASSIGN, HEX, candidate
from tidemill.llm.quality_rules import STOP_WORDS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
d AS (SELECT doc_id, coalesce(w, []) AS w, len(coalesce(w, [])) AS n FROM w),
s AS (SELECT doc_id, unnest(range(1, n - 11)) AS i, w FROM d WHERE n > 12),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM s),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS first FROM h),
g AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM f WHERE first < doc_id GROUP BY doc_id)
SELECT doc_id, n AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
         list_transform(list_filter(list_zip(w, range(1, n + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""
)
def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.token_windows import remove_repeated_windows

    got = remove_repeated_windows(read(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op6_longest_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.longest_factor import remove_repeated_strings

    got = remove_repeated_strings(read(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    n_spans = F.size("removed_spans").cast("long").alias("n_spans")
    return got.select("doc_id", "n_bytes", "n_removed", n_spans, F.sha2("kept_bytes", 256).alias("kept_sha256"))


@query(
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\v\f\r]')) AS lines FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) > 2),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM s),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, w, lines, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    list_transform(lines, lambda x: regexp_replace(x, '^[ \t\n\v\f\r]+|[ \t\n\v\f\r]+$', '', 'g')) AS t,
    string_split('STOP', ' ') AS stop
  FROM d LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    word_chars >= 3 * n_words AND word_chars <= 10 * n_words AND n_symbols <= 0.1 * n_words
    AND len(list_filter(w, lambda x: list_contains(stop, x))) >= 0.01 * n_words
    AND n_dup_lines <= 0.5 * len(lines)
    AND len(list_filter(t, lambda x: x[1:1] IN ('-', '*', '•', '·', '–'))) <= 0.9 * len(lines)
    AND len(list_filter(t, lambda x: x LIKE '%...' OR x LIKE '%…')) <= 0.3 * len(lines) AS good FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND good AS kept FROM v
""".replace("STOP", " ".join(STOP_WORDS))
)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.quality_rules import apply_rules

    got = apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


@query(
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS size FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
t AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS t
      FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
s AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS t
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM b) WHERE len(w) >= size)),
h AS (SELECT doc_id, i, size, item_id FROM s JOIN t USING (size, t)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
)
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.decontaminate import contamination

    docs, benchmark = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark")
    got = contamination(docs, benchmark)
    return got.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.simhash import near_duplicates

    got = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, radius=4)
    return got.select("doc_id", "fingerprint", "component_id")


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemill.llm.bpe import decode, encode

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = decode(coded.drop("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.fuzzy_lines import remove_similar_lines

    got = remove_similar_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=5)
    return got.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
)
def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.warc_index import capture_histories

    # the table has no fetch times: pages were fetched one a second in the order of their ids
    fetched = F.timestamp_seconds(F.lit(1_704_067_200) + F.coalesce("page_id", F.lit(0)))
    got = capture_histories(read(spark, sf_dir, "pages"), captured=fetched)
    return got.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _located_sql(pattern: str, keep: str = "true") -> str:
    """Starts, ends and texts of all matches, by adding up what lies between them."""
    p = pattern.replace("'", "''")
    return f"""
      (SELECT list({{'t': m, 's': s, 'e': s + length(m)}}) FROM (
        SELECT m, i, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i, g, ms
              FROM (SELECT regexp_extract_all(text, '{p}') AS ms, string_split_regex(text, '{p}') AS g))) WHERE {keep})"""


@query(
    rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, {_located_sql(ASSIGN, "length(regexp_extract(m, '" + ASSIGN.replace("'", "''") + "', 2)) >= 6")} AS a,
  {_located_sql(ACCESS)} AS k, {_located_sql(HEX)} AS h, {_located_sql(candidate(20))} AS c FROM d),
e AS (SELECT *, list_transform(list_filter(coalesce(c, []), lambda x: NOT regexp_matches(x.t, '^[A-Za-z+/_=-]+$') AND NOT regexp_matches(x.t, '^[0-9+/_=-]+$')
    AND NOT regexp_matches(x.t, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
    AND NOT regexp_matches(x.t, '(?i)abcdefghij|0123456789|9876543210')),
    lambda x: {{'s': x.s, 'w': list_filter(range(0, length(x.t) - 19), lambda i: list_aggregate(string_split(substr(x.t, 1 + i, 20), ''), 'entropy')
       >= CASE WHEN regexp_matches(substr(x.t, 1 + i, 20), '^[0-9a-fA-F]+$') THEN 2.9 ELSE 3.7 END - 1e-9)}}) AS w FROM f),
n AS (SELECT *, list_transform(coalesce(a, []), lambda x: {{'s': x.s, 'o': 0, 'e': x.e}}) AS na, list_transform(coalesce(k, []), lambda x: {{'s': x.s, 'o': 1, 'e': x.e}}) AS nk,
    list_transform(coalesce(h, []), lambda x: {{'s': x.s, 'o': 2, 'e': x.e}}) AS nh,
    list_transform(list_filter(w, lambda x: len(x.w) > 0), lambda x: {{'s': x.s + list_min(x.w), 'o': 3, 'e': x.s + list_max(x.w) + 20}}) AS ne FROM e),
r AS (SELECT doc_id, len(na) AS n_assign, len(nk) AS n_access, len(nh) AS n_hex, list_sort(na || nk || nh) AS base, list_sort(na || nk || nh || ne) AS every FROM n)
SELECT doc_id, n_assign, n_access, n_hex,
  sha256(array_to_string(list_transform(base, lambda x: ['assign', 'access', 'hex', 'entropy'][CAST(x.o AS INTEGER) + 1] || ':' || x.s || ':' || x.e), ',')) AS base_sha256,
  array_to_string(list_transform(every, lambda x: ['assign', 'access', 'hex', 'entropy'][CAST(x.o AS INTEGER) + 1] || ':' || x.s || ':' || x.e), ',') AS spans
FROM r
"""
)
def op9_entropy_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.entropy_scan import listed, scan

    got = scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = F.sha2(listed(of("assign", "access", "hex")), 256).alias("base_sha256")
    return got.select("doc_id", *counts, base, listed(F.col("secrets")).alias("spans"))


@query()
def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.pseudonyms import pseudonymize

    got = pseudonymize(read(spark, sf_dir, "documents").select("doc_id", "text"), key="corpus-2024")
    return got.select("doc_id", F.size("replaced").cast("long").alias("n_replaced"), F.col("safe_text").alias("text"))


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemill.llm.alignment import align, score_links

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    linked = align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return score_links(linked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "links", digest))


@query()
def op13_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.ngram_model import score_texts

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return score_texts(docs, F.crc32(F.encode(name, "UTF-8")) % 7 != 2)


_CRC = """list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda crc, b: list_reduce(range(0, 8), lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(crc, b)), 4294967295)"""


@query(
    f"""
WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS turn,
      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor({_CRC}, 4294967295) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, p, turn FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND p <= h
      UNION ALL SELECT conv_id, p, turn FROM c JOIN t USING (conv_id) WHERE p > h),
s AS (SELECT conv_id, coalesce(list(turn ORDER BY p) FILTER (p IS NOT NULL), []) AS seq FROM c LEFT JOIN b USING (conv_id) GROUP BY conv_id),
g AS (SELECT d, seq[1:d] AS pre, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = d), '') AS ends
    FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM s) GROUP BY d, pre),
k AS (SELECT d - 1 AS d, pre[1:d - 1] AS pre, count(*) AS n FROM g WHERE d > 0 GROUP BY ALL),
w AS (SELECT g.d, g.pre, coalesce(n, 0) AS n_children, CASE WHEN n IS NULL THEN 1 ELSE 0 END AS leaf,
      CASE WHEN g.d = 0 THEN 0 ELSE (n_convs - 1) * length(pre[g.d].t) END AS saved FROM g LEFT JOIN k USING (d, pre)),
u AS (SELECT a AS d, pre[1:a] AS pre, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM w) GROUP BY ALL)
SELECT g.conv_id, g.d AS depth, up.conv_id AS parent_conv_id, g.n_convs, w.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM g JOIN w USING (d, pre) JOIN u USING (d, pre) LEFT JOIN g up ON up.d = g.d - 1 AND up.pre = g.pre[1:g.d - 1]
"""
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemill.llm.prefix_trie import numbered_turns, prefix_nodes

    turns = numbered_turns(read(spark, sf_dir, "conversations"))
    opened, conversations = open_alike(turns)
    return prefix_nodes(opened, conversations)


def open_alike(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt, and their ids: it opens with the first h turns of the first conversation of its block of
    ids, h = crc32(id) mod ``most``, and goes on with its own turns after as many."""
    c, h = F.col("conv"), F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % most
    conversations = turns.select("conv").distinct()
    # at most ``most - 1`` turns of one conversation in each block
    first = turns.filter((c % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "block")
    opening = conversations.withColumn("block", c - c % block).join(first, "block").filter(F.col("pos") <= h)
    own = turns.filter(F.col("pos") > h)
    return own.unionByName(opening.select(*own.columns)), conversations
