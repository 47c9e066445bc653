"""Passages of a benchmark in training documents, found by winnowing.

A text's fingerprints are the least hash of every ``w`` consecutive hashes of ``k`` words.  Any shared span
of ``w + k - 1`` words has a fingerprint in common, so the join of training and test fingerprints misses
none.  A hit names a diagonal (document place less item place), which is then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import NO_ID
from tidemill.plans.skew import small_side

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what separates words after lower-casing.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: words of a hashed gram, where the guaranteed span allows it
GRAM = 5


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, WORD_BREAK), "")


def _places(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def fingerprints(df: DataFrame, span: int, *keep: str) -> DataFrame:
    """``keep`` with ``fp`` and ``place`` (from 1): the winnowed fingerprints of the column ``words``,
    such that two texts that share ``span`` consecutive words share one."""
    k = min(GRAM, span)
    w = span - k + 1
    hashed = df.select(*keep, F.transform("words", lambda x: F.xxhash64(x)).alias("h"))
    last = F.size("h") - (k - 1)
    grams = hashed.select(
        *keep, F.transform(_places(last), lambda i: F.xxhash64(*[F.get("h", i + (j - 1)) for j in range(k)])).alias("g")
    )

    def least(i: Column) -> Column:
        window = F.slice("g", i, F.lit(w))
        return (i - 1 + F.array_position(window, F.array_min(window))).cast("int")

    chosen = _places(F.size("g") - (w - 1))
    places = F.array_distinct(F.transform(chosen, least)) if w > 1 else chosen
    picked = grams.select(*keep, "g", places.alias("p"))
    return picked.select(
        *keep, F.inline(F.transform("p", lambda i: F.struct(F.get("g", i - 1).alias("fp"), i.alias("place"))))
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
    one_in: int = 20,
) -> DataFrame:
    """The input with ``n_words``, ``n_hit`` (words inside any occurrence of an item's window), ``hit_words`` (their
    places from 0, ascending), ``items`` (ids of items with occurring windows, sorted as strings) and
    ``contaminated`` (one word in ``one_in`` or more, and at least one, is hit).

    A window is ``window`` consecutive words of an item; a shorter item that has words is one window.
    Words are runs of characters other than ASCII ones that are no digit or letter, after lower-casing A-Z.

    * Null and empty texts have no words and are clean; null or empty items match nothing.
    * Items without an id mark words but are not listed; items with equal ids are listed once.
    * Equal rows get equal results; an empty table of either kind gives no hits.
    * Input columns named like a result column are replaced.
    * Test fingerprints go to every task only if they are proven small, else both sides are shuffled.
    """
    # input columns are kept aside under one name, so that none can clash
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("rank"),
        F.xxhash64(docs[text_col].cast("string")).alias("th"),
    )
    text = F.col("row")[text_col]
    items = (
        benchmark.select(benchmark[item_id_col].cast("string").alias("item"), words_of(benchmark[item_text_col]).alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
        .withColumn("key", F.xxhash64("item", "words"))
    )
    long_items, short_items = items.filter(F.size("words") >= window), items.filter(F.size("words") < window)
    shortest = short_items.agg(F.min(F.size("words"))).first()[0]
    worded = rows.select("rank", "th", words_of(text).alias("words"))
    hits = None
    for span, tests in ((window, long_items), (shortest, short_items)):
        if span is None:
            continue
        prints = fingerprints(tests, span, "key").withColumnsRenamed({"place": "at"})
        enough = worded.filter(F.size("words") >= span)
        found = fingerprints(enough, span, "rank", "th").join(small_side(prints), "fp")
        diagonals = found.select("rank", "th", "key", (F.col("place") - F.col("at")).alias("offset"))
        hits = diagonals if hits is None else hits.unionByName(diagonals)
    per_pair = hits.distinct().join(small_side(items), "key")
    per_doc = per_pair.groupBy("rank", "th").agg(F.collect_list(F.struct("item", "offset", "words")).alias("hits"))
    joined = rows.join(per_doc, ["rank", "th"], "left").select("row", words_of(text).alias("words"), "hits")

    def occurring(hit: Column) -> Column:
        """The item with the document places (from 1) where a whole window of it agrees."""
        size = F.least(F.size(hit["words"]), F.lit(window))
        starts = F.filter(
            F.sequence(F.lit(1), F.size(hit["words"]) - size + 1),
            lambda i: (i + hit["offset"] >= 1)
            & (F.slice(hit["words"], i, size) == F.slice("words", F.greatest(i + hit["offset"], F.lit(1)), size)),
        )
        covered = F.flatten(F.transform(starts, lambda i: F.sequence(i + hit["offset"], i + hit["offset"] + size - 1)))
        return F.struct(hit["item"].alias("item"), covered.alias("covered"))

    found = joined.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.filter(F.transform(F.coalesce("hits", F.array().cast(joined.schema["hits"].dataType)), occurring),
                 lambda x: F.size(x["covered"]) > 0).alias("hits"),
    )
    result = found.select(
        "row",
        F.inline(
            F.array(
                F.struct(
                    "n_words",
                    F.transform(F.array_sort(F.array_distinct(F.flatten("hits.covered"))), lambda i: i - 1).alias("hit_words"),
                    F.array_sort(F.array_distinct(F.array_compact("hits.item"))).alias("items"),
                )
            )
        ),
    )
    n_hit = F.size("hit_words").cast("long")
    names = ("n_words", "n_hit", "hit_words", "items", "contaminated")
    own = [f.name for f in result.schema["row"].dataType.fields if f.name.lower() not in names]
    return result.select(
        *[F.col("row")[n].alias(n) for n in own],
        "n_words",
        n_hit.alias("n_hit"),
        "hit_words",
        "items",
        ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"),
    )
