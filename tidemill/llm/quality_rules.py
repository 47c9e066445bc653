"""Quality rules: a threshold table compiled into one projection.

Each measure is a Spark expression over the words and lines of the text, each rule a pair of bounds on
a measure; the verdict is their conjunction.  No user function runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that separates words, and the characters counted as symbols.
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of English, French, German and Spanish, as they stand inside a sentence.
STOP_WORDS = (
    "the be to of and that have with in is it for on as was by this are from which "
    "de la le et les des que en un une du qui dans pour est au "
    "der die und das von zu ist mit den ein eine nicht im auf dem "
    "el los las por con del se una su no es lo"
).split()
BULLETS = ("-", "*", "•", "·", "–")


@dataclass(frozen=True)
class Rule:
    """A text passes if ``at_least <= measure <= at_most``; a bound of ``None`` is open."""

    name: str
    measure: str
    at_least: float | None = None
    at_most: float | None = None

    def passes(self) -> Column:
        bounds = []
        if self.at_least is not None:
            bounds.append(F.col(self.measure) >= self.at_least)
        if self.at_most is not None:
            bounds.append(F.col(self.measure) <= self.at_most)
        return reduce(lambda a, b: a & b, bounds, F.lit(True))


#: The base rules: length, and words in repeated three-word windows.
BASE = (Rule("few_words", "n_words", at_least=50), Rule("repeated_words", "repeat_share", at_most=0.5))
RULES = (
    Rule("word_length", "mean_word_chars", 3, 10),
    Rule("symbols", "symbol_share", at_most=0.1),
    Rule("stop_words", "stop_word_share", at_least=0.01),
    Rule("repeated_lines", "dup_line_share", at_most=0.5),
    Rule("bullet_lines", "bullet_line_share", at_most=0.9),
    Rule("ellipsis_lines", "ellipsis_line_share", at_most=0.3),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = (
    "repeat_share", "mean_word_chars", "symbol_share", "stop_word_share",
    "dup_line_share", "bullet_line_share", "ellipsis_line_share",
)


def _windows(words: Column, n: Column) -> Column:
    """All three-word windows with their place, equal windows side by side."""
    place = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(
        F.arrays_zip(
            F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c"), place.alias("i")
        )
    )


def _repeated(windows: Column) -> Column:
    """How many words lie in a window that occurs twice or more."""
    n = F.greatest(F.size(windows) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(windows, 1, n).alias("p"), F.slice(windows, 2, n).alias("q"))
    same = F.filter(
        pairs, lambda x: (x["p"]["a"] == x["q"]["a"]) & (x["p"]["b"] == x["q"]["b"]) & (x["p"]["c"] == x["q"]["c"])
    )
    places = F.transform(same, lambda x: F.array(*[x[side]["i"] + F.lit(d) for side in "pq" for d in range(3)]))
    return F.size(F.array_distinct(F.flatten(places)))


def _share(part: Column, whole: str) -> Column:
    return part / F.greatest(F.col(whole), F.lit(1))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (the input columns) with :data:`COUNTS` and :data:`SHARES`."""
    text = docs.select(F.struct("*").alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    split = text.select(
        "row",
        "text",
        F.array_remove(F.split("text", WORD_BREAK), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    trimmed = lambda line: F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    parts = split.select(
        "row",
        "words",
        "lines",
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).alias("n_symbols"),
        _windows(F.col("words"), F.greatest(F.size("words") - 2, F.lit(0))).alias("windows"),
        F.transform("lines", trimmed).alias("trimmed"),
    )
    counts = parts.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).alias("n_stop"),
        F.size(F.filter("trimmed", lambda s: F.left(s, F.lit(1)).isin(*BULLETS))).alias("n_bullet"),
        F.size(F.filter("trimmed", lambda s: s.endswith("...") | s.endswith("…"))).alias("n_ellipsis"),
    )
    # a generator, so that a filter on the verdict is not copied below with all of the measuring
    return counts.select(
        "row",
        F.inline(
            F.array(
                F.struct(
                    *COUNTS,
                    _share(F.col("n_repeat_words"), "n_words").alias("repeat_share"),
                    _share(F.col("word_chars"), "n_words").alias("mean_word_chars"),
                    _share(F.col("n_symbols"), "n_words").alias("symbol_share"),
                    _share(F.col("n_stop"), "n_words").alias("stop_word_share"),
                    _share(F.col("n_dup_lines"), "n_lines").alias("dup_line_share"),
                    _share(F.col("n_bullet"), "n_lines").alias("bullet_line_share"),
                    _share(F.col("n_ellipsis"), "n_lines").alias("ellipsis_line_share"),
                )
            )
        ),
    )


def apply_rules(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE
) -> DataFrame:
    """The input with the counts, the shares, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``.

    * Null and empty texts have no words and fail the base rules; their shares are 0.
    * A text of any length is measured whole; lines are split at ``\\n`` and count if they hold a word.
    * Equal rows get equal verdicts; an empty table gives an empty result.
    * Input columns named like a result column are replaced.
    """
    table = measured(docs, text_col)
    results = [*COUNTS, *SHARES]
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in [*base, *rules]]))
    verdicts = {
        "base_failed": ~reduce(lambda a, b: a & b, [r.passes() for r in base], F.lit(True)),
        "failed_rules": failed,
        "kept": reduce(lambda a, b: a & b, [r.passes() for r in [*base, *rules]], F.lit(True)),
    }
    taken = {n.lower() for n in [*results, *verdicts]}
    own = [f.name for f in table.schema["row"].dataType.fields if f.name.lower() not in taken]
    return table.select(
        *[F.col("row")[n].alias(n) for n in own], *results, *[c.alias(n) for n, c in verdicts.items()]
    )


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE) -> DataFrame:
    """The rows that pass every rule, with the input's columns."""
    passes = reduce(lambda a, b: a & b, [r.passes() for r in [*base, *rules]], F.lit(True))
    return measured(docs, text_col).filter(passes).select("row.*")
