"""Secrets in text: known shapes, and strings whose characters look drawn at random.

Candidates are long runs of key characters.  A window slides over each; the counts of its characters change by
one that enters and one that leaves, and with them the sum from which the Shannon entropy follows.  The
threshold depends on the character class of the window; what the allow list matches is no secret.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.matches import between, bound, found, located

#: The shapes that are always secrets.  Lengths that a greedy run makes certain are part of the pattern.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
#: The characters of candidates; a character's place is its counter.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


@dataclass(frozen=True)
class CharacterClass:
    """Windows whose characters all match ``pattern`` need ``bits`` bits a character; the first class holds."""

    name: str
    pattern: str
    bits: float


CLASSES = (CharacterClass("hex", "^[0-9a-fA-F]+$", 2.9), CharacterClass("base64", "^[A-Za-z0-9+/_=-]+$", 3.7))
#: Words without a digit, plain numbers, UUIDs, and rows of the alphabet.
ALLOW = (
    "^[A-Za-z+/_=-]+$",
    "^[0-9+/_=-]+$",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?i)abcdefghij|0123456789|9876543210",
)


def candidate(window: int) -> str:
    return f"[A-Za-z0-9+/_=-]{{{window},}}"


def window_edges(text: Column, window: int, classes: Sequence[CharacterClass]) -> Column:
    """``low`` and ``high``: where (code points from 1) the first and the last window of ``window`` characters end that have
    the entropy of their class or more; null if none has.

    The state of the slide has a fixed size: the counts packed into longs, the entropy's sum in fixed point, how many
    characters are foreign to each class, and the two places.
    """
    width = window.bit_length()
    per = 63 // width
    fields = [f"f{k}" for k in range(-(-len(ALPHABET) // per))]
    scale = 1 << 40
    whole = lambda numbers: F.lit([int(x) for x in numbers]).cast("array<bigint>")
    weight = whole(round(n * math.log2(n) * scale) if n > 1 else 0 for n in range(window + 2))
    foreign = [whole([0, *(not re.search(c.pattern, x) for x in ALPHABET)]) for c in classes]
    # code 0 stands for no character: its counter is never read
    shift = lambda code: ((code - 1) % per) * width
    field = lambda code: F.floor((code - 1) / per).cast("int")

    def counted(state: Column, code: Column, by: int) -> Column:
        """The state with a character more or less; nothing changes for code 0."""
        packed = F.get(F.array(*[state[f] for f in fields]), field(code))
        mask = F.lit((1 << width) - 1).cast("bigint")
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift(code))

        def changed(n: Column) -> Column:
            new = {f: F.when(field(code) == k, state[f] + by * one).otherwise(state[f]) for k, f in enumerate(fields)}
            total = state["sum"] - F.get(weight, n) + F.get(weight, n + by)
            others = [(state[f"o{k}"] + by * F.get(t, code)).alias(f"o{k}") for k, t in enumerate(foreign)]
            return F.struct(*[c.alias(f) for f, c in new.items()], total.alias("sum"), *others, state["low"].alias("low"), state["high"].alias("high"))

        count = F.call_function("shiftright", packed, shift(code)).bitwiseAND(mask).cast("int")
        return F.when(code == 0, state).otherwise(bound(count, changed))

    def slide(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            leaving = F.when(i > window, F.get(codes, i - 1 - window)).otherwise(0)
            return bound(bound(counted(state, leaving, -1), lambda s: counted(s, F.get(codes, i - 1), 1)), lambda s: judged(s, i))

        none = F.lit(None).cast("int")
        zero = F.lit(0).cast("bigint")
        start = F.struct(
            *[zero.alias(f) for f in fields], zero.alias("sum"), *[zero.alias(f"o{k}") for k in range(len(classes))],
            none.alias("low"), none.alias("high"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high")))

    def judged(state: Column, i: Column) -> Column:
        # the entropy is log2(window) - sum / window: a class asks for a sum of so much at most
        most = [math.floor((math.log2(window) - c.bits + 1e-9) * window * scale) for c in classes]
        limit = F.coalesce(*[F.when(state[f"o{k}"] == 0, F.lit(m)) for k, m in enumerate(most)], F.lit(-1)).cast("bigint")
        passes = (i >= window) & (state["sum"] <= limit)
        kept = [state[c].alias(c) for c in (*fields, "sum", *[f"o{k}" for k in range(len(classes))])]
        low = F.when(passes, F.coalesce(state["low"], i)).otherwise(state["low"]).alias("low")
        return F.struct(*kept, low, F.when(passes, i).otherwise(state["high"]).alias("high"))

    return bound(F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c)), slide)


def scan(
    docs: DataFrame,
    text_col: str = "text",
    window: int = 20,
    classes: Sequence[CharacterClass] = CLASSES,
    allow: Sequence[str] = ALLOW,
) -> DataFrame:
    """The input with ``secrets``: an array of ``kind``, ``start`` and ``end`` (code points, end exclusive), ordered by
    start, then kind as in :data:`KINDS`.

    An entropy span reaches from the first to the last window of a candidate that passes.  It may overlap a
    span of a known shape; those always stay.  The class is the window's own: a hexadecimal secret is found with a
    name or path glued to it, and so is a number of ``window`` digits.  The allow list is for whole candidates.

    * Null and empty texts have none.  Texts and candidates of any length are scanned whole: in time that grows with a candidate's length,
      and with the power 1.5 of the number of matches in a text.
    * Equal rows get equal results; an empty table gives an empty result.
    * An input column named ``secrets`` is replaced.
    """
    text = docs.select(F.struct("*").alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": candidate(window)}
    cut = text.select(
        "row",
        *[found("text", p).alias(f"m_{k}") for k, p in patterns.items()],
        *[between("text", p).alias(f"p_{k}") for k, p in patterns.items()],
    )
    placed = cut.select("row", *[located(f"m_{k}", f"p_{k}").alias(k) for k in KINDS])

    def named(kind: str, spans: Column) -> Column:
        order = F.lit(KINDS.index(kind))
        return F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), order.alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind"))
        )

    def passing(s: Column) -> Column:
        return bound(
            window_edges(s["text"], window, classes),
            lambda e: F.struct(s["start"].alias("base"), e["low"].alias("low"), e["high"].alias("high")),
        )

    suspects = F.filter("entropy", lambda s: ~reduce(lambda a, b: a | b, [s["text"].rlike(p) for p in allow], F.lit(False)))
    random = F.transform(
        F.filter(F.transform(suspects, passing), lambda s: s["low"].isNotNull()),
        lambda s: F.struct((s["base"] + s["low"] - window).alias("start"), (s["base"] + s["high"]).alias("end")),
    )
    assigned = F.filter("assign", lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= ASSIGN_CHARS)
    everything = F.concat(
        named("assign", assigned), named("access", F.col("access")), named("hex", F.col("hex")), named("entropy", random)
    )
    own = [f.name for f in placed.schema["row"].dataType.fields if f.name.lower() != "secrets"]
    return placed.select(
        *[F.col("row")[n].alias(n) for n in own],
        F.transform(F.array_sort(everything), lambda s: F.struct(s["kind"], s["start"].cast("long"), s["end"].cast("long")))
        .cast("array<struct<kind:string,start:long,end:long>>")
        .alias("secrets"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
