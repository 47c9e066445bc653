"""Exact number formatting and integer arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1 halves the 53 bits of a double


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split_double(x: float) -> tuple[float, float]:
    c = x * _SPLIT
    high = c - (c - x)
    return high, x - high


def format_fixed(col: Column, decimals: int) -> Column:
    """``%.<decimals>f`` as C, Go and Python print it, JVM-side.

    Rounding follows the exact binary value (0.25 -> 0.2, 0.35 -> 0.3 for one decimal),
    while Spark's own functions round the shortest decimal text.  The fraction is
    scaled with an error-free product, so a tie is recognised exactly.
    Null for NaN and infinities.  From 2**126 on the digits after the seventeenth are zeros.
    """
    if not 0 <= decimals <= 15:
        raise ValueError("decimals must be between 0 and 15")
    limit = 10**decimals
    scale = float(limit)
    s_hi, s_lo = _split_double(scale)
    x = col.cast("double")

    def of_size(size: Column) -> Column:
        whole = F.floor(size).cast("bigint")
        return let(F.struct(whole.alias("whole"), (size - whole.cast("double")).alias("frac")), of_parts)

    def of_parts(p: Column) -> Column:
        high = let(p["frac"] * _SPLIT, lambda c: c - (c - p["frac"]))
        scaled = F.struct(
            p["whole"].alias("whole"),
            p["frac"].alias("frac"),
            high.alias("high"),
            (p["frac"] * scale).alias("product"),
        )
        return let(scaled, of_product)

    def of_product(p: Column) -> Column:
        low = p["frac"] - p["high"]
        # product + error is frac * scale exactly
        error = ((p["high"] * s_hi - p["product"]) + p["high"] * s_lo + low * s_hi) + low * s_lo
        down = F.floor(p["product"]).cast("bigint")
        state = F.struct(
            p["whole"].alias("whole"),
            down.alias("down"),
            (p["product"] - F.floor(p["product"]).cast("double")).alias("gap"),
            error.alias("error"),
        )
        return let(state, of_state)

    def of_state(p: Column) -> Column:
        last_digit = p["down"] if decimals else p["whole"]
        tie_up = F.when(p["error"] != 0, p["error"] > 0).otherwise(last_digit % 2 != 0)
        up = F.when(p["gap"] == 0.5, tie_up).otherwise(p["gap"] > 0.5)
        return let(F.struct(p["whole"].alias("whole"), (p["down"] + up.cast("bigint")).alias("units")), of_units)

    def of_units(p: Column) -> Column:
        carry = (p["units"] >= limit).cast("bigint")
        head = (p["whole"] + carry).cast("string")
        if not decimals:
            return head
        digits = F.lpad((p["units"] - carry * limit).cast("string"), decimals, "0")
        return F.concat(head, F.lit("."), digits)

    def of_large(a: Column) -> Column:
        """Whole numbers from 2**63 on: 61 bits of them times a power of two."""
        power = F.floor(F.log2(a)).cast("int") - 60
        head = (a / F.pow(F.lit(2.0), power)).cast("bigint").cast("decimal(20,0)")
        half = F.least(power, F.lit(40))
        two = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n).cast("decimal(20,0)")
        exact = (head * two(half)).cast("decimal(38,0)") * two(power - half).cast("decimal(21,0)")
        digits = F.when(a < float(2**126), exact.cast("decimal(38,0)").cast("string")).otherwise(F.format_string("%.0f", a))
        return F.concat(digits, F.lit("." + "0" * decimals)) if decimals else digits

    finite = ~F.isnan(x) & (F.abs(x) < float("inf"))
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")  # also for the negative zero
    small = F.when(finite & (F.abs(x) < float(2**63)), F.abs(x))
    large = F.when(finite & (F.abs(x) >= float(2**63)), F.abs(x))
    return F.concat(sign, F.when(large.isNotNull(), of_large(large)).otherwise(let(small, lambda a: F.when(a.isNotNull(), of_size(a)))))


def truncating_div(value: Column, divisor: int) -> Column:
    """64-bit division that truncates toward zero."""
    return F.call_function("div", value, F.lit(divisor).cast("bigint"))


def leading_int(text: Column) -> Column:
    """The integer a text starts with (``12abc`` -> 12), null if there is none."""
    digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)", 1)
    # a failing cast is costly, an empty match is common
    return F.nullif(digits, F.lit("")).try_cast("bigint")
