"""String expressions."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.errors import any_of

# --- fixed values -----------------------------------------------------------------------
#: e-mail pattern of the regex filter demo; the class [A-Z|a-z] holds a literal "|"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
#: settings that count as "on"
TRUE_WORDS = ("yes", "ok", "1", "true")
# ----------------------------------------------------------------------------------------

# a word boundary over ASCII letters only, as RE2 understands \b
_ASCII_BOUNDARY = r"(?:(?<![0-9A-Za-z_])(?=[0-9A-Za-z_])|(?<=[0-9A-Za-z_])(?![0-9A-Za-z_]))"


def is_true_word(value: str | None) -> bool:
    """Whether a settings value switches something on."""
    return value is not None and value.lower() in TRUE_WORDS


def ascii_boundaries(pattern: str) -> str:
    r"""Rewrite ``\b`` outside a character class: Java's is Unicode-aware, RE2's is ASCII."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            pair = pattern[i : i + 2]
            out.append(_ASCII_BOUNDARY if pair == r"\b" and not in_class else pair)
            i += 2
            continue
        if ch == "[":
            in_class = True
        elif ch == "]":
            in_class = False
        out.append(ch)
        i += 1
    return "".join(out)


def required_text(pattern: str) -> str:
    """A text every match must contain, or an empty one.

    Looking for it first spares the pattern on most rows.  Patterns with groups or
    alternatives are not looked into.
    """
    runs, run, i = [], "", 0
    while i < len(pattern):
        ch, step = pattern[i], 1
        literal = ch
        if ch in "(|":
            return ""
        if ch == "[":
            close = pattern.find("]", i + 2)
            if close < 0 or pattern[i + 1 : close].endswith("\\"):
                return ""
            literal, step = "", close + 1 - i
        elif ch == "\\":
            literal, step = pattern[i + 1 : i + 2], 2
            if literal.isalnum():
                if literal not in "bBdDwWsSAzZnrt":
                    return ""
                literal = ""
        elif ch in ".^$":
            literal = ""
        after = pattern[i + step : i + step + 1]
        if after in ("*", "?", "{"):  # may be absent
            literal = ""
        runs.append(run)
        run = run + literal if literal else ""
        runs.append(run)
        i += step
        if after and after in "*+?{":
            run = ""
            while i < len(pattern) and pattern[i] in "*+?{":
                i = pattern.find("}", i) + 1 if pattern[i] == "{" else i + 1
    return max(runs, key=len, default="")


def contains_any(col: Column, words: Sequence[str]) -> Column:
    """Whether the lower-cased text contains one of the words."""
    low = F.lower(col)
    return any_of([low.contains(w.lower()) for w in words])


def mask_emails(col: Column, replacement: str = "redacted") -> Column:
    """Replace the user part of every e-mail address and keep the domain."""
    user, domain = EMAIL_PATTERN.split("@")
    pattern = ascii_boundaries(f"{user}(@{domain})")
    return F.when(col.contains("@"), F.regexp_replace(col, pattern, f"{replacement}$1")).otherwise(col)


def money_to_decimal(col: Column) -> Column:
    """``$93.855`` as decimal(18,4); null when it is no number."""
    return F.regexp_replace(col, r"^\s*\$", "").try_cast("decimal(18,4)")


def unescape_entities(col: Column) -> Column:
    """Named and numeric HTML entities as characters, each decoded once.

    The text is cut at ``&``; a piece that starts with a known ``name;`` is replaced.
    """
    names = F.create_map(*[F.lit(x) for name, cp in sorted(name2codepoint.items()) for x in (name, chr(cp))])

    def char_of(code: Column) -> Column:
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][0-9A-Za-z]{1,31});", 1)
        decimal = F.regexp_extract(name, r"^#([0-9]+)$", 1).try_cast("bigint")
        hexa = F.conv(F.regexp_extract(name, r"^#[xX]([0-9A-Fa-f]+)$", 1), 16, 10).try_cast("bigint")
        char = F.coalesce(F.try_element_at(names, name), char_of(F.coalesce(decimal, hexa)))
        rest = F.substr(p, F.length(name) + 2)
        return F.when((name != "") & char.isNotNull(), F.concat(char, rest)).otherwise(F.concat(F.lit("&"), p))

    parts = F.split(col, "&", -1)
    tail = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), piece)
    decoded = F.concat(F.element_at(parts, 1), F.array_join(tail, ""))
    return F.when(F.instr(col, "&") == 0, col).otherwise(decoded)


def html_to_text(col: Column) -> Column:
    """Visible text of a page: no comments, scripts, styles or tags; blanks collapsed."""
    text = F.regexp_replace(col, r"(?is)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<script\b.*?</script\s*>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    text = unescape_entities(text)
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))
