"""Format-preserving pseudonyms: numbers and dates that pass their check are permuted within their format.

Each kind maps its valid values one to one to a domain of A * B numbers, on which a keyed Feistel network
is a permutation: rounds add a keyed hash of one half to the other, modulo its size.  So equal values get equal
pseudonyms in all documents, different ones stay different, and a pseudonym passes the same check.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.matches import between, found

ROUNDS = 8
#: Dates are permuted in the 400-year cycle from here: those to the twelfth of a month (240 * 240 of them) among
#: themselves and the later ones (9 * 9833) among themselves, so that a month-first date can be read as one.
FIRST_YEAR, EARLY_HALVES, LATE_HALVES = 1800, (240, 240), (9, 9833)
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
#: Letters and digits of a mailbox name that one permutation covers; longer names take several.
MAIL_CHUNK = 20
#: Length of an account number by country (ISO 13616); numbers of other countries may have any length from 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _hash(key: str, *parts: Column) -> Column:
    """A keyed 60-bit number."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts], F.lit(key))
    return F.conv(F.substr(F.sha2(text, 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column, inverse: bool = False) -> Column:
    """The pair (``a`` below ``size_a``, ``b`` below ``size_b``) permuted; a struct of ``a`` and ``b``."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    sign = -1 if inverse else 1

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        new_a = F.pmod(s["a"] + sign * F.pmod(_hash(key, tweak, r, s["b"]), size_a), size_a)
        new_b = F.pmod(s["b"] + sign * F.pmod(_hash(key, tweak, r, s["a"]), size_b), size_b)
        return F.struct(
            F.when(even, new_a).otherwise(s["a"]).cast("long").alias("a"), F.when(even, s["b"]).otherwise(new_b).cast("long").alias("b")
        )

    return F.aggregate(F.reverse(rounds) if inverse else rounds, start, step)


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), F.lit(width) if isinstance(width, int) else width, F.lit("0"))


def permuted_digits(digits: Column, key: str, tweak: Column, inverse: bool = False) -> Column:
    """A string of up to 36 digits permuted among those of its length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    ten = lambda k: F.round(F.pow(F.lit(10.0), k)).cast("long")
    number = lambda s: F.coalesce(F.try_to_number(s, F.lit("9" * 18)).cast("long"), F.lit(0))
    a, b = number(F.substr(digits, F.lit(1), left)), number(F.substr(digits, left + 1, n))
    done = feistel(a, b, ten(left), ten(n - left), key, F.concat_ws("/", tweak, n), inverse)
    return _let(done, lambda s: F.concat(F.when(left > 0, _padded(s["a"], left)).otherwise(""), _padded(s["b"], n - left)))


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes ``payload`` a valid card number."""
    n = F.length(payload)
    values = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: _let(
            F.substr(payload, i, F.lit(1)).cast("int"),
            lambda d: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d),
        ),
    )
    return F.pmod(-F.aggregate(values, F.lit(0), lambda s, x: s + x), F.lit(10)).cast("string")


def mod97(text: Column) -> Column:
    """The remainder by which an account number is checked; letters count from ten."""
    cells = F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda i: F.conv(F.substr(text, i, F.lit(1)), 36, 10).cast("int")
    )
    return F.aggregate(cells, F.lit(0), lambda s, x: (s * F.when(x > 9, 100).otherwise(10) + x) % 97)


def refilled(shape: Column, digits: Column, which: str = "[0-9]") -> Column:
    """``shape`` with its characters of ``which`` replaced by those of ``digits`` in turn."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(shape)),
            lambda i: F.when(
                F.substr(shape, i, F.lit(1)).rlike(which),
                F.substr(digits, i - F.length(F.regexp_replace(F.left(shape, i), which, "")), F.lit(1)),
            ).otherwise(F.substr(shape, i, F.lit(1))),
        ),
        "",
    )


@dataclass(frozen=True)
class Kind:
    """A shape in text and what may not stand beside it, the pseudonym of a value, the check that it must pass
    (none: every value does), and the readings of a match in the order they are tried (none: the match alone)."""

    name: str
    before: str
    shape: str
    after: str
    pseudonym: Callable[[Column, str, bool], Column]
    valid: Callable[[Column], Column] | None = None
    readings: Callable[[Column], Column] | None = None

    @property
    def pattern(self) -> str:
        return f"{self.before}(?:{self.shape}){self.after}"

    def values(self, text: Column) -> Column:
        """The valid values in ``text``, longest first: at every place where the shape begins the first reading that passes."""
        readings = self.readings or F.array
        matches = F.array_distinct(F.regexp_extract_all(text, F.lit(f"{self.before}(?=({self.shape}){self.after})"), F.lit(1)))
        first = F.array_compact(F.transform(matches, lambda m: F.get(F.filter(readings(m), self.valid), 0)))
        longer = lambda a, b: F.length(b) - F.length(a)
        return F.array_sort(F.array_distinct(first), longer)

    def found_in(self, text: Column) -> Column:
        """A pattern of the valid values in ``text``; null if there are none."""
        if self.valid is None:
            return F.lit(f"(?:{self.pattern})")
        literal = lambda values: F.array_join(F.transform(values, lambda v: F.replace(v, F.lit("."), F.lit("[.]"))), "|")
        return _let(
            self.values(text),
            lambda v: F.when(F.size(v) > 0, F.concat(F.lit(f"(?:{self.before}(?:"), literal(v), F.lit(f"){self.after})"))),
        )


def _cut_at(match: Column, separator: str) -> Column:
    """``match`` and what of it ends before a separator, longest first."""
    ends = F.filter(F.sequence(F.length(match), F.lit(1), F.lit(-1)), lambda i: F.substr(match, i + 1, F.lit(1)).rlike(f"^{separator}?$"))
    return F.transform(ends, lambda i: F.left(match, i))


def _card(match: Column, key: str, inverse: bool) -> Column:
    digits = _digits(match)
    payload = permuted_digits(F.left(digits, F.length(digits) - 1), key, F.lit("card"), inverse)
    return refilled(match, _let(payload, lambda p: F.concat(p, luhn_digit(p))))


def _card_readings(match: Column) -> Column:
    """Of 13 digits or more; what follows the number in the same run of groups may be its expiry date."""
    return F.filter(_cut_at(match, "[ -]"), lambda r: F.length(_digits(r)) >= 13)


def _card_valid(match: Column) -> Column:
    digits = _digits(match)
    return (F.right(digits, F.lit(1)) == luhn_digit(F.left(digits, F.length(digits) - 1))) & ~digits.rlike("^0+$")


def _nanp(match: Column, key: str, inverse: bool) -> Column:
    """Area and exchange code from 200 to 999, and a line of four digits: two halves of 80,000."""
    full = _digits(match)
    digits = F.right(full, F.lit(10))
    area, exchange, line = (F.substr(digits, F.lit(p), F.lit(w)).cast("int") for p, w in ((1, 3), (4, 3), (7, 4)))
    half = F.lit(80_000)
    a, b = (area - 200) * 100 + F.floor(line / 100), (exchange - 200) * 100 + line % 100
    done = feistel(a, b, half, half, key, F.lit("nanp"), inverse)
    numbers = _let(
        done,
        lambda s: F.concat(
            F.left(full, F.length(full) - 10), _padded(F.floor(s["a"] / 100) + 200, 3), _padded(F.floor(s["b"] / 100) + 200, 3),
            _padded(s["a"] % 100, 2), _padded(s["b"] % 100, 2),
        ),
    )
    return refilled(match, numbers)


def _phone(match: Column, key: str, inverse: bool) -> Column:
    """The leading two digits hold the country and stay."""
    digits = _digits(match)
    rest = permuted_digits(F.substr(digits, F.lit(3), F.length(digits)), key, F.concat_ws("/", F.lit("phone"), F.left(digits, F.lit(2))), inverse)
    return refilled(match, F.concat(F.left(digits, F.lit(2)), rest))


def _ssn(match: Column, key: str, inverse: bool) -> Column:
    """Areas 001-899 but 666, groups 01-99, serials 0001-9999."""
    digits = _digits(match)
    area, group, serial = (F.substr(digits, F.lit(p), F.lit(w)).cast("int") for p, w in ((1, 3), (4, 2), (6, 4)))
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    done = feistel(index * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("ssn"), inverse)
    numbers = _let(
        done,
        lambda s: _let(
            F.floor(s["a"] / 99),
            lambda i: F.concat(
                _padded(F.when(i >= 665, i + 2).otherwise(i + 1), 3), _padded(s["a"] % 99 + 1, 2), _padded(s["b"] + 1, 4)
            ),
        ),
    )
    return refilled(match, numbers)


def _ip(match: Column, key: str, inverse: bool) -> Column:
    octets = F.split(match, r"\.")
    octet = lambda i: F.get(octets, i).cast("int")
    half = F.lit(65_536)
    done = feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), half, half, key, F.lit("ip"), inverse)
    return _let(
        done, lambda s: F.concat_ws(".", *[x.cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256)])
    )


def _iban(match: Column, key: str, inverse: bool) -> Column:
    """Country and letters stay, the digits after the check digits are permuted, the check is made anew."""
    flat = F.replace(match, F.lit(" "), F.lit(""))
    country, account = F.left(flat, F.lit(2)), F.substr(flat, F.lit(5), F.length(flat))
    digits = permuted_digits(_digits(account), key, F.concat_ws("/", F.lit("iban"), country, F.regexp_replace(account, "[0-9]", "0")), inverse)
    return _let(
        refilled(account, digits),
        lambda x: refilled(match, F.concat(country, _padded(98 - mod97(F.concat(x, country, F.lit("00"))), 2), x), "[0-9A-Z]"),
    )


def _iban_readings(match: Column) -> Column:
    """The one of the country's length, then the others."""
    lengths = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for c in codes.split() for x in (c, n)])
    own = lambda r: F.length(F.replace(r, F.lit(" "), F.lit(""))) == F.coalesce(F.try_element_at(lengths, F.left(r, F.lit(2))), F.lit(0))
    return _let(_cut_at(match, " "), lambda all_: F.concat(F.filter(all_, own), F.filter(all_, lambda r: ~own(r))))


def _iban_valid(match: Column) -> Column:
    flat = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(flat, F.lit(5), F.length(flat)), F.left(flat, F.lit(4)))
    # 02 to 98 are the check digits that are given out
    check = F.substr(flat, F.lit(3), F.lit(2)).cast("int")
    return (F.length(flat) >= 15) & (F.length(flat) <= 34) & (mod97(turned) == 1) & check.between(2, 98)


def _date_parts(match: Column) -> Column:
    """Year, month and day, and their order: ``ymd``, ``mdy`` (the second part is above twelve) or ``dmy``."""
    part = lambda i: F.get(F.split(match, "[-./]"), i).cast("int")
    order = F.when(match.rlike("^[0-9]{4}"), "ymd").when(part(1) > 12, "mdy").otherwise("dmy")
    named = lambda o: F.struct(*[part(o.index(n)).alias(n) for n in "ymd"], F.lit(o).alias("order"))
    return F.when(order == "ymd", named("ymd")).when(order == "mdy", named("mdy")).otherwise(named("dmy"))


def _late_day(index: Column) -> Column:
    """The date of a number among those after the twelfth."""
    first = F.lit(f"{FIRST_YEAR}-01-01").cast("date")
    day = lambda k: F.date_add(first, (index + (k + 1) * 12).cast("int"))
    month = lambda d: (F.year(d) - FIRST_YEAR) * 12 + F.month(d) - 1
    a, b = LATE_HALVES
    # the month that the mean length points to, or one beside it
    guess = F.floor(index * 4800 / (a * b)).cast("int")
    months = F.filter(F.sequence(guess - 2, guess + 2), lambda k: (month(day(k)) == k) & (F.day(day(k)) > 12))
    return day(F.get(months, 0))


def _date(match: Column, key: str, inverse: bool) -> Column:
    """Any day of the 400-year cycle on the same side of the twelfth, in the layout it was written in."""

    def permute(p: Column) -> Column:
        month = (p["y"] - FIRST_YEAR) * 12 + p["m"] - 1

        def permuted(index: Column, halves: tuple[int, int], name: str) -> Column:
            a, b = halves
            done = feistel(F.floor(index / b), index % b, F.lit(a), F.lit(b), key, F.lit(name), inverse)
            return _let(done, lambda s: s["a"] * b + s["b"])

        start = F.lit(f"{FIRST_YEAR}-01-01").cast("date")
        late = _let(
            permuted(F.date_diff(F.make_date(p["y"], p["m"], p["d"]), start) - (month + 1) * 12, LATE_HALVES, "date"),
            lambda i: _let(_late_day(i), lambda d: F.struct(F.year(d).alias("y"), F.month(d).alias("m"), F.day(d).alias("d"))),
        )
        early = _let(
            permuted(month * 12 + p["d"] - 1, EARLY_HALVES, "early date"),
            lambda i: F.struct(
                (F.floor(i / 144) + FIRST_YEAR).cast("int").alias("y"), (F.floor(i / 12) % 12 + 1).cast("int").alias("m"), (i % 12 + 1).cast("int").alias("d")
            ),
        )
        return _let(F.when(p["d"] > 12, late).otherwise(early), lambda n: written(p, n))

    def written(p: Column, new: Column) -> Column:
        # without zeros in front if a part had one digit
        short = F.exists(F.split(match, "[-./]"), lambda x: F.length(x) == 1)
        cell = lambda n: F.when(short | F.lit(n == "y"), new[n].cast("string")).otherwise(_padded(new[n], 2))
        separator = lambda i: F.get(F.regexp_extract_all(match, F.lit("[-./]"), F.lit(0)), i)
        text = lambda o: F.concat(cell(o[0]), separator(0), cell(o[1]), separator(1), cell(o[2]))
        return F.when(p["order"] == "ymd", text("ymd")).when(p["order"] == "mdy", text("mdy")).otherwise(text("dmy"))

    return _let(_date_parts(match), permute)


def _date_valid(match: Column) -> Column:
    def holds(p: Column) -> Column:
        inside = p["y"].between(FIRST_YEAR, FIRST_YEAR + 399) & p["m"].between(1, 12) & p["d"].between(1, 31)
        first = F.make_date(F.when(inside, p["y"]), p["m"], F.lit(1))
        return F.coalesce(inside & (p["d"] <= F.day(F.last_day(first))), F.lit(False))

    return _let(_date_parts(match), holds)


def _mail(match: Column, key: str, inverse: bool) -> Column:
    """Letters (lower-cased) and digits of the mailbox name are permuted in base 36, some at a time."""
    name = F.lower(F.regexp_extract(match, "^([^@]*)@", 1))
    flat = F.regexp_replace(name, "[^0-9a-z]", "")
    chunks = F.sequence(F.lit(0), F.greatest(F.floor((F.length(flat) - 1) / MAIL_CHUNK).cast("int"), F.lit(0)))

    def permute(i: Column) -> Column:
        part = F.substr(flat, i * MAIL_CHUNK + 1, F.lit(MAIL_CHUNK))
        n = F.length(part)
        left = F.floor(n / 2).cast("int")
        power = lambda k: F.round(F.pow(F.lit(36.0), k)).cast("long")
        number = lambda s: F.coalesce(F.conv(F.when(F.length(s) > 0, s), 36, 10).cast("long"), F.lit(0))
        done = feistel(
            number(F.left(part, left)), number(F.substr(part, left + 1, n)), power(left), power(n - left),
            key, F.concat_ws("/", F.lit("mail"), i, n), inverse,
        )
        text = lambda x, w: F.when(w > 0, F.lpad(F.lower(F.conv(x.cast("string"), 10, 36)), w, F.lit("0"))).otherwise("")
        return _let(done, lambda s: F.concat(text(s["a"], left), text(s["b"], n - left)))

    new = F.array_join(F.transform(chunks, permute), "")
    domain = F.regexp_extract(match, "@(.*)$", 1)
    return F.when(F.length(flat) == 0, match).otherwise(F.concat(refilled(name, new, "[0-9a-z]"), F.lit("@"), domain))


_WORD = "[0-9A-Za-z]"
#: Year first or last, with one or two digits for day and month; a time may follow an ISO date.
_DATES = r"[0-9]{4}(?:-M-M|/M/M|\.M\.M)|M[./]M[./][0-9]{4}|M-M-[0-9]{4}".replace("M", "[0-9]{1,2}")
#: In the order in which they are tried at a place.
KINDS = (
    Kind("email", r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+", "", _mail),
    Kind("iban", f"(?<!{_WORD})", "[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]){11,30}", f"(?!{_WORD})", _iban, _iban_valid, _iban_readings),
    Kind("date", "(?<![0-9A-Za-z./-])", _DATES, f"(?!(?!T[0-9]){_WORD})", _date, _date_valid),
    Kind("ip", "(?<![0-9A-Za-z.])", rf"{_OCTET}(?:\.{_OCTET}){{3}}", rf"(?!\.?{_WORD})", _ip),
    Kind("nanp", "(?<![0-9A-Za-z+])", r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}", f"(?!{_WORD})", _nanp),
    Kind("phone", "(?<![0-9A-Za-z+])", r"\+[0-9](?:[ ().-]{0,2}[0-9]){7,14}", f"(?!{_WORD})", _phone),
    Kind("ssn", "(?<![0-9A-Za-z-])", "(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", "(?![0-9A-Za-z-])", _ssn),
    Kind("card", f"(?<!{_WORD})", "[0-9](?:[ -]?[0-9]){12,18}", f"(?!{_WORD})", _card, _card_valid, _card_readings),
)


def pseudonymize(
    docs: DataFrame, key: str, text_col: str = "text", kinds: Sequence[Kind] = KINDS, inverse: bool = False
) -> DataFrame:
    """The input with ``safe_text``, the text with every valid value replaced, and ``replaced``, the kinds of the
    values in order of their places.

    ``key`` is the secret of the permutation; ``inverse`` undoes it with the same key (the case of mailbox
    names is not kept).  What has the shape but fails the check stays as it is, and is searched for shorter values,
    later ones and other kinds.  A value that spans several spellings (separators) has the same digits as its
    pseudonym in all of them.

    Dates are year-month-day, day-month-year, or month-day-year where the second part is above twelve, with ``-``, ``/`` or ``.``
    and days and months of one or two digits; of a time stamp the time stays.  Left out: years of two digits, months
    by name, dates without separators, years before 1800 and after 2199.  A day stays on its side of the twelfth; one
    digit may become two, and ``inverse`` then gives two.

    An account number has its country's length if that passes; a card is the longest run of digit groups that passes.  One
    run in ten passes by chance, so digits beside a card may count as part of it, here or when ``inverse`` reads the pseudonym.

    * Null text gives an empty ``safe_text`` and no kinds; texts are searched whole.
    * Equal rows get equal results; an empty table gives an empty result.
    * Input columns named like a result column are replaced.
    """
    text = docs.select(F.struct("*").alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    # a check is made before the search, so that what fails it does not hide what it overlaps
    searched = text.select("row", "text", F.concat_ws("|", *[k.found_in(F.col("text")) for k in kinds]).alias("pattern"))
    cut = searched.select("row", "text", found("text", F.col("pattern")).alias("matches"), between("text", F.col("pattern")).alias("pieces"))

    def replaced(match: Column) -> Column:
        """Kind and new text of a match; no kind if it fails the check."""
        cases = None
        for k in kinds:
            holds = match.rlike(f"^(?:{k.pattern})$")
            holds = holds & k.valid(match) if k.valid else holds
            value = F.struct(F.lit(k.name).alias("kind"), k.pseudonym(match, key, inverse).alias("new"))
            cases = F.when(holds, value) if cases is None else cases.when(holds, value)
        return cases.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), match.alias("new")))

    made = cut.select("row", "text", "pieces", F.transform("matches", replaced).alias("made"))
    joined = F.concat(
        F.array_join(F.transform("made", lambda m, i: F.concat(F.get("pieces", i), m["new"])), ""), F.element_at("pieces", -1)
    )
    own = [f.name for f in made.schema["row"].dataType.fields if f.name.lower() not in ("safe_text", "replaced")]
    return made.select(
        *[F.col("row")[n].alias(n) for n in own],
        F.when(F.size("made") == 0, F.col("text")).otherwise(joined).alias("safe_text"),
        F.array_compact("made.kind").alias("replaced"),
    )
