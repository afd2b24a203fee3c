"""Pseudonyms for personal numbers, dates and addresses that keep their format.

Every value is validated (Luhn digit, IBAN remainder, octets, calendar), turned
into a number of the set of all values of its format, sent through a keyed
permutation of that set, and written back with the same separators and widths.
The permutation is a Feistel network of `ROUNDS` rounds with a keyed hash, on
the next power of four, repeated until it lands inside the set (cycle walking).
Equal values get equal pseudonyms in every document, different values of one
format never share one, and the key holder can reverse it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from skerry.llm.shared import keyed_texts, map_slices, map_texts, with_values

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
LAST_DAY = datetime.date(2099, 12, 31).toordinal()

KINDS = ("email", "iban", "card", "date", "ipv4", "ssn", "phone")


class Feistel:
    """A keyed permutation of range(n) per format name, and its inverse."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, name: str, size: int, step: int, half: int) -> int:
        said = f"{name}|{size}|{step}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def _pass(self, value: int, name: str, size: int, bits: int, back: bool) -> int:
        mask = (1 << bits) - 1
        left, right = value >> bits, value & mask
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ (self._round(name, size, step, left) & mask), left
            else:
                left, right = right, left ^ (self._round(name, size, step, right) & mask)
        return left << bits | right

    def permute(self, value: int, name: str, size: int, back: bool = False) -> int:
        """The image of `value` in range(size). Sets of one value keep it."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        value = self._pass(value, name, size, bits, back)
        while value >= size:
            value = self._pass(value, name, size, bits, back)
        return value


def luhn_digit(digits: str) -> str:
    """The digit that completes `digits` to a valid card number."""
    doubled = [int(d) * 2 if at % 2 == 0 else int(d) for at, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def _refill(shape: str, digits: str) -> str:
    """`shape` with its digits replaced one by one."""
    fill = iter(digits)
    return "".join(next(fill) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _permuted_digits(feistel: Feistel, name: str, digits: str, back: bool) -> str:
    return str(feistel.permute(int(digits), f"{name}{len(digits)}", 10 ** len(digits), back)).zfill(len(digits))


def card(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    digits = _digits(match[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = _permuted_digits(feistel, "card", digits[:-1], back)
    return _refill(match[0], body + luhn_digit(body))


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


# Lengths of the IBAN registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def iban_end(run: str) -> int | None:
    """Where the valid IBAN at the start of `run` ends, at a space or the end of the run.

    The length of the country comes first, then the whole run, then, for
    countries without a known length, its shorter ends.
    """
    ends = [len(run), *(at for at in range(len(run) - 1, 0, -1) if run[at] == " ")]
    length = IBAN_LENGTHS.get(run[:2])
    fitting = [e for e in ends if len(run[:e].replace(" ", "")) == length]
    for end in [*fitting, *(ends if length is None else ends[:1])]:
        plain = run[:end].replace(" ", "")
        if 15 <= len(plain) <= 34 and iban_check(plain[:2], plain[4:]) == plain[2:4]:
            return end
    return None


def iban(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    """The pseudonym of the IBAN at the start of the match, which may be shorter than the match."""
    end = iban_end(match[0])
    if end is None:
        return None
    shape = match[0][:end]
    plain = shape.replace(" ", "")
    country, body = plain[:2], _by_class(feistel, "iban" + plain[:2], plain[4:], back)
    fill = iter(country + iban_check(country, body) + body)
    return "".join(c if c == " " else next(fill) for c in shape)


def ipv4(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    octets = match[0].split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    value = feistel.permute(int.from_bytes(bytes(map(int, octets)), "big"), "ipv4", 1 << 32, back)
    return ".".join(map(str, value.to_bytes(4, "big")))


# Valid numbers of three parts: areas 001 to 899 without 666, groups from 01, serials from 0001.
AREAS = [a for a in range(1, 900) if a != 666]
AREA_AT = {a: i for i, a in enumerate(AREAS)}


def ssn(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    area, group, serial = map(int, match[0].split("-"))
    if area not in AREA_AT or not group or not serial:
        return None
    value = (AREA_AT[area] * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(feistel.permute(value, "ssn", len(AREAS) * 99 * 9999, back), 9999)
    area, group = divmod(value, 99)
    return f"{AREAS[area]:03}-{group + 1:02}-{serial + 1:04}"


# Country codes; no code begins another.
DIALLING = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})")


def phone(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    """The country code, or the 0 before a number in pairs, stays; the rest is permuted among those of its length."""
    code = re.match(r"\+\d{1,3}(?=[ (.-])", match[0])
    plain = match["plain"] or match["pairs"]
    if plain and not code:
        code = DIALLING.match(match[0]) or re.match("0", match[0])
    kept = code[0] if code else ""
    rest = match[0][len(kept) :]
    digits = _digits(rest)
    if not plain and not 7 <= len(digits) <= 13:
        return None
    return kept + _refill(rest, _permuted_digits(feistel, "phone", digits, back))


@cache
def _days(order: str) -> list[int]:
    """Day numbers a date of this field order can have; month first is read only where day first is no date."""
    days = range(FIRST_DAY, LAST_DAY + 1)
    return [d for d in days if order != "mdy" or datetime.date.fromordinal(d).day > 12]


def date(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    """Year first, day first, or month first where only that is a date; 1900 to 2099.

    Days are permuted among the days of that reading, so one date gets one
    pseudonym whether it is written year or day first. A date written with a
    one-digit field stays without leading zeros.
    """
    separator = re.search(r"\D", match[0])[0]
    parts = match[0].split(separator)
    for order in ["ymd"] if len(parts[0]) == 4 else ["dmy", "mdy"]:
        field = dict(zip(order, map(int, parts)))
        try:
            day = datetime.date(field["y"], field["m"], field["d"]).toordinal()
        except ValueError:
            continue
        days = _days(order)
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        name = "month-first" if order == "mdy" else "date"
        new = datetime.date.fromordinal(days[feistel.permute(bisect_left(days, day), name, len(days), back)])
        width = min(map(len, parts))
        value = {"y": str(new.year), "m": str(new.month).zfill(width), "d": str(new.day).zfill(width)}
        return separator.join(value[f] for f in order)
    return None


def _by_class(feistel: Feistel, name: str, text: str, back: bool) -> str:
    """Permute the letters and digits of `text` together, each position inside its own class."""
    radix = {c: (10, "0") if c.isdigit() else (26, "a") if c.islower() else (26, "A") for c in set(text) if c.isalnum()}
    shape = "".join(radix[c][1] if c in radix else c for c in text)
    size, value = 1, 0
    for c in text:
        if c in radix:
            size, value = size * radix[c][0], value * radix[c][0] + ord(c) - ord(radix[c][1])
    if size == 1:
        return text
    value, out = feistel.permute(value, name + shape, size, back), []
    for c in reversed(text):
        if c in radix:
            value, rest = divmod(value, radix[c][0])
            out.append(chr(ord(radix[c][1]) + rest))
        else:
            out.append(c)
    return "".join(reversed(out))


def email(feistel: Feistel, match: re.Match, back: bool) -> str | None:
    """Local part and first domain label are permuted together; the rest of the domain stays."""
    local, _, domain = match[0].partition("@")
    label, dot, rest = domain.partition(".")
    return _by_class(feistel, "email", f"{local}@{label}", back) + dot + rest


# In order of precedence; a place taken by an earlier kind is left alone by later ones.
FINDERS: list[tuple[str, re.Pattern, Callable]] = [
    (
        "email",
        re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
        email,
    ),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), iban),
    (
        "card",
        re.compile(
            r"(?<![0-9])(?<![0-9][.,-])(?:(?:(?=0)|(?<!^\+)(?<![^0-9A-Za-z+]\+))[0-9]{13,15}|[0-9]{16,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"
            r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])(?![.,-][0-9])"
        ),
        card,
    ),
    (
        "date",
        re.compile(
            r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})"
            r"(?![0-9]|[./-][0-9])"
        ),
        date,
    ),
    ("ipv4", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"), ipv4),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"), ssn),
    (
        "phone",
        re.compile(
            r"(?:(?<![0-9A-Za-z.(+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
            r"[0-9]{3,4}[ .-][0-9]{3,4}|(?<![0-9A-Za-z+])(?P<plain>\+[1-9][0-9]{7,14})"
            r"|(?<![0-9A-Za-z.+-])(?P<pairs>(?:0[0-9]|\+[1-9][0-9]{0,2}[ .-]?[0-9]{1,2})(?P<gap>[ .-])[0-9]{2}"
            r"(?:(?P=gap)[0-9]{2}){3}))(?![0-9]|[.-][0-9])"
        ),
        phone,
    ),
]


def find_private(text: str, feistel: Feistel, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every validated value, by start, without overlaps."""
    if not re.search(r"[0-9@]", text):
        return []
    found: list[tuple[int, int, str, str]] = []
    starts: list[int] = []  # of the values found, ascending, and their ends
    ends: list[int] = []
    for kind, pattern, change in FINDERS:
        if kind == "email" and "@" not in text:
            continue
        match = pattern.search(text)
        while match:
            # An IBAN run may hold further words; its pseudonym is as long as the IBAN.
            new = change(feistel, match, back)
            end = match.start() + len(new) if new is not None and kind == "iban" else match.end()
            # Values do not overlap, so only the last one that starts before the end can be in the way.
            at = bisect_left(starts, end)
            if new is not None and not (at and ends[at - 1] > match.start()):
                found.append((match.start(), end, kind, new))
                starts.insert(at, match.start())
                ends.insert(at, end)
            elif kind == "iban":
                end = match.start() + 1
            match = pattern.search(text, end)
    return sorted(found)


def _replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    parts, at = [], 0
    for start, end, _, new in found:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]])


def pseudonymise(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False
) -> DataFrame:
    """Per row: doc_id, text with pseudonyms, n_found, spans (kind:start:end in the input), one count per kind.

    A NULL or empty text gives the empty text and no spans; repeated rows give
    equal results. `back` reverses the pseudonyms of the same key.
    """

    def make():
        feistel = Feistel(key.encode())

        def work(texts: list[str]) -> list[tuple]:
            rows = []
            for text in texts:
                found = find_private(text, feistel, back)
                kinds = [kind for _, _, kind, _ in found]
                spans = ",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in found)
                rows.append((_replaced(text, found), len(found), spans, *map(kinds.count, KINDS)))
            return rows

        return work

    texts = keyed_texts(docs, id_col, text_col)
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return map_texts(texts, make, f"masked string, n_found bigint, spans string, {counts}").withColumnRenamed(
        "masked", "text"
    )


def pseudonymise_column(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """`docs` with the text column replaced by its pseudonymised form, in one narrow pass; NULL stays NULL."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        feistel = Feistel(key.encode())
        masked = lambda t: None if t is None else _replaced(t, find_private(t, feistel))
        return lambda part: with_values(part, text_col, list(map(masked, part.column(text_col).to_pylist())))

    return map_slices(docs, make)
