"""Format-preserving pseudonyms: validated numbers and dates are permuted, under a key, within
their own format, so equal values get equal pseudonyms in all documents.

A value is its index among the valid values of its kind (digits without separators and check
digits, days of a calendar range, ...).  A keyed Feistel network permutes the indices, walking
on until it lands in the range, and the result is written in the value's own layout.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import col

ROUNDS = 10
_FIRST_DAY, _LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
# English month names.
MONTHS = "January February March April May June July August September October November December".split()
# Registered lengths of IBANs by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
KINDS = ("iban", "card", "ssn", "phone", "ipv4", "date")


class Feistel:
    """A keyed permutation of 0 .. size - 1 for any size and tweak."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, k: int, half: int, bits: int) -> int:
        text = f"{tweak}/{k}/{half}".encode()
        digest = hashlib.blake2b(text, key=self.key[:64], digest_size=(bits + 7) // 8 + 8).digest()
        return int.from_bytes(digest, "big") & ((1 << bits) - 1)

    def _walk(self, value: int, size: int, tweak: str, back: bool) -> int:
        if size <= 1:
            return value
        bits = max(2, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            a, b = value >> bits, value & mask
            for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
                a, b = (b ^ self._round(tweak, k, a, bits), a) if back else (b, a ^ self._round(tweak, k, b, bits))
            value = a << bits | b
            if value < size:
                return value

    def permute(self, value: int, size: int, tweak: str) -> int:
        return self._walk(value, size, tweak, False)

    def invert(self, value: int, size: int, tweak: str) -> int:
        return self._walk(value, size, tweak, True)


def luhn_digit(body: str) -> str:
    """The digit that makes ``body`` pass the Luhn check."""
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c in "0123456789" else c for c in text)


def _card(text, move):
    d = _digits(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1]:
        return None
    body = f"{move(int(d[:-1]), 10 ** (len(d) - 1), f'card{len(d)}'):0{len(d) - 1}d}"
    return _refill(text, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(text, move):
    flat = re.sub(r"\s", "", text)
    country, rest = flat[:2], flat[4:]
    if not 11 <= len(rest) <= 30 or _iban_check(country, rest) != flat[2:4]:
        return None
    # Digits stay digits and letters letters, position by position.
    value, size = 0, 1
    for c in rest:
        base = 10 if c.isdigit() else 26
        value, size = value * base + (int(c) if c.isdigit() else ord(c) - 65), size * base
    shape = "".join("9" if c.isdigit() else "A" for c in rest)
    value, out = move(value, size, f"iban{country}{shape}"), []
    for c in reversed(rest):
        value, r = divmod(value, 10 if c.isdigit() else 26)
        out.append(str(r) if c.isdigit() else chr(65 + r))
    new = "".join(reversed(out))
    new = iter(country + _iban_check(country, new) + new)
    return "".join(c if c.isspace() else next(new) for c in text)


def _ssn(text, move):
    d = _digits(text)
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    areas = area - 1 - (area > 666)
    value = move((areas * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    area += 1 + (area >= 665)
    return _refill(text, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


# Calling codes of one and two digits; all others have three.
_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(text, move):
    d = _digits(text)
    if text[0] == "+":
        code = next((d[:k] for k in (1, 2) if d[:k] in _CODES), d[:3])
    else:
        code = "1" if len(d) == 11 else ""
    rest = d[len(code) :]
    # Numbers of the plan of code 1 get the same pseudonym with and without it.
    return _refill(text, f"{code}{move(int(rest), 10 ** len(rest), f'phone{code or 1}' + ('' if len(rest) == 10 else f'/{len(rest)}')):0{len(rest)}d}")


def _ipv4(text, move):
    parts = text.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    value = 0
    for x in parts:
        value = value * 256 + int(x)
    value = move(value, 1 << 32, "ipv4")
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _day(year: int, month: int, day: int) -> date | None:
    try:
        found = date(year, month, day)
    except ValueError:
        return None
    return found if _FIRST_DAY <= found <= _LAST_DAY else None


def _moved_day(day: date | None, move) -> date | None:
    if day is None:
        return None
    size = (_LAST_DAY - _FIRST_DAY).days + 1
    return _FIRST_DAY + timedelta(days=move((day - _FIRST_DAY).days, size, "date"))


def _date(text, move):
    if m := re.fullmatch(r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})", text):
        new = _moved_day(_day(int(m[1]), int(m[3]), int(m[4])), move)
        return new and f"{new.year}{m[2]}{new.month:02d}{m[2]}{new.day:02d}"
    if m := re.fullmatch(r"(\d{1,2})([-/.])(\d{1,2})\2(\d{4})", text):
        day, month = int(m[1]), int(m[3])
        first_is_month = m[2] == "/" and day <= 12  # 3/14/2015; other separators put the day first
        new = _moved_day(_day(int(m[4]), *((day, month) if first_is_month else (month, day))), move)
        if new is None:
            return None
        # Written the way it will be read: a slashed day above 12 stays above 12.
        a, b = (new.month, new.day) if first_is_month else (new.day, new.month)
        if m[2] == "/" and not first_is_month and new.day <= 12:
            a, b = new.month, new.day
        return f"{a:02d}{m[2]}{b:02d}{m[2]}{new.year}"
    if m := re.fullmatch(r"([A-Z][a-z]+)(\.?) (\d{1,2})(,? )(\d{4})", text):
        new = _moved_day(_day(int(m[5]), _month(m[1]), int(m[3])), move)
        return new and f"{_named(new.month, m[1])}{m[2]} {new.day}{m[4]}{new.year}"
    if m := re.fullmatch(r"(\d{1,2}) ([A-Z][a-z]+)(\.?) (\d{4})", text):
        new = _moved_day(_day(int(m[4]), _month(m[2]), int(m[1])), move)
        return new and f"{new.day} {_named(new.month, m[2])}{m[3]} {new.year}"
    return None


def _month(name: str) -> int:
    return next(k for k, month in enumerate(MONTHS, 1) if month.startswith(name[:3]))


def _named(month: int, like: str) -> str:
    """The month's name, short where ``like`` is (May, which is both, counts as short)."""
    return MONTHS[month - 1][:3] if len(like) == 3 else MONTHS[month - 1]


def _iban_ends(text: str) -> list[int]:
    """Where the IBAN that ``text`` begins with may end, longest first: at its country's length, else at a space."""
    flat, ends = 0, []
    for k, c in enumerate(text, 1):
        flat += c != " "
        if c != " " and (k == len(text) or text[k] == " ") and flat >= 15 and flat == IBAN_LENGTHS.get(text[:2], flat):
            ends.append(k)
    return ends[::-1]


def _card_ends(text: str) -> list[int]:
    """Where the card number that ``text`` begins with may end, longest first: after 13 digits or more, before a space."""
    digits, ends = 0, []
    for k, c in enumerate(text, 1):
        digits += c.isdigit()
        if c.isdigit() and digits >= 13 and (k == len(text) or text[k] == " "):
            ends.append(k)
    return ends[::-1]


_ENDS = {"iban": _iban_ends, "card": _card_ends}
_MONTH_NAMES = "|".join(f"{m}|{m[:3]}\\.?" for m in MONTHS)


_FORMS = {
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "phone": (
        r"(?<![\w+])\+?1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?!\d)"
        r"|(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![ .-]?\d|\w)"
        r"|(?<![\w+])\+[2-9](?:[ .-]?\(?\d\)?){7,14}(?!\d|\w)",
        _phone,
    ),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "ipv4": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ipv4),
    "date": (
        r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4}|\d{1,2} (?:" + _MONTH_NAMES + r") \d{4}|(?:" + _MONTH_NAMES + r") \d{1,2},? \d{4})(?![\w/-])",
        _date,
    ),
    "card": (r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])", _card),
}


class Pseudonyms:
    """Finds validated values in a text and replaces them."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.feistel = Feistel(key)
        self.forms = [(kind, re.compile(form), fn) for kind, (form, fn) in _FORMS.items()]
        self.known: dict[tuple[str, str], str | None] = {}

    def replace(self, kind: str, text: str, fn, back: bool = False) -> str | None:
        key = (kind, text)
        if back:
            return fn(text, self.feistel.invert)
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[key] = fn(text, self.feistel.permute)
        return self.known[key]

    def apply(self, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """(new text, spans): kind, start and end in the given text, in order.  Kinds named first win overlaps."""
        spans: list[tuple[int, int, str, str]] = []  # in order, none over another
        for kind, form, fn in self.forms:
            found, taken, at = [], 0, 0
            while m := form.search(text, at):
                start, end = m.span()
                while taken < len(spans) and spans[taken][1] <= start:
                    taken += 1
                if taken < len(spans) and spans[taken][0] < end:  # a kind named earlier holds these characters
                    at = max(spans[taken][1], start + 1)
                    continue
                at = start + 1
                for size in _ENDS[kind](m[0]) if kind in _ENDS else (len(m[0]),):
                    if (new := self.replace(kind, m[0][:size], fn, back)) is not None:
                        found.append((start, start + size, kind, new))
                        at = start + size
                        break
            spans = sorted(spans + found)
        out, at = [], 0
        for a, b, _, new in spans:
            out += [text[at:a], new]
            at = b
        return "".join(out) + text[at:], [(kind, a, b) for a, b, kind, _ in spans]


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
REPLACED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
        *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    ]
)
_made: dict[bytes, Pseudonyms] = {}


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans, n_<kind>...) for every row of ``docs``.

    A null text stays null with no spans; bytes that are not UTF-8 become replacement characters.  Values that
    fail their check (Luhn, IBAN remainder, octets, calendar) are left alone; an IBAN or card number followed by
    more characters of its kind is found by its registered length or at the last space where it checks.
    Rows are independent, repeated rows get equal results, nothing is shuffled; time is linear in a text's length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _made:
            _made.clear()
            _made[key] = Pseudonyms(key)
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, spans, counts = [], [], []
            for text in batch.column(1).to_pylist():
                new, found = _made[key].apply(text) if text else (text, [])
                texts.append(new)
                spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                n = Counter(k for k, _, _ in found)
                counts.append([n[k] for k in KINDS])
            cols = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] if counts else [pa.array([], pa.int64())] * len(KINDS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(spans, spans_type), *cols], names=REPLACED.names)

    return docs.select(col(id_col).cast("long").alias("doc_id"), F.make_valid_utf8(col(text_col).cast("string")).alias("text")).mapInArrow(run, REPLACED)
