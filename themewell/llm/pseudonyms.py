"""Pseudonyms for personal data: keyed permutations within the format of the value.

Numbers and dates are found by pattern and validated (check digits, ranges,
calendar). Each kind of value is numbered 0 to N - 1 within its format, the number
is permuted by a Feistel network with a secret key, walking on while it leaves the
range, and written back in the same format: a card number stays a valid card
number of the same length and spacing, a date a date. As it is a permutation,
equal values have equal pseudonyms in all documents, different values different
ones, and who has the key can undo it. A day has one pseudonym in all its spellings;
it keeps whether its number can be a month's, and whether month and day have two
digits, as else some spellings could not be read back.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from themewell.llm.arrow import batch_of, map_batches, texts_of

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "ip", "date", "phone")  # in order of precedence

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2099, 12, 31).toordinal() - FIRST_DAY + 1

#: Length of an IBAN by country: the registry; fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}


# ---- the permutation --------------------------------------------------------


def _round(key: bytes, tweak: bytes, number: int, half: int, bits: int) -> int:
    data = tweak + bytes([0, number]) + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
    need = (bits + 7) // 8
    out = b""
    while len(out) < need:
        out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=key[:64], digest_size=64).digest()
    return int.from_bytes(out[:need], "big") & ((1 << bits) - 1)


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of 0 to size - 1 (its inverse with ``back``)."""
    if not 0 <= value < size:
        raise ValueError("value out of range")
    if size < 2:
        return value
    bits = max(2, (size - 1).bit_length())
    low = bits // 2
    high = bits - low
    tweak = tweak + size.to_bytes((size.bit_length() + 7) // 8, "big")
    while True:
        # Halves of high and low bits in turn take in a keyed function of the other one.
        left, right = value >> low, value & ((1 << low) - 1)
        for r in range(ROUNDS) if not back else range(ROUNDS - 1, -1, -1):
            if r % 2 == 0:
                left ^= _round(key, tweak, r, right, high)
            else:
                right ^= _round(key, tweak, r, left, low)
        value = left << low | right
        if value < size:  # else walk on along the cycle, which must come back into the range
            return value


def permute_digits(digits: str, key: bytes, tweak: bytes, back: bool = False) -> str:
    return str(permute(int(digits), 10 ** len(digits), key, tweak, back)).zfill(len(digits)) if digits else ""


def permute_characters(text: str, key: bytes, tweak: bytes, back: bool = False) -> str:
    """Letters become letters of the same case and digits digits, all others stay; equal but for case stays so."""
    size, value, radix = 1, 0, []
    for c in text.lower():
        base = 10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" else 1
        radix.append(base)
        size *= base
        value = value * base + (ord(c) - (48 if base == 10 else 97) if base > 1 else 0)
    shape = bytes(b for b in radix)
    value = permute(value, size, key, tweak + shape, back)
    out = []
    for c, base in zip(reversed(text), reversed(radix), strict=True):
        if base > 1:
            value, x = divmod(value, base)
            new = chr(x + (48 if base == 10 else 97))
            c = new.upper() if c.isupper() else new
        out.append(c)
    return "".join(reversed(out))


def _respaced(shape: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``shape``."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


# ---- kinds of values: each gives the pseudonym, or None if the value is not valid ----


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def card(text: str, key: bytes, back: bool = False) -> str | None:
    """13 to 19 digits with a valid check digit; the first digit stays."""
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[0] + permute_digits(digits[1:-1], key, b"card" + digits[:1].encode(), back)
    return _respaced(text, body + luhn_digit(body))


def iban_check(country: str, rest: str) -> str:
    moved = "".join(str(int(c, 36)) for c in rest + country + "00")
    return str(98 - int(moved) % 97).zfill(2)


def iban(text: str, key: bytes, back: bool = False) -> str | None:
    """Country and length stay, check digits are made anew."""
    plain = text.replace(" ", "")
    country, rest = plain[:2], plain[4:]
    if IBAN_LENGTHS.get(country) != len(plain) or iban_check(country, rest) != plain[2:4]:
        return None
    rest = permute_characters(rest, key, b"iban" + country.encode(), back)
    new = iter(country + iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(new) for c in text)


def ssn(text: str, key: bytes, back: bool = False) -> str | None:
    """Area 1 to 899 but 666, group and serial from 1."""
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute(number, 898 * 99 * 9999, key, b"ssn", back), 9999)
    area, group = divmod(number, 99)
    area += 1
    return f"{area + (area >= 666):03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def ip(text: str, key: bytes, back: bool = False) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    new = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip", back)
    return ".".join(map(str, new.to_bytes(4, "big")))


_DATE = re.compile(r"(\d{1,4})([-./])(\d{1,2})\2(\d{1,4})")


def date(text: str, key: bytes, back: bool = False) -> str | None:
    """A day of 1900 to 2099: year first, day first with points or dashes, month first with slashes if that is a day."""
    m = _DATE.fullmatch(text)
    a, sign, b, c = m[1], m[2], m[3], m[4]
    if len(a) == 4 and len(c) <= 2:
        orders = ("ymd",)
    elif len(c) == 4 and len(a) <= 2:
        orders = ("mdy", "dmy") if sign == "/" else ("dmy",)
    else:
        return None
    for order in orders:
        fields = dict(zip(order, (a, b, c), strict=True))
        try:
            day = datetime.date(int(fields["y"]), int(fields["m"]), int(fields["d"])).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        padded = all(len(fields[f]) == 2 for f in "md")
        if not padded and any(fields[f][0] == "0" for f in "md"):
            return None
        return _written(day, order, sign, padded, key, back)
    return None


def _written(day: int, order: str, sign: str, padded: bool, key: bytes, back: bool) -> str:
    """The new day is the same for all spellings of a day, and of its sort, so that it can only be read as it is written."""
    width = 2 if padded else 1
    days, places = _days()
    sort, place = places[day]
    place = permute(place, len(days[sort]), key, b"date%d" % sort, back)
    new = datetime.date.fromordinal(FIRST_DAY + days[sort][place])
    shown = {"y": f"{new.year:04d}", "m": f"{new.month:0{width}d}", "d": f"{new.day:0{width}d}"}
    return sign.join(shown[f] for f in order)


def _sort(day: datetime.date) -> int:
    """Whether the day can be a month's number, and whether month and day both have two digits without a zero before them."""
    return 2 * (day.day > 12) + (day.month >= 10 and day.day >= 10)


@lru_cache(maxsize=1)
def _days() -> tuple[list[list[int]], list[tuple[int, int]]]:
    """The days of each sort, and for each day its sort and its place there."""
    days: list[list[int]] = [[], [], [], []]
    places = []
    for day in range(DAYS):
        sort = _sort(datetime.date.fromordinal(FIRST_DAY + day))
        places.append((sort, len(days[sort])))
        days[sort].append(day)
    return days, places


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """10 to 15 digits, written as a phone number; a country code before the first space or sign stays.

    So does the leading 0 of a national number in groups, which may have 9 digits if these are not parted by dashes.
    """
    digits = _digits(text)
    national = not _AMERICAN.fullmatch(text) and re.match(r"\(?0[1-9]", text)
    least = 9 if national and "-" not in text else 10
    if not least <= len(digits) <= 15 or not (text[0] in "+(" or re.search(r"\d[ ./-]\d", text)):
        return None
    if national:
        return _national(text, digits, key, back)
    code = len(m[1]) if (m := re.match(r"\+(\d{1,3})[^\d]", text)) else 0
    kept, rest = digits[:code], digits[code:]
    return _respaced(text, kept + permute_digits(rest, key, b"phone" + kept.encode(), back))


def _national(text: str, digits: str, key: bytes, back: bool) -> str:
    """The digit after the 0 is never 0; walks on until no part of the new number can be read as a card."""
    low = 10 ** (len(digits) - 2)
    value = int(digits) - low
    while True:
        value = permute(value, 9 * low, key, b"national", back)
        new = _respaced(text, f"0{value + low}")
        if all(card(m[0], key) is None for m in _FORMS["card"].finditer(new)):
            return new


def email(text: str, key: bytes, back: bool = False) -> str | None:
    """Name and domain are permuted by characters, the last label stays."""
    name, domain = text.rsplit("@", 1)
    labels, _, top = domain.rpartition(".")
    top_key = top.lower().encode()
    return f"{permute_characters(name, key, b'name', back)}@{permute_characters(labels, key, b'host' + top_key, back)}.{top}"


_VALUE: dict[str, Callable[..., str | None]] = {
    "email": email, "iban": iban, "card": card, "ssn": ssn, "ip": ip, "date": date, "phone": phone,
}
_IBAN_START = re.compile("[A-Z]{2}[0-9]{2}")
_NUMBERS = re.compile(r"[+(]?[0-9][0-9 ().+/-]{5,}[0-9]")
_AMERICAN = re.compile(r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}")
_FORMS = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"),
    "iban": re.compile(
        r"(?<![A-Za-z0-9])(?:"
        + "|".join(
            rf"(?:{'|'.join(c for c, k in IBAN_LENGTHS.items() if k == n)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}"
            for n in sorted(set(IBAN_LENGTHS.values()))
        )
        + r")(?![A-Za-z0-9])"
    ),
    "card": re.compile(r"(?<![0-9A-Za-z.])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])"),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "ip": re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"),
    "date": re.compile(
        r"(?<![0-9A-Za-z./-])(?:[0-9]{4}([-./])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-./])[0-9]{1,2}\2[0-9]{4})"
        r"(?:(?=T[0-9]{2}:?[0-9]{2})|(?![0-9A-Za-z]|[./-][0-9]))"
    ),
    "phone": re.compile(
        r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
        r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}"
        # National: 0, the rest of the area, and groups parted in one way; but not in the shape of a card.
        r"|(?![0-9]{4}([ -])(?:[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{6}\2[0-9]{5})(?![0-9]))0[1-9][0-9]{0,4}([ .-])[0-9]{2,8}(?:\3[0-9]{2,4}){0,4}|0[1-9][0-9]{0,4}/[0-9]{3,8}"
        r"|\(0[1-9][0-9]{0,4}\) ?[0-9]{3,8}(?:[ .-][0-9]{2,4}){0,3})(?![0-9A-Za-z])"
    ),
}


# ---- texts ------------------------------------------------------------------


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all that looks like a value and is valid, left to right."""
    taken: list[tuple[int, int, str]] = []  # sorted; no two overlap

    def offer(kind: str, low: int, high: int) -> None:
        at = low
        while m := _FORMS[kind].search(text, at, high):
            start, end = m.span()
            i = bisect_left(taken, (end,))  # the last one that starts before the end
            free = not i or taken[i - 1][1] <= start
            if free and _VALUE[kind](m[0], b"") is not None:
                taken.insert(i, (start, end, kind))
                at = end
            else:
                at = start + 1

    if "@" in text:
        offer("email", 0, len(text))
    if _IBAN_START.search(text):
        offer("iban", 0, len(text))
    regions = [m.span() for m in _NUMBERS.finditer(text)]
    for kind in KINDS[2:]:
        for low, high in regions:
            offer(kind, low, high)
    # Values end at a region's border only if the text does not go on there.
    return [(s, e, k) for s, e, k in taken if _whole(text, s, e, k)]


def _whole(text: str, start: int, end: int, kind: str) -> bool:
    if kind in ("email", "iban"):
        return True
    m = _FORMS[kind].match(text, start)
    return m is not None and m.end() == end


@lru_cache(maxsize=20_000)
def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str:
    """The pseudonym of a valid value (with ``back``: the value of a pseudonym)."""
    out = _VALUE[kind](value, key, back)
    if out is None:
        raise ValueError(f"not a valid {kind}")
    return out


def replace(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and the spans found in the original."""
    spans = find(text)
    out, at = [], 0
    for start, end, kind in spans:
        out += [text[at:start], pseudonym(kind, text[start:end], key, back)]
        at = end
    return "".join([*out, text[at:]]), spans


def pseudonymize(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_<kind> for each kind, n_replaced, spans), one row per row of ``docs``.

    ``spans`` are ``kind:start:end`` in code points of the original text. ``key``
    has 16 to 64 bytes. A null text stays null, an empty one empty; texts without
    a valid value come back as they are. Repeated rows get equal answers, null ids
    are kept; other columns are not read.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key has 16 to 64 bytes")

    def make(schema: pa.Schema):
        def one(doc_id, text):
            new, spans = replace(text, key) if text else (text, [])
            counts = [sum(k == kind for _, _, k in spans) for kind in KINDS]
            return doc_id, new, *counts, len(spans), ",".join(f"{k}:{s}:{e}" for s, e, k in spans)

        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                texts = batch.column("text")
                rows = [one(i, t.as_py()) for i, t in zip(batch.column("doc_id").to_pylist(), texts, strict=True)]
                yield batch_of(schema, {f.name: [r[k] for r in rows] for k, f in enumerate(schema)})

        return run

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(texts_of(docs), make, f"doc_id long, text string, {counts}, n_replaced long, spans string")
