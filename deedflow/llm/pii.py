r"""PII: format-preserving Feistel pseudonyms.

E-mail addresses, IBANs, IPv4 addresses, payment cards, US social security numbers, telephone numbers and calendar
dates are found in whole texts and validated (check digits, ranges, calendar). A valid value is written as an index
into the set of all values of its format, that index goes through a keyed Feistel permutation of the set, and the
result is written back in the same layout: so it is a valid value of the same format, and equal values (also in
another layout, such as a card number with spaces) get equal pseudonyms in every document. Only the key undoes it.

The permutation works on Z_a x Z_b by modular addition, ROUNDS times, with keyed BLAKE2b as the round function; it is a
bijection for any a and b. Sets that don't factor are walked in cycles inside a slightly larger one.

Punctuation around a value doesn't matter, only a number or word that goes on; of a match that isn't valid, its beginnings are
tried. Ten digits are a telephone number if they begin with an area code (2 to 9 first); with +1 or a bracket also if they don't,
for unassigned numbers are written too, and then the pseudonym begins with 0 or 1 as well. An e-mail address is taken whole,
however long; its last label has 2 to 63 letters or is an encoded one (xn--). A date of the years 1 to 9999 is read day first where it can be, but
where its layout is year first or only month first fits; its pseudonym is in the same of three spans of years (to 1899, to 2099, later).

Where values overlap, the earlier kind in KINDS wins, then the leftmost. Text outside valid values isn't touched.
Defined results: a null text stays null; an empty one stays empty; every row gives a row, and repeated rows the same; a long text is
read as one, whatever its length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b
from secrets import token_hex

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table

KINDS = ("email", "iban", "ip", "card", "ssn", "phone", "date")
ROUNDS = 10
#: The session's setting with the key.
PII_KEY = "deedflow.pii.key"


class Feistel:
    """Keyed permutations of {0 .. n - 1}, one for each tweak."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, i: int, half: int) -> int:
        return int.from_bytes(blake2b(f"{tweak}|{i}|{half}".encode(), key=self.key, digest_size=64).digest(), "big")

    def pair(self, x: int, y: int, a: int, b: int, tweak: str, back: bool = False) -> tuple[int, int]:
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                y = (y + sign * self._round(tweak, i, x)) % b
            else:
                x = (x + sign * self._round(tweak, i, y)) % a
        return x, y

    def mixed(self, digits: list[int], radices: list[int], tweak: str, back: bool = False) -> list[int]:
        """Permute a number of mixed radix: its two halves are the two sides."""
        half = (len(digits) + 1) // 2
        sides = []
        for lo, hi in ((0, half), (half, len(digits))):
            value, size = 0, 1
            for d, r in zip(digits[lo:hi], radices[lo:hi], strict=True):
                value, size = value * r + d, size * r
            sides.append((value, size))
        (x, a), (y, b) = sides
        out = []
        for value, lo, hi in zip(self.pair(x, y, a, b, tweak, back), (0, half), (half, len(digits)), strict=True):
            part = []
            for r in reversed(radices[lo:hi]):
                value, d = divmod(value, r)
                part.append(d)
            out += part[::-1]
        return out

    def index(self, i: int, n: int, tweak: str, back: bool = False) -> int:
        """Permute {0 .. n - 1} for any n, by walking the cycle inside the square that holds it."""
        side = max(2, int(n**0.5) + 1)
        while True:
            i = sum(p * q for p, q in zip(self.pair(i // side, i % side, side, side, tweak, back), (side, 1), strict=True))
            if i < n:
                return i


def luhn(digits: str) -> int:
    """The check digit that follows digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def spread(layout: str, chars: str, of: Callable[[str], bool] = str.isdigit) -> str:
    """chars in the places of layout that satisfy of."""
    it = iter(chars)
    return "".join(next(it) if of(c) else c for c in layout)


def letters(fe: Feistel, text: str, tweak: str, back: bool = False) -> str:
    """Permute letters and digits of ASCII within their class; the tweak holds the layout, other characters stay."""
    kinds = [("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else ("0", 10) if "0" <= c <= "9" else None for c in text]
    at = [i for i, k in enumerate(kinds) if k]
    shape = "".join(k[0] if k else c for k, c in zip(kinds, text, strict=True))
    got = fe.mixed([ord(text[i]) - ord(kinds[i][0]) for i in at], [kinds[i][1] for i in at], f"{tweak}|{shape}", back)
    out = list(text)
    for i, d in zip(at, got, strict=True):
        out[i] = chr(ord(kinds[i][0]) + d)
    return "".join(out)


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


# --- a value of each kind to its pseudonym, or None where it isn't valid ------------------------------------------


def email(fe: Feistel, m: str, back: bool = False) -> str | None:
    name, _, domain = m.partition("@")
    host, _, top = domain.rpartition(".")
    return f"{letters(fe, name, 'email', back)}@{letters(fe, host, 'domain', back)}.{top}"


#: Fixed values (ISO 13616): lengths by country; other countries' may have any.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def iban(fe: Feistel, m: str, back: bool = False) -> str | None:
    flat_ = m.replace(" ", "")
    if not 15 <= len(flat_) <= 34 or len(flat_) != IBAN_LENGTHS.get(flat_[:2], len(flat_)) or iban_check(flat_[:2], flat_[4:]) != flat_[2:4]:
        return None
    rest = letters(fe, flat_[4:], "iban" + flat_[:2], back)
    return spread(m, flat_[:2] + iban_check(flat_[:2], rest) + rest, lambda c: c != " ")


def ip(fe: Feistel, m: str, back: bool = False) -> str | None:
    parts = [int(x) for x in m.split(".")]
    if any(p > 255 for p in parts) or any(len(x) > 1 and x[0] == "0" for x in m.split(".")):
        return None
    return ".".join(map(str, fe.mixed(parts, [256] * 4, "ip", back)))


def card(fe: Feistel, m: str, back: bool = False) -> str | None:
    d = digits_of(m)
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn(d[:-1]) != int(d[-1]):
        return None
    body = d[0] + "".join(map(str, fe.mixed([int(c) for c in d[1:-1]], [10] * (len(d) - 2), f"card{len(d)}{d[0]}", back)))
    return spread(m, body + str(luhn(body)))


def ssn(fe: Feistel, m: str, back: bool = False) -> str | None:
    a, b, c = (int(x) for x in m.split("-"))
    if a in (0, 666) or a > 899 or not b or not c:
        return None
    got = fe.mixed([a - 1 - (a > 666), b - 1, c - 1], [898, 99, 9999], "ssn", back)
    area = got[0] + 1
    return f"{area + (area >= 666):03d}-{got[1] + 1:02d}-{got[2] + 1:04d}"


#: Country codes of two digits (ITU-T E.164); 1 and 7 have one, all others three.
TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def country_code(digits: str) -> str:
    return digits[:1] if digits[0] in "17" else digits[:2] if digits[:2] in TWO_DIGITS else digits[:3]


def phone(fe: Feistel, m: str, back: bool = False) -> str | None:
    d = digits_of(m)
    local = d[1:] if m.startswith("+1") and len(d) == 11 else d if len(d) == 10 and not m.startswith("+") else None
    if local:  # ten digits in a North American layout; the country code stays, and so does whether they begin with 0 or 1
        if local[0] in "01" and not m.startswith(("+", "(")):
            return None  # no area code, and nothing else says that it is a telephone number
        low = 0 if local[0] in "01" else 2
        got = fe.mixed([int(local[0]) - low, *map(int, local[1:])], [8 if low else 2] + [10] * 9, f"phone{low}", back)
        return spread(m, d[: len(d) - 10] + str(got[0] + low) + "".join(map(str, got[1:])))
    if not m.startswith("+") or m.startswith("+1") or not 8 <= len(d) <= 15:
        return None
    code = country_code(d)
    rest = d[len(code) :]
    return spread(m, code + "".join(map(str, fe.mixed([int(c) for c in rest], [10] * len(rest), f"phone{code}", back))))


#: A date's pseudonym stays in the span of years that the date is in.
SPANS = ((date(1900, 1, 1), date(2099, 12, 31)), (date(1, 1, 1), date(1899, 12, 31)), (date(2100, 1, 1), date(9999, 12, 31)))


def calendar(fe: Feistel, m: str, back: bool = False) -> str | None:
    sep = re.search(r"[^0-9]", m)[0]
    parts = m.split(sep)
    year_first = len(parts[0]) == 4
    y, p, q = int(parts[0] if year_first else parts[2]), int(parts[1]), int(parts[2] if year_first else parts[0])
    month_first = not year_first and sep == "/" and p > 12  # 12/31/1999; otherwise the day comes first
    month, day = (q, p) if month_first else (p, q)
    try:
        value = date(y, month, day)
    except ValueError:
        return None
    first, last = next(s for s in SPANS if s[0] <= value <= s[1])
    got = first + timedelta(fe.index((value - first).days, (last - first).days + 1, "date" if first == SPANS[0][0] else f"date{first.year}", back))
    # A layout without leading zeros stays one; where both parts have two digits anyway, it can't be told.
    wide = 2 if all(len(x) >= 2 for x in parts) else 1
    if year_first:
        return f"{got.year:04d}{sep}{got.month:0{wide}d}{sep}{got.day:0{wide}d}"
    # A month-first layout that would read as day-first keeps its meaning only where the day says so.
    a, b = (got.month, got.day) if month_first and got.day > 12 else (got.day, got.month)
    return f"{a:0{wide}d}{sep}{b:0{wide}d}{sep}{got.year:04d}"


# Only a word or a number that goes on forbids a value: other punctuation may stand on both sides.
START, END = r"(?<![A-Za-z0-9_+])(?<![0-9][.-])", r"(?![A-Za-z0-9_])(?![.\-/][0-9])"
LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?")
DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}))*\.(?:[Xx][Nn]--[A-Za-z0-9-]{1,58}[A-Za-z0-9]|[A-Za-z]{2,63})(?![A-Za-z0-9])")
PATTERNS = {
    "iban": re.compile(START + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + END),
    "ip": re.compile(r"(?<![A-Za-z0-9_+])(?<![0-9]\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9_])(?!\.[0-9])"),
    "card": re.compile(START + r"[2-6](?:[0-9]{12,18}|[0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{3}([ -])[0-9]{6}\2[0-9]{5})" + END),
    "ssn": re.compile(START + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + END),
    "phone": re.compile(START + r"(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[2-9][0-9]{2} [0-9]{3} [0-9]{4}|[2-9][0-9]{9}|\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,5}\)?){1,5})" + END),
    "date": re.compile(START + r"(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?!\1[0-9])|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}(?!\2[0-9]))(?:(?![A-Za-z0-9_])|(?=T[0-9]))"),
}
MAPS = {"email": email, "iban": iban, "ip": ip, "card": card, "ssn": ssn, "phone": phone, "date": calendar}


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of e-mail addresses, found from their @."""
    at, free = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > free and (text[lo - 1].isascii() and text[lo - 1].isalnum() or text[lo - 1] in "._%+-"):
            lo -= 1
        while lo < at and not text[lo].isalnum():
            lo += 1
        right = DOMAIN.match(text, at + 1)
        if right and lo < at and LOCAL.fullmatch(text, lo, at):
            yield lo, right.end()
            free = right.end()
        at = text.find("@", max(at + 1, free))


def values(kind: str, text: str, swap: Callable[[str, str], str | None]) -> Iterator[tuple[int, int, str | None]]:
    """(start, end, pseudonym) of valid values, leftmost first. Where a match isn't valid, its beginnings up to a separator
    are tried, the longest first."""
    if kind == "email":
        yield from ((a, b, swap(kind, text[a:b])) for a, b in emails(text))
        return
    pattern, at = PATTERNS[kind], 0
    while m := pattern.search(text, at):
        a, b = m.span()
        for end in [b, *(i for i in range(b - 1, a, -1) if text[i] in " .-")]:
            if (end == b or pattern.fullmatch(text, a, end)) and (new := swap(kind, text[a:end])) is not None:
                yield a, end, new
                at = end
                break
        else:
            at = a + 1


def pseudonymise(text: str, swap: Callable[[str, str], str | None]) -> tuple[str, dict[str, int]]:
    """The text with swap(kind, value) in place of every valid value, and the number of each kind."""
    taken: list[tuple[int, int, str]] = []
    counts: dict[str, int] = {}
    for kind in KINDS:
        fresh = []
        known, k = sorted(taken), 0
        for a, b, new in values(kind, text, swap):
            while k < len(known) and known[k][1] <= a:
                k += 1
            if k < len(known) and known[k][0] < b:
                continue
            if new is not None:
                fresh.append((a, b, new))
                counts[kind] = counts.get(kind, 0) + 1
        taken += fresh
    if not taken:
        return text, counts
    out, last = [], 0
    for a, b, new in sorted(taken):
        out += [text[last:a], new]
        last = b
    return "".join([*out, text[last:]]), counts


def protect(docs: DataFrame, key: bytes, text: str = "text", counts: bool = True) -> DataFrame:
    """docs with text pseudonymised in place under a secret key; with counts, also n_email .. n_date (long), in place of
    columns of docs with such a name."""
    if not key:
        raise ValueError("a secret key is needed")
    if counts:
        docs = docs.drop(*[f"n_{k}" for k in KINDS])
    names = docs.columns
    at = names.index(text)
    more = [f"n_{k}" for k in KINDS] if counts else []
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + "".join(f", {n} long" for n in more)

    def run(batches):
        fe = Feistel(key)

        @lru_cache(1 << 14)
        def swap(kind, value):
            return MAPS[kind](fe, value)

        for batch in batches:
            column = batch.column(at)
            # A value has a digit or an @; other texts pass as they are.
            maybe = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False).to_numpy(zero_copy_only=False)
            found = {k: [0] * len(column) for k in KINDS}
            changed = {}
            for i in maybe.nonzero()[0].tolist():
                old = column[i].as_py()
                new, n = pseudonymise(old, swap)
                if n:
                    changed[i] = new
                    for k, c in n.items():
                        found[k][i] = c
            if changed:
                mask = pa.array([i in changed for i in range(len(column))])
                column = pc.replace_with_mask(column, mask, pa.array([changed[i] for i in sorted(changed)], column.type))
            columns = [column if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[n[2:]], pa.int64()) for n in more)], names=[*names, *more])

    return docs.mapInArrow(lean(run), schema)


def session_key(spark: SparkSession) -> bytes:
    """The secret that the session names in PII_KEY; without one a random key for this call, so that nobody can undo
    pseudonyms by reading this code."""
    return (spark.conf.get(PII_KEY, None) or token_hex(32)).encode()


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return protect(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark))
