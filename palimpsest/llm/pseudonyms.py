"""Op 1: format-preserving pseudonyms by keyed Feistel permutations of validated values."""

from __future__ import annotations

import bisect
import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.batches import lut, per_text, raw, slices, texts
from palimpsest.runtime import ship

ROUNDS = 10
#: The key of the registered query; production passes its own.
DEMO_KEY = b"palimpsest demonstration key"
KINDS = ("email", "phone", "card", "ipv4", "iban", "ssn", "date")


class Feistel:
    """A keyed permutation of range(size) for each tweak.

    An alternating Feistel network over mixed radices a * b >= size; values that land
    outside are sent round again (cycle walking), so the result is a permutation. A size of
    0 or 1 has only the identity.
    """

    def __init__(self, key: bytes) -> None:
        self.key = key

    def _round(self, tweak: bytes, i: int, size: int, half: int) -> int:
        return int.from_bytes(hmac.digest(self.key, b"%d|%d|%b|%d" % (i, size, tweak, half), "sha256")[:16], "big")

    def _once(self, x: int, size: int, a: int, b: int, tweak: bytes, back: bool) -> int:
        left, right = divmod(x, b)
        order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        for i in order:
            if i % 2:
                step = self._round(tweak, i, size, left)
                right = (right - step if back else right + step) % b
            else:
                step = self._round(tweak, i, size, right)
                left = (left - step if back else left + step) % a
        return left * b + right

    def _walk(self, x: int, size: int, tweak: bytes, back: bool, valid: Callable[[int], bool] | None) -> int:
        if size < 2:
            return x
        a = max(1, int(size**0.5))
        b = -(-size // a)
        while True:
            x = self._once(x, size, a, b, tweak, back)
            if x < size and (valid is None or valid(x)):
                return x

    def encrypt(self, x: int, size: int, tweak: bytes, valid: Callable[[int], bool] | None = None) -> int:
        """The image of `x`; with `valid`, of a permutation of the valid values alone (`x` is one)."""
        return self._walk(x, size, tweak, False, valid)

    def decrypt(self, x: int, size: int, tweak: bytes, valid: Callable[[int], bool] | None = None) -> int:
        return self._walk(x, size, tweak, True, valid)


def luhn_digit(body: str) -> int:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_digits(country: str, body: str) -> int:
    """The check digits of a country and a body."""
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _refill(pattern: str, fresh: str, wanted: Callable[[str], bool]) -> str:
    """`pattern` with the characters that are `wanted` replaced one by one."""
    new = iter(fresh)
    return "".join(next(new) if wanted(c) else c for c in pattern)


_DIGITS = "0123456789"


@lru_cache(1)
def _late_days() -> list[datetime.date]:
    """The days after the 12th of a month from 1900 to 2099, which no layout can take for a month."""
    first = datetime.date(1900, 1, 1)
    every = (first + datetime.timedelta(k) for k in range((datetime.date(2100, 1, 1) - first).days))
    return [d for d in every if d.day > 12]


# The country codes of one and of two digits; all others have three.
SHORT_CODES = {
    "1", "7",
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
    "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66",
    "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
}


def country_code(digits: str) -> str:
    """The country code an international number begins with."""
    return next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])



# What each format looks like before validation.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9A-Za-z/-])",
    "ipv4": r"(?<![0-9A-Za-z.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-][0-9]{2,4}){2,3}|(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[1-9][0-9]{7,14})(?![0-9A-Za-z])",
}
FIND = re.compile("|".join(f"(?P<{k}>{PATTERNS[k]})" for k in ("email", "iban", "date", "ipv4", "ssn", "card", "phone")))


class Pseudonymiser:
    """Replaces every validated value by another of its format, one to one; equal values stay equal.

    With `back` it turns pseudonyms into the values they stand for.
    """

    def __init__(self, key: bytes, back: bool = False) -> None:
        cipher = Feistel(key)
        self.permute = cipher.decrypt if back else cipher.encrypt
        self.value = lru_cache(1 << 16)(self._value)

    def email(self, text: str) -> str:
        """The local part, each character within its own kind; the lower-cased domain is the tweak."""
        local, domain = text.rsplit("@", 1)
        sizes = [10 if c in _DIGITS else 26 if c.isascii() and c.isalpha() else 1 for c in local]
        total, x = 1, 0
        for c, n in zip(local, sizes):
            at = ord(c) - (48 if n == 10 else 97 if c.islower() else 65)
            total, x = total * n, x * n + (at if n > 1 else 0)
        x = self.permute(x, total, b"email" + domain.lower().encode())
        out = []
        for c, n in zip(reversed(local), reversed(sizes)):
            x, at = divmod(x, n)
            out.append(c if n == 1 else chr(at + (48 if n == 10 else 97 if c.islower() else 65)))
        return "".join(reversed(out)) + "@" + domain

    def _digits(self, head: str, digits: str, tweak: bytes, whole: Callable[[str], str]) -> str:
        """Permute `digits` behind `head` among those whose `whole` number isn't one digit again and again."""
        n = len(digits)
        made = lambda x: whole(head + str(x).zfill(n))
        return made(self.permute(int(digits), 10**n, tweak + head.encode(), lambda x: len(set(made(x))) > 1))

    def card(self, text: str) -> str | None:
        digits = "".join(c for c in text if c in _DIGITS)
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        fresh = self._digits(digits[0], digits[1:-1], b"card", lambda body: body + str(luhn_digit(body)))
        return _refill(text, fresh, _DIGITS.__contains__)

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        country, check, body = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or f"{iban_digits(country, body):02d}" != check:
            return None
        sizes = [10 if c in _DIGITS else 26 for c in body]
        total, x = 1, 0
        for c, n in zip(body, sizes):
            total, x = total * n, x * n + ord(c) - (48 if n == 10 else 65)
        x = self.permute(x, total, b"iban" + country.encode())
        out = []
        for n in reversed(sizes):
            x, at = divmod(x, n)
            out.append(chr(at + (48 if n == 10 else 65)))
        body = "".join(reversed(out))
        return _refill(text, f"{country}{iban_digits(country, body):02d}{body}", lambda c: c != " ")

    def ipv4(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts):
            return None
        x = self.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ipv4")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def ssn(self, text: str) -> str | None:
        """Areas 001-665 and 667-899, groups 01-99, serials 0001-9999."""
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        x = ((area - (area > 666) - 1) * 99 + group - 1) * 9999 + serial - 1
        x = self.permute(x, 898 * 99 * 9999, b"ssn")
        x, serial = divmod(x, 9999)
        area, group = divmod(x, 99)
        area += 1 + (area + 1 >= 666)
        return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"

    def _day(self, day: datetime.date) -> datetime.date:
        """Days up to the 12th among themselves, and later ones among themselves.

        So a day that only one layout can hold stays one, and a day has one pseudonym in all layouts.
        """
        if day.day > 12:
            late = _late_days()
            return late[self.permute(bisect.bisect_left(late, day), len(late), b"date/late")]
        x, d = divmod(self.permute(((day.year - 1900) * 12 + day.month - 1) * 12 + day.day - 1, 200 * 144, b"date/early"), 12)
        return datetime.date(1900 + x // 12, x % 12 + 1, d + 1)

    def date(self, text: str) -> str | None:
        """A calendar day of 1900 to 2099; month first with slashes unless only day first is valid."""
        if "-" in text:
            layouts = [(0, 1, 2)]
        elif "." in text:
            layouts = [(2, 1, 0)]
        else:
            layouts = [(2, 0, 1), (2, 1, 0)]
        parts = re.split(r"[-./]", text)
        for layout in layouts:
            try:
                new = self._day(datetime.date(*(int(parts[k]) for k in layout)))
            except ValueError:
                continue
            out = ["", "", ""]
            for k, shown in zip(layout, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")):
                out[k] = shown
            return re.sub(r"[0-9]+", lambda _, it=iter(out): next(it), text)
        return None

    def phone(self, text: str) -> str | None:
        """7 to 15 digits; the country code stays, the national digits are permuted behind their first.

        Layout plays no part, and a number without a code is one of code 1, so +1 212 555 0100
        and (212) 555-0100 stay linked.
        """
        digits = "".join(c for c in text if c in _DIGITS)
        code = country_code(digits) if text.startswith("+") else "1"
        national = digits[len(code) :] if text.startswith("+") else digits
        if not 7 <= len(code) + len(national) <= 15 or len(national) < 2 or len(set(national)) == 1:
            return None
        fresh = self._digits(national[0], national[1:], b"phone" + code.encode() + b"/", str)
        return _refill(text, code + fresh if text.startswith("+") else fresh, _DIGITS.__contains__)

    def _value(self, kind: str, text: str) -> str | None:
        return getattr(self, kind)(text)

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many values of each kind it held.

        A match that fails its own format's check is tried again as a phone number when it
        starts like one; else it stays.
        """
        counts = dict.fromkeys(KINDS, 0)
        out, last, at = [], 0, 0
        while (m := FIND.search(text, at)) is not None:
            fresh = self.value(m.lastgroup, m.group())
            if fresh is None:
                # A shorter value can begin inside what failed.
                at = m.start() + 1
                continue
            counts[m.lastgroup] += 1
            out += [text[last : m.start()], fresh]
            last = at = m.end()
        return "".join([*out, text[last:]]), counts


@lru_cache(4)
def pseudonymiser(key: bytes) -> Pseudonymiser:
    return Pseudonymiser(key)


def pseudonymise(docs: DataFrame, columns: list[str], key: bytes = DEMO_KEY, text_col: str = "text", counts: bool = True) -> DataFrame:
    """`columns` of `docs` with the text column pseudonymised, and n_replaced and a count by kind.

    `columns` may hold the text column, which keeps its place. One narrow pass: no value is
    looked up anywhere, so the same value gets the same pseudonym on every executor and run
    with the same key, however it is laid out: dates in every layout, phone numbers, cards and
    IBANs with or without separators, letters of either case in e-mail addresses. Null texts stay null, empty ones
    empty; repeated rows and null ids are treated like others; an empty table gives an empty
    result. With `counts` the counts' names must not be among `columns`.
    """
    ship(docs.sparkSession)
    read = docs.select(*columns, F.col(text_col).alias("_text_read"))
    extra = ["n_replaced", *(f"n_{k}" for k in KINDS)] if counts else []
    schema = T.StructType([f for f in read.schema if f.name != "_text_read"] + [T.StructField(c, T.LongType()) for c in extra])
    digit = lut(*range(48, 58))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = pseudonymiser(key)
        for b in slices(batches, "_text_read"):
            array = texts(b, "_text_read")
            data, offsets = raw(array)
            own = b.column("_text_read")
            found = {k: np.zeros(len(array), np.int64) for k in KINDS}
            changed: dict[int, str] = {}
            for k in np.flatnonzero((per_text(digit[data], offsets) >= 6) | (per_text(data == ord("@"), offsets) > 0)):
                text, counted = work.replace(array[int(k)].as_py())
                if any(counted.values()):
                    changed[int(k)] = text
                    for kind, n in counted.items():
                        found[kind][k] = n
            if changed and text_col in columns:
                values = own.to_pylist()
                for k, text in changed.items():
                    values[k] = text
                own = pa.array(values, own.type)
            total = sum(found.values())
            tail = [pa.array(total), *(pa.array(found[k]) for k in KINDS)] if counts else []
            yield pa.RecordBatch.from_arrays([*(own if c == text_col else b.column(c) for c in columns), *tail], [*columns, *extra])

    return read.mapInArrow(run, schema)
