"""Operator 2: format-preserving pseudonyms for personal data, by a keyed Feistel network.

Found values are validated (Luhn, octets, calendar, mod 97, valid number ranges), mapped to a number within all values of
their format, permuted there under a key, and written back in the same format: separators, lengths, check digits
and country codes stay. The permutation is one to one, so equal values stay equal across documents and
different ones different, and the holder of the key can reverse it. Digits that fail validation are left alone.

At each start the longest fit is tried first, then every shorter one that ends there as a value may end (an IBAN: first the
length of its country), so that what follows a value does not hide it: a card before its expiry, an IBAN before a currency.

Kinds: card, iban, ssn, phone, ip, ipv6, date, email, secret (32 and more hexadecimal digits). Digits are ASCII ones.

Nulls: a null text stays null, with nothing found; other columns pass through. Repeated rows are treated alike. An
empty table gives no rows. Very long texts and values are read whole, in time that follows their length. Of kinds that
fit at one place the first in the list above KINDS counts; of values that overlap the one that starts first.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from calendar import monthrange
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from ipaddress import AddressValueError, IPv6Address
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailybars.llm.common import holds, on_workers, release_others

ROUNDS = 10


class Feistel:
    """A keyed permutation of 0 .. n - 1 for any n: unequal halves, and walking on until the result is in range."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, number: int, half: int, modulus: int) -> int:
        size = max(16, (modulus.bit_length() + 7) // 8 + 8)
        data = tweak + bytes([number]) + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=self.key).digest()
        return int.from_bytes(out[:size], "big") % modulus

    def _pass(self, x: int, a: int, b: int, tweak: bytes, back: bool) -> int:
        left, right = divmod(x, b)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if number % 2:
                right = (right + sign * self._round(tweak, number, left, b)) % b
            else:
                left = (left + sign * self._round(tweak, number, right, a)) % a
        return left * b + right

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        # Decimal as long as Python writes numbers so.
        marked = f"{tweak}/{n}".encode() if n.bit_length() < 4096 else f"{tweak}/x{n:x}".encode()
        while True:
            x = self._pass(x, a, b, marked, back)
            if x < n:
                return x


def luhn(digits: str) -> int:
    """0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _refill(pattern: str, digits: str) -> str:
    """The digits of a pattern replaced in order; all else stays."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in pattern)


Permute = Callable[[int, int, str], int]


def _card(value: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", value)
    if luhn(digits) or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = str(permute(int(digits[:-1]), 10**n, f"card{n}")).zfill(n)
    return _refill(value, body + str((10 - luhn(body + "0")) % 10))


ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


#: Longer values are permuted block by block: big numbers cost the square of their length.
BLOCK = 256


def _by_class(value: str, permute: Permute, tweak: str, alphabets=ALPHABETS) -> str:
    """Every character of an alphabet becomes another of the same alphabet; the rest stays.

    A value of more than one block has each block permuted under a digest of all that is before it in the value, so that
    the whole stays one to one, and blocks that two values share differ once anything before them does.
    """
    if len(value) <= BLOCK:
        return _block(value, permute, tweak, alphabets)
    before, out = hashlib.blake2b(digest_size=16), []
    for at in range(0, len(value), BLOCK):
        part = value[at : at + BLOCK]
        out.append(_block(part, permute, f"{tweak}/{at}/{before.hexdigest()}", alphabets))
        before.update(part.encode())
    return "".join(out)


def _block(value: str, permute: Permute, tweak: str, alphabets) -> str:
    number, size, own = 0, 1, []
    for c in value:
        alphabet = next((a for a in alphabets if c in a), None)
        own.append(alphabet)
        if alphabet:
            number, size = number * len(alphabet) + alphabet.index(c), size * len(alphabet)
    shape = "".join(c if a is None else str(alphabets.index(a)) for c, a in zip(value, own))
    number = permute(number, size, f"{tweak}/{shape}")
    out = []
    for c, alphabet in zip(reversed(value), reversed(own)):
        if alphabet:
            number, at = divmod(number, len(alphabet))
            c = alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def _iban(value: str, permute: Permute) -> str | None:
    plain = value.replace(" ", "")

    def rest(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97

    if rest(plain) != 1:
        return None
    body = _by_class(plain[4:], permute, f"iban{plain[:2]}")
    check = 98 - rest(plain[:2] + "00" + body)
    new = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(new) for c in value)


def _ssn(value: str, permute: Permute) -> str | None:
    area, group, serial = (int(value[a:b]) for a, b in ((0, 3), (4, 6), (7, 11)))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    area -= 1 + (area > 666)
    x = permute((area * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    area += 1 + (area + 1 >= 666)
    return f"{area:03d}{value[3]}{group + 1:02d}{value[6]}{serial + 1:04d}"


def _phone(value: str, permute: Permute) -> str | None:
    head = re.match(r"\+\d{1,3}(?=\D)", value)
    head = head.group() if head else ""
    digits = re.sub(r"\D", "", value[len(head) :])
    if not 7 <= len(digits) <= 12:
        return None
    new = str(permute(int(digits), 10 ** len(digits), f"phone{len(digits)}")).zfill(len(digits))
    return head + _refill(value[len(head) :], new)


def _ip(value: str, permute: Permute) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    x = permute(int.from_bytes(bytes(map(int, octets)), "big"), 2**32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ipv6(value: str, permute: Permute) -> str | None:
    try:
        IPv6Address(value)
    except AddressValueError:
        return None
    upper, lower = value != value.lower(), value != value.upper()
    if upper and lower:
        return None
    return _by_class(value, permute, "ipv6", HEX[upper])


FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


@lru_cache(1)
def month_first_days() -> list[int]:
    return [day for day in range(FIRST_DAY, LAST_DAY + 1) if date.fromordinal(day).day > 12]


def _date(value: str, permute: Permute) -> str | None:
    parts = re.split(r"\D", value)
    order = "ymd" if len(parts[0]) == 4 else "dmy"
    found = dict(zip(order, map(int, parts)))
    if order == "dmy" and found["m"] > 12 >= found["d"]:
        order, found = "mdy", {"m": found["d"], "d": found["m"], "y": found["y"]}
    y, m, d = found["y"], found["m"], found["d"]
    if not (1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= monthrange(y, m)[1]):
        return None
    day = date(y, m, d).toordinal()
    if order == "mdy":
        # Only a day above 12 shows that the month comes first; the new date has one, too.
        days = month_first_days()
        new = date.fromordinal(days[permute(bisect_left(days, day), len(days), "date/mdy")])
    else:
        new = date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))
    written = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    separators = re.findall(r"\D", value)
    return written[order[0]] + separators[0] + written[order[1]] + separators[1] + written[order[2]]


def _email(value: str, permute: Permute) -> str | None:
    head, dot, top = value.rpartition(".")
    return _by_class(head, permute, "email") + dot + top


HEX = ("0123456789abcdef",), ("0123456789ABCDEF",)


def _secret(value: str, permute: Permute) -> str | None:
    if value.isdigit() or value.isalpha():
        return None
    return _by_class(value, permute, "secret", HEX[value != value.lower()])


#: In this order at each place; the first that fits and is valid is taken.
KINDS: dict[str, tuple[str, Callable]] = {
    "email": (r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "secret": (r"[0-9a-f]{32,}|[0-9A-F]{32,}", _secret),
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}", _iban),
    "card": (r"[0-9](?:[ -]?[0-9]){12,18}", _card),
    "ip": (r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", _ip),
    "ipv6": (r"[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}", _ipv6),
    "date": (r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}", _date),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn),
    "phone": (
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
        r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}",
        _phone,
    ),
}
#: What must not follow: the value would go on. A time may follow a date.
TAILS = dict.fromkeys(KINDS, r"[\w@]|[.-]\d") | {
    "email": r"[\w@]", "date": r"(?![Tt]\d\d)[\w@]|[.-]\d", "ipv6": r"[\w@:]|[.-]\d",
}
#: What must not precede.
HEADS = {"email": r"(?<![\w.%+-])", "ipv6": r"(?<![\w.@+:])"}
PATTERNS = {
    kind: re.compile(rf"{HEADS.get(kind, r'(?<![\w.@+])')}(?:{pattern})(?!{TAILS[kind]})")
    for kind, (pattern, _) in KINDS.items()
}
WHOLE = {kind: re.compile(pattern) for kind, (pattern, _) in KINDS.items()}
GOES_ON = {kind: re.compile(tail) for kind, tail in TAILS.items()}

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


def _ends(kind: str, text: str, match: re.Match) -> Iterator[int]:
    """Where a value from the start of the match may end, in the order to be tried."""
    first, longest = match.span()
    if kind == "iban" and (length := IBAN_LENGTHS.get(match.group()[:2])):
        last = first
        for last in range(first + 1, longest + 1):
            length -= text[last - 1] != " "
            if not length:
                break
        if not length and last < longest and not GOES_ON[kind].match(text, last):
            yield last
        yield longest
        return
    yield longest
    for last in range(longest - 1, first, -1):
        if not GOES_ON[kind].match(text, last) and WHOLE[kind].fullmatch(text, first, last):
            yield last


DIGIT = re.compile(r"\d")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.permute = lru_cache(100_000)(Feistel(key).permute)

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, first, last) of what was found in the original."""
        found: list[tuple[int, int, str, str]] = []
        if "@" in text:
            found += self._matches("email", text)
        if DIGIT.search(text):
            for kind in KINDS:
                if kind != "email":
                    found += self._matches(kind, text)
        elif not found:
            return text, []
        rank = {kind: i for i, kind in enumerate(KINDS)}
        found.sort(key=lambda x: (x[0], rank[x[2]]))
        out, spans, at = [], [], 0
        for first, last, kind, new in found:
            if first >= at:
                out += [text[at:first], new]
                spans.append((kind, first, last))
                at = last
        return "".join([*out, text[at:]]), spans

    def _matches(self, kind: str, text: str) -> Iterator[tuple[int, int, str, str]]:
        write = KINDS[kind][1]
        at = 0
        while match := PATTERNS[kind].search(text, at):
            first, at = match.start(), match.start() + 1
            for last in _ends(kind, text, match):
                new = write(text[first:last], self.permute)
                if new is not None:
                    yield first, last, kind, new
                    at = last
                    break


_made: dict[bytes, Pseudonyms] = {}
holds("pseudonyms", _made.clear)


def _pseudonyms(key: bytes) -> Pseudonyms:
    release_others("pseudonyms")
    if key not in _made:
        _made[key] = Pseudonyms(key)
    return _made[key]


def rewritten(docs: DataFrame, key: bytes) -> DataFrame:
    """All columns of docs, `text` with pseudonyms. Row by row, no shuffle."""
    on_workers(docs.sparkSession)
    at = docs.columns.index("text")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewrite = _pseudonyms(key).rewrite
        for batch in batches:
            new = [None if t is None else rewrite(t)[0] for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(new, pa.string()), *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(tasks, docs.schema)


SPANS = T.ArrayType(T.StructType().add("kind", "string").add("first", "integer").add("last", "integer"))


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text (with pseudonyms), n_found, spans (kind, first, last: characters of the original)."""
    on_workers(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("n_found", "integer").add("spans", SPANS)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewrite = _pseudonyms(key).rewrite
        for batch in batches:
            made = [(None, []) if t is None else rewrite(t) for t in batch.column(1).to_pylist()]
            spans = [[dict(zip(("kind", "first", "last"), s)) for s in x] for _, x in made]
            columns = [
                batch.column(0),
                pa.array([t for t, _ in made], pa.string()),
                pa.array([len(s) for s in spans], pa.int32()),
                pa.array(spans, arrow),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_found", "spans"])

    return texts.mapInArrow(tasks, schema)


def refreshed_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs
