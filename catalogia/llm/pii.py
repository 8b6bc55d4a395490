"""PII: format-preserving pseudonyms from a keyed Feistel network.

Each value is permuted within its own format: digits stay digits, letters letters, separators
stay where they are, and numbers with a check digit stay valid.  The permutation depends only on
the key, the kind and the format, so equal values stay equal across all documents, and whoever
holds the key can invert it.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import math
import re
from functools import cache, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 10
HEX = "0123456789abcdef"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# The patterns of the kinds, tried in this order at each place.
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<iban>\b(?![0-9A-F]{32,64}(?![0-9A-Za-z]))[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b)"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![./-]?\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\d-])"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?![\d-])|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<secret>(?<![0-9A-Za-z])(?=[a-fA-F]*[0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z]))"
)


def feistel(value: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of 0 .. size - 1 (alternating modular halves, walking back into range)."""
    if size < 2:
        return value
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for i in range(ROUNDS):
            if i % 2 == 0:
                left = (left + _round(key, tweak, i, right, a)) % a
            else:
                right = (right + _round(key, tweak, i, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def _round(key: bytes, tweak: str, i: int, half: int, modulus: int) -> int:
    if modulus <= 1 << 128:
        data = f"{tweak}|{i}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=16).digest(), "big")
    # As many digests as reach the highest symbols of a long value, and 64 bits more.
    blocks = -(-(modulus.bit_length() + 64) // 512)
    seed = hashlib.blake2b(f"{tweak}|{i}|{half:x}".encode(), key=key[:64]).digest()
    digests = [hashlib.blake2b(seed + k.to_bytes(8, "big"), key=key[:64]).digest() for k in range(blocks)]
    return int.from_bytes(b"".join(digests), "big")


def _permuted(symbols: str, alphabet: str, key: bytes, tweak: str) -> str:
    """The string of ``alphabet`` symbols of the same length that stands for ``symbols``."""
    n, value = len(alphabet), 0
    for s in symbols:
        value = value * n + alphabet.index(s)
    value = feistel(value, n ** len(symbols), key, f"{tweak}|{n}|{len(symbols)}")
    out = []
    for _ in symbols:
        value, r = divmod(value, n)
        out.append(alphabet[r])
    return "".join(reversed(out))


def _refill(template: str, old: str, new: str) -> str:
    """``template`` with its symbols, which are ``old`` in order, replaced by ``new``."""
    out, i = [], 0
    for c in template:
        if i < len(old) and c == old[i]:
            out.append(new[i])
            i += 1
        else:
            out.append(c)
    return "".join(out)


def luhn_digit(digits: str) -> str:
    """Check digit that makes ``digits`` followed by it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _email(text, key):
    local, domain = text.rsplit("@", 1)
    # Letters and digits are permuted as one string in lower case; the domain tells no person.
    symbols = "".join(c for c in local.lower() if c in LETTERS or c in HEX)
    if not symbols:
        return text
    mask = [c.lower() in LETTERS or c in HEX for c in local]
    alphabet = "0123456789" + LETTERS
    new = iter(_permuted(symbols, alphabet, key, "email"))
    return "".join(next(new) if m else c for c, m in zip(local, mask, strict=True)) + "@" + domain


def _card(text, key):
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        # Not a valid card: still a long number of somebody's, permuted as plain digits.
        return _refill(text, digits, _permuted(digits, HEX[:10], key, "number"))
    body = _permuted(digits[:-1], HEX[:10], key, "card")
    return _refill(text, digits, body + luhn_digit(body))


def _phone(text, key):
    # The country code stays, so that the number stays one of its country.
    head = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d|", text).group()
    rest = text[len(head):]
    digits = re.sub(r"\D", "", rest)
    return head + _refill(rest, digits, _permuted(digits, HEX[:10], key, "phone"))


def _ssn(text, key):
    digits = text.replace("-", "")
    return _refill(text, digits, _permuted(digits, HEX[:10], key, "ssn"))


def _ip(text, key):
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return text
    value = feistel(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 12, 31).toordinal()


@cache
def _late_days() -> list[int]:
    """Days after the 12th of a month: written mm/dd they are no dd/mm date, so the form is known."""
    return [d for d in range(FIRST_DAY, LAST_DAY + 1) if datetime.date.fromordinal(d).day > 12]


def _date(text, key):
    iso, month_first = text[4] == "-", False
    parts = list(map(int, re.split(r"[-./]", text)))
    year, month, day = parts if iso else reversed(parts)
    if not iso and month > 12:
        month_first, month, day = True, day, month
    try:
        at = datetime.date(year, month, day).toordinal()
    except ValueError:
        return text
    if not FIRST_DAY <= at <= LAST_DAY:
        return text
    if month_first:
        days = _late_days()
        new = days[feistel(bisect.bisect_left(days, at), len(days), key, "date|mdy")]
    else:
        new = FIRST_DAY + feistel(at - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date")
    new = datetime.date.fromordinal(new)
    if iso:
        return new.isoformat()
    first, second = (new.month, new.day) if month_first else (new.day, new.month)
    return f"{first:02d}{text[2]}{second:02d}{text[5]}{new.year:04d}"


def _iban(text, key):
    plain = text.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if len(plain) < 15 or iban_check(country, account) != plain[2:4]:
        return text
    digits = "".join(c for c in account if c.isdigit())
    moved = _refill(account, digits, _permuted(digits, HEX[:10], key, "iban"))
    return _refill(text, plain, country + iban_check(country, moved) + moved)


def _secret(text, key):
    new = _permuted(text.lower(), HEX, key, "secret")
    return new if text == text.lower() else new.upper()


PSEUDONYMS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn,
              "card": _card, "secret": _secret}


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, dict[str, int]]:
    """The text with every value replaced, and how many of each kind were."""
    if not text:
        return text, {}
    counts: dict[str, int] = {}
    replace = _replacer(key)

    def new(match):
        kind, old = match.lastgroup, match.group()
        value = replace(kind, old)
        if value != old:
            counts[kind] = counts.get(kind, 0) + 1
        return value

    return PATTERN.sub(new, text), counts


@lru_cache(maxsize=8)
def _replacer(key: bytes):
    @lru_cache(maxsize=100_000)
    def replace(kind, old):
        return PSEUDONYMS[kind](old, key)

    return replace


# A text without one of these holds no value of any kind; most texts are settled here.
HINT = re.compile(r"\d|@")


def replace_pii(docs: DataFrame, key: bytes, text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and, with ``counts``, columns pii_count and pii_kinds.

    Kinds: e-mail addresses (local part), card numbers (Luhn-valid ones stay valid, other numbers
    of 13 to 19 digits are permuted as digits), IBANs that check, IPv4 addresses, real dates of
    1900 to 2100 (year, day or month first; xx/yy is mm/dd only if it is no dd/mm), phone numbers (country code kept), social security numbers and hexadecimal
    secrets of 32 to 64 digits.  A null or empty text stays as it is; all other columns and rows
    are kept unchanged, existing columns of the two names are replaced.
    """
    made = ("pii_count", "pii_kinds")
    kept = [n for n in docs.columns if not counts or n not in made]
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.select(*[f"`{n}`" for n in kept]).dtypes)

    def run(batches):
        for batch in batches:
            texts, found = [], []
            for text in batch.column(text_col).to_pylist():
                new, seen = pseudonymise(text, key) if text and HINT.search(text) else (text, {})
                texts.append(new)
                found.append(seen)
            at = batch.schema.get_field_index(text_col)
            columns = [batch.column(n) for n in kept]
            columns[kept.index(text_col)] = pa.array(texts, batch.column(at).type)
            names = list(kept)
            if counts:
                columns += [pa.array([sum(f.values()) for f in found], pa.int64()),
                            pa.array([",".join(sorted(f)) for f in found], pa.string())]
                names += made
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*[f"`{n}`" for n in kept]).mapInArrow(
        run, fields + (", pii_count long, pii_kinds string" if counts else ""))
