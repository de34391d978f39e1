"""Operator 6: personal data to format-preserving Feistel pseudonyms.

Each value found is validated, taken as a number below the size of its
format, permuted by a keyed Feistel network on the next even number of bits
(walking on until the result is in the format again) and written back in the
shape it had. A permutation keeps different values apart and equal ones
equal, in all documents and however they are punctuated; with the key it can
be undone.

Formats and their validation:

- e-mail addresses: letters and digits change within their kind, all but the
  top-level domain; upper case stays upper;
- payment cards: 13 to 19 digits, Luhn; first digit kept, check digit renewed;
- telephone numbers, North American: valid area and exchange, or written
  with ``+`` or the area in brackets;
- other telephone numbers with ``+`` and country code: 8 to 15 digits, also
  in groups; the country code and a ``(0)`` stay (kind phone as well);
- social security numbers: valid area, group and serial;
- IBANs: mod 97; of the length of the country, so that a word behind it is
  left, or else all that looks like one; country kept, check digits renewed;
- IPv4 addresses: four numbers up to 255;
- dates from 1900 to 2099, year-first, day-first or month-first: real days,
  also before ``T`` and a time, which stays;
- access keys and values behind ``password=``, ``token =`` and the like: letters and digits within their kind,
  at any length (values of over 64 characters in linked blocks).

What isn't valid stays as it is.

Defined results: null text stays null, with nothing found. Every row gives
one row.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import re
import string

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import id_and_text, ready, slices

ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

#: The shapes that are looked for, the first that fits counts.
SHAPES = {
    "email": r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9])",
    "key": r"\bAKIA[A-Z0-9]{16}\b",
    "password": r"(?i:\b(?:password|passwd|secret|token|api_?key)\s?[=:]\s?)[\"']?[A-Za-z0-9_\-+/]{6,}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "date": r"(?<![\w./-])(?:\d{4}(?P<a>[-/.])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[-/.])\d{1,2}(?P=b)\d{4})(?:(?=[Tt]\d\d)|(?!\w|[./-]\d))",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+?1[\s.-]?)?(?:\(\d{3}\)\s?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    "e164": r"(?<![\w+])\+[1-9](?:[ ./-]?\(?\d\)?){7,15}(?!\w)",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?P<c>[ -])\d{4}(?P=c)\d{4}(?P=c)\d{1,7}|3\d{3}(?P<d>[ -])\d{6}(?P=d)\d{5})(?![\w-])",
}
KINDS = list(SHAPES)
#: Length of an IBAN by country, from the registry.
IBAN_LENGTH = {c: n for n, of in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU"}.items() for c in of.split()}
#: Telephone country codes of one and two digits; all others have three.
_DIALLED = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")
_ANY = re.compile("|".join(f"(?P<{k}>{v})" for k, v in SHAPES.items()))


def _first(text: str) -> bool:
    """Whether a text can hold a value at all."""
    return "@" in text or "=" in text or ":" in text or _DIGIT.search(text) is not None


_DIGIT = re.compile(r"\d|AKIA")


class Feistel:
    """Keyed permutations of the numbers below any ``size``."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, tweak: bytes, r: int, x: int, half: int) -> int:
        if half > 448:          # more than one digest holds
            raw = b"%d|%d|" % (r, half) + x.to_bytes(half // 8 + 1, "big") + tweak
            out = hashlib.shake_256(self.key + raw).digest(half // 8 + 9)
            return int.from_bytes(out, "big") & ((1 << half) - 1)
        out = hashlib.blake2b(b"%d|%d|%d|%s" % (r, half, x, tweak), key=self.key,
                              digest_size=min(64, half // 8 + 9)).digest()
        return int.from_bytes(out, "big") & ((1 << half) - 1)

    def _once(self, x: int, half: int, tweak: bytes, back: bool) -> int:
        low = (1 << half) - 1
        a, b = x >> half, x & low
        for r in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
            if back:
                a, b = b ^ self._f(tweak, r, a, half), a
            else:
                a, b = b, a ^ self._f(tweak, r, b, half)
        return a << half | b

    def permute(self, x: int, size: int, tweak: bytes, back: bool = False) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        x = self._once(x, half, tweak, back)
        while x >= size:
            x = self._once(x, half, tweak, back)
        return x


#: Characters that are permuted as one number.
LINK = 64


def _chars(f: Feistel, s: str, tweak: bytes, back: bool) -> str:
    """Letters and digits permuted within their kind; the case pattern and all
    else stays. Equal but for case gives equal but for case.

    A value of more than ``LINK`` characters is permuted in linked blocks of as
    many, from front to back, each under a digest of what came out before, then
    from back to front: every character depends on all, and the time grows
    with the length."""
    if len(s) <= LINK:
        return _block(f, s, tweak, back)
    blocks = [s[i:i + LINK] for i in range(0, len(s), LINK)]
    tweak += b"|%d" % len(s)
    for way in ((1, 0) if back else (0, 1)):
        order = range(len(blocks)) if way == 0 else range(len(blocks) - 1, -1, -1)
        chain, done = b"", list(blocks)
        for i in order:
            new = _block(f, blocks[i], tweak + b"|%d|%d|" % (way, i) + chain, back)
            done[i] = new
            out = blocks[i] if back else new        # what this pass gave, or had given, here
            chain = hashlib.blake2b(chain + out.lower().encode(), key=f.key, digest_size=16).digest()
        blocks = done
    return "".join(blocks)


def _block(f: Feistel, s: str, tweak: bytes, back: bool) -> str:
    low, x, size = s.lower(), 0, 1
    kinds = [string.digits if c in string.digits else string.ascii_lowercase if c in string.ascii_lowercase else ""
             for c in low]
    for c, k in zip(low, kinds, strict=True):
        if k:
            x, size = x * len(k) + k.index(c), size * len(k)
    tweak += b"|" + "".join("0" if len(k) == 10 else "a" if k else c for c, k in zip(low, kinds, strict=True)).encode()
    x, out = f.permute(x, size, tweak, back), list(s)
    for i in range(len(s) - 1, -1, -1):
        if k := kinds[i]:
            x, d = divmod(x, len(k))
            out[i] = k[d].upper() if s[i].isupper() else k[d]
    return "".join(out)


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _luhn(digits: str) -> int:
    """The check digit for the digits before it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _email(f, s, back):
    head, dot, top = s.rpartition(".")
    return _chars(f, head, b"email|" + top.lower().encode(), back) + dot + top


def _key(f, s, back):
    return s[:4] + _chars(f, s[4:], b"key", back)


def _password(f, s, back):
    at = re.search(r"[=:]\s?[\"']?", s).end()
    return s[:at] + _chars(f, s[at:], b"password", back)


def _card(f, s, back):
    d = re.sub(r"\D", "", s)
    if not 13 <= len(d) <= 19 or _luhn(d[:-1]) != int(d[-1]) or len(set(d)) == 1:
        return None
    n = len(d) - 2
    new = d[0] + str(f.permute(int(d[1:-1]), 10 ** n, b"card|%d|%s" % (n, d[0].encode()), back)).zfill(n)
    return _refill(s, new + str(_luhn(new)))


def _phone(f, s, back):
    d = re.sub(r"\D", "", s)
    d, front = d[-10:], d[:-10]
    valid = lambda n: n[0] not in "01" and n[3] not in "01"
    if not valid(d) and not s.startswith(("+", "(")):
        return None
    x = int(d)
    while True:       # walk on to the next number of the same validity
        x = f.permute(x, 10 ** 10, b"phone", back)
        new = str(x).zfill(10)
        if valid(new) == valid(d):
            return _refill(s, front + new)


def _e164(f, s, back):
    trunk = s.find("(0)")
    d = re.sub(r"\D", "", s.replace("(0)", "", 1))
    if not 8 <= len(d) <= 15:
        return None
    if len(d) == 11 and d[0] == "1" and trunk < 0:
        return _phone(f, s, back)       # North American, as with separators
    n = len(d) - len(code := _DIALLED.match(d)[0])
    x, front = int(d[len(code):]), sum(c.isdigit() for c in s[:max(trunk, 0)])
    while True:       # walk on to a number with the same first (0), or without one
        x = f.permute(x, 10 ** n, b"e164|%d|%s" % (n, code.encode()), back)
        new = code + str(x).zfill(n)
        new = _refill(s, new if trunk < 0 else new[:front] + "0" + new[front:])
        if new.find("(0)") == trunk:
            return new


def _ssn(f, s, back):
    a, g, n = map(int, s.split("-"))
    if not (0 < a < 900 and a != 666 and g and n):
        return None
    a -= 1 if a < 666 else 2
    x = f.permute((a * 99 + g - 1) * 9999 + n - 1, 898 * 99 * 9999, b"ssn", back)
    x, n = divmod(x, 9999)
    a, g = divmod(x, 99)
    return f"{a + (1 if a < 665 else 2):03d}-{g + 1:02d}-{n + 1:04d}"


def _mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def _is_iban(flat: str) -> bool:
    return 15 <= len(flat) <= 34 and _mod97(flat[4:] + flat[:4]) == 1


def _own_length(s: str) -> str | None:
    """The front of ``s`` that is a valid IBAN of its country's length."""
    n, end = IBAN_LENGTH.get(s[:2], 0), 0
    for end, c in enumerate(s, 1):
        n -= c != " "
        if n == 0:
            break
    if n or s[end:end + 1].isalnum() or not _is_iban(s[:end].replace(" ", "")):
        return None
    return s[:end]


def _iban(f, s, back):
    own = _own_length(s)
    s = own or s
    flat = s.replace(" ", "")
    if not _is_iban(flat):
        return None
    while True:       # walk on, so that one of another length doesn't start with one of its country's
        body = _chars(f, flat[4:], b"iban|" + flat[:2].encode(), back)
        flat = f"{flat[:2]}{98 - _mod97(body + flat[:2] + '00'):02d}{body}"
        it = iter(flat)
        new = "".join(c if c == " " else next(it) for c in s)
        if own or not _own_length(new):
            return new


def _ip(f, s, back):
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = f.permute(int.from_bytes(bytes(map(int, parts)), "big"), 2 ** 32, b"ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _date(f, s, back):
    sep = re.search(r"\D", s)[0]
    p = s.split(sep)
    orders = ["ymd"] if len(p[0]) == 4 else ["dmy", "mdy"]
    for order in orders:
        v = dict(zip(order, map(int, p), strict=True))
        try:
            day = dt.date(v["y"], v["m"], v["d"]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # a day-first date stays one that reads day-first, a month-first date one that doesn't
        only = order == "mdy"
        while True:
            day = FIRST_DAY + f.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, b"date", back)
            new = dt.date.fromordinal(day)
            if not only or new.day > 12:
                break
        width = {"y": 4, "m": min(len(p[order.index("m")]), 2), "d": min(len(p[order.index("d")]), 2)}
        of = {"y": new.year, "m": new.month, "d": new.day}
        return sep.join(str(of[c]).zfill(width[c]) for c in order)
    return None


_MAKE = {"email": _email, "key": _key, "password": _password, "card": _card, "phone": _phone, "e164": _e164, "ssn": _ssn,
         "iban": _iban, "ip": _ip, "date": _date}


def pseudonymise(f: Feistel, text: str, back: bool = False) -> tuple[str, list[str]]:
    """The text with its values replaced, and their kinds in order."""
    found: list[str] = []
    if not _first(text):
        return text, found
    out, at = [], 0
    while m := _ANY.search(text, at):
        new = _MAKE[m.lastgroup](f, m[0], back)
        # an IBAN has the length it had; what it leaves of the match is looked through again
        end = m.start() + len(new) if m.lastgroup == "iban" and new is not None else m.end()
        out += [text[at:m.start()], text[m.start():end] if new is None else new]
        if new is not None:
            found.append("phone" if m.lastgroup == "e164" else m.lastgroup)
        at = end
    return "".join([*out, text[at:]]), found


@functools.lru_cache(4)
def _feistel(key: bytes) -> Feistel:
    return Feistel(key)


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_values, kinds (of the values in order), text."""

    def run(batches):
        f = _feistel(key)
        for b in slices(batches):
            done = [(None, []) if t is None else pseudonymise(f, t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(k) for _, k in done], pa.int32()),
                 pa.array([k for _, k in done], pa.list_(pa.string())), pa.array([t for t, _ in done], pa.string())],
                names=["doc_id", "n_values", "kinds", "text"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_values int, kinds array<string>, text string")


def replace_text(docs: DataFrame, key: bytes, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the text replaced, and its length
    in ``length_col``, if named."""
    ready(docs.sparkSession)

    def run(batches):
        f = _feistel(key)
        for b in slices(batches, text_col):
            i = b.schema.get_field_index(text_col)
            new = [None if t is None else pseudonymise(f, t)[0] for t in b.column(i).to_pylist()]
            yield b.set_column(i, b.schema.field(i), pa.array(new, b.schema.field(i).type))

    out = docs.mapInArrow(run, T.StructType([T.StructField(x.name, x.dataType) for x in docs.schema]))
    if length_col:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out
