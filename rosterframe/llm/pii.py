"""Format-preserving pseudonyms for personal data.

Values that pass their validation (Luhn, mod 97, calendar, octet and numbering-plan
rules) are replaced by the image of a keyed permutation of their own format, so the
pseudonym is valid too, equal values stay linked across documents, and different ones
stay different.  The permutation is a Feistel network over the integers below the size
of the format (after Black and Rogaway, "Ciphers with Arbitrary Finite Domains", 2002):
alternating keyed additions on two halves, walked on until the result lies inside.
E-mail names and secrets are permuted character class by character class in the same way.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import ipaddress
import json
import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Alphabets, month names, two-digit country calling codes.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
MONTHS = ("January February March April May June July August September October November December").split()
CALLING_2 = {20, 27, *range(30, 35), 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98}

#: Digits after the country code (fewest, most) where the numbering plan bounds them closely; a trunk zero comes on top.
NATIONAL = {
    1: (10, 10), 7: (10, 10), 20: (9, 10), 27: (9, 9), 30: (10, 10), 31: (9, 9), 32: (8, 9), 33: (9, 9), 34: (9, 9), 36: (8, 9), 39: (8, 11),
    40: (9, 9), 41: (9, 9), 44: (9, 10), 45: (8, 8), 46: (7, 10), 47: (8, 8), 48: (9, 9), 49: (7, 11), 51: (8, 9), 52: (10, 10), 54: (10, 11),
    55: (10, 11), 56: (9, 9), 57: (10, 10), 58: (10, 10), 60: (8, 10), 61: (9, 9), 62: (8, 12), 63: (9, 10), 64: (8, 10), 65: (8, 8), 66: (8, 9),
    81: (9, 10), 82: (8, 10), 84: (9, 10), 86: (10, 11), 90: (10, 10), 91: (10, 10), 92: (9, 10), 94: (9, 9), 98: (10, 10), 351: (9, 9),
    353: (7, 9), 358: (6, 11), 380: (9, 9), 420: (9, 9), 421: (9, 9), 852: (8, 8), 886: (8, 9), 966: (8, 9), 971: (8, 9), 972: (8, 9)}
#: Groups of digits in which card numbers are written, besides a single one; likelier ones first.
CARD_GROUPS = [(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 4, 2), (4, 4, 4, 4, 1), (6, 13), (8, 8), (4, 4, 4, 1), (4, 3, 3, 3)]

#: Days that are permuted among themselves.
SPANS = [(dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()), (dt.date(1800, 1, 1).toordinal(), dt.date(1899, 12, 31).toordinal())]
ROUNDS = 10
#: Characters permuted together: an addition's 256 bits are wider than half of them.
CHUNK = 64


class Cipher:
    """A keyed permutation of range(size), for any size; ``tweak`` selects another one."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode()).digest()

    def _add(self, tweak: bytes, i: int, value: int) -> int:
        text = b"%d|%d|" % (i, value) + tweak
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big")

    def permute(self, x: int, size: int, tweak: str) -> int:
        if size <= 1:
            return x
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        mark = f"{tweak}|{size}".encode()
        while True:
            left, right = divmod(x, b)
            for i in range(0, ROUNDS, 2):
                left = (left + self._add(mark, i, right)) % a
                right = (right + self._add(mark, i + 1, left)) % b
            x = left * b + right
            if x < size:
                return x

    def permute_chars(self, text: str, tweak: str, alphabets: tuple[str, ...] = (DIGITS, LOWER, UPPER)) -> str:
        """Permute the characters of each alphabet among themselves, jointly; others stay.
        A longer text goes chunk by chunk, each by a permutation of its own."""
        if len(text) > CHUNK:
            return "".join(self.permute_chars(text[k:k + CHUNK], f"{tweak}|{k // CHUNK}", alphabets) for k in range(0, len(text), CHUNK))
        own = [next((a for a in alphabets if c in a), None) for c in text]
        x, size = 0, 1
        for c, a in zip(text, own):
            if a:
                x, size = x * len(a) + a.index(c), size * len(a)
        x = self.permute(x, size, f"{tweak}|{'.'.join(str(len(a)) if a else c for c, a in zip(text, own))}")
        out = list(text)
        for k in range(len(text) - 1, -1, -1):
            if own[k]:
                x, r = divmod(x, len(own[k]))
                out[k] = own[k][r]
        return "".join(out)


# ------------------------------------------------------------- validations

def luhn_sum(digits: str) -> int:
    doubled = (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def iban_mod(compact: str) -> int:
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in turn by ``chars``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


# --------------------------------------------------- finders: match -> new text, or places and new texts in it

Found = tuple[int, int, str]

def _email(m: re.Match, c: Cipher) -> str:
    name, domain = m[0].lower().rsplit("@", 1)
    return f"{c.permute_chars(name, 'email|' + domain)}@{m[0].rsplit('@', 1)[1]}"


def _card(text: str, c: Cipher) -> str | None:
    d = re.sub(r"\D", "", text)
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn_sum(d) or len(set(re.findall(r"\D", text))) > 1:
        return None
    body = d[0] + c.permute_chars(d[1:-1], f"card|{d[0]}")
    return _refill(text, body + str(-luhn_sum(body + "0") % 10))


def _groups(m: re.Match) -> list[tuple[int, int]]:
    return [g.span() for g in re.finditer(r"\d+", m[0])]


def _cards(m: re.Match, c: Cipher, usual: bool) -> list[Found]:
    """The cards in a run of groups of digits, whatever numbers stand beside them.  ``usual``: in the groups
    that cards are written in, from anywhere in the run.  Otherwise in any groups: the run, as far
    as 19 digits go, and the run without up to two groups at either end."""
    at, text, base = _groups(m), m.string, m.start()
    n = len(at)
    if at[-1][1] < 13:
        return []
    first = 0 if not re.match(r"[\w.-]", text[base - 1:base]) else 1
    last = n if not re.match(r"[\w-]", text[m.end():m.end() + 1]) else n - 1
    size = [e - s for s, e in at]

    def at_window(i: int, j: int) -> Found | None:
        s, e = at[i][0], at[j - 1][1]
        put = _card(m[0][s:e], c) if e - s < 38 else None
        return put and (base + s, base + e, put)

    if usual:
        out, i = [], first
        while i < last:
            ends = [i + 1] if 13 <= size[i] <= 19 else [i + len(g) for g in CARD_GROUPS if i + len(g) <= last and tuple(size[i:i + len(g)]) == g]
            if i == 0 and text[base - 1:base] == "+":
                ends = [j for j in ends if j == 1]  # a phone's country code
            hit, j = next(((x, j) for j in ends if (x := at_window(i, j))), (None, i + 1))
            out += [hit] if hit else []
            i = j
        return out
    most = first
    while most < last and sum(size[first:most + 1]) <= 19:
        most += 1
    tries = [(first, most), *((i, j) for i in range(first, first + 3) for j in range(last, last - 3, -1))]
    return [x for i, j in tries if i < j if (x := at_window(i, j))][:1]


def _iban(m: re.Match, c: Cipher) -> str | None:
    shape, rest = m[0], ""
    if shape != shape.upper():  # written in small letters: found as its capitals are
        small = _IBAN.fullmatch(shape.upper()) and _iban(_IBAN.fullmatch(shape.upper()), c)
        return small and "".join(x.lower() if y.islower() else x for x, y in zip(small, shape))
    while iban_mod(shape.replace(" ", "")) != 1:  # capital words may follow
        shape, gap, cut = shape.rpartition(" ")
        rest = gap + cut + rest
        if len(shape.replace(" ", "")) < 15:
            return None
    compact = shape.replace(" ", "")
    bban = c.permute_chars(compact[4:], f"iban|{compact[:2]}")
    check = 98 - iban_mod(compact[:2] + "00" + bban)
    return _refill(shape, f"{compact[:2]}{check:02}{bban}") + rest


def _ipv4(m: re.Match, c: Cipher) -> str | None:
    octets = [int(x) for x in m[0].split(".")]
    if max(octets) > 255:
        return None
    x = c.permute(int.from_bytes(bytes(octets), "big"), 1 << 32, "ipv4")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ipv6(m: re.Match, c: Cipher) -> str | None:
    """Long enough not to be a time or a name with colons; the notation stays as it is."""
    try:
        ipaddress.IPv6Address(m[0])
    except ValueError:
        return None
    if len(re.findall(r"[0-9A-Fa-f]", m[0])) < 8:
        return None
    return c.permute_chars(m[0], "ipv6", (HEX,) if m[0] == m[0].lower() else (HEX.upper(),) if m[0] == m[0].upper() else (DIGITS, LOWER[:6], UPPER[:6]))


def _ssn(m: re.Match, c: Cipher) -> str | None:
    area, group, serial = int(m[1]), int(m[2]), int(m[3])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    x = c.permute(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03}-{group + 1:02}-{serial + 1:04}"


def _nanp(m: re.Match, c: Cipher) -> str | None:
    if not re.match(r"\+|\(", m[0]) and len(re.findall(r"[ .)-]", m[0])) < 2:
        return None  # ten bare digits are any number
    area, line = int(m[1]) - 200, int(m[2]) - 200
    x, last = divmod(c.permute((area * 800 + line) * 10_000 + int(m[3]), 800 * 800 * 10_000, "nanp"), 10_000)
    area, line = divmod(x, 800)
    head = m[0][: m.start(1) - m.start()]
    return head + _refill(m[0][len(head):], f"{area + 200}{line + 200}{last:04}")


def _phone(m: re.Match, c: Cipher) -> list[Found]:
    """The longest run of groups that the numbering plan of the country allows, else of 8 to 15 digits in all.
    Numbers behind it don't belong to it, nor do the groups of a card."""
    code = re.sub(r"\D", "", m[0][:12])
    n = 1 if code[0] in "17" else 2 if int(code[:2]) in CALLING_2 else 3
    cards = [x for r in _RUN.finditer(m.string, m.start(), m.end()) for x in _cards(r, c, True)]
    planned = other = None
    digits = 0
    for s, e in _groups(m):
        digits += e - s
        if digits > 15:
            break
        if m[0][e:e + 1] == ")":
            e += 1
        shape, stop = m[0][:e], m.start() + e
        if (digits < 8 or shape.count("(") != shape.count(")") or any(a < stop for a, _, _ in cards)
                or stop == m.end() and re.match(r"[\w-]", m.string[stop:stop + 1])):
            continue
        d = re.sub(r"\D", "", shape)
        few, most = NATIONAL.get(int(d[:n]), (0, 0))
        if few <= digits - n - (d[n] == "0" and d[:n] != "39") <= most:
            planned = shape, d
        other = shape, d
    if not (best := planned or other):
        return []
    shape, d = best
    return [(m.start(), m.start() + len(shape), _refill(shape, d[:n] + c.permute_chars(d[n:], f"phone|{d[:n]}")))]


def _day(y: int, m: int, d: int, c: Cipher) -> dt.date | None:
    try:
        x = dt.date(y, m, d).toordinal()
    except ValueError:
        return None
    return next((dt.date.fromordinal(a + c.permute(x - a, b - a + 1, "date")) for a, b in SPANS if a <= x <= b), None)


def _pad(a: str, b: str) -> str:
    """Format of day and month: two digits unless the original left a zero out."""
    return "" if 1 in (len(a), len(b)) else "02"


def _date_ymd(m: re.Match, c: Cipher) -> str | None:
    day = _day(int(m[1]), int(m[3]), int(m[4]), c)
    return day and f"{day.year:04}{m[2]}{day.month:{_pad(m[3], m[4])}}{m[2]}{day.day:{_pad(m[3], m[4])}}"


def _date_dmy(m: re.Match, c: Cipher) -> str | None:
    """Day first with dots or hyphens; with slashes month first, unless it can't be one."""
    month_first = m[2] == "/" and int(m[1]) <= 12
    day = _day(int(m[4]), int(m[1 if month_first else 3]), int(m[3 if month_first else 1]), c)
    if not day:
        return None
    first, second = (day.month, day.day) if month_first else (day.day, day.month)
    if m[2] == "/" and not month_first and first <= 12:
        return f"{day.year:04}/{second:02}/{first:02}"  # would be read month first
    return f"{first:{_pad(m[1], m[3])}}{m[2]}{second:{_pad(m[1], m[3])}}{m[2]}{day.year:04}"


def _month(name: str) -> int:
    return next(k for k, x in enumerate(MONTHS, 1) if x.startswith(name[:3].title()))


def _month_name(like: str, n: int) -> str:
    x = MONTHS[n - 1] if len(like.rstrip(".")) > 3 or like.lower() == "may" else MONTHS[n - 1][:3] + like[3:]
    return x.upper() if like.isupper() else x.lower() if like.islower() else x


def _ordinal(suffix: str, n: int) -> str:
    return "" if not suffix else "th" if 10 < n % 100 < 14 else {1: "st", 2: "nd", 3: "rd"}.get(n % 10, "th")


def _date_mdy_name(m: re.Match, c: Cipher) -> str | None:
    day = _day(int(m[5]), _month(m[1]), int(m[2]), c)
    return day and f"{_month_name(m[1], day.month)} {day.day}{_ordinal(m[3], day.day)}{m[4]}{day.year:04}"


def _date_dmy_name(m: re.Match, c: Cipher) -> str | None:
    day = _day(int(m[5]), _month(m[3]), int(m[1]), c)
    return day and f"{day.day}{_ordinal(m[2], day.day)} {_month_name(m[3], day.month)}{m[4]}{day.year:04}"


def _cloud_key(m: re.Match, c: Cipher) -> str:
    return m[1] + c.permute_chars(m[2], f"key|{m[1]}", (DIGITS + UPPER,))


def _secret(m: re.Match, c: Cipher) -> str | None:
    value = m[2].rstrip(".,;:!?)]}")
    # "token: something" is prose; "token=something" and a quoted value are not
    if len(value) < 8 or not (re.search(r"\d", value) or m[1].rstrip()[-1] in "=\"'"):
        return None
    return m[1] + _token(value, c) + m[2][len(value):]


def _token(value: str, c: Cipher) -> str:
    own = (HEX,) if re.fullmatch(r"[0-9a-f]+", value) else (HEX.upper(),) if re.fullmatch(r"[0-9A-F]+", value) else (DIGITS, LOWER, UPPER)
    return c.permute_chars(value, "secret", own)


def _hex_token(m: re.Match, c: Cipher) -> str | None:
    return _token(m[0], c) if re.search(r"\d", m[0]) and re.search(r"[A-Fa-f]", m[0]) else None


def _web_token(m: re.Match, c: Cipher) -> str | None:
    """Header, claims and signature in URL-safe base 64.  The header, which only names the
    algorithm, stays: it proves the value to be a token."""
    head, *parts = m[0].split(".")
    try:
        if not isinstance(json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))), dict):
            return None
    except ValueError:
        return None
    return ".".join([head, *(_token(x, c) for x in parts)])


def _called(m: re.Match, c: Cipher) -> str:
    """Ten digits that the text says to be called."""
    return m[1] + c.permute_chars(m[2], "phone|bare")


_NAME = "((?i:" + "|".join(f"{m[:3]}(?:{m[3:]}|\\.)?" if m[3:] else m for m in MONTHS) + "))"
_A = r"(?<![A-Za-z0-9])"  # not inside a word or number
_Z = r"(?![A-Za-z0-9])"

_IBAN = re.compile(_A + r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)" + _Z)
_RUN = re.compile(r"(?=[\d -]{13})\d++(?:[ -]\d++)*+")

#: (kind, needs, pattern, finder): earlier ones win where matches overlap at the same start.
FINDERS: list[tuple[str, str, re.Pattern, Callable[[re.Match, Cipher], str | list[Found] | None]]] = [
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[\w-]+\.)+[^\W\d_]{2,}(?![\w-])"), _email),
    ("key", "AKIA", re.compile(_A + r"(AKIA)([A-Z0-9]{16})" + _Z), _cloud_key),
    ("key", "ASIA", re.compile(_A + r"(ASIA)([A-Z0-9]{16})" + _Z), _cloud_key),
    ("secret", "eyJ", re.compile(_A + r"eyJ[\w-]+\.[\w-]+\.[\w-]+" + _Z, re.A), _web_token),
    ("secret", "*", re.compile(_A + r"((?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[ ]*[=:][ ]*[\"']?)([^\s\"'<>]{8,})"), _secret),
    ("secret", "", re.compile(_A + r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)" + _Z), _hex_token),
    ("iban", "", _IBAN, _iban),
    ("iban", "", re.compile(_A + r"[a-z]{2}\d{2}(?:[a-z0-9]{11,30}|(?: [a-z0-9]{4}){2,7}(?: [a-z0-9]{1,3})?)" + _Z), _iban),
    ("date", "", re.compile(r"(?<![\w./-])(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d|[-/.]\d)"), _date_ymd),
    ("date", "", re.compile(r"(?<![\w./-])(\d{1,2})([-/.])(\d{1,2})\2(\d{4})(?!\w|[-/.]\d)"), _date_dmy),
    ("date", "", re.compile(r"(?<!\w)" + _NAME + r" (\d{1,2})(st|nd|rd|th)?(,? )(\d{4})(?!\w)"), _date_mdy_name),
    ("date", "", re.compile(r"(?<!\w)(\d{1,2})(st|nd|rd|th)? " + _NAME + r"(,? )(\d{4})(?!\w)"), _date_dmy_name),
    ("ip", "", re.compile(r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)"), _ipv4),
    ("ip", ":", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])"), _ipv6),
    ("phone", "", re.compile(_A + r"((?i:call|phone|tel|telephone|mobile|cell|fax|whatsapp|sms|text)(?:(?i: me| us| at| on| number)|[.:]){0,3} ?)(\d{10})(?![\w-])"), _called),
    ("ssn", "", re.compile(r"(?<![\w-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"), _ssn),
    ("phone", "", re.compile(r"(?<![\w+.-])(?:\+?1[ .-]?)?\(?([2-9]\d\d)\)?[ .-]?([2-9]\d\d)[ .-]?(\d{4})(?![\w-])"), _nanp),
    ("phone", "+", re.compile(r"(?<![\w+])\+[1-9]\d*+(?:[ .-]?\(?\d++\)?+)*+"), _phone),
    ("card", "", _RUN, lambda m, c: _cards(m, c, True)),
    ("card", "", _RUN, lambda m, c: _cards(m, c, False)),
]
#: Ranks of the finders whose values go before others that they overlap: names, marks, checksums in a fixed form.
SURE = {k for k, f in enumerate(FINDERS) if f[0] in ("email", "key", "secret", "iban")} | {len(FINDERS) - 2}
_DIGIT = re.compile(r"[0-9]")


def find(text: str, cipher: Cipher) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the values found, in order, without overlap."""
    digits = _DIGIT.search(text) is not None
    named = digits or "=" in text or ":" in text  # of a secret
    spans = []
    for rank, (kind, needs, pattern, new) in enumerate(FINDERS):
        if (named if needs == "*" else needs in text if needs in ("@", "AKIA", "ASIA", "eyJ") else digits and needs in text):
            for m in pattern.finditer(text):
                put = new(m, cipher)
                for start, stop, x in put if isinstance(put, list) else [(m.start(), m.end(), put)]:
                    if x is not None:
                        spans.append((start, rank, stop, kind, x))
    out: list[tuple[int, int, str, str]] = []
    for sure in (True, False):
        kept, ends, end = out, [x[1] for x in out], 0
        out = list(kept)
        for start, rank, stop, kind, put in sorted(spans):
            k = bisect_right(ends, start)  # the first kept one that ends behind this start
            if (rank in SURE) == sure and start >= end and (k == len(kept) or kept[k][0] >= stop):
                out.append((start, stop, kind, put))
                end = stop
        out.sort()
    return out


def replace(text: str, cipher: Cipher) -> tuple[str, list[tuple[int, int, str, str]]]:
    found = find(text, cipher)
    parts, at = [], 0
    for start, end, _, put in found:
        parts += [text[at:start], put]
        at = end
    return "".join([*parts, text[at:]]) if found else text, found


# ---------------------------------------------------------------- operator

FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("length", T.IntegerType())]))


@lru_cache(maxsize=8)
def _cipher(key: str) -> Cipher:
    return Cipher(key)


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default all; with ``text_col``) with personal values in ``text_col`` replaced,
    plus ``pii``: kind, start and length (code points of the original text) of each.

    - Null text stays null and empty text empty, with no findings.
    - Text outside the findings is unchanged; digits that fail every validation stay.
    - Repeated rows are treated alike.  Empty table: no rows.
    - An input column named pii is replaced; no other name can clash.
    """
    names = [c for c in (columns or docs.columns) if c.lower() != "pii"]
    at = names.index(text_col)
    src = docs.select(F.struct(*(docs[c] for c in names)).alias("row"))
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = _cipher(key)
        for b in batches:
            row = b.column(0)
            fields = [row.field(k) for k in range(len(names))]
            done = [replace(t, cipher) if t else (t, []) for t in (x.as_py() for x in fields[at])]
            fields[at] = pa.array([t for t, _ in done], fields[at].type)
            pii = pa.array([[{"kind": k, "start": s, "length": e - s} for s, e, k, _ in f] for _, f in done], found_type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(row.type)), pii], ["row", "pii"])

    return src.mapInArrow(run, T.StructType([src.schema["row"], T.StructField("pii", FOUND)])).select("row.*", "pii")
