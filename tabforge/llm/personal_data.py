"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score.

The four base kinds (email, ip, card, phone) stay whatever their score. The
others (iban, ssn) are kept from a score of ``least``: an IBAN has a checksum of
its own, a social security number needs a word nearby that speaks for it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = 4

# What each kind looks like. A possessive repeat takes a whole run, which is all that a match can start with.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", re.ASCII)
SSN = re.compile(r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", re.ASCII)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Lengths of IBANs by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TR": 26, "UA": 29,
}

# Score (per cent) by kind before its context, what a word nearby adds, and what one against it takes.
SCORES = {"email": 90, "ip": 60, "card": 70, "phone": 60, "iban": 80, "ssn": 40}
FOR, AGAINST = 30, 30

# Words that speak for a kind, and words that speak against numbers being personal.
WORDS_FOR = {
    "email": ("email", "e-mail", "mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login", "client"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "cvv"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "transfer", "swift", "bic"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
WORDS_AGAINST = ("example", "version", "isbn", "serial", "test", "sample", "order", "invoice", "part")
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)?")
_LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_ALNUM = LOCAL - frozenset("._%+-")


def luhn(digits: str) -> bool:
    """Whether the weighted digit sum is a multiple of ten."""
    twice = "0246813579"
    return sum(int(d if i % 2 == 0 else twice[int(d)]) for i, d in enumerate(reversed(digits))) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an IBAN without blanks leaves 1 when its head is put last and letters become 10 to 35."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: before each @ the run of local characters that no earlier match has taken, then a domain of two labels or more."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of all spans that their pattern proposes and their validator confirms."""
    if "@" in text:
        yield from ((0, *span) for span in emails(text))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        # Shorter matches cannot hold enough digits, longer ones hold too many: at most every other character is a separator.
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield 2, m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield 3, m.start(), m.end()
    for m in IBAN.finditer(text):
        end = iban_end(m[0])
        after = m.start() + end
        if end and text[after : after + 1] not in _ALNUM and mod_97(m[0][:end].replace(" ", "")):
            yield 4, m.start(), after
    for m in SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield 5, m.start(), m.end()


def iban_end(found: str) -> int:
    """Where the account's length by its country ends in a match, 0 if the match is shorter or the country unknown."""
    left = IBAN_LENGTHS.get(found[:2], 0)
    for i, c in enumerate(found if left else ""):
        left -= c != " "
        if not left:
            return i + 1
    return 0


def score(text: str, kind: int, start: int, end: int, window: int) -> int:
    """Per cent: that of the kind, more with a word for it and less with one against it within ``window`` characters."""
    name = KINDS[kind]
    before, after = text[max(0, start - window) : start].translate(_LOWER), text[end : end + window].translate(_LOWER)
    near = set(_WORD.findall(before)) | set(_WORD.findall(after))
    value = SCORES[name] + FOR * any(w in near for w in WORDS_FOR[name]) - AGAINST * any(w in near for w in WORDS_AGAINST)
    return max(0, min(100, value))


def spans_of(text: str | None, least: int, window: int) -> list[tuple[int, int, int, int]]:
    """Sorted (start, kind number, end, score): base spans, and the others from ``least`` that overlap no base span."""
    if not text:
        return []
    base, added = [], []
    for kind, start, end in candidates(text):
        rated = (start, kind, end, score(text, kind, start, end, window))
        if kind < BASE:
            base.append(rated)
        elif rated[3] >= least:
            added.append(rated)
    if added:
        base.sort()
        starts, ends = [b[0] for b in base], list(accumulate((b[2] for b in base), max))
        # Base spans that start before the end of the other: one overlaps it if the furthest of their ends lies behind its start.
        before = [bisect_left(starts, a[2]) for a in added]
        added = [a for a, n in zip(added, before, strict=True) if not n or ends[n - 1] <= a[0]]
    return sorted(base + added)


def find_personal_data(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None, least: int = 60, window: int = 40) -> DataFrame:
    """The ``carried`` columns of ``docs`` (all, unless said otherwise) with ``spans``: sorted structs of start, kind_no, end and score.

    Positions are code points, ends exclusive. An input column named ``spans``
    is replaced. Null and empty texts have no spans; equal texts have equal
    spans; repeated rows stay; very long texts are read whole, in a time in
    proportion to their length; an empty table gives no rows.
    """
    kept = docs.columns if carried is None else carried

    @F.arrow_udf("array<struct<start:long,kind_no:int,end:long,score:int>>")
    def spans(texts: pa.Array) -> pa.Array:
        parts, sizes = ([], [], [], []), [0]
        for text in texts:
            found = spans_of(text.as_py(), least, window)
            sizes.append(sizes[-1] + len(found))
            for row in found:
                for part, value in zip(parts, row, strict=True):
                    part.append(value)
        types = pa.int64(), pa.int32(), pa.int64(), pa.int32()
        structs = pa.StructArray.from_arrays([pa.array(p, t) for p, t in zip(parts, types, strict=True)], names=["start", "kind_no", "end", "score"])
        return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs)

    columns = [f"`{c.replace('`', '``')}`" for c in kept if c.lower() != "spans"]
    return docs.select(*columns, spans(F.col(f"`{text_col}`")).alias("spans"))


def base_of(spans: str | Column) -> Column:
    """The spans of the base kinds."""
    return F.filter(spans, lambda s: s["kind_no"] < BASE)


def count_of(spans: str | Column, kind: str) -> Column:
    """Number of spans of one kind."""
    no = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind_no"] == no)).cast("long")


def listed(spans: str | Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")
