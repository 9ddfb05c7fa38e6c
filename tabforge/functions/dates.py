"""Parsing of timestamp text in mixed formats, and calendar parts."""

from __future__ import annotations

from itertools import product
from string import ascii_lowercase, ascii_uppercase, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp notations and their shapes. In a shape, 9 is any digit, A a capital, a a small letter; T and Z are themselves.
FORMATS = {
    "yyyy-MM-dd HH:mm:ss": ["9999-99-99 99:99:99"],
    "yyyy-MM-dd HH:mm": ["9999-99-99 99:99"],
    "yyyy-MM-dd'T'HH:mm:ss": ["9999-99-99T99:99:99"],
    "yyyy-MM-dd": ["9999-99-99"],
    "yyyy/MM/dd": ["9999/99/99"],
    "yyyy/MM/dd HH:mm:ss": ["9999/99/99 99:99:99"],
    "d MMM yyyy": ["9 Aaa 9999", "99 Aaa 9999"],
    "d MMM yyyy HH:mm:ss": ["9 Aaa 9999 99:99:99", "99 Aaa 9999 99:99:99"],
    "M/d/yyyy": [f"{m}/{d}/9999" for m, d in product(("9", "99"), repeat=2)],
    "M/d/yyyy H:mm": [f"{m}/{d}/9999 {h}:99" for m, d, h in product(("9", "99"), repeat=3)],
    "M/d/yyyy H:mm:ss": [f"{m}/{d}/9999 {h}:99:99" for m, d, h in product(("9", "99"), repeat=3)],
}

# Fixed value: the pattern of texts with a fraction of a second, an offset, or both; the instant is taken in UTC.
PRECISE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?(?:Z|[+-]\d{2}:?\d{2})?$"

_CAPITALS = ascii_uppercase.translate({ord("T"): None, ord("Z"): None})
_CHARACTERS, _KINDS = digits + _CAPITALS + ascii_lowercase, "9" * 10 + "A" * 24 + "a" * 26


def parse_timestamp(text: Column, formats: dict[str, list[str]] | None = None) -> Column:
    """Timestamp of the notation whose shape fits; NULL when none fits or the date does not exist.

    The shape is worked out once and compared as a whole, so a value is parsed
    at most once, whatever the number of notations. Testing the shape first
    matters: a failed parse costs an exception per row.
    """
    none = F.lit(None).cast("timestamp_ntz")
    rest = none if formats else F.when(text.rlike(PRECISE), text.try_cast("timestamp").cast("timestamp_ntz")).otherwise(none)

    def parsed(shape: Column) -> Column:
        branches = None
        for pattern, shapes in (formats or FORMATS).items():
            value = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
            branches = (F if branches is None else branches).when(shape.isin(*shapes), value)
        return branches.otherwise(rest)

    return F.transform(F.array(F.translate(text, _CHARACTERS, _KINDS)), parsed)[0]


def looks_like_timestamp(text: Column) -> Column:
    return parse_timestamp(text).isNotNull()


def calendar_part(ts: Column, part: str) -> Column:
    """``hour``, ``day_of_week`` (0 = Monday) or ``month`` as an integer."""
    return {"hour": F.hour, "day_of_week": F.weekday, "month": F.month}[part](ts)
