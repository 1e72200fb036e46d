"""Hash keys, link keys and hashdiffs, as Column expressions.

All of them stay inside whole-stage codegen; nothing here needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stored keys depend on them.
SEPARATOR = "||"
NULL_TOKEN = "^^"
KEY_BAR = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text_or_token(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN))


def normalise_key(c: Column | str) -> Column:
    """Business-key form used before hashing: trimmed, lower case."""
    return F.lower(F.trim(_col(c)))


def hash_key(*cols: Column | str, source: str | None = None) -> Column:
    """Hub key. ``source`` keeps the keys of one source apart; shared hubs leave it out."""
    parts = [_text_or_token(c) for c in cols]
    if source is not None:
        parts.insert(0, F.lit(source))
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def link_key(*hub_keys: Column | str, role: Column | str | None = None) -> Column:
    """Key over hub keys and an optional role; NULL if any part is NULL."""
    parts = [_col(c) for c in hub_keys]
    if role is not None:
        parts.append(_col(role))
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit(SEPARATOR), part)
    return F.md5(joined)


def hashdiff(*cols: Column | str) -> Column:
    """Change marker over the listed attributes, in the listed order.

    Attributes left out are not versioned. Pass decimals as the text they arrived
    in: casting a decimal back to text pads it to its scale.
    """
    return F.md5(F.concat_ws(SEPARATOR, *[_text_or_token(c) for c in cols]))


def business_key(source: str, c: Column | str) -> Column:
    """``source|id`` text; NULL stays NULL."""
    return F.concat(F.lit(source + KEY_BAR), _col(c).cast("string"))


def utc_text(c: Column | str) -> Column:
    """Timestamp as fixed-format text for hashing, e.g. ``2020-01-31 00:00:00+00``."""
    return F.concat(F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))


def short_key(text: Column) -> Column:
    """A text as bytes, 32 hexadecimal digits as the 16 bytes they stand for; different texts stay different.

    Only such digits give 16 bytes: other texts of 16 bytes or more get one more.
    """
    raw = text.cast("binary")
    return F.when(text.rlike(r"^[0-9a-f]{32}\z"), F.unhex(text)).when(F.octet_length(raw) < 16, raw).otherwise(
        F.concat(raw, F.unhex(F.lit("00"))))


def key_text(short: Column) -> Column:
    """The text that ``short_key`` was given."""
    n = F.octet_length(short)
    return F.when(n == 16, F.lower(F.hex(short))).when(n < 16, short.cast("string")).otherwise(
        F.substring(short, F.lit(1), n - 1).cast("string"))
