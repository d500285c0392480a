"""Record headers: ordered, keys may repeat, values are nullable bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double quote, a backslash or a control character would break the one-line envelope.
# Bytes of multi-byte characters are all above 0x7F, so a match on text equals one on bytes.
UNSAFE = r'["\\\x00-\x1f]'


def _usable(value: Column) -> Column:
    return (F.octet_length(value) > 0) & F.is_valid_utf8(value.cast("string"))


def header_value(headers: Column, key: str) -> Column:
    """First usable value of `key`: non-null, valid UTF-8, not empty. NULL if there is none.

    Nearly always the first header of that name is usable, and finding it needs no lambda;
    the scan over all headers is left for the rest.
    """
    position = F.array_position(headers["key"], key)
    first = F.get(headers, (position - 1).cast("int"))["value"]
    others = F.filter(headers, lambda h: (h["key"] == key) & _usable(h["value"]))
    return F.when(_usable(first), first.cast("string")).when(
        position > 0, F.get(others, F.lit(0))["value"].cast("string")
    )


def is_unsafe(text: Column) -> Column:
    return text.rlike(UNSAFE)


def keeps(header: Column) -> Column:
    """Whether a header can be spliced into the envelope unescaped. NULL for a null value."""
    return ~is_unsafe(F.concat(header["key"], header["value"].cast("string")))


def safe_headers(headers: Column) -> Column:
    """The headers that go into the envelope, in their order."""
    return F.filter(headers, keeps)


def drop_reason(header: Column) -> Column:
    """Why `safe_headers` drops a header; NULL for one it keeps."""
    return (
        F.when(header["value"].isNull(), "null_value")
        .when(is_unsafe(header["value"].cast("string")), "unsafe_value")
        .when(is_unsafe(header["key"]), "unsafe_key")
    )
