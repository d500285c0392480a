"""Decoders: the bytes of a record value -> the body that goes into the envelope.

`DECODERS` is the registry that topic configuration refers to by name; add an entry to
support another framing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# The schema-registry frame is one zero byte and a four-byte schema id.
MAGIC_BYTE = b"\x00"
FRAME_BYTES = 5

# How decoders are named in error messages.
DECODER_LABELS = {"schema": "JsonSchemaDecoder", "string": "JsonStringDecoder"}


class Decoder(NamedTuple):
    """How large the body of a value is, NULL if it cannot be decoded, and the body itself.

    `body` may assume that `size` is not NULL. Values can be tens of megabytes and every
    mention of one in a projection may copy it, so all checks go by the size.
    """

    size: Callable[[Column], Column]
    body: Callable[[Column], Column]


def _framed_size(value: Column) -> Column:
    framed = (F.octet_length(value) >= FRAME_BYTES) & (
        F.substring(value, 1, 1) == F.lit(MAGIC_BYTE)
    )
    return F.when(framed, F.octet_length(value) - FRAME_BYTES)


# What is behind the schema-registry frame; a bad or short frame is an error.
FRAMED = Decoder(_framed_size, lambda value: F.substr(value, F.lit(FRAME_BYTES + 1)))
# The value as it is.
PLAIN = Decoder(F.octet_length, lambda value: value)

DECODERS: dict[str, Decoder] = {"schema": FRAMED, "string": PLAIN}


def _by_name(decoder: Column, built: Mapping[str, Column], kind: str) -> Column:
    chosen = F.lit(None).cast(kind)
    for name, column in built.items():
        chosen = F.when(decoder == name, column).otherwise(chosen)
    return chosen


# Size of the body of a record that has no value at all.
NO_VALUE = -1


def body_size(value: Column, decoder: Column, registry: Mapping[str, Decoder] = DECODERS) -> Column:
    """Bytes of the body by the decoder named in the row.

    NULL for a value that cannot be decoded, `NO_VALUE` for a NULL value.
    """
    sized = _by_name(decoder, {n: d.size(value) for n, d in registry.items()}, "int")
    return F.when(value.isNull(), F.lit(NO_VALUE)).otherwise(sized)


def body(value: Column, decoder: Column, registry: Mapping[str, Decoder] = DECODERS) -> Column:
    """Body of a value that is known to decode."""
    return _by_name(decoder, {n: d.body(value) for n, d in registry.items()}, "binary")


def outcome(size: Column) -> Column:
    """`skip_null`, `decode_error`, `skip_empty` or `ok`, by `body_size`."""
    return (
        F.when(size.isNull(), "decode_error")
        .when(size == NO_VALUE, "skip_null")
        .when(size == 0, "skip_empty")
        .otherwise("ok")
    )


def error_message(topic: Column, partition: Column, offset: Column, decoder: Column) -> Column:
    """Text of a decode error."""
    label = F.coalesce(
        F.create_map(*[F.lit(x) for pair in DECODER_LABELS.items() for x in pair])[decoder], decoder
    )
    return F.format_string(
        "could not decode record '%s', partition '%d', offset '%d' with %s",
        topic,
        partition,
        offset,
        label,
    )
