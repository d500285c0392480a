"""The one-line JSON envelope around a body and its headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.headers import keeps

LEAD = '{"data":'
TAIL = "}"


def header_members(headers: Column) -> Column:
    """`,"x-<key>":"<value>"` for each safe header; empty for no headers.

    The text may hold bytes that are not UTF-8; they pass through unchanged.
    """
    members = F.transform(
        headers,
        lambda h: F.when(
            keeps(h),
            F.concat(F.lit(',"x-'), h["key"], F.lit('":"'), h["value"].cast("string"), F.lit('"')),
        ),
    )
    return F.coalesce(F.array_join(members, ""), F.lit(""))


def envelope_line(body: Column, headers: Column, terminator: str = "") -> Column:
    """The envelope as bytes. The body is spliced in verbatim and never parsed.

    Pass `terminator="\n"` for the form that is written to files.
    """
    return F.concat(
        F.lit(LEAD.encode()),
        body,
        header_members(headers).cast("binary"),
        F.lit((TAIL + terminator).encode()),
    )


def envelope_bytes(body_bytes: Column, headers: Column) -> Column:
    """Size of the written line with its newline, without building it."""
    fixed = len(LEAD) + len(TAIL) + 1
    return body_bytes.cast("bigint") + F.octet_length(header_members(headers)) + fixed
