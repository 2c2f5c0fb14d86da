"""JSON codecs as Column expressions (JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_json(value: str | Column, schema: T.StructType) -> Column:
    """UTF-8 JSON bytes or text -> struct, PERMISSIVE.

    Malformed text, JSON ``null`` or a top-level array give a struct whose
    fields are all NULL; a field of the wrong type is NULL on its own.
    """
    return F.from_json(_col(value).cast("string"), schema)


def encode_json(*fields: str | Column) -> Column:
    """Columns -> one JSON object as text; NULL fields are left out."""
    return F.to_json(F.struct(*[_col(f) for f in fields]))


def encode_json_bytes(*fields: str | Column) -> Column:
    """Columns -> JSON object as UTF-8 bytes, the shape of a message value."""
    return encode_json(*fields).cast("binary")
