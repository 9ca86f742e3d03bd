"""Hashes that other engines can repeat."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(*parts: Column) -> Column:
    """The first 32 bits of the md5 of the parts joined by '#'; a null part is left out."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts)), 1, 8), 16, 10).cast("long")


def fraction(*parts: Column) -> Column:
    """number() from 0 to 1."""
    return number(*parts) / F.lit(4294967296.0)


def shard(n: int, *parts: Column) -> Column:
    return (number(*parts) % n).cast("int")


def document_id(path: Column, index: Column) -> Column:
    """The id of a record that has none: where it stands."""
    return F.md5(F.concat_ws("#", path, index.cast("string")))
