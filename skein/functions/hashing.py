"""Identifiers and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_id(stem: Column) -> Column:
    """The first 16 hexadecimal digits of the md5 of a stem."""
    return F.left(F.md5(stem.cast("binary")), F.lit(16))


def uuid5(namespace: str, name: Column) -> Column:
    """The version 5 UUID of a name in a namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def member_digest(names: Column) -> Column:
    """Sixteen digits of the sha1 of sorted names; the same for any order of members (an aggregate's array)."""
    return F.left(F.sha1(F.array_join(F.sort_array(names), "|").cast("binary")), F.lit(16))


def near_hash(a: Column, b: Column, most: int = 5) -> Column:
    """Whether two 64-bit perceptual hashes differ in so many bits at most."""
    return F.bit_count(a.bitwiseXOR(b)) <= most
