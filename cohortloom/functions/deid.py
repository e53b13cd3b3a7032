"""Keyed hashing and identifier cleaning without Python workers."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pads(key: bytes) -> tuple[bytes, bytes]:
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    padded = key.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in padded), bytes(b ^ 0x5C for b in padded)


def hmac_sha256(value: Column | str, key: bytes) -> Column:
    """HMAC-SHA256 in hex from two built-in digests; NULL stays NULL."""
    inner_pad, outer_pad = _pads(key)
    text = F.encode(_col(value).cast("string"), "UTF-8")
    inner = F.unhex(F.sha2(F.concat(F.lit(bytearray(inner_pad)), text), 256))
    return F.sha2(F.concat(F.lit(bytearray(outer_pad)), inner), 256)


def plain_sha256(value: Column | str) -> Column:
    return F.sha2(F.encode(_col(value).cast("string"), "UTF-8"), 256)


def clean_mrn(value: Column | str) -> Column:
    """Undo a float cast (``123.0`` -> ``123``); leading zeros stay; blank becomes NULL."""
    text = F.trim(_col(value).cast("string"))
    return F.nullif(F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"), F.lit(""))


def strip_leading_zeros(value: Column | str) -> Column:
    return F.regexp_replace(_col(value).cast("string"), "^0+", "")


def numeric_id(value: Column | str) -> Column:
    """Numeric ids lose their leading zeros; alphanumeric ids stay as they are."""
    text = _col(value).cast("string")
    return F.when(text.rlike("^[0-9]+$"), strip_leading_zeros(text)).otherwise(text)


def strip_type(reference: Column | str, resource_type: str) -> Column:
    return F.regexp_replace(_col(reference), f"^{resource_type}/", "")
