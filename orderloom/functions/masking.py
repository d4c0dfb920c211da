"""Pseudonyms and partial masks for personal columns, all as native expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .numeric import as_column

# Pseudonym prefix, mask text, digest block size and pads of the keyed hash.
ID_PREFIX = "cust_"
MASK = "***"
BLOCK_BYTES = 64
INNER_PAD, OUTER_PAD = 0x36, 0x5C
PHONE_SEPARATORS = r"\s\-.()"

MaskFunction = Callable[[Column], Column]


def keyed_digest(c: Column | str, secret: str) -> Column:
    """Hex HMAC-SHA256 of a text.

    The two padded keys are literals in the plan, so they show in ``explain`` output and
    event logs: keep those as private as the secret itself.
    """
    key = secret.encode()
    if len(key) > BLOCK_BYTES:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK_BYTES, b"\0")
    inner = F.lit(bytearray(b ^ INNER_PAD for b in key))
    outer = F.lit(bytearray(b ^ OUTER_PAD for b in key))
    message = F.encode(as_column(c).cast("string"), "UTF-8")
    first = F.unhex(F.sha2(F.concat(inner, message), 256))
    return F.sha2(F.concat(outer, first), 256)


def mask_customer_id(c: Column | str, secret: str, hex_chars: int = 8) -> Column:
    """Stable pseudonym; empty and NULL ids pass through.

    Eight digits are 32 bits: among 100,000 ids expect about one pair sharing a pseudonym.
    Raise ``hex_chars`` for larger populations.
    """
    c = as_column(c)
    alias = F.concat(F.lit(ID_PREFIX), F.substring(keyed_digest(c, secret), 1, hex_chars))
    return F.when(c.isNull() | (c.cast("string") == ""), c).otherwise(alias)


def mask_email(c: Column | str) -> Column:
    """First character and last domain label stay."""
    c = as_column(c)
    local = F.substring_index(c, "@", 1)
    domain = F.substr(c, F.length(local) + F.lit(2))
    head = F.concat(F.substring(local, 1, 1), F.lit(MASK))
    tail = F.when(
        domain.contains("."), F.concat(F.lit(MASK + "."), F.substring_index(domain, ".", -1))
    ).otherwise(MASK)
    return F.when(
        c.contains("@"), F.concat(F.when(local == "", MASK).otherwise(head), F.lit("@"), tail)
    ).otherwise(MASK)


def mask_phone(c: Column | str) -> Column:
    """The first block of digits stays; later blocks become stars of the same length."""
    c = as_column(c)
    trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
    pieces = F.regexp_extract_all(
        trimmed, F.lit(f"([^{PHONE_SEPARATORS}]+|[{PHONE_SEPARATORS}])"), F.lit(1)
    )
    is_block = lambda piece: piece.rlike(r"^\+?\d+$")
    first_block = F.array_position(F.transform(pieces, is_block), F.lit(True))
    masked = F.transform(
        pieces,
        lambda piece, at: F.when(
            is_block(piece) & (at + 1 > first_block), F.repeat(F.lit("*"), F.length(piece))
        ).otherwise(piece),
    )
    return F.when(c.isNull() | (c == ""), MASK).otherwise(F.array_join(masked, ""))


def mask_name(c: Column | str) -> Column:
    """Initials stay."""
    c = as_column(c)
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    initials = F.transform(words, lambda w: F.concat(F.substring(w, 1, 1), F.lit(MASK)))
    return F.when(c.isNull() | (c == ""), MASK).otherwise(F.array_join(initials, " "))


def default_masks(secret: str) -> dict[str, MaskFunction]:
    """Only the stable person key is personal in the served tables."""
    return {"customer_unique_id": lambda c: mask_customer_id(c, secret)}


def mask_columns(df: DataFrame, masks: Mapping[str, MaskFunction]) -> DataFrame:
    """Replace the named columns by their masks; NULLs and all other columns stay."""
    present = {name: fn for name, fn in masks.items() if name in df.columns}
    if not present:
        return df
    return df.withColumns({
        name: F.when(F.col(name).isNotNull(), fn(F.col(name)))
        for name, fn in present.items()
    })
