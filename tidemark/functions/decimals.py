"""Connector decimals: Base64 text of a big-endian two's-complement integer with a fixed scale."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_HEX_DIGITS = 16  # eight bytes, far beyond the five that DECIMAL(10,2) needs


def decode_decimal(encoded: Column, precision: int = 10, scale: int = 2) -> Column:
    """Decode inside whole-stage codegen; null for null, undecodable or oversized input."""
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    sign_fill = F.when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    widened = F.lpad(digits, _MAX_HEX_DIGITS, sign_fill)
    unscaled = F.conv(widened, 16, -10).cast("decimal(20,0)")
    value = unscaled * F.lit(Decimal(1).scaleb(-scale))
    return F.when(
        F.length(digits).between(2, _MAX_HEX_DIGITS),
        value.try_cast(f"decimal({precision},{scale})"),
    )


def is_undecodable(encoded: Column) -> Column:
    """True for text that is present but yields no value; such records go to quarantine."""
    return encoded.isNotNull() & decode_decimal(encoded).isNull()


def encode_decimal(value: Column) -> Column:
    """The eight-byte form of a two-decimals amount, as a connector would send it."""
    cents = F.round(value * 100).cast("bigint")
    return F.base64(F.unhex(F.lpad(F.hex(cents), _MAX_HEX_DIGITS, F.lit("0"))))
