"""Phone number cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that are stripped, and the two leading patterns that become "0".
_SEPARATORS = r"[\(\)\s\-]"
_COUNTRY_PREFIX = r"^\+84"
_LEADING_CLASS = r"^[+84]"


def normalize_phone(phone: Column, strict_compat: bool = False) -> Column:
    """Strip separators and write the country prefix as a leading zero.

    ``strict_compat`` replaces a single leading ``+``, ``8`` or ``4`` instead, which is what one
    of the two historic cleaners did; numbers cleaned that way do not match the other cleaner's.
    """
    leading = _LEADING_CLASS if strict_compat else _COUNTRY_PREFIX
    return F.regexp_replace(F.regexp_replace(phone, _SEPARATORS, ""), leading, "0")
