"""Column expressions; all run inside the JVM."""

from tidemark.functions.dates import (
    OPEN_END,
    as_date,
    as_timestamp,
    date_from_epoch_days,
    date_key,
    timestamp_from_millis,
)
from tidemark.functions.decimals import decode_decimal, encode_decimal, is_undecodable
from tidemark.functions.keys import day_key, transaction_key
from tidemark.functions.phones import normalize_phone

__all__ = [
    "OPEN_END",
    "as_date",
    "as_timestamp",
    "date_from_epoch_days",
    "date_key",
    "day_key",
    "decode_decimal",
    "encode_decimal",
    "is_undecodable",
    "normalize_phone",
    "timestamp_from_millis",
    "transaction_key",
]
