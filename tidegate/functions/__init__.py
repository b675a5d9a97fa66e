"""Column -> Column helpers; every one stays inside Catalyst expressions."""

from tidegate.functions.clock import iso_utc, seconds_between, timestamp_literal
from tidegate.functions.text import concat0, object_name, quoted, quotename, sha256_hex

__all__ = [
    "concat0",
    "iso_utc",
    "object_name",
    "quoted",
    "quotename",
    "seconds_between",
    "sha256_hex",
    "timestamp_literal",
]
