"""ISO-8601 order timestamps."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the accepted timestamp layout — date 'T' time, optional 6- or 3-digit
# fraction, then an offset ('Z' or +hh). Anything else parses to NULL.
ISO_TS_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X"


def parse_iso_ts(c: Column) -> Column:
    """Text → TIMESTAMP (UTC instant), NULL when the text does not fit the layout.
    `try_to_timestamp` keeps a malformed row from failing the job under ANSI mode."""
    return F.try_to_timestamp(c, F.lit(ISO_TS_PATTERN))
