"""What downloaded bytes are, by their first and last bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kind -> hex of the first bytes.
SIGNATURES = {"png": "89504E470D0A1A0A", "gif": "47494638", "jpeg": "FFD8FF", "bmp": "424D", "zip": "504B0304", "pdf": "25504446"}
#: Hex that a whole file of the kind ends with.
ENDINGS = {"png": "49454E44AE426082", "gif": "3B", "jpeg": "FFD9"}


def kind_of(data: Column) -> Column:
    head = F.hex(F.substring(data, 1, 8))
    out = None
    for kind, mark in SIGNATURES.items():
        out = F.when(head.startswith(mark), kind) if out is None else out.when(head.startswith(mark), kind)
    return out


def is_image(data: Column) -> Column:
    return F.coalesce(kind_of(data).isin("png", "gif", "jpeg", "bmp"), F.lit(False))


def whole_image(data: Column) -> Column:
    """An image that is not cut off; the end mark may be followed by padding."""
    tail = F.hex(F.substring(data, F.greatest(F.octet_length(data) - 1023, F.lit(1)), F.lit(1024)))
    kind = kind_of(data)
    ends = F.lit(True)
    for name, mark in ENDINGS.items():
        ends = F.when(kind == name, tail.contains(mark)).otherwise(ends)
    return is_image(data) & ends


def error_page(text: Column) -> Column:
    """Login, parked and database-error pages that answer in place of content."""
    return (F.length(text) < 200) | text.contains("mySQL error") | text.contains("You are not logged in") | text.contains("domain is parked")


def mib(size: Column) -> Column:
    return F.bround(size / 1048576, 1)
