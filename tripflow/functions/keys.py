"""Row keys and the hash positions that make sampling and splitting repeatable.

``sample`` and ``randomSplit`` depend on how rows are spread over partitions, so the same job on
another cluster picks other rows. The md5 of a row's key depends on nothing but the key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(columns: list[str]) -> Column:
    """Text key of a row."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _hex_number(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def split_bucket(key: Column) -> Column:
    """0 to 99, from the first 6 hex digits of the key's md5."""
    return _hex_number(F.md5(key), 1, 6) % 100


def sample_position(key: Column) -> Column:
    """0 (included) to 1 (excluded), from the 12 hex digits after those of ``split_bucket``."""
    return _hex_number(F.md5(key), 7, 12) / F.lit(float(16**12))
