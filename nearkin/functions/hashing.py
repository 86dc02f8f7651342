"""Repeatable numbers from md5, the same in Spark, in Python and in any SQL database."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 15  # 60 bits: fits BIGINT and is far above any row count


def md5_number(text: Column) -> Column:
    """The first 60 bits of md5(text) as BIGINT."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("bigint")


def md5_number_of(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:HEX_DIGITS], 16)


def id_order(doc_id: Column) -> Column:
    """Sort key that puts ids in a fixed pseudo-random order, whatever the partitioning."""
    return F.md5(doc_id.cast("string").cast("binary"))
