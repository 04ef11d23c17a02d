"""Batch stamp helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import STAMP_FORMAT, STAMP_PATTERN


def batch_stamp(ts) -> Column:
    """``yyyyMMdd_HHmmss`` name of a batch taken at ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, STAMP_FORMAT)


def extract_datestamp(key, strict: bool = False) -> Column:
    """First ``\\d{8}_\\d{6}`` in an object key or path.

    Null when absent; with ``strict=True`` the query fails instead.
    """
    c = F.col(key) if isinstance(key, str) else key
    found = F.regexp_extract(c, STAMP_PATTERN, 1)
    stamp = F.when(found != "", found)
    if strict:
        return F.when(stamp.isNull(),
                      F.raise_error(F.concat(F.lit("no batch stamp in: "), c))).otherwise(stamp)
    return stamp
