"""Date ranges, upload windows and id lists (SRC-1, SRC-2, SRC-3, SRC-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_range(start: Column, end: Column) -> Column:
    """SRC-1: inclusive array of days start..end; ``end < start`` -> empty
    (a reversed ``sequence`` with a positive step would raise)."""
    s, e = F.to_date(start), F.to_date(end)
    return F.when(e >= s, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))


def upload_window(df: DataFrame, ts_col: str, day: str,
                  partition_col: str | None = "upload_date") -> DataFrame:
    """SRC-2: rows uploaded within one UTC day, from its midnight to before the next.
    The range reaches the parquet scan as PushedFilters; when the table is
    partitioned by upload day, the day is also a partition filter, so only
    that day's folder is listed and read."""
    start = F.to_date(F.lit(day))
    out = df.filter((F.col(ts_col) >= start.cast("timestamp"))
                    & (F.col(ts_col) < F.date_add(start, 1).cast("timestamp")))
    if partition_col and partition_col in df.columns:
        out = out.filter(F.col(partition_col) == F.to_date(F.lit(day)))
    return out


def range_scan(df: DataFrame, col: str, low, high) -> DataFrame:
    """SRC-7: ``col BETWEEN low AND high`` (both ends inclusive)."""
    return df.filter(F.col(col).between(F.lit(low), F.lit(high)))


# Fixed value: characters removed from an id-list text before splitting.
ID_LIST_STRIP = r"[\[\]\r\n ]"


def parse_id_list(text: Column) -> Column:
    """SRC-3: strip ``[ ] \\r \\n`` and spaces, split on ','. The empty list
    gives [''] (one empty id); use ``explode_ids`` to drop it."""
    return F.split(F.regexp_replace(text, ID_LIST_STRIP, ""), ",")


def explode_ids(df: DataFrame, text_col: str, out: str = "subject_id") -> DataFrame:
    others = [c for c in df.columns if c != text_col]
    return (df.select(*others, F.explode(parse_id_list(F.col(text_col))).alias(out))
            .filter(F.col(out) != ""))
