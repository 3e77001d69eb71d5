"""Filters, marker slices and projections (FIL-*, PRJ-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ATTRIBUTE, ELEMENT, SEQ, SUBJECT


def element_filter(stream: DataFrame, elements: Sequence[str]) -> DataFrame:
    """FIL-1: keep the listed element kinds (attribute rows of them stay in).

    Must run BEFORE any next-row scan: the kept rows define "next"."""
    return stream.filter(F.col(ELEMENT).isin(list(elements)))


def header_rows(stream: DataFrame, elements: Sequence[str]) -> DataFrame:
    """FIL-2: header elements, text rows only."""
    return stream.filter(F.col(ELEMENT).isin(list(elements)) & (F.col(ATTRIBUTE) == "text"))


def _marker_bounds(stream: DataFrame, start: Column, end: Column) -> DataFrame:
    # per-subject partial aggregate: one row per subject whatever its size
    return stream.groupBy(SUBJECT).agg(
        F.min(F.when(start, F.col(SEQ))).alias("__s"),
        F.min(F.when(end, F.col(SEQ))).alias("__e"))


def marker_slice(stream: DataFrame, start: Column, end: Column) -> DataFrame:
    """FIL-3a: rows in ``[first start, first end)``; both markers required."""
    b = _marker_bounds(stream, start, end)
    return (stream.join(b, SUBJECT)
            .filter((F.col(SEQ) >= F.col("__s")) & (F.col(SEQ) < F.col("__e")))
            .drop("__s", "__e"))


def marker_slice_inclusive(stream: DataFrame, start: Column, end: Column) -> DataFrame:
    """FIL-3b: rows between the two first markers, both ends included, in
    either order. Subjects missing a marker yield no rows (callers add the
    constant empty row)."""
    b = _marker_bounds(stream, start, end)
    lo, hi = F.least("__s", "__e"), F.greatest("__s", "__e")
    return (stream.join(b, SUBJECT)
            .filter(F.col("__s").isNotNull() & F.col("__e").isNotNull()
                    & (F.col(SEQ) >= lo) & (F.col(SEQ) <= hi))
            .drop("__s", "__e"))


def drop_all_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """FIL-4 / FIL-7: drop rows whose (subset) columns are all null."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def not_done(df: DataFrame, col: str = "item_category", marker: str = "DONE") -> DataFrame:
    """FIL-5: drop ``col == marker``; NULL rows are KEPT."""
    return df.filter(~F.col(col).eqNullSafe(F.lit(marker)))


def drop_both_blank(df: DataFrame, a: str, b: str) -> DataFrame:
    """FIL-6: drop rows where both columns are NULL or ''."""
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return df.filter(~(blank(a) & blank(b)))


def with_period(df: DataFrame, period: Column | str, name: str = "Period") -> DataFrame:
    """PRJ-1: Period as the first column."""
    p = F.lit(period) if isinstance(period, str) else period
    return df.select(p.alias(name), *[F.col(f"`{c}`") for c in df.columns if c != name])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-2: rename, ignoring names that are absent."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """PRJ-5: wanted ∩ present, in wanted order."""
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns])
