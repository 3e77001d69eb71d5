"""Aggregations and set operations (AGG-*, SET-*).

Every aggregation here is partial-aggregatable (map-side combine), so a hot
key collapses to one partial row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def distinct_list(df: DataFrame, key: str, value: str, order: str, *,
                  joiner: str = ", ", null_text: str | None = None,
                  list_name: str = "Product_List", count_name: str = "Distinct_SubjectNum_Count") -> DataFrame:
    """AGG-1 (``null_text=None``) / AGG-2 (``null_text='nan'``).

    Per key (NULL keys dropped): the count of distinct keys (always 1) and the
    distinct values joined in order of first appearance. Values are first
    reduced to ``(key, value, first position)`` -- a partial aggregate -- so the
    list step only ever sees distinct values, never the raw rows of a hot key.
    Two shuffles, no join: keys whose values are all NULL keep one NULL value
    through the first step and get an empty list."""
    v = _q(value) if null_text is None else F.coalesce(_q(value).cast("string"), F.lit(null_text))
    base = df.filter(_q(key).isNotNull()).select(_q(key).alias(key), v.alias("__v"), _q(order).alias("__o"))
    firsts = base.groupBy(key, "__v").agg(F.min("__o").alias("__o"))
    lists = firsts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(
            F.col("__v").isNotNull(), F.struct(F.col("__o"), F.col("__v").cast("string").alias("__v"))))),
            lambda x: x["__v"]), joiner).alias(list_name))
    return lists.select(key, F.lit(1).cast("long").alias(count_name), list_name)


def respondents_per_value(df: DataFrame, group: Sequence[str], subject: str, *,
                          approx: bool = False, out: str = "respondents") -> DataFrame:
    """AGG-3: distinct respondents per answer value (narrow pivot table)."""
    agg = F.approx_count_distinct(_q(subject)) if approx else F.count_distinct(_q(subject))
    return df.groupBy(*[_q(g) for g in group]).agg(agg.alias(out))


def dedupe_within(df: DataFrame, partition: str | None = None) -> DataFrame:
    """AGG-4: drop duplicate rows per source table (the ``partition`` column is
    part of the row, so duplicates are never matched across tables)."""
    return df.dropDuplicates()


def load_counts(df: DataFrame, table_col: str = "Variable", out: str = "rows") -> DataFrame:
    """AGG-5: rows per table plus a grand total row (``table_col`` NULL)."""
    return df.rollup(_q(table_col)).agg(F.count(F.lit(1)).alias(out))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """SET-1: heterogeneous UNION ALL by name, missing columns NULL. Empty
    input is an error (no subjects)."""
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("no subject ids")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def consolidate(long: DataFrame, summaries: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """SET-2: many per-key tables -> summary tables. ``long`` is the single
    table holding every source table (a ``Variable`` column tells them apart);
    each summary is wanted ∩ present columns, deduplicated per source table."""
    from .filters import select_present

    return {name: select_present(long, cols).dropDuplicates() for name, cols in summaries.items()}


def column_lists(df, key: str, columns, order: str, *, joiner: str = ", ",
                 category: str = "category", list_name: str = "Product_List",
                 count_name: str = "Distinct_SubjectNum_Count") -> DataFrame:
    """AGG-1 for many columns at once (the per-column tables of one wide
    dataset): unpivot the columns (EX-5) and build every list in ONE
    aggregation keyed by ``(category, key)`` -- one scan instead of one per
    column. NULL cells are skipped; the ``category`` column names the table."""
    long = df.select(_q(key).alias(key), _q(order).alias("__o"), *[_q(c).cast("string").alias(c) for c in columns])
    long = long.unpivot([key, "__o"], list(columns), category, "__v").filter(
        F.col("__v").isNotNull() & _q(key).isNotNull())
    firsts = long.groupBy(category, key, "__v").agg(F.min("__o").alias("__o"))
    return firsts.groupBy(category, key).agg(
        F.lit(1).cast("long").alias(count_name),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("__o"), F.col("__v")))),
                                 lambda x: x["__v"]), joiner).alias(list_name))


def option_lists(df, key: str, columns, explode_cols, sep: str = ",", *, joiner: str = ", ",
                 category: str = "category", list_name: str = "Product_List",
                 count_name: str = "Distinct_SubjectNum_Count") -> DataFrame:
    """AGG-1 per column of a wide one-row-per-respondent dataset, equal to
    "explode the multi-select columns (EX-1), then list each column's distinct
    values in order of first appearance" -- without building the row product:
    after the sequential explode, a column's values first appear in the order
    of its own options, so each list is the cell's options, deduplicated in
    order. FIL-7 first: respondents whose explode columns are all NULL drop
    out of every table. A column with no value gives ''."""
    from ..functions.scalars import option_list
    from .filters import drop_all_null

    base = drop_all_null(df, list(explode_cols)).filter(_q(key).isNotNull())
    cells = []
    for c in columns:
        empty = F.array().cast("array<string>")
        opts = (F.coalesce(option_list(_q(c), sep), empty) if c in explode_cols
                else F.when(_q(c).isNotNull(), F.array(_q(c).cast("string"))).otherwise(empty))
        cells.append(F.struct(F.lit(c).alias(category), opts.alias("__opts")))
    long = base.select(_q(key).alias(key), F.inline(F.array(*cells)))
    return long.select(category, key, F.lit(1).cast("long").alias(count_name),
                       F.array_join(F.array_distinct("__opts"), joiner).alias(list_name))
