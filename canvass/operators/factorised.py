"""EX-1 without its row product.

Exploding n multi-select columns one after another makes, of each row, as many rows
as the product of its option counts. What is asked of that table, rows loaded (AGG-5),
respondents and rows per answer (AGG-3), follows from the lists themselves: an option
stands on (product / its column's count) rows. The lists are kept; work and memory
grow with the sum of the counts. Products are decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import option_list
from .filters import drop_all_null

EXACT = "decimal(38,0)"


def _options(c: str, sep: str) -> Column:
    """The options that EX-1 makes rows of: one NULL for a cell without any."""
    opts = option_list(F.col(f"`{c}`"), sep)
    return F.when(F.size(opts) > 0, opts).otherwise(F.array(F.lit(None).cast("string")))


def with_options(df: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """``df`` (without rows whose ``columns`` are all NULL, as EX-1) with ``__opts`` (a list for
    each column) and ``__rows`` (the rows that the product would have)."""
    base = drop_all_null(df, list(columns)).withColumn("__opts", F.array(*[_options(c, sep) for c in columns]))
    sizes = [F.size(F.col("__opts")[i]).cast(EXACT) for i in range(len(columns))]
    return base.withColumn("__rows", reduce(lambda a, b: (a * b).cast(EXACT), sizes).cast(EXACT))


def product_rows(df: DataFrame, columns: Sequence[str], sep: str = ",", out: str = "rows") -> DataFrame:
    """AGG-5: the number of rows of the product (one row, 0 for no input)."""
    return with_options(df, columns, sep).agg(F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias(out))


def product_value_counts(df: DataFrame, subject: str, columns: Sequence[str], sep: str = ",",
                         variable: str = "variable", value: str = "value") -> DataFrame:
    """AGG-3: (variable, value, respondents, rows) for each option of each column: distinct
    subjects, and rows of the product with that option. NULL options are left out. An
    option that a cell holds twice stands on twice the rows. Partial aggregates."""
    cells = [F.struct(F.lit(c).alias(variable), F.col("__opts")[i].alias("__o"),
                      (F.col("__rows") / F.size(F.col("__opts")[i])).cast(EXACT).alias("__n")) for i, c in enumerate(columns)]
    long = with_options(df, columns, sep).select(F.col(f"`{subject}`").alias("__s"), F.inline(F.array(*cells))) \
        .select("__s", variable, F.explode("__o").alias(value), "__n").where(F.col(value).isNotNull())
    # rows per (value, subject) first, so that the distinct count has no Expand
    each = long.groupBy(variable, value, "__s").agg(F.sum("__n").alias("__n"))
    return each.groupBy(variable, value).agg(F.count("__s").alias("respondents"), F.sum("__n").cast("long").alias("rows"))
