"""AGG-3 over any span of periods, from stored sketches.

Each period's distinct respondents per answer value are kept as one HyperLogLog sketch
(a few KB). A day's load adds that day's sketches only; the respondents of a span are the
union of its periods' sketches, so nothing of the answers is read again and a respondent
who comes back in a later period is counted once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12                 # 2^12 registers: a standard error of 1.6 %
SKETCH = "sketch"


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a union of sketches with 2^lg_k registers."""
    return 1.04 / 2 ** (lg_k / 2)


def period_sketches(answers: DataFrame, period: str, values: Sequence[str], subject: str, lg_k: int = LG_K) -> DataFrame:
    """``(period, *values, sketch)``: the respondents of each period and answer value. Rows
    without a period or a respondent are left out; a null value is a value of its own.
    Partial aggregates, so a value with a third of all rows leaves each task as one sketch."""
    rows = answers.where(F.col(period).isNotNull() & F.col(subject).isNotNull())
    return rows.groupBy(F.col(period).alias("period"), *values).agg(F.hll_sketch_agg(subject, lg_k).alias(SKETCH))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Load the sketches of some periods; a repeated load replaces exactly its periods. The
    rows of a period are few (one per value), so each is one file."""
    (sketches.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("period").parquet(path))


def respondents_in(sketches: DataFrame, first, last, values: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``(*values, estimate, low, high)`` over the periods ``first`` to ``last``, both included
    (a partition filter on stored sketches). ``low`` and ``high`` are three standard errors off."""
    return _estimates(sketches.where(F.col("period").between(first, last)), values, lg_k)


def respondents_per_span(sketches: DataFrame, spans: DataFrame, values: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``(first, last, *values, estimate, low, high)`` for each of ``spans(first, last)``, dates of
    daily periods; overlapping spans and repeated ones are fine. A span with no answers has no row.
    The spans are dealt out by period and met by equality; a period's sketch is merged within
    its task before the shuffle."""
    days = spans.select("first", "last").distinct().withColumn(
        "period", F.explode(F.when(F.col("first") <= F.col("last"), F.sequence("first", "last"))))
    return _estimates(sketches.join(days, "period"), ["first", "last", *values], lg_k)


def _estimates(sketches: DataFrame, keys: Sequence[str], lg_k: int) -> DataFrame:
    merged = sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("estimate"))
    off = 3 * standard_error(lg_k)
    return merged.select(*keys, "estimate", F.floor(F.col("estimate") / (1 + off)).alias("low"),
                         F.ceil(F.col("estimate") / (1 - off)).alias("high"))
