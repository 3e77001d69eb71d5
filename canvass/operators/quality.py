"""Row quarantine and empty-day reporting (QUA-1, QUA-2).

One policy instead of per-dataset exception classes: every row gets a
``status`` ('valid' / 'reject') and a ``reason``; rejects are written beside
the valid rows, never dropped silently, never fail the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quarantine(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """QUA-1: ``checks`` maps a reason to a Column that is TRUE when the row
    fails; the first failing check (in order) becomes the reason."""
    reason = None
    for name, failed in checks.items():
        cond = F.coalesce(failed, F.lit(False))
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    reason = reason if reason is not None else F.lit(None).cast("string")
    return df.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), F.lit("valid")).otherwise(F.lit("reject")))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """valid rows (without the bookkeeping) and rejects."""
    valid = df.filter(F.col("status") == "valid").drop("status", "reason")
    rejects = df.filter(F.col("status") == "reject")
    return valid, rejects


def empty_day_report(days: DataFrame, rows: DataFrame, day_col: str = "day",
                     ts_col: str = "ts") -> DataFrame:
    """QUA-2: every requested day with its row count; ``empty`` flags days
    that produced nothing (reported, the run goes on)."""
    counts = rows.groupBy(F.to_date(F.col(ts_col)).alias(day_col)).agg(F.count(F.lit(1)).alias("n"))
    out = days.join(counts, day_col, "left")
    return out.select(day_col, F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
                      F.col("n").isNull().alias("empty"))


def position_check(stream: DataFrame, name: str) -> DataFrame:
    """Rows vs distinct ``(subject, seq)`` positions of a stream: every ordered
    operator assumes they are equal (a duplicate position makes "next row"
    ambiguous). One pass; a mismatch is a reject reason. Positions are counted within
    their block (which goes by seq), as the stream is hashed already."""
    from ..schema import BLOCK, SEQ, SUBJECT

    per_pos = stream.groupBy(SUBJECT, *([BLOCK] if BLOCK in stream.columns else []), SEQ).agg(F.count(F.lit(1)).alias("__n"))
    return per_pos.agg(F.lit(name).alias("stream"), F.sum("__n").cast("long").alias("rows"),
                       F.count(F.lit(1)).alias("positions"))
