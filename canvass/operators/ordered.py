"""Skew-safe ordered scans over an answer stream.

A plain ``Window.partitionBy(subject).orderBy(seq)`` sends every row of a
subject to one task; one hot subject (a bot user, a giant interview) would then
serialise a third of the job. Every ordered operator of the engine therefore
runs as a *two-level* scan:

1. the window runs over ``(subject, block)``; a block is a bounded seq range,
   so no task sees more than ``span`` rows of one subject;
2. a per-block summary (first row, block totals, first match) is read off
   the first row of each block of the same window output (the shuffle is
   reused, nothing is re-aggregated), scanned over blocks by subject --
   ``rows / span`` rows only -- and joined back on ``(subject, block)``, a
   join whose big side is already partitioned on exactly those keys.

All outputs requested in one call share one window spec, one summary and one
join, so an operator costs one shuffle of the stream.

A stream that marks its subjects as whole (``whole_block``) needs no second level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import BLOCK, BLOCK_SPAN_CONF, DEFAULT_BLOCK_SPAN, SEQ, SUBJECT


# Metadata of a stream's ``block`` column: the rows of a subject come from one row of the source
# (a document) or fill one block, so they lie in one task whatever the scan does.
WHOLE = "whole_subjects"


def whole_block(block: Column) -> Column:
    """``block`` of a stream whose subjects are whole in one task."""
    return block.alias(BLOCK, metadata={WHOLE: True})


def has_whole_subjects(df: DataFrame, block: str = BLOCK) -> bool:
    return block in df.columns and bool(df.schema[block].metadata.get(WHOLE))


def block_span(spark) -> int:
    return int(spark.conf.get(BLOCK_SPAN_CONF, str(DEFAULT_BLOCK_SPAN)))


def with_block(df: DataFrame, span: int | None = None, seq: str = SEQ,
               block: str = BLOCK) -> DataFrame:
    """Add ``block = seq div span`` unless the stream already carries one."""
    if block in df.columns:
        return df
    span = span or block_span(df.sparkSession)
    return df.withColumn(block, F.floor(F.col(seq) / F.lit(span)).cast("long"))


@dataclass
class Scan:
    """Outputs of one ordered pass.

    lead:       ``{out: column}`` -- value of ``column`` on the next row
                (null on the last row of the subject).
    running:    ``{out: numeric Column}`` -- inclusive running sum by seq.
    next_match: ``{out: (predicate, value)}`` -- ``value`` on the first row
                strictly after this one where ``predicate`` holds.
    """

    lead: dict[str, str] = field(default_factory=dict)
    running: dict[str, Column] = field(default_factory=dict)
    next_match: dict[str, tuple[Column, Column]] = field(default_factory=dict)


def ordered_scan(df: DataFrame, scan: Scan, *, subject: str = SUBJECT,
                 seq: str = SEQ, block: str = BLOCK) -> DataFrame:
    if has_whole_subjects(df, block) and not scan.next_match:
        return _whole_scan(df, scan, subject, seq)
    df = with_block(df, seq=seq, block=block)
    # rows without a subject belong to no interview; stating the filter here
    # (instead of letting the join infer it on one side only) keeps both join
    # branches identical below the window, so they share ONE shuffle
    df = df.filter(F.col(subject).isNotNull() & F.col(block).isNotNull())
    base_cols = df.columns
    w = Window.partitionBy(subject, block).orderBy(seq)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_after = w.rowsBetween(1, Window.unboundedFollowing)
    w_all = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wb = Window.partitionBy(subject).orderBy(block)

    inner_cols: list[Column] = [F.row_number().over(w).alias("__rn")]
    head_cols: list[Column] = []      # block-level values, read off the block's first row
    carry_cols: list[Column] = []
    finals: list[Column] = []

    if scan.lead:
        # plain per-column leads (no struct per row); lead(seq) tells "there is
        # a next row in this block" apart from "the next value is NULL"
        cols = list(dict.fromkeys(scan.lead.values()))
        inner_cols.append(F.lead(seq).over(w).alias("__lead_seq"))
        inner_cols += [F.lead(c).over(w).alias(f"__lead_{k}") for k, c in enumerate(cols)]
        head_cols += [F.col(c).alias(f"__head_{k}") for k, c in enumerate(cols)]
        carry_cols += [F.lead(f"__head_{k}").over(wb).alias(f"__next_{k}") for k in range(len(cols))]
        in_block = F.col("__lead_seq").isNotNull()
        finals += [F.when(in_block, F.col(f"__lead_{cols.index(c)}"))
                    .otherwise(F.col(f"__next_{cols.index(c)}")).alias(out)
                   for out, c in scan.lead.items()]

    for i, (out, expr) in enumerate(scan.running.items()):
        f, r, t, o = f"__f{i}", f"__r{i}", f"__t{i}", f"__o{i}"
        inner_cols.append(F.sum(expr).over(w_run).alias(r))
        inner_cols.append(F.sum(expr).over(w_all).alias(f))
        head_cols.append(F.col(f).alias(t))
        carry_cols.append(F.coalesce(
            F.sum(t).over(wb.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias(o))
        finals.append((F.col(r) + F.col(o)).alias(out))

    for i, (out, (pred, val)) in enumerate(scan.next_match.items()):
        m, bm, cm = f"__m{i}", f"__bm{i}", f"__cm{i}"
        hit = F.when(pred, F.struct(val.alias("v")))
        inner_cols.append(F.first(hit, ignorenulls=True).over(w_after).alias(m))
        inner_cols.append(F.first(hit, ignorenulls=True).over(w_all).alias(bm))
        head_cols.append(F.col(bm))
        carry_cols.append(F.first(bm, ignorenulls=True)
                          .over(wb.rowsBetween(1, Window.unboundedFollowing)).alias(cm))
        finals.append(F.coalesce(F.col(m), F.col(cm))["v"].alias(out))

    # one window pass over (subject, block); the block summary is the first
    # row of each block, so both join sides reuse the same shuffle
    inner = df.select("*", *inner_cols)
    heads = inner.filter(F.col("__rn") == 1).select(subject, block, *head_cols)
    carry = heads.select(subject, block, *carry_cols)
    joined = inner.join(carry, [subject, block], "left")
    return joined.select(*[F.col(c) for c in base_cols], *finals)


def _whole_scan(df: DataFrame, scan: Scan, subject: str, seq: str) -> DataFrame:
    """The scan where subjects are whole: one window, no summary and no join. Nothing
    moves if the stream is already hashed by subject."""
    w = Window.partitionBy(subject).orderBy(seq)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.filter(F.col(subject).isNotNull()).select(
        *[F.col(c) for c in df.columns], *[F.lead(c).over(w).alias(out) for out, c in scan.lead.items()],
        *[F.sum(expr).over(run).alias(out) for out, expr in scan.running.items()])


def with_next(df: DataFrame, cols: list[str], prefix: str = "next_", **kw) -> DataFrame:
    return ordered_scan(df, Scan(lead={prefix + c: c for c in cols}), **kw)


def with_ordinal(df: DataFrame, out: str = "rn", **kw) -> DataFrame:
    """1-based row number by seq within subject (two-level, skew-safe)."""
    return ordered_scan(df, Scan(running={out: F.lit(1).cast("long")}), **kw)


def with_running_count(df: DataFrame, flag: Column, out: str, **kw) -> DataFrame:
    return ordered_scan(df, Scan(running={out: flag.cast("long")}), **kw)
