"""Repeated-record assembly (GRP-1 .. GRP-4).

A record is opened by a sentinel variable. Its number is the running count of
sentinel rows (two-level scan, skew-safe); rows before the first sentinel join
record 1. Duplicate variables in one record: the LAST wins, a NULL included
(``max_by`` keeps a NULL value at the max key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ANSWER, ELEMENT, QUESTION, SEQ, SUBJECT, VALUE
from .lookup import prepare_pairs
from .ordered import Scan, ordered_scan


def assemble_records(stream: DataFrame, variables: Sequence[str], sentinel: str | None, *,
                     elements: Sequence[str] = (QUESTION, ANSWER), question: str = QUESTION,
                     answer: str = ANSWER, strip_prefix: bool = False,
                     record_col: str = "rec") -> DataFrame:
    """GRP-1 (``sentinel`` set) / GRP-2 (``sentinel=None``: one record).

    Returns ``subject_id, rec`` + one column per variable, one row per record
    that holds at least one known variable."""
    s = prepare_pairs(stream, elements, strip_prefix)
    is_var = (F.col(ELEMENT) == question) & F.col(VALUE).isin(list(variables))
    scan = Scan(lead={"__ne": ELEMENT, "__nv": VALUE})
    if sentinel is not None:
        scan.running = {"__sc": F.when(is_var & (F.col(VALUE) == sentinel), 1).otherwise(0)}
    s = ordered_scan(s, scan).filter(is_var)
    rec = F.greatest(F.lit(1), F.col("__sc")) if sentinel is not None else F.lit(1)
    val = F.when(F.col("__ne") == answer, F.col("__nv"))
    s = s.select(SUBJECT, SEQ, VALUE, rec.cast("long").alias(record_col), val.alias("__val"))
    return s.groupBy(SUBJECT, record_col).agg(*[
        F.max_by(F.col("__val"), F.when(F.col(VALUE) == v, F.col(SEQ))).alias(v)
        for v in variables])


def section_values(stream: DataFrame, section: Column, name: str, *,
                   question: str = QUESTION, joiner: str = ", ") -> DataFrame:
    """GRP-3: in document order, for each ``section`` row take the next row's
    value when that row is a ``question``; join them with ``joiner``.
    (Apply ``marker_slice`` first to restrict to a slice.) Only the matching
    rows are collected per subject, sorted by position."""
    s = ordered_scan(stream, Scan(lead={"__ne": ELEMENT, "__nv": VALUE}))
    s = s.filter(section & (F.col("__ne") == question))
    return s.groupBy(SUBJECT).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(SEQ).alias("s"), F.col("__nv").alias("v")))),
        lambda x: x["v"]), joiner).alias(name))
