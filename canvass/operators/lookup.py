"""Answer lookups (LK-1 .. LK-7): one row per subject, one column per variable.

All variables of a spec are resolved by ONE ordered scan (next row) and ONE
aggregation by subject, instead of a pass per variable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import option_list, strip, strip_loop_prefix
from ..schema import (ANSWER, ELEMENT, GRID_ANSWER, QUESTION, SEQ, SUBJECT, VALUE)
from .filters import element_filter, header_rows
from .ordered import Scan, ordered_scan, with_ordinal


def with_answer(stream: DataFrame, answer_element: str = ANSWER) -> DataFrame:
    """Adds ``loose`` (next row's value) and ``strict`` (next value only when the
    next row is an answer) to every row of an already element-filtered stream."""
    s = ordered_scan(stream, Scan(lead={"__next_element": ELEMENT, "__next_value": VALUE}))
    strict = F.when(F.col("__next_element") == answer_element, F.col("__next_value"))
    return (s.withColumn("loose", F.col("__next_value")).withColumn("strict", strict)
            .drop("__next_element", "__next_value"))


def prepare_pairs(stream: DataFrame, elements: Sequence[str] = (QUESTION, ANSWER),
                  strip_prefix: bool = False) -> DataFrame:
    """FIL-1 (+ SC-5) on the stream, ready for a next-row scan."""
    s = element_filter(stream, elements)
    if strip_prefix:
        s = s.withColumn(VALUE, strip_loop_prefix(VALUE))
    return s


def lookup(stream: DataFrame, variables: Sequence[str], *, mode: str = "strict",
           elements: Sequence[str] = (QUESTION, ANSWER), question: str | None = QUESTION,
           answer: str = ANSWER, strip_prefix: bool = False,
           names: Sequence[str] | None = None) -> DataFrame:
    """LK-1 (mode='loose') / LK-2 (mode='strict').

    For each variable: the FIRST ``question`` row whose value is the variable;
    the result is the next row's value (loose) or the next row's value only if
    that row is an ``answer`` (strict). No next row / not found -> NULL.
    ``question=None`` keys the lookup on the element name instead (the
    variable IS the element, as for header tags or conversation roles).
    Output: ``subject_id`` + one column per variable (``names`` renames them).
    """
    s = with_answer(prepare_pairs(stream, elements, strip_prefix), answer)
    key = F.col(VALUE) if question is not None else F.col(ELEMENT)
    is_q = (F.col(ELEMENT) == question) if question is not None else F.lit(True)
    s = s.filter(is_q & key.isin(list(variables)))
    names = list(names or variables)
    return s.groupBy(SUBJECT).agg(*[
        F.min_by(F.col(mode), F.when(key == v, F.col(SEQ))).alias(n)
        for v, n in zip(variables, names)])


def header_by_name(stream: DataFrame, elements: Sequence[str],
                   names: dict[str, str] | None = None) -> DataFrame:
    """LK-6: first text value of each header element, NULL when absent."""
    names = names or {}
    h = header_rows(stream, elements)
    return h.groupBy(SUBJECT).agg(*[
        F.min_by(F.col(VALUE), F.when(F.col(ELEMENT) == e, F.col(SEQ))).alias(names.get(e, e))
        for e in elements])


def header_pairs(stream: DataFrame, first: str = "SubjectNum", second: str = "Upload") -> DataFrame:
    """LK-7 (pair mode): header text rows taken in order and paired by position
    (row 1,3,5.. -> ``first``, 2,4,6.. -> ``second``); several pairs give several
    header rows, numbered ``pair``."""
    h = with_ordinal(header_rows(stream, [first, second]), "__rn")
    h = h.withColumn("pair", F.ceil(F.col("__rn") / 2).cast("long"))
    return h.groupBy(SUBJECT, "pair").agg(
        F.max(F.when(F.col("__rn") % 2 == 1, F.col(VALUE))).alias(first),
        F.max(F.when(F.col("__rn") % 2 == 0, F.col(VALUE))).alias(second))


def sku_metric_lookup(stream: DataFrame, skus: Sequence[str], metrics: Sequence[str], *,
                      mode: str = "loose", sku_col: str = "Variable") -> DataFrame:
    """LK-3: lookup of every ``<sku>_<metric>`` variable, long by SKU.

    The sku x metric dimension is spec-fixed (bounded, broadcast); every subject
    gets one row per SKU even when nothing was found."""
    spark = stream.sparkSession
    dim = spark.createDataFrame(
        [(f"{s}_{m}", s, m) for s in skus for m in metrics], "__name string, __sku string, __metric string")
    s = with_answer(prepare_pairs(stream))
    s = s.filter(F.col(ELEMENT) == QUESTION)
    hits = s.join(F.broadcast(dim), F.col(VALUE) == F.col("__name"))
    found = (hits.groupBy(SUBJECT, F.col("__sku").alias(sku_col)).agg(*[
        F.min_by(F.col(mode), F.when(F.col("__metric") == m, F.col(SEQ))).alias(m)
        for m in metrics]))
    # all SKUs for every subject that has a stream: a bounded generator, not a join
    subjects = stream.select(SUBJECT).distinct()
    grid = subjects.select(SUBJECT, F.explode(F.array(*[F.lit(x) for x in skus])).alias(sku_col))
    return grid.join(found, [SUBJECT, sku_col], "left")


def next_answer_after_labels(stream: DataFrame, labels: Sequence[str], *,
                             label_element: str | None = "Text", answer_element: str = GRID_ANSWER,
                             missing: str | None = "") -> DataFrame:
    """LK-4: for each label, the first ``answer_element`` row anywhere after the
    label row (answers may be skipped or shared). A repeated label: the last
    occurrence wins. Missing -> ``missing``."""
    s = ordered_scan(stream, Scan(next_match={
        "__ans": (F.col(ELEMENT) == answer_element, F.col(VALUE))}))
    key = F.col(VALUE) if label_element is not None else F.col(ELEMENT)
    is_label = (F.col(ELEMENT) == label_element) if label_element is not None else F.lit(True)
    s = s.filter(is_label & key.isin(list(labels)))
    agg = s.groupBy(SUBJECT).agg(*[
        F.max_by(F.col("__ans"), F.when(key == lb, F.col(SEQ))).alias(lb)
        for lb in labels])
    if missing is None:
        return agg
    return agg.select(SUBJECT, *[F.coalesce(F.col(f"`{lb}`"), F.lit(missing)).alias(lb)
                                 for lb in labels])


def vector_or_labels(slice_: DataFrame, labels: Sequence[str], *,
                     answer_element: str = GRID_ANSWER, label_element: str = "Text") -> DataFrame:
    """LK-5: inside a slice, the first ``answer_element`` value containing a
    comma is split, trimmed, padded with '' / cut to len(labels) and named by
    the labels; without such a value, LK-4 over the slice's label/answer rows."""
    has_comma = (F.col(ELEMENT) == answer_element) & F.coalesce(F.col(VALUE).contains(","), F.lit(False))
    vec = slice_.groupBy(SUBJECT).agg(F.min_by(F.col(VALUE), F.when(has_comma, F.col(SEQ))).alias("__vec"))
    parts = F.transform(F.split(F.col("__vec"), ","), lambda x: strip(x))
    vec = vec.select(SUBJECT, "__vec", *[F.coalesce(F.get(parts, i), F.lit("")).alias(f"__v{i}")
                                          for i in range(len(labels))])
    pairs = element_filter(slice_, [answer_element, label_element])
    fb = next_answer_after_labels(pairs, labels, label_element=label_element,
                                  answer_element=answer_element)
    out = vec.join(fb, SUBJECT, "left")
    return out.select(SUBJECT, *[
        F.when(F.col("__vec").isNotNull(), F.col(f"__v{i}"))
         .otherwise(F.coalesce(F.col(f"`{lb}`"), F.lit(""))).alias(lb)
        for i, lb in enumerate(labels)])


def first_per_subject(df: DataFrame, value: str, order: str = SEQ, out: str | None = None,
                      subject: str = SUBJECT) -> DataFrame:
    """LIM-1: the first value per subject (``min_by``, partial-aggregated)."""
    return df.groupBy(subject).agg(F.min_by(F.col(value), F.col(order)).alias(out or value))


def option_sets_equal(c: Column | str, options: Sequence[str], sep: str = ",") -> Column:
    """SRT-1: case-folded, sorted option list equals ``options`` (duplicates count)."""
    x = F.col(c) if isinstance(c, str) else c
    got = F.array_sort(F.transform(F.split(x, sep), lambda v: F.lower(strip(v))))
    want = F.array(*[F.lit(o) for o in sorted(o.lower() for o in options)])
    return F.coalesce(got == want, F.lit(False))


__all__ = ["lookup", "header_by_name", "header_pairs", "sku_metric_lookup",
           "next_answer_after_labels", "vector_or_labels", "first_per_subject",
           "option_sets_equal", "with_answer", "prepare_pairs", "option_list"]
