"""Multi-value expansion, reshaping and positional joins (EX-*, JN-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import _regex_literal, option_list, strip
from ..schema import SEQ, SUBJECT
from .filters import drop_all_null
from .ordered import with_ordinal


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def explode_columns(df: DataFrame, columns: Sequence[str] | str, sep: str = ",") -> DataFrame:
    """EX-1: drop rows where all targets are NULL; split each target on the
    literal ``sep``, trim, drop blank options; explode the targets one after
    another (a per-row Cartesian product). A NULL/blank cell among others gives
    one NULL row, not a dropped row. Narrow: no shuffle."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    out = drop_all_null(df, cols)
    out = out.select(*[option_list(_q(c), sep).alias(c) if c in cols else _q(c) for c in out.columns])
    order = out.columns
    for c in cols:
        out = out.select(*[F.explode_outer(_q(c)).alias(c) if x == c else _q(x) for x in order])
    return out


def explode_untrimmed(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """EX-2: split without trim; leading spaces and blank options stay."""
    return df.select(*[F.explode_outer(F.split(_q(c), _regex_literal(sep))).alias(c) if c == column
                       else _q(c) for c in df.columns])


def explode_then_trim(df: DataFrame, column: str, sep: str = ",", null_text: str | None = None) -> DataFrame:
    """EX-3: split, explode, then trim; blanks kept. ``null_text='None'`` gives
    the parity rendering of a NULL cell, default keeps NULL."""
    src = _q(column) if null_text is None else F.coalesce(_q(column), F.lit(null_text))
    out = df.select(*[F.explode_outer(F.split(src, _regex_literal(sep))).alias(c) if c == column
                      else _q(c) for c in df.columns])
    return out.withColumn(column, strip(_q(column)))


# The wet/dry category pair of the hair-salon census.
WET, DRY = "Wet", "Dry Hair"


def expand_categories(df: DataFrame, category: str = "Category", wet: str = "segment_wet",
                      dry: str = "segment_dry") -> DataFrame:
    """EX-4 + FIL-6: category/segment expansion.

    Category set == {wet, dry hair}: one row per wet segment (Category='Wet',
    dry '') and one per dry segment ('Dry Hair', wet ''). Otherwise, for EACH
    category, one row per wet segment (dry '') then one per dry segment (wet '').
    NULL cells count as ['']. Rows with both segments blank are dropped."""
    from .lookup import option_sets_equal

    def parts(c):
        return F.when(_q(c).isNull(), F.array(F.lit(""))).otherwise(
            F.transform(F.split(_q(c), ","), lambda x: strip(x)))

    def rows(cat, wets, drys):
        return F.concat(
            F.transform(wets, lambda w: F.struct(cat.alias("c"), w.alias("w"), F.lit("").alias("d"))),
            F.transform(drys, lambda d: F.struct(cat.alias("c"), F.lit("").alias("w"), d.alias("d"))))

    combo = option_sets_equal(_q(category), [WET.lower(), DRY.lower()])
    wets, drys, cats = parts(wet), parts(dry), parts(category)
    pair_rows = F.concat(
        F.transform(wets, lambda w: F.struct(F.lit(WET).alias("c"), w.alias("w"), F.lit("").alias("d"))),
        F.transform(drys, lambda d: F.struct(F.lit(DRY).alias("c"), F.lit("").alias("w"), d.alias("d"))))
    per_cat = F.flatten(F.transform(cats, lambda c: rows(c, wets, drys)))
    arr = F.when(combo, pair_rows).otherwise(per_cat)
    others = [c for c in df.columns if c not in (category, wet, dry)]
    out = df.select(*[_q(c) for c in others], F.inline(arr))
    out = out.select(*[_q(c) for c in others], F.col("c").alias(category),
                     F.col("w").alias(wet), F.col("d").alias(dry))
    blank = lambda c: F.coalesce(_q(c), F.lit("")) == ""
    out = out.filter(~(blank(wet) & blank(dry)))
    return out.select(*[_q(c) for c in df.columns])


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], *,
                 name: str = "category", value: str = "value", sep: str | None = ",") -> DataFrame:
    """EX-5: wide -> long (one row per column), then one row per option
    (linear in the options, no product). NULL cells are dropped."""
    long = df.unpivot(list(ids), list(columns), name, value)
    long = long.filter(F.col(value).isNotNull())
    if sep is None:
        return long
    return long.select(*ids, name, F.explode(option_list(F.col(value), sep)).alias(value))


def split_metric_name(name: Column, metrics: Sequence[str]) -> tuple[Column, Column]:
    """EX-6: ``<sku>_<metric>`` -> (sku, metric) with the longest known metric
    suffix; a pure expression (no join)."""
    ms = sorted(metrics, key=len, reverse=True)
    metric = F.coalesce(*[F.when(name.endswith("_" + m), F.lit(m)) for m in ms])
    sku = F.when(metric.isNotNull(), F.substring(name, F.lit(1), F.length(name) - F.length(metric) - 1))
    return sku, metric


def positional_zip(frames: Sequence[DataFrame], order_cols: Sequence[str], *,
                   subject: str = SUBJECT, rn: str = "rn") -> DataFrame:
    """JN-2: row i of each input beside row i of the others, per subject; the
    shorter side is padded with NULL (full outer join on ``(subject, rn)``).

    ``order_cols[i]`` orders input i. The join key is unique per row, so a hot
    subject spreads over all partitions."""
    numbered = []
    for f, oc in zip(frames, order_cols):
        g = f.withColumnRenamed(oc, SEQ) if oc != SEQ else f
        g = with_ordinal(g, rn, seq=SEQ, block="__zb") if "__zb" not in g.columns else g
        numbered.append(g.drop("__zb", SEQ))
    out = numbered[0]
    for g in numbered[1:]:
        out = out.join(g, [subject, rn], "full_outer")
    return out


def fill_from_first(df: DataFrame, columns: Sequence[str], order: str = "rn",
                    subject: str = SUBJECT) -> DataFrame:
    """JN-3: NULLs of ``columns`` take the value of the subject's first row
    (by ``order``); when that first value is NULL nothing is filled."""
    firsts = df.groupBy(subject).agg(*[F.min_by(_q(c), F.col(order)).alias(f"__first_{c}")
                                       for c in columns])
    out = df.join(firsts, subject, "left")
    return out.select(*[F.coalesce(_q(c), F.col(f"`__first_{c}`")).alias(c) if c in columns else _q(c)
                        for c in df.columns])


def header_broadcast(header: DataFrame, items: DataFrame, subject: str = SUBJECT) -> DataFrame:
    """JN-1: repeat the one-row header beside every item of the subject.
    An equi-join on the subject; AQE splits a hot subject (skew join)."""
    return header.join(items, subject, "inner")
