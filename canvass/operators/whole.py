"""Operators over whole interviews: one row an interview, its answers an array in document order.

Where each interview is one document, nothing has to be exploded, sorted or joined to know the
next answer: lookups (LK-1/2), headers (LK-6/7), records (GRP-1/2), their zip (JN-2), the header
beside them (JN-1) and the fill from the first record (JN-3) are array expressions over a row,
all of them in one pass. They give what the operators of the same names give over the stream.

A stream that was read out of such documents carries them (``with_whole``). Any step on it
(a filter, a join) gives a stream that carries nothing, which is read as a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import strip_loop_prefix
from ..schema import ATTRIBUTE, ELEMENT, SUBJECT, VALUE

ROWS = "rows"            # array<struct<element, attribute, value>>; no attribute: text
PAIR = ("SubjectNum", "Upload")


@dataclass(frozen=True)
class Whole:
    """``documents(subject_id, rows)``: one row an interview. ``rest``: the stream of the
    interviews that have several documents, if there are any."""

    documents: DataFrame
    rest: DataFrame | None = None


def with_whole(stream: DataFrame, whole: Whole) -> DataFrame:
    stream._whole = whole
    return stream


def whole_of(stream: DataFrame) -> Whole | None:
    return stream.__dict__.get("_whole")


def header_rows_of(elements: Sequence[str]) -> Column:
    """FIL-2 over ``rows``."""
    return F.filter(ROWS, lambda x: x[ELEMENT].isin(list(elements)) & (F.coalesce(x[ATTRIBUTE], F.lit("text")) == "text"))


def _plain(c: str, strip_prefix: bool):
    return lambda x: strip_loop_prefix(x[c]) if strip_prefix else x[c]


class Reading:
    """The columns of several operators over one frame of documents, made in a few steps, each
    of which keeps what the next one uses more than once."""

    def __init__(self, documents: DataFrame):
        self.frame = documents.select(SUBJECT, ROWS)
        self.kept: dict[tuple, str] = {}
        self.pairs: Column | None = None
        self.values: dict[str, Column] = {}                    # of the interview
        self.records: list[tuple[str, tuple[str, ...], str | None]] = []
        self.known = F.col(SUBJECT).isNotNull()                # scans drop interviews without an id

    def _keep(self, key: tuple, value: Column) -> str:
        if key not in self.kept:
            self.kept[key] = f"__w{len(self.kept)}"
            self.frame = self.frame.withColumn(self.kept[key], value)
        return self.kept[key]

    def header(self, elements: Sequence[str], names: dict[str, str], pairs: bool) -> None:
        """LK-6, or LK-7 with ``pairs``: the interview has a row for each pair of header rows."""
        if pairs:
            h = self._keep(("header",), F.when(self.known, header_rows_of(PAIR)))
            self.pairs = F.ceil(F.size(h) / 2).cast("int")
            for i, e in enumerate(PAIR):
                self.values[e] = F.get(F.col(f"{h}.{VALUE}"), 2 * F.col("__pair") + i)
        else:
            h = self._keep(("header",), header_rows_of(elements))
            self.pairs = F.least(F.size(h), F.lit(1))
            for e in elements:
                at = F.array_position(F.col(f"{h}.{ELEMENT}"), F.lit(e)).cast("int") - 1
                self.values[names.get(e, e)] = F.get(F.col(f"{h}.{VALUE}"), at)

    def _elements(self, elements: Sequence[str]) -> str:
        """FIL-1."""
        return self._keep(("rows", tuple(elements)), F.when(self.known, F.filter(ROWS, lambda x: x[ELEMENT].isin(list(elements)))))

    def lookup(self, variables: Sequence[str], mode: str, elements: Sequence[str], question: str, answer: str,
               strip_prefix: bool, first_record: bool) -> None:
        """LK-1 / LK-2. ``first_record``: the values stand beside record 1 only."""
        e, value = self._elements(elements), _plain(VALUE, strip_prefix)
        key = tuple(elements), question, strip_prefix
        names = self._keep(("names", *key), F.transform(e, lambda x: F.when(x[ELEMENT] == question, value(x))))
        given = self._keep(("values", *key, mode, answer), F.transform(
            e, lambda x: value(x) if mode == "loose" else F.when(x[ELEMENT] == answer, value(x))))
        for v in variables:
            at = F.array_position(names, F.lit(v)).cast("int")       # counted from 1: the row after it
            found = F.when(at > 0, F.get(F.col(given), at))
            self.values[v] = F.when(F.col("rec") == 1, found) if first_record else found

    def assemble(self, variables: Sequence[str], sentinel: str | None, elements: Sequence[str], question: str, answer: str,
                 strip_prefix: bool) -> None:
        """GRP-1 / GRP-2: the rows of the variables with their strict answers, and the places of the sentinels."""
        e, value, none = self._elements(elements), _plain(VALUE, strip_prefix), F.lit(None)
        asked = lambda x: (x[ELEMENT] == question) & value(x).isin(list(variables))

        def row(x: Column, i: Column) -> Column:
            after = F.get(F.col(e), i + 1)
            return F.when(asked(x), F.struct(value(x).alias("v"), F.when(after[ELEMENT] == answer, value(after)).alias("a")))

        n = len(self.records)
        rows = self._keep(("asked", n), F.filter(F.transform(e, row), lambda x: x.isNotNull()))
        opened = self._keep(("opened", n), none.cast("array<int>") if sentinel is None else F.filter(
            F.transform(rows, lambda x, i: F.when(x["v"] == sentinel, i)), lambda i: i.isNotNull()))
        self.records.append((rows, tuple(variables), opened))

    def _count(self, rows: str, opened: str) -> Column:
        """Records: rows before the first sentinel join record 1."""
        some = F.coalesce(F.size(rows), F.lit(0)) > 0
        return F.when(some, F.greatest(F.lit(1), F.size(opened))).otherwise(0)

    def read(self, at_least_one: bool, fill_first: Sequence[str] = ()) -> DataFrame:
        """subject_id, ``rec`` if there are records, and a column for each value. JN-2: records
        side by side by number. JN-1: the header beside each. ``at_least_one``: an interview without
        records has its row 1. JN-3: nulls of ``fill_first`` take record 1's value."""
        n = F.lit(1)
        if self.records:
            counts = [self._count(rows, opened) for rows, _, opened in self.records]
            n = F.greatest(F.lit(1 if at_least_one else 0), *counts)
        out = self.frame.withColumn("__n", n).withColumn("__rows", F.coalesce(self.pairs, F.lit(0)) * F.col("__n")).drop(ROWS)
        some = F.when(F.col("__rows") > 0, F.sequence(F.lit(0), F.col("__rows") - 1))
        # no filter below the explode: it would be pushed down and read the document again
        out = out.select("*", F.explode_outer(some).alias("__at")).where("__at is not null")
        out = out.withColumn("__pair", F.expr("cast(__at div __n as int)")).withColumn("rec", F.expr("__at % __n + 1"))
        ends = []
        for k, (rows, variables, opened) in enumerate(self.records):
            last = self._count(rows, opened)
            start = F.when(F.col("rec") == 1, 0).otherwise(F.get(F.col(opened), F.col("rec") - 1))
            stop = F.when(F.col("rec") >= last, F.size(rows)).otherwise(F.get(F.col(opened), F.col("rec")))
            own = F.when(F.col("rec") <= last, F.reverse(F.slice(rows, start + 1, stop - start)))
            stop1 = F.when(F.lit(1) >= last, F.size(rows)).otherwise(F.get(F.col(opened), F.lit(1)))
            ends.append(own.alias(f"__r{k}"))
            if set(variables) & set(fill_first):
                ends.append(F.reverse(F.slice(rows, F.lit(1), stop1)).alias(f"__f{k}"))
        out = out.select("*", *ends)
        columns = [c.alias(name) for name, c in self.values.items()]

        def last_of(r: str, v: str) -> Column:                 # the last wins, a null included
            return F.get(F.col(f"{r}.a"), F.array_position(F.col(f"{r}.v"), F.lit(v)).cast("int") - 1)

        for k, (_, variables, _) in enumerate(self.records):
            for v in variables:
                own = last_of(f"__r{k}", v)
                columns.append((F.coalesce(own, last_of(f"__f{k}", v)) if v in fill_first else own).alias(v))
        rec = [F.col("rec").cast("long").alias("rec")] if self.records else []
        # out of a generator, so that later filters and expressions refer to the values and do not repeat how they are made
        return out.select(SUBJECT, F.inline(F.array(F.struct(*rec, *columns))))
