"""GRP-1 with labels that are not known in advance (the schema comes from the answers).

One scan numbers the records and puts each answer beside its question; from it come both
the dictionary (which labels there are, how often they are answered, which type all their
answers have) and the records, each a map from label to answer. Only the last step turns
the map into columns, from the dictionary or from a chosen part of it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ANSWER, ELEMENT, QUESTION, SEQ, SUBJECT, VALUE
from .lookup import prepare_pairs
from .ordered import Scan, ordered_scan

MAX_COLUMNS = 4000        # a wider table is refused
LABEL, RECORD, ANSWERS = "label", "rec", "answers"
WHOLE = r"^-?(0|[1-9][0-9]{0,17})$"
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def labelled_answers(stream: DataFrame, sentinel: str | None, *, question: str = QUESTION, answer: str = ANSWER,
                     strip_prefix: bool = False) -> DataFrame:
    """``(subject_id, rec, label, answer, seq)``: one row per question row. The record number is
    the running count of ``sentinel`` questions (rows before the first one: record 1;
    no sentinel: record 1 throughout); a question without an answer row next to it has a
    null answer, one with a null label is left out."""
    s = prepare_pairs(stream, (question, answer), strip_prefix)
    scan = Scan(lead={"__ne": ELEMENT, "__nv": VALUE})
    if sentinel is not None:
        scan.running = {"__sc": F.when((F.col(ELEMENT) == question) & (F.col(VALUE) == sentinel), 1).otherwise(0)}
    s = ordered_scan(s, scan).filter((F.col(ELEMENT) == question) & F.col(VALUE).isNotNull())
    rec = F.greatest(F.lit(1), F.col("__sc")) if sentinel is not None else F.lit(1)
    return s.select(SUBJECT, rec.cast("long").alias(RECORD), F.col(VALUE).alias(LABEL),
                    F.when(F.col("__ne") == answer, F.col("__nv")).alias("answer"), SEQ)


def label_dictionary(answers: DataFrame) -> DataFrame:
    """``(label, questions, answered, type)`` for every label: ``long`` if all answers are whole
    numbers of up to 18 digits, ``double`` if all are numbers, else ``string`` (also with no
    answer at all). Numbers with leading zeros are text. One partial aggregate."""
    a = F.col("answer")
    seen = answers.groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("questions"), F.count(a).alias("answered"),
        F.count_if(a.rlike(WHOLE)).alias("__w"), F.count_if(a.rlike(NUMBER)).alias("__n"))
    kind = F.when((F.col("answered") == 0) | (F.col("__n") < F.col("answered")), "string") \
        .when(F.col("__w") == F.col("answered"), "long").otherwise("double")
    return seen.select(LABEL, "questions", "answered", kind.alias("type"))


def label_records(answers: DataFrame) -> DataFrame:
    """``(subject_id, rec, answers map<label, answer>)``: one row per record. A label that
    stands more than once in a record keeps its last answer, a null included."""
    last = answers.groupBy(SUBJECT, RECORD, LABEL).agg(F.max_by("answer", SEQ).alias("answer"))
    return last.groupBy(SUBJECT, RECORD).agg(F.map_from_entries(F.collect_list(F.struct(LABEL, "answer"))).alias(ANSWERS))


def column_types(dictionary: DataFrame, max_columns: int = MAX_COLUMNS) -> dict[str, str]:
    """The dictionary as ``{label: type}``, by label. It becomes a table's columns, so more
    than ``max_columns`` labels are refused; a map of records has no such bound."""
    rows = dictionary.select(LABEL, "type").limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} labels")
    return dict(sorted((r[LABEL], r["type"]) for r in rows))


def typed_records(records: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The records as a table with one column per label of ``types``; a label that a record
    lacks is null, an answer that is not of its column's type as well."""
    return records.select(SUBJECT, RECORD, *(
        F.try_element_at(F.col(ANSWERS), F.lit(label)).try_cast(kind).alias(label) for label, kind in types.items()))
