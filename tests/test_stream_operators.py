"""Operator semantics on the hand-written sample interview (FIXTURES.md §3)."""

from pyspark.sql import functions as F

from canvass.operators.assemble import assemble_records, section_values
from canvass.operators.filters import marker_slice, marker_slice_inclusive, not_done
from canvass.operators.lookup import (header_by_name, header_pairs, lookup,
                                      next_answer_after_labels, vector_or_labels)
from canvass.functions.scalars import strip_parenthetical
from conftest import stream_df

SAMPLE = [
    ("SubjectNum", "7001"),
    ("Upload", "2026-01-02T03:04:05Z"),
    ("FullVariable", "outlet_code"),
    ("QuestionAnswer", "A1"),
    ("FullVariable", "I_1_item_category"),
    ("QuestionAnswer", "Water"),
    ("FullVariable", "I_1_item_name"),
    ("QuestionAnswer", "Voltic (500ml) (PET)"),
    ("FullVariable", "I_1_item_price"),
    ("FullVariable", "I_2_item_category"),
    ("QuestionAnswer", "DONE"),
    ("FullVariable", "radio_stations"),
    ("QuestionAnswer", "Joy FM, , Peace FM"),
    ("FullVariable", "tail_question"),
]


def test_loose_vs_strict(spark, small_blocks):
    s = stream_df(spark, SAMPLE)
    vars_ = ["outlet_code", "item_price", "tail_question", "absent"]
    loose = lookup(s, vars_, mode="loose", strip_prefix=True).collect()[0].asDict()
    strict = lookup(s, vars_, mode="strict", strip_prefix=True).collect()[0].asDict()
    assert loose["outlet_code"] == "A1" and strict["outlet_code"] == "A1"
    # unanswered question: loose returns the NEXT QUESTION'S NAME, strict NULL
    assert loose["item_price"] == "item_category"
    assert strict["item_price"] is None
    assert loose["tail_question"] is None and loose["absent"] is None


def test_sentinel_assembly_and_done(spark, small_blocks):
    s = stream_df(spark, SAMPLE)
    vars_ = ["outlet_code", "item_category", "item_name", "item_price"]
    recs = assemble_records(s, vars_, "item_category", strip_prefix=True).orderBy("rec")
    got = [r.asDict() for r in recs.collect()]
    assert len(got) == 2
    # rows before the first sentinel join record 1
    assert got[0]["outlet_code"] == "A1" and got[0]["item_category"] == "Water"
    assert got[0]["item_price"] is None
    assert got[1]["item_category"] == "DONE" and got[1]["outlet_code"] is None
    kept = not_done(recs).collect()
    assert [r.rec for r in kept] == [1]
    name = recs.select(strip_parenthetical("item_name").alias("n")).first().n
    assert name == "Voltic "


def test_last_wins_with_null(spark):
    rows = [("FullVariable", "a"), ("QuestionAnswer", "1"), ("FullVariable", "a")]
    recs = assemble_records(stream_df(spark, rows), ["a"], None).collect()
    assert len(recs) == 1 and recs[0]["a"] is None


def test_dead_sentinel_single_record(spark):
    rows = [("FullVariable", "a"), ("QuestionAnswer", "1"), ("FullVariable", "b"),
            ("QuestionAnswer", "2"), ("FullVariable", "a"), ("QuestionAnswer", "3")]
    recs = assemble_records(stream_df(spark, rows), ["a", "b"], "never").collect()
    assert len(recs) == 1 and recs[0]["a"] == "3" and recs[0]["b"] == "2"


def test_header_by_name_and_pairs(spark):
    s = stream_df(spark, SAMPLE + [("SubjectNum", "7002"), ("Upload", "x")])
    h = header_by_name(s, ["SubjectNum", "Upload", "VisitEnd"]).first()
    assert h["SubjectNum"] == "7001" and h["VisitEnd"] is None
    p = header_pairs(s).orderBy("pair").collect()
    assert [(r.SubjectNum, r.Upload) for r in p] == [("7001", "2026-01-02T03:04:05Z"), ("7002", "x")]


def test_marker_slices(spark):
    rows = [("Variable", "x"), ("Variable", "start"), ("FullVariable", "q1"),
            ("Variable", "end"), ("FullVariable", "q2"), ("Variable", "start")]
    s = stream_df(spark, rows)
    st = (F.col("element") == "Variable") & (F.col("value") == "start")
    en = (F.col("element") == "Variable") & (F.col("value") == "end")
    assert sorted(r.seq for r in marker_slice(s, st, en).collect()) == [1, 2]
    assert sorted(r.seq for r in marker_slice_inclusive(s, en, st).collect()) == [1, 2, 3]


def test_section_values(spark):
    rows = [("Variable", "brand_impression"), ("FullVariable", "strong"),
            ("Variable", "brand_impression"), ("QuestionAnswer", "x"),
            ("Variable", "brand_impression"), ("FullVariable", "cheap")]
    s = stream_df(spark, rows)
    sec = (F.col("element") == "Variable") & (F.col("value") == "brand_impression")
    got = section_values(s, sec, "brand_impression").first()
    assert got["brand_impression"] == "strong, cheap"


def test_next_answer_after_labels_and_vector(spark):
    rows = [("Text", "A"), ("Text", "B"), ("TopicAnswer", "1"), ("Text", "A"),
            ("TopicAnswer", "2")]
    s = stream_df(spark, rows)
    got = next_answer_after_labels(s, ["A", "B", "C"]).first().asDict()
    assert got == {"subject_id": 1, "A": "2", "B": "1", "C": ""}
    vec_rows = [("Text", "A"), ("TopicAnswer", "x, y"), ("TopicAnswer", "1,2,3")]
    v = vector_or_labels(stream_df(spark, vec_rows), ["p", "q", "r"]).first().asDict()
    assert v == {"subject_id": 1, "p": "x", "q": "y", "r": ""}
