"""What the shared steps move: lines and documents are hashed once, scans and checks over
them move nothing more, and results stay as they are."""

import pytest
from pyspark.sql import functions as F

from canvass.operators.ordered import Scan, has_whole_subjects, ordered_scan
from canvass.operators.quality import position_check
from canvass.plans import all_queries
from canvass.sources.bindings import lineitem_stream
from canvass.sources.documents import documents_to_stream, materialize_stream

LINE = ("l_orderkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_partkey long, l_quantity double, "
        "l_extendedprice double, l_discount double, l_shipdate date")
XML = "<Interview><Header><SubjectNum>{0}</SubjectNum></Header><Answers><FullVariable>q</FullVariable>" \
      "<QuestionAnswer>a{0}</QuestionAnswer></Answers></Interview>"


def _hashes(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture()
def lines(spark, tmp_path):
    import datetime
    day = datetime.date(2024, 1, 1)
    rows = [(k, n, "R", "O", k, float(n), 1.5, None if n == 2 else 0.1, day) for k in range(40) for n in (1, 2, 2)]
    spark.createDataFrame(rows, LINE).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_lines_are_hashed_once(spark, lines):
    out = all_queries()[0]["grp1_records_per_order"](spark, lines)
    assert _hashes(out) == 1
    assert sorted(tuple(r) for r in out.collect()) == [(k, 3, 5.0) for k in range(40)]


def test_a_large_order_is_still_cut_into_blocks(spark, lines, small_blocks):
    s = lineitem_stream(spark, lines)
    assert not has_whole_subjects(s)
    assert s.select("subject_id", "block").distinct().count() > 40
    assert s.count() == s.select("subject_id", "seq").distinct().count()


def test_position_check_moves_no_answers(spark, lines):
    s = lineitem_stream(spark, lines)
    out = position_check(s, "line_items")
    assert _hashes(out) == 1
    r = out.first()
    assert r["rows"] == r["positions"] == 40 * (14 + 13 + 13)


def test_documents_are_hashed_once(spark):
    docs = spark.range(50).select(F.col("id").alias("subject_id"), F.format_string(XML.replace("{0}", "%1$d"), "id").alias("xml"))
    s = materialize_stream(documents_to_stream(docs.repartition(8, "subject_id")))
    out = ordered_scan(s, Scan(lead={"nxt": "value"}, running={"n": F.lit(1).cast("long")}))
    assert _hashes(out) == 1
    got = out.where("element = 'FullVariable'").select("subject_id", "nxt", "n").collect()
    assert sorted(tuple(r) for r in got) == [(k, f"a{k}", 2) for k in range(50)]


def test_plain_and_other_documents_read_alike(spark):
    plain = "<r><a> x > y </a><b>\u00a0</b><c></c><d>1<e>2</e>tail</d></r>"
    docs = [(0, plain), (1, plain.replace("<c>", "<c >")), (2, "<!-- c -->" + plain), (3, plain.replace("</e>", "</e><![CDATA[]]>"))]
    s = documents_to_stream(spark.createDataFrame(docs, "subject_id long, xml string"))
    rows = {k: [] for k in range(4)}
    for r in s.orderBy("subject_id", "seq").collect():
        rows[r["subject_id"]].append((r["seq"], r["element"], r["attribute"], r["value"]))
    assert rows[0] == [(0, "a", "text", " x > y "), (1, "d", "text", "1"), (2, "e", "text", "2")]
    assert rows[0] == rows[1] == rows[2] == rows[3]
