"""What a micro-batch moves: documents are hashed and parsed once, in tasks of a bounded
number of documents, however many land and whatever the cluster's default parallelism is."""

import os

import pytest
from pyspark.sql import functions as F

from canvass.plans.catalog import BY_ID
from canvass.sources.documents import documents_to_stream
from canvass.streaming import ingest

XML = "<I><SubjectNum>%1$d</SubjectNum><FullVariable>Region</FullVariable><QuestionAnswer>r%1$d</QuestionAnswer></I>"
DAY = "timestamp'2024-01-01 00:00:00'"


def _land(spark, path, first, last):
    ids = F.col("id").alias("subject_id")
    spark.range(first, last).select(ids, F.expr(DAY).alias("upload_ts"), F.format_string(XML, "id").alias("xml")) \
        .write.mode("append").parquet(path)


def _files(target, batch):
    return sum(f.endswith(".parquet") for d, _, files in os.walk(target) if d.endswith(f"-{batch}") for f in files)


@pytest.fixture()
def folders(tmp_path):
    return [str(tmp_path / x) for x in ("landing", "target", "checkpoint")]


def test_tasks_grow_with_what_lands(spark, folders, monkeypatch):
    """More than the 4 tasks of this session's default parallelism; a later, larger landing gets more again."""
    monkeypatch.setattr(ingest, "DOCS_PER_TASK", 10, raising=False)
    landing, target, _ = folders
    epochs = []
    for first, last in ((0, 100), (50, 500)):
        _land(spark, landing, first, last)
        q = ingest.run_incremental(spark, *folders, BY_ID["D01"])
        epochs.append(max(q.recentProgress, key=lambda p: p["numInputRows"]))
    assert epochs[0]["stateOperators"][0]["numShufflePartitions"] == 10
    assert _files(target, epochs[0]["batchId"]) > 5 and _files(target, epochs[1]["batchId"]) > 20
    rows = ingest.read_target(spark, target).select("subject_id", "SubjectNum", "Region", F.col("upload_date").cast("string"))
    assert sorted(tuple(r) for r in rows.collect()) == [(i, str(i), f"r{i}", "2024-01-01") for i in range(500)]


def test_answers_move_nothing_after_their_documents(spark, folders):
    plans = []

    def post(out):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    _land(spark, folders[0], 0, 40)
    ingest.run_incremental(spark, *folders, BY_ID["D01"], post=post)
    assert len(plans) == 1                    # not for the batch that only moves the watermark
    assert "REPARTITION_BY_NUM" in plans[0] and "Exchange hashpartitioning(subject_id" in plans[0]
    assert "ENSURE_REQUIREMENTS" not in plans[0].replace("BroadcastExchange", "")
    assert ingest.read_target(spark, folders[1]).count() == 40


def test_a_batch_without_answers_loads_nothing(spark, folders):
    landing, target, _ = folders
    schema = "subject_id long, upload_ts timestamp, xml string"
    spark.createDataFrame([(1, None, "<I/>"), (2, None, "<I>"), (3, None, None)], schema).write.parquet(landing)
    ingest.run_incremental(spark, *folders, BY_ID["D01"])
    odd = spark.createDataFrame([(4, None, XML.replace("%1$d", "4")), (None, None, XML.replace("%1$d", "5"))], schema)
    odd.write.mode("append").parquet(landing)
    ingest.run_incremental(spark, *folders, BY_ID["D01"])
    assert [(r.subject_id, r.Region) for r in ingest.read_target(spark, target).collect()] == [(4, "r4")]


def test_kept_columns_stand_on_each_row(spark):
    docs = spark.createDataFrame([(1, "<a><b>x</b><c k='y'/></a>", 7), (2, "<a>", 8)], "subject_id long, xml string, day int")
    got = documents_to_stream(docs, keep=["day"])
    assert [(r.seq, r.value, r.day) for r in got.orderBy("seq").collect()] == [(0, "x", 7), (1, "y", 7)]
    assert [r.day for r in documents_to_stream(docs, keep_errors=True, keep=["day"]).where("parse_error is not null").collect()] == [8]
