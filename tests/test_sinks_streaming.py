"""Sinks (SNK-*), sources (SRC-*), quarantine and stream = batch (STR-1)."""

import os
import tempfile

from pyspark.sql import functions as F

from canvass.operators.quality import quarantine, split_quarantine
from canvass.plans.catalog import BY_ID
from canvass.plans.interviews import order_interviews
from canvass.plans.spec import run_spec
from canvass.sinks.writers import (SKU_SALES_INFO, conform, ensure_table, export_csv, fan_out,
                                   load_partitions_idempotent, only_new_rows)
from canvass.sources.documents import document_errors, documents_to_stream, read_landing
from canvass.sources.ranges import day_range, explode_ids
from canvass.streaming.ingest import run_incremental
from conftest import SF_SMALL
from walker import flatten_document


def _scratch():
    return tempfile.mkdtemp(prefix="canvass-test-")


def test_flatten_document_order_and_attributes():
    doc = "<R><SubjectNum>1</SubjectNum><Q id='7' k='x'>  </Q><Q>a<b>c</b>tail</Q></R>"
    assert flatten_document(doc) == [("SubjectNum", "text", "1"), ("Q", "id", "7"), ("Q", "k", "x"),
                                     ("Q", "text", "a"), ("b", "text", "c")]


def test_bad_documents_are_quarantined(spark):
    docs = spark.createDataFrame([(1, "<a><b>x</b></a>"), (2, "<a><b>x</a>")], "subject_id long, xml string")
    assert [r.subject_id for r in documents_to_stream(docs).collect()] == [1]
    assert [r.subject_id for r in document_errors(docs).collect()] == [2]


def test_landing_folder_read(spark):
    d = _scratch()
    for sid in (11, 12, "AB-7"):
        with open(os.path.join(d, f"{sid}.xml"), "w") as fh:
            fh.write(f"<R><SubjectNum>{sid}</SubjectNum></R>")
    got = read_landing(spark, d)
    assert sorted(r.subject_id for r in got.collect()) == ["11", "12", "AB-7"]


def test_day_range_guard_and_id_list(spark):
    df = spark.createDataFrame([("2024-01-03", "2024-01-01"), ("2024-01-01", "2024-01-03")], "s string, e string")
    sizes = [len(r.d) for r in df.select(day_range(F.col("s"), F.col("e")).alias("d")).collect()]
    assert sizes == [0, 3]
    ids = spark.createDataFrame([(1, "[]"), (2, "[ 5,\r\n6 ]")], "k long, t string")
    assert sorted(r.subject_id for r in explode_ids(ids, "t").collect()) == ["5", "6"]


def test_idempotent_partition_load(spark):
    d = os.path.join(_scratch(), "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k long, upload_date string")
    load_partitions_idempotent(df, d, ["upload_date"])
    load_partitions_idempotent(df.filter("k = 2"), d, ["upload_date"])   # re-run of one day
    assert sorted(r.k for r in spark.read.parquet(d).collect()) == [1, 2]
    new = spark.createDataFrame([(2, "2024-01-02"), (3, "2024-01-03")], "k long, upload_date string")
    assert [r.k for r in only_new_rows(new, spark.read.parquet(d), ["k"]).collect()] == [3]


def test_fan_out_conform_and_export(spark):
    base = _scratch()
    df = spark.createDataFrame([("CLUB 625ML/RB", "12.5", "3"), ("Stella-A", "x", None)],
                               "Variable string, Price string, Pack_Quantity string")
    fan_out(df, os.path.join(base, "fan"), "Variable")
    parts = sorted(p for p in os.listdir(os.path.join(base, "fan")) if p.startswith("table="))
    assert parts == ["table=club_625ml_rb", "table=stella_a"]
    typed = conform(df, SKU_SALES_INFO).orderBy("Variable").collect()
    assert str(typed[0].Price) == "12.50" and typed[1].Price is None and typed[0].Pack_Quantity == 3
    ensure_table(spark, os.path.join(base, "sum"), SKU_SALES_INFO)
    assert spark.read.parquet(os.path.join(base, "sum")).schema == SKU_SALES_INFO
    export_csv(df, os.path.join(base, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(base, "csv")).count() == 2


def test_quarantine_policy(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z"), (2, "2024-01-01T00:00:00.5Z")], "k long, t string")
    from canvass.functions.scalars import ts_parse_failed
    valid, rejects = split_quarantine(quarantine(df, {"bad_upload": ts_parse_failed("t")}))
    assert [r.k for r in valid.collect()] == [1]
    assert [(r.k, r.reason) for r in rejects.collect()] == [(2, "bad_upload")]


def test_stream_equals_batch(spark):
    base = _scratch()
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderdate").cast("timestamp").alias("upload_ts"))
    docs = order_interviews(spark, SF_SMALL).join(o, "subject_id")
    landing = os.path.join(base, "landing")
    # two landings of the same interviews: the second is a re-delivery
    docs.write.parquet(landing)
    docs.write.mode("append").parquet(landing)
    run_incremental(spark, landing, os.path.join(base, "target"), os.path.join(base, "ck"),
                    BY_ID["D01"], watermark="3650 days")
    streamed = spark.read.parquet(os.path.join(base, "target")).drop("upload_date", "batch")
    batch = run_spec(BY_ID["D01"], documents_to_stream(docs.select("subject_id", "xml")))
    cols = sorted(batch.columns)
    assert streamed.count() == batch.count()
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_upload_window_prunes_partitions(spark):
    """SRC-2 on a landing table partitioned by upload day: the day window is a
    partition filter (only that day's folder is read)."""
    from canvass.sources.ranges import upload_window

    base = os.path.join(_scratch(), "landing")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderdate").cast("timestamp").alias("upload_ts"))
    o.withColumn("upload_date", F.to_date("upload_ts")).write.partitionBy("upload_date").parquet(base)
    day = o.select(F.date_format(F.min("upload_ts"), "yyyy-MM-dd")).first()[0]
    landed = spark.read.parquet(base)
    picked = upload_window(landed, "upload_ts", day)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(upload_date" in plan
    want = o.filter(F.to_date("upload_ts") == F.lit(day)).count()
    assert picked.count() == want > 0


def test_append_counted_observes_rows(spark):
    from canvass.sinks.writers import append_counted

    d = os.path.join(_scratch(), "t")
    df = spark.range(1234).withColumn("day", F.col("id") % 3)
    assert append_counted(df, d, ["day"])["rows"] == 1234
    assert spark.read.parquet(d).count() == 1234


def test_streaming_daily_counts_equal_batch(spark):
    from canvass.streaming.ingest import LANDING_SCHEMA, daily_counts, read_landing_stream

    base = _scratch()
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderdate").cast("timestamp").alias("upload_ts"),
        F.lit("<a/>").alias("xml"))
    o.write.parquet(os.path.join(base, "landing"))
    counts = daily_counts(read_landing_stream(spark, os.path.join(base, "landing")), watermark="0 seconds")
    q = (counts.writeStream.outputMode("append").format("parquet")
         .option("path", os.path.join(base, "out")).option("checkpointLocation", os.path.join(base, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(str(r.upload_date), r.interviews) for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    want = {(str(r.d), r.n) for r in o.groupBy(F.to_date("upload_ts").alias("d")).agg(F.count("*").alias("n")).collect()}
    # append mode emits a day once the watermark has passed it: every day but the last
    last = max(d for d, _ in want)
    assert got == {x for x in want if x[0] != last}
    assert LANDING_SCHEMA.fieldNames() == ["subject_id", "upload_ts", "xml"]


def test_load_survey_idempotent_with_rejects(spark):
    from canvass.plans.survey_load import load_survey

    base = _scratch()
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderdate").cast("timestamp").alias("upload_ts"))
    docs = order_interviews(spark, SF_SMALL).join(o, "subject_id")
    bad = spark.createDataFrame([(10**9, "<Interview><Header>", )], "subject_id long, xml string") \
        .withColumn("upload_ts", F.to_timestamp(F.lit("1996-01-02 00:00:00")))
    landing = os.path.join(base, "landing")
    docs.unionByName(bad).withColumn("upload_date", F.to_date("upload_ts")) \
        .write.partitionBy("upload_date").parquet(landing)
    out = os.path.join(base, "out")
    first = load_survey(spark, landing, [BY_ID["D01"]], out, first_day="1996-01-01", last_day="1996-12-31",
                        run_date="2026-03-15")
    again = load_survey(spark, landing, [BY_ID["D01"]], out, first_day="1996-01-01", last_day="1996-12-31",
                        run_date="2026-03-15")
    loaded = spark.read.parquet(os.path.join(out, "profile"))
    want = o.filter(F.year("upload_ts") == 1996).count()
    assert first == again == {"profile": want} and loaded.count() == want > 0
    assert {r.Period for r in loaded.select("Period").distinct().collect()} == {"2026-03-01"}
    assert loaded.columns[0] == "Period"
    rejects = spark.read.parquet(os.path.join(out, "_rejects")).collect()
    assert [(r.subject_id, r.reason) for r in rejects] == [(10**9, "unparsable document")]   # once, however often it runs


def test_late_interviews_are_counted(spark):
    from canvass.streaming.ingest import late_drops

    base = _scratch()
    doc = "<I><SubjectNum>1</SubjectNum><Upload>2024-01-01T00:00:00Z</Upload></I>"
    for i, day in ((1, "2024-01-01"), (2, "2024-02-01"), (3, "2024-01-02")):
        spark.createDataFrame([(i, doc)], "subject_id long, xml string") \
            .withColumn("upload_ts", F.to_timestamp(F.lit(f"{day} 00:00:00"))).select("subject_id", "upload_ts", "xml") \
            .write.mode("append").parquet(os.path.join(base, "landing"))
        q = run_incremental(spark, os.path.join(base, "landing"), os.path.join(base, "t"), os.path.join(base, "ck"), BY_ID["D01"])
    assert late_drops(q) == 1


def test_upload_window_has_no_gap(spark):
    from canvass.sources.ranges import upload_window

    df = spark.sql("SELECT timestamp'2024-01-01 23:59:59.999999' ts UNION ALL SELECT timestamp'2024-01-02 00:00:00'")
    assert [upload_window(df, "ts", d).count() for d in ("2024-01-01", "2024-01-02")] == [1, 1]


def test_strip_takes_all_white_space(spark):
    from canvass.operators.lookup import option_sets_equal
    from canvass.operators.reshape import explode_then_trim

    df = spark.createDataFrame([("a,\tb,\nc\u00a0",)], "v string")
    assert [r.v for r in explode_then_trim(df, "v").collect()] == ["a", "b", "c"]
    wet = spark.createDataFrame([("Wet,\nDry Hair",)], "v string")
    assert wet.select(option_sets_equal("v", ["wet", "dry hair"]).alias("x")).first().x
