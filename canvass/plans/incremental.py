"""STR-1 as a registered query: stream = batch.

Interview documents derived from the tables land as parquet files in the
shared checkpoint folder; a Structured Streaming query (``availableNow``)
deduplicates them within the watermark, runs the D01 spec per micro-batch and
loads the result idempotently by upload day; the loaded table is returned.
Its oracle is the batch D01 oracle: the stream must produce the same table.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sinks.writers import append_new_rows, append_table, export_csv, fan_out, load_days
from ..sinks.versions import load_range, read_table_version
from ..sources.documents import documents_to_stream, materialize_stream, question
from ..sources.landing import land, read_container, stream_container
from ..streaming.corrections import corrected, current, load_corrections
from ..streaming.ingest import read_landing_stream, read_target, run_incremental
from .catalog import BY_ID
from .interviews import extra_category, order_interviews
from .registry import ORACLES, query
from .spec import spec_rejects, specs_from_json, specs_to_json
from .survey_load import load_survey

OUT_TS = "yyyy-MM-dd HH:mm:ss"
TS_COLS = ("Upload", "VisitStart", "VisitEnd", "Date")


def _landing(spark, sf_dir, base):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.col("o_orderdate").cast("timestamp").alias("upload_ts"))
    docs = order_interviews(spark, sf_dir).join(o, "subject_id")
    path = f"{base}/landing"
    docs.select("subject_id", "upload_ts", "xml").write.mode("overwrite").parquet(path)
    return path


def _format(out):
    return out.select(*[F.date_format(c, OUT_TS).alias(c) if c in TS_COLS else F.col(f"`{c}`")
                        for c in out.columns])


@query("str1_stream_equals_batch_d01")
def q_str1(spark, sf_dir):
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/str1-{uuid.uuid4().hex}"
    landing = _landing(spark, sf_dir, base)
    run_incremental(spark, landing, f"{base}/target", f"{base}/stream-checkpoint", BY_ID["D01"],
                    watermark="3650 days", post=_format)
    return read_target(spark, f"{base}/target").drop("upload_date")


# the stream must equal the batch dataset
ORACLES["str1_stream_equals_batch_d01"] = ORACLES["d01_recruit_profile_from_xml"]


@query("str1_two_arrivals_same_day", ORACLES["d01_recruit_profile_from_xml"])
def q_two_arrivals(spark, sf_dir):
    """Each day's interviews arrive in two runs, the second with re-deliveries of the
    first; a two-day watermark on the arrival time. Nothing is lost or doubled."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/str1-{uuid.uuid4().hex}"
    docs = spark.read.parquet(_landing(spark, sf_dir, base)).withColumn(
        "upload_ts", F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(
            secs=F.pmod("subject_id", F.lit(3600))))
    path = f"{base}/arrivals"
    odd = F.col("subject_id") % 2 == 1
    for part in (docs.where(odd), docs.where(~odd | (F.col("subject_id") % 3 == 0))):
        part.write.mode("append").parquet(path)
        run_incremental(spark, path, f"{base}/target", f"{base}/stream-checkpoint", BY_ID["D01"], watermark="2 days",
                        post=_format)
    return read_target(spark, f"{base}/target").drop("upload_date")


@query("snk5_rerun_emptied_day", """
SELECT o_orderkey AS subject_id, strftime(o_orderdate, '%Y-%m-01') AS upload_date FROM orders
WHERE o_orderkey % 4 <> 0 AND month(o_orderdate) <> 1
""")
def q_rerun_emptied(spark, sf_dir):
    """SNK-5: orders loaded by the first of their month, then re-run from a source that
    has lost some rows of each such day and all rows of each January."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snk5-{uuid.uuid4().hex}"
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("subject_id"), F.trunc("o_orderdate", "month").alias("upload_date"))
    for rows in (o, o.where((F.col("subject_id") % 4 != 0) & (F.month("upload_date") != 1))):
        load_days(rows.repartition("upload_date"), f"{base}/t")
    return spark.read.parquet(f"{base}/t").select("subject_id", F.col("upload_date").cast("string"))


@query("snk5_append_new_keys", """
SELECT DISTINCT c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR)
""")
def q_append_new(spark, sf_dir):
    """SNK-5: keyed appends run twice over rows with repeated and NULL keys."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snk5-{uuid.uuid4().hex}"
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_nationkey").cast("long").alias("nation"), F.col("c_mktsegment").alias("segment"))
    none = c.select(F.lit(None).cast("long").alias("nation"), F.lit(None).cast("string").alias("segment"))
    for rows in (c.where("nation < 10").union(none), c.union(none)):
        append_new_rows(rows, f"{base}/t", ["nation", "segment"])
    return spark.read.parquet(f"{base}/t")


@query("qua1_spec_rejects", """
SELECT o_orderkey AS subject_id, 'D01' AS dataset,
       CASE o_orderkey % 5 WHEN 0 THEN 'missing header' WHEN 1 THEN 'bad header time' ELSE 'no answers' END AS reason
FROM orders WHERE o_orderkey % 5 <= 2
""")
def q_rejects(spark, sf_dir):
    """QUA-1: interviews without header rows, with a malformed upload time, and empty ones."""
    k = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(k)
    header = F.concat(F.lit("<SubjectNum>"), k.cast("string"), F.lit("</SubjectNum><Upload>2024-01-02T03:04:05"),
                      F.when(k % 5 == 1, ".5Z").otherwise("Z"), F.lit("</Upload>"))
    body = F.lit("<FullVariable>surveyor</FullVariable><QuestionAnswer>x</QuestionAnswer>")
    xml = F.when(k % 5 == 2, "<I/>").otherwise(F.concat(
        F.lit("<I>"), F.when(k % 5 == 0, "").otherwise(header), body, F.lit("</I>")))
    docs = o.select(k.alias("subject_id"), xml.alias("xml"))
    return spec_rejects(BY_ID["D01"], materialize_stream(documents_to_stream(docs)), docs)


def _named_documents(spark, sf_dir):
    """Documents named by text (parts) and by number (suppliers), over 60 upload days; one in
    50 parts has no upload time."""
    def docs(table, key, prefix, name):
        k = F.col(key)
        day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 60).cast("int")).cast("timestamp")
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(
            F.concat(F.lit(prefix), k.cast("string")).alias("subject_id"),
            F.when((k % 50 != 0) | (F.lit(prefix) == ""), day).alias("upload_ts"),
            F.concat(F.lit("<I>"), question("q", F.col(name)), F.lit("</I>")).alias("xml"))

    return docs("part", "p_partkey", "AB-", "p_name").union(docs("supplier", "s_suppkey", "", "s_name"))


def _answers(docs):
    return documents_to_stream(docs).where("element = 'QuestionAnswer'").select("subject_id", F.col("value").alias("answer"))


ALL_ANSWERS = """
SELECT 'AB-' || p_partkey AS subject_id, p_name AS answer FROM part
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier
"""


@query("src4_landing_text_ids", ALL_ANSWERS)
def q_landing(spark, sf_dir):
    """SRC-4: all documents of a container, named by text and by number."""
    path = _scratch(spark, "src4")
    land(_named_documents(spark, sf_dir), path)
    return _answers(read_container(spark, path, ["subject_id", "xml"]))


@query("src2_landing_window", """
SELECT 'AB-' || p_partkey AS subject_id, p_name AS answer FROM part WHERE p_partkey % 60 BETWEEN 9 AND 15 AND p_partkey % 50 <> 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name FROM supplier WHERE s_suppkey % 60 BETWEEN 9 AND 15
""")
def q_landing_window(spark, sf_dir):
    """SRC-2: a window of upload days; the source plans those days' files only."""
    path = _scratch(spark, "src2")
    land(_named_documents(spark, sf_dir), path)
    days = F.col("upload_date").between("2024-01-10", "2024-01-16")
    return _answers(read_container(spark, path, ["subject_id", "xml", "upload_date"]).where(days))


@query("src4_landing_stream", ALL_ANSWERS)
def q_landing_stream(spark, sf_dir):
    """SRC-4 as a stream: two deliveries, the second with earlier upload times; each is read
    once and loaded under the micro-batch's own id."""
    base = _scratch(spark, "src4s")
    docs = _named_documents(spark, sf_dir)
    late = F.coalesce(F.col("upload_ts") < "2024-01-15", F.lit(True))

    def write(batch, epoch):
        load_range(_answers(batch).withColumn("day", F.lit("all")), f"{base}/t", day_col="day", append=True,
                   load_id=f"batch-{epoch}")

    for part in (docs.where(~late), docs.where(late)):
        land(part, f"{base}/landed")
        stream_container(spark, f"{base}/landed").writeStream.foreachBatch(write) \
            .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return read_table_version(spark, f"{base}/t").drop("day")


@query("snk5_failed_load_keeps_old_state", """
WITH o AS (SELECT o_orderkey AS subject_id, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-01') END AS upload_date
           FROM orders),
old AS (SELECT * FROM o WHERE subject_id % 4 <> 0)
SELECT 'after the failure' AS state, * FROM old
UNION ALL SELECT 'after the repeat', * FROM old WHERE upload_date NOT BETWEEN '1994-01-01' AND '1995-12-01' OR upload_date IS NULL
UNION ALL SELECT 'after the repeat', * FROM o WHERE upload_date BETWEEN '1994-01-01' AND '1995-12-01'
""")
def q_failed_load(spark, sf_dir):
    """SNK-5: a load of two years fails midway, and is repeated. Readers see the old state until
    the new one is published; rows without a day stay throughout."""
    path = _scratch(spark, "snk5")
    key = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        key.alias("subject_id"),
        F.when(key % 9 != 0, F.trunc("o_orderdate", "month")).cast("string").alias("upload_date")).repartition("upload_date")
    load_range(o.where("subject_id % 4 <> 0"), path)
    years = o.where("upload_date between '1994-01-01' and '1995-12-01'")
    broken = years.withColumn("subject_id", F.when(F.col("upload_date") == "1995-12-01", F.raise_error(F.lit("lost")).cast("long"))
                              .otherwise(F.col("subject_id")))
    try:
        load_range(broken, path, "1994-01-01", "1995-12-01")
        raise AssertionError("the load has to fail")
    except PySparkException:
        before = read_table_version(spark, path)
    load_range(years, path, "1994-01-01", "1995-12-01")
    cols = ["subject_id", "upload_date"]
    return before.select(F.lit("after the failure").alias("state"), *cols) \
        .union(read_table_version(spark, path).select(F.lit("after the repeat"), *cols))


@query("snk5_survey_redelivered", ORACLES["d01_recruit_profile_from_xml"])
def q_redelivered(spark, sf_dir):
    """SNK-5: each third interview is delivered twice, first with other answers, and the load runs twice; every
    interview is in the table once, with its last delivery."""
    base = _scratch(spark, "snk5r")
    docs = spark.read.parquet(_landing(spark, sf_dir, base)).withColumn("upload_ts", F.date_trunc("month", "upload_ts"))
    first = docs.where("subject_id % 3 = 0").withColumn("upload_ts", F.col("upload_ts") - F.expr("interval 1 hour")) \
        .withColumn("xml", F.replace("xml", F.lit("Enumerator_Name"), F.lit("Region")))
    docs.union(first).write.parquet(f"{base}/landed")
    for _ in range(2):
        load_survey(spark, f"{base}/landed", [BY_ID["D01"]], f"{base}/out", load=load_range)
    return _format(read_table_version(spark, f"{base}/out/{BY_ID['D01'].sink}")).drop("upload_date")


@query("str1_corrections", ORACLES["d01_recruit_profile_from_xml"])
def q_corrections(spark, sf_dir):
    """STR-1: each third interview first comes with other answers and is corrected in a later run, which
    also brings older deliveries of each fifth; the table holds every interview as corrected."""
    base = _scratch(spark, "str1c")
    docs = spark.read.parquet(_landing(spark, sf_dir, base)).withColumn("upload_ts", F.date_trunc("year", "upload_ts"))
    third, fifth = F.col("subject_id") % 3 == 0, F.col("subject_id") % 5 == 0
    wrong = F.replace("xml", F.lit("Enumerator_Name"), F.lit("Region"))
    hour = F.expr("interval 1 hour")
    runs = (docs.withColumn("xml", F.when(third, wrong).otherwise(F.col("xml"))),
            docs.where(third).withColumn("upload_ts", F.col("upload_ts") + hour)
            .union(docs.where(fifth & ~third).select("subject_id", F.col("upload_ts") - hour, wrong)))
    for part in runs:
        part.write.mode("append").parquet(f"{base}/landed")
        load_corrections(corrected(read_landing_stream(spark, f"{base}/landed"), timedelta(days=3650)), BY_ID["D01"], f"{base}/t",
                         f"{base}/checkpoint", post=_format)
    return current(spark, f"{base}/t")


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("snk1_append_table", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def q_append(spark, sf_dir):
    """SNK-1: two appends into one partitioned table, read back."""
    path = _scratch(spark, "snk1")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_mktsegment")
    for rows in (c.where("c_nationkey < 10"), c.where("c_nationkey >= 10")):
        append_table(rows, path, ["c_mktsegment"])
    return spark.read.schema(c.schema).parquet(path).select(*c.columns)


@query("snk3_csv_export", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def q_export(spark, sf_dir):
    """SNK-3: export with a header line, read back as text."""
    path = _scratch(spark, "snk3")
    export_csv(spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name"), path)
    return spark.read.option("header", True).csv(path)


@query("snk4_fan_out", "SELECT c_custkey, c_mktsegment, lower(c_mktsegment) AS \"table\" FROM customer")
def q_fan_out(spark, sf_dir):
    """SNK-4: one sub-table per segment, read back."""
    path = _scratch(spark, "snk4")
    fan_out(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment"), path, "c_mktsegment")
    return spark.read.parquet(path)


@query("src8_specs_from_json", ORACLES["d06_extra_category_from_xml"])
def q_specs_json(spark, sf_dir):
    """SRC-8: a job read back from its JSON form gives the dataset of the catalogue."""
    job = {s.id: s for s in specs_from_json(specs_to_json(list(BY_ID.values())))}["D06"]
    return extra_category(spark, sf_dir, job)
