"""STR-1: incremental ingest of interview documents with Structured Streaming.

The original jobs re-run a date range; here new interview files are picked up as
they land. Each interview arrives whole, so every stream operator runs per
micro-batch inside ``foreachBatch``; the only streaming state is the
deduplication of re-delivered interviews (``dropDuplicatesWithinWatermark``
on the subject key, bounded by the watermark). A batch writes partitions of its
own, ``(upload_date, batch)``: a replay after a failure replaces what that batch
wrote and nothing else, and interviews of one day may arrive in many batches.
Interviews later than the watermark are dropped by Spark and counted
(``late_drops``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.whole import Whole, with_whole
from ..plans.spec import SurveySpec, run_spec
from ..sinks.writers import load_partitions_idempotent
from ..sources.documents import read_documents, stream_of

DOCS_PER_TASK = 25_000

LANDING_SCHEMA = T.StructType([
    T.StructField("subject_id", T.LongType()),
    T.StructField("upload_ts", T.TimestampType()),
    T.StructField("xml", T.StringType()),
])


def read_landing_stream(spark: SparkSession, path: str, schema: T.StructType = LANDING_SCHEMA,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def landed_count(spark: SparkSession, path: str) -> int:
    """Documents in a landing folder (from the files' footers); 0 if there is none yet."""
    try:
        return spark.read.schema(LANDING_SCHEMA).parquet(path).count()
    except AnalysisException:
        return 0


def deduplicated(docs: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Re-delivered interviews (same subject) within the watermark are dropped."""
    return docs.withWatermark("upload_ts", watermark).dropDuplicatesWithinWatermark(["subject_id"])


def spec_batch_writer(spec: SurveySpec, target: str,
                      post: Callable[[DataFrame], DataFrame] | None = None, run: str = "0", tasks: int = 1):
    """foreachBatch body: flatten, interpret the spec, load idempotently by day
    and batch. ``run`` names the query (its checkpoint), so that batch numbers of
    different queries on one target do not meet. Documents are read in ``tasks`` tasks,
    no fewer than the state has partitions."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        n = max(tasks, int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        docs = batch.select("subject_id", F.to_date("upload_ts").alias("upload_date"), "xml").repartition(n, "subject_id")
        # The stateful step runs once, and its late drops count once: all else reads the answers.
        # Documents are hashed and parsed once, and joins of their answers move nothing
        # (the batch is replayable, so a lost cache block is recomputed, not lost).
        # A batch has an interview once, so each is read whole
        parsed = read_documents(docs, keep=["upload_date"]).persist()
        out = None
        try:
            days = parsed.where("size(rows) > 0").select("subject_id", "upload_date")     # one row a document
            count = days.count()
            if not count:                                 # a batch that only moves the watermark
                return
            out = run_spec(spec, with_whole(stream_of(parsed), Whole(parsed)))
            if post is not None:
                out = post(out)
            # kept, as ranges are sampled before the rows are cut by them
            out = out.join(days, "subject_id").persist()
            # range-clustered on (day, subject): a quiet day lands in one task
            # (one file), a hot day is cut into several ranges (several tasks)
            ranges = max(batch.sparkSession.sparkContext.defaultParallelism, -(-count // DOCS_PER_TASK))
            rows = out.repartitionByRange(ranges, "upload_date", "subject_id")
            rows = rows.withColumn("batch", F.lit(f"{run}-{epoch_id}"))
            load_partitions_idempotent(rows, target, ["upload_date", "batch"])
        finally:
            if out is not None:
                out.unpersist()
            parsed.unpersist()
    return write


def run_incremental(spark: SparkSession, landing: str, target: str, checkpoint: str,
                    spec: SurveySpec, *, watermark: str = "2 days",
                    post: Callable[[DataFrame], DataFrame] | None = None,
                    state_partitions: int | None = None):
    """Process everything that has landed (``availableNow``) and stop.

    The dedup state is split into ``state_partitions`` (fixed for the life of the
    checkpoint; default: by what has landed at the first run, at most ``DOCS_PER_TASK``
    documents each, and no fewer than the cluster's default parallelism). Documents that
    pass it are split anew in each run, so later, larger landings get more tasks."""
    docs = deduplicated(read_landing_stream(spark, landing), watermark)
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    tasks = -(-landed_count(spark, landing) // DOCS_PER_TASK)
    parts = state_partitions or max(spark.sparkContext.defaultParallelism, tasks)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        q = (docs.writeStream.foreachBatch(spec_batch_writer(spec, target, post, name, tasks))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    return q


def late_drops(q) -> int:
    """Interviews that a finished query dropped for coming after the watermark."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in q.recentProgress for s in p["stateOperators"])


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """The loaded table without the batch partition."""
    return spark.read.parquet(target).drop("batch")


def daily_counts(docs_stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Interviews per upload day, emitted once the day is closed by the watermark."""
    return (docs_stream.withWatermark("upload_ts", watermark)
            .groupBy(F.window("upload_ts", "1 day")).agg(F.count(F.lit(1)).alias("interviews"))
            .select(F.to_date(F.col("window.start")).alias("upload_date"), "interviews"))
