"""Batch load of one survey over a range of upload days.

landing documents -> day-range filter (partition-pruned) -> parse once
(answer stream kept on disk during the load) -> every dataset spec -> idempotent load by
upload day; unparsable documents and interviews that a spec cannot use go to a
rejects table, with dataset and reason. Re-running a range replaces exactly those
days, in the rejects too, and a day that has become empty loses its rows. An
interview that was delivered more than once counts once, with its last delivery.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.whole import Whole, with_whole
from ..schema import SUBJECT
from ..sinks.writers import load_days
from ..sources.documents import read_documents, stream_of
from .spec import SurveySpec, period_of, run_spec, spec_rejects


def _days(docs: DataFrame, first_day: str | None, last_day: str | None) -> DataFrame:
    out = docs
    day = F.to_date("upload_ts")
    if first_day:
        out = out.filter(day >= F.to_date(F.lit(first_day)))
    if last_day:
        out = out.filter(day <= F.to_date(F.lit(last_day)))
    if "upload_date" in docs.columns:            # partitioned landing: prune folders too
        if first_day:
            out = out.filter(F.col("upload_date") >= F.to_date(F.lit(first_day)))
        if last_day:
            out = out.filter(F.col("upload_date") <= F.to_date(F.lit(last_day)))
    return out


def last_deliveries(docs: DataFrame) -> DataFrame:
    """One row for each interview: the delivery with the latest upload time (ties: the
    greater document). Partial aggregates: a hot interview is one row a task."""
    last = docs.groupBy(SUBJECT).agg(F.max(F.struct("upload_ts", "xml")).alias("__last"))
    return last.select(SUBJECT, "__last.upload_ts", "__last.xml")


def load_survey(spark: SparkSession, landing: str, specs: Sequence[SurveySpec], out_root: str, *,
                first_day: str | None = None, last_day: str | None = None,
                run_date: str | None = None, load: Callable[..., int] = load_days) -> dict[str, int]:
    """Load every dataset of one survey; returns rows loaded per dataset
    (counted during the write). ``run_date`` gives the parity Period (run
    month); without it no Period column is added. ``load`` writes a table:
    ``load_days`` (plain partition folders) or ``versions.load_range`` (readers see
    each table's range change at once)."""
    landed = _days(spark.read.parquet(landing), first_day, last_day).select(SUBJECT, "upload_ts", "xml")
    docs = last_deliveries(landed)
    # the day of the last delivery, without moving the documents again
    days = landed.groupBy(SUBJECT).agg(F.to_date(F.max("upload_ts")).alias("upload_date"))
    # parsed once: a row for each interview, on disk for as long as the load runs
    # (a lost block is read out of the documents again)
    parsed = read_documents(docs).persist(StorageLevel.DISK_ONLY)
    try:
        return _load_datasets(parsed, days, specs, out_root, first_day, last_day, run_date, load)
    finally:
        parsed.unpersist()


def _load_datasets(parsed: DataFrame, days: DataFrame, specs: Sequence[SurveySpec], out_root: str, first_day: str | None,
                   last_day: str | None, run_date: str | None, load: Callable[..., int]) -> dict[str, int]:
    answers = with_whole(stream_of(parsed), Whole(parsed))
    broken = parsed.filter(~F.col("good")).select(
        SUBJECT, F.lit(None).cast("string").alias("dataset"), F.lit("unparsable document").alias("reason"))
    whole = days.select(SUBJECT).join(broken, SUBJECT, "left_anti")
    rejects = broken
    period = period_of(run_date) if run_date else None
    counts = {}
    for spec in specs:
        bad = spec_rejects(spec, answers, whole)
        rejects = rejects.unionByName(bad)
        out = run_spec(spec, answers, period).join(bad.select(SUBJECT), SUBJECT, "left_anti").join(days, SUBJECT)
        if period is not None:                          # PRJ-1: Period stays first
            out = out.select("Period", *[F.col(f"`{c}`") for c in out.columns if c != "Period"])
        # a quiet day in one file, a hot day cut into several ranges
        out = out.repartitionByRange("upload_date", SUBJECT)
        counts[spec.sink] = load(out, f"{out_root}/{spec.sink}", first_day, last_day)
    load(rejects.join(days, SUBJECT), f"{out_root}/_rejects", first_day, last_day)
    return counts
