"""STR-1 with corrections.

An interview may be delivered again, corrected. ``corrected`` keeps, for each interview, the
upload time and number of its last delivery as state (not the document), and passes on a
delivery only if it is newer: a late older one is dropped. A passed delivery
carries its revision; ``load_corrections`` appends its dataset rows under that
number, each micro-batch once, and ``current`` reads each interview at its last revision, so an
interview whose correction has no rows left is gone.
"""

from __future__ import annotations

import datetime
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..plans.spec import SurveySpec, run_spec
from ..sinks.versions import load_range, read_table_version
from ..sources.documents import documents_to_stream, interviews_once

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no copy of the package

DELIVERY_DDL = "subject_id {0}, upload_ts timestamp, xml string, revision long"
NEVER = pd.Timestamp.min


def _newest(ttl_ms: int | None):
    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best = None                                    # (upload time or the least, document)
        for p in parts:
            for ts, xml in zip(p["upload_ts"], p["xml"]):
                d = (NEVER if pd.isna(ts) else ts, xml or "")
                best = d if best is None or d > best else best
        at = -1 if best[0] is NEVER else best[0].value // 1000          # microseconds
        old, revision = state.get if state.exists else (-2, 0)
        if at > old:
            state.update((at, revision + 1))
            # one frame an interview: built in its types, as a cast costs as much as the frame
            ts = np.array([np.datetime64("NaT") if best[0] is NEVER else best[0].value], "datetime64[ns]")
            yield pd.DataFrame({"subject_id": [key[0]], "upload_ts": ts, "xml": [best[1]], "revision": [revision + 1]})
        if ttl_ms is not None:
            state.setTimeoutTimestamp(max(max(at, old) // 1000, state.getCurrentWatermarkMs(), 0) + ttl_ms)
    return run


def corrected(docs: DataFrame, ttl: datetime.timedelta | None = datetime.timedelta(days=90)) -> DataFrame:
    """Deliveries ``(subject_id, upload_ts, xml)`` that are the first or newer than all
    before, with their revision. Of one micro-batch's deliveries of an interview the newest
    counts (ties: the greater document). An equal upload time is a repeat and dropped; no
    upload time is older than any.

    State is bounded by the interviews of ``ttl`` in upload time: it is the watermark's
    delay, and an interview's state goes once the watermark is ``ttl`` past its last
    delivery. (A processing-time limit would never let ``availableNow`` end.) None: state
    for good."""
    ms = None if ttl is None else int(ttl.total_seconds() * 1000)
    kind = docs.schema["subject_id"].dataType.simpleString()
    docs = docs.select("subject_id", "upload_ts", "xml")
    if ttl is not None:
        docs = docs.withWatermark("upload_ts", f"{int(ttl.total_seconds())} seconds")
    return docs.groupBy("subject_id").applyInPandasWithState(
        _newest(ms), DELIVERY_DDL.format(kind), "upload_us long, revision long", "append",
        GroupStateTimeout.NoTimeout if ms is None else GroupStateTimeout.EventTimeTimeout)


def load_corrections(deliveries: DataFrame, spec: SurveySpec, target: str, checkpoint: str,
                     post: Callable[[DataFrame], DataFrame] | None = None):
    """Run the spec over each micro-batch of ``corrected`` and append rows and revisions; all
    that has landed (``availableNow``). A replayed micro-batch is not loaded again."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            days = batch.select("subject_id", "revision", F.to_date("upload_ts").alias("upload_date"))
            out = run_spec(spec, documents_to_stream(interviews_once(batch.select("subject_id", "xml"))))
            out = (post(out) if post else out).join(days, "subject_id")
            load_range(out, f"{target}/rows", append=True, load_id=f"batch-{epoch}")
            # the rows come first: a revision that readers see has its rows
            load_range(days, f"{target}/revisions", append=True, load_id=f"batch-{epoch}")
        finally:
            batch.unpersist()

    q = deliveries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def current(spark: SparkSession, target: str) -> DataFrame:
    """The dataset with each interview at its last revision."""
    last = read_table_version(spark, f"{target}/revisions").groupBy("subject_id").agg(F.max("revision").alias("revision"))
    return read_table_version(spark, f"{target}/rows").join(last, ["subject_id", "revision"]).drop("revision", "upload_date")
