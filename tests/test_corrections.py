"""STR-1 with corrections: a stream of deliveries against the last delivery in batch."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from canvass.plans.catalog import BY_ID
from canvass.plans.survey_load import last_deliveries
from canvass.sources.documents import documents_to_stream
from canvass.plans.spec import run_spec
from canvass.streaming.corrections import corrected, current, load_corrections
from canvass.streaming.ingest import LANDING_SCHEMA, read_landing_stream

DOC = "<I><SubjectNum>{0}</SubjectNum><Upload>2024-01-01T00:00:00Z</Upload>" \
      "<FullVariable>Source</FullVariable><QuestionAnswer>{1}</QuestionAnswer></I>"


@pytest.mark.parametrize("ttl", [None, timedelta(days=90)])
def test_each_interview_stands_at_its_last_delivery(spark, tmp_path, ttl):
    landing = str(tmp_path / "landed")
    runs = [[(1, "2024-01-01", "first"), (2, "2024-01-02", "only"), (3, "2024-01-05", "new"), (3, "2024-01-04", "old")],
            [(1, "2024-01-03", "second"), (2, "2024-01-01", "older, late"), (3, "2024-01-05", "a repeat"), (4, "2024-01-02", "x")],
            [(1, "2024-01-02", "between"), (4, "2024-01-04", None)]]
    everything = spark.createDataFrame([], LANDING_SCHEMA)
    for rows in runs:
        part = spark.createDataFrame([(i, t, DOC.format(i, a) if a else "<I/>") for i, t, a in rows], "subject_id long, t string, xml string") \
            .select("subject_id", F.to_timestamp("t").alias("upload_ts"), "xml").coalesce(1)
        part.write.mode("append").parquet(landing)
        everything = everything.union(part.where("xml not like '%a repeat%'"))
        load_corrections(corrected(read_landing_stream(spark, landing), ttl), BY_ID["D05"], str(tmp_path / "t"), str(tmp_path / "check"))
        want = run_spec(BY_ID["D05"], documents_to_stream(last_deliveries(everything).select("subject_id", "xml")))
        got = current(spark, str(tmp_path / "t")).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.subject_id: r.Source for r in got.collect()} == {1: "second", 2: "only", 3: "new"}     # 4 is empty now
