"""Versioned loads (SNK-5), the landing data source (SRC-2, SRC-4) and loads of rows without a day."""

import datetime
import os
import threading

import pytest
from pyspark.sql import functions as F

from canvass.sinks import versions
from canvass.sinks.versions import LoadConflict, expire, load_range, read_table_version, read_version
from canvass.sinks.writers import load_days
from canvass.sources.landing import Container, land, read_container, stream_container

DDL = "k long, upload_date date"


def rows(spark, *pairs):
    return spark.createDataFrame([(k, d and datetime.date.fromisoformat(d)) for k, d in pairs], DDL)


def held(df):
    return sorted((r.k, r.upload_date and str(r.upload_date)) for r in df.collect())


def test_range_replaces_its_days_only(spark, tmp_path):
    t = str(tmp_path / "t")
    assert load_range(rows(spark, (1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")), t) == 3
    assert load_range(rows(spark, (20, "2024-01-02")), t, "2024-01-01", "2024-01-02") == 1     # the first has become empty
    assert held(read_table_version(spark, t)) == [(3, "2024-01-03"), (20, "2024-01-02")]
    assert held(read_table_version(spark, t, 1)) == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]
    assert read_table_version(spark, t).schema == rows(spark).schema
    assert load_range(rows(spark), t) == 0 and read_table_version(spark, t).collect() == []


def test_rows_without_a_day_stay(spark, tmp_path):
    t = str(tmp_path / "t")
    load_range(rows(spark, (1, "2024-01-01"), (9, None)), t)
    for _ in range(2):                                  # a re-run replaces what its range brought
        load_range(rows(spark, (2, "2024-01-01"), (8, None)), t, "2024-01-01", "2024-01-01")
        assert held(read_table_version(spark, t)) == [(2, "2024-01-01"), (8, None), (9, None)]
    load_range(rows(spark, (5, None)), t)               # all days, so all rows
    assert held(read_table_version(spark, t)) == [(5, None)]


def test_days_outside_the_range_are_an_error(spark, tmp_path):
    t = str(tmp_path / "t")
    load_range(rows(spark, (1, "2024-01-01")), t)
    with pytest.raises(ValueError, match="2024-01-05"):
        load_range(rows(spark, (2, "2024-01-05")), t, "2024-01-01", "2024-01-02")
    assert held(read_table_version(spark, t)) == [(1, "2024-01-01")]


def _while_loading(spark, monkeypatch, t, other):
    """Run ``other`` after a load has written its files and before it publishes."""
    real, done = versions._publish, []

    def publish(*args):
        if not done:
            done.append(1)
            other()
        return real(*args)
    monkeypatch.setattr(versions, "_publish", publish)


def test_loads_of_other_days_go_on_from_each_other(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    load_range(rows(spark, (1, "2024-01-01"), (2, "2024-01-02")), t)
    _while_loading(spark, monkeypatch, t, lambda: load_range(rows(spark, (20, "2024-01-02")), t, "2024-01-02", "2024-01-02"))
    load_range(rows(spark, (10, "2024-01-01")), t, "2024-01-01", "2024-01-01")
    assert held(read_table_version(spark, t)) == [(10, "2024-01-01"), (20, "2024-01-02")]
    assert read_version(spark, t).number == 3


def test_loads_of_one_day_conflict(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    load_range(rows(spark, (1, "2024-01-01")), t)
    _while_loading(spark, monkeypatch, t, lambda: load_range(rows(spark, (7, "2024-01-01")), t, "2024-01-01", "2024-01-03"))
    with pytest.raises(LoadConflict):
        load_range(rows(spark, (8, "2024-01-01")), t, "2024-01-01", "2024-01-01")
    assert held(read_table_version(spark, t)) == [(7, "2024-01-01")]


def test_readers_see_old_or_new(spark, tmp_path):
    """A reader beside a series of loads of two days never sees days of different loads."""
    t = str(tmp_path / "t")
    load_range(rows(spark, (0, "2024-01-01"), (0, "2024-01-02")), t)
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            seen.append({k for k, _ in held(read_table_version(spark, t))})
    reader = threading.Thread(target=watch)
    reader.start()
    for i in range(1, 5):
        load_range(rows(spark, (i, "2024-01-01"), (i, "2024-01-02")), t)
    stop.set()
    reader.join()
    assert seen and all(len(x) == 1 for x in seen)


def test_replayed_load_counts_once_and_old_folders_go(spark, tmp_path):
    t = str(tmp_path / "t")
    for _ in range(3):
        assert load_range(rows(spark, (1, "2024-01-01")), t, append=True, load_id="batch-0") == 1
    load_range(rows(spark, (2, "2024-01-01")), t, append=True, load_id="batch-1")
    assert held(read_table_version(spark, t)) == [(1, "2024-01-01"), (2, "2024-01-01")]
    load_range(rows(spark, (3, "2024-01-02")), t)
    assert expire(spark, t, older_than_s=3600) == 0     # too young
    load_range(rows(spark, (3, "2024-01-02")), t)
    assert expire(spark, t, older_than_s=0) >= 1 and held(read_table_version(spark, t)) == [(3, "2024-01-02")]
    assert len(os.listdir(os.path.join(t, "data"))) == 1


def test_plain_loads_keep_rows_without_a_day(spark, tmp_path):
    t = str(tmp_path / "t")
    assert load_days(rows(spark, (1, "2024-01-01"), (9, None)), t) == 2
    assert held(spark.read.schema(DDL).parquet(t)) == [(1, "2024-01-01"), (9, None)]
    load_days(rows(spark, (2, "2024-01-01")), t, "2024-01-01", "2024-01-01")
    assert held(spark.read.schema(DDL).parquet(t)) == [(2, "2024-01-01"), (9, None)]
    load_days(rows(spark, (2, "2024-01-01")), t)        # all days, and none without one
    assert held(spark.read.schema(DDL).parquet(t)) == [(2, "2024-01-01")]


def test_survey_load_takes_the_last_delivery(spark, tmp_path):
    from canvass.plans.catalog import BY_ID
    from canvass.plans.survey_load import load_survey

    doc = "<I><SubjectNum>{0}</SubjectNum><Upload>2024-01-0{1}T00:00:00Z</Upload><VisitStart>2024-01-01T00:00:00Z</VisitStart>" \
          "<FullVariable>supply_source</FullVariable><QuestionAnswer>{2}</QuestionAnswer></I>"
    landed = [(1, "2024-01-01", doc.format(1, 1, "old")), (1, "2024-01-02", doc.format(1, 2, "new")),
              (1, "2024-01-02", doc.format(1, 2, "new")), (2, "2024-01-01", doc.format(2, 1, "two")),
              (3, None, doc.format(3, 1, "no time")), (4, None, "<I>"), (4, None, "<I>")]
    spark.createDataFrame(landed, "subject_id long, t string, xml string") \
        .select("subject_id", F.to_timestamp("t").alias("upload_ts"), "xml").write.parquet(str(tmp_path / "landed"))
    spec = BY_ID["D05"]
    for load, read in ((load_days, lambda p: spark.read.parquet(p)), (load_range, lambda p: read_table_version(spark, p))):
        out = str(tmp_path / load.__name__)
        for _ in range(2):
            counts = load_survey(spark, str(tmp_path / "landed"), [spec], out, load=load)
            got = read(f"{out}/{spec.sink}").collect()
            assert counts == {spec.sink: 3} and sorted(r.subject_id for r in got) == [1, 2, 3]
            assert {r.subject_id: r.upload_date and str(r.upload_date) for r in got} == {1: "2024-01-02", 2: "2024-01-01", 3: None}
            assert [(r.subject_id, r.reason) for r in read(f"{out}/_rejects").collect()] == [(4, "unparsable document")]


def landed(spark, *rows):
    return spark.createDataFrame([(i, t, x) for i, t, x in rows], "subject_id string, t string, xml string") \
        .select("subject_id", F.to_timestamp("t").alias("upload_ts"), "xml")


def test_container_prunes_days_and_ids(spark, tmp_path):
    c = str(tmp_path / "c")
    land(landed(spark, ("a", "2024-01-01 10:00:00", "<a/>"), ("b", "2024-01-02 23:59:59", None), ("c", None, "<c/>")), c)
    land(landed(spark, ("d", "2024-01-02 00:00:00", "<d/>"), (None, "2024-01-03 00:00:00", "<n/>")), c)
    df = read_container(spark, c)
    everything = df.collect()
    assert len(everything) == 5 and df.columns == ["subject_id", "upload_ts", "xml", "upload_date"]
    for where in ["upload_date = '2024-01-02'", "upload_date > '2024-01-01' and upload_date < '2024-01-03'", "upload_date is null",
                  "upload_date in ('2024-01-01', '2024-01-03')", "not (upload_date = '2024-01-02')", "subject_id in ('a', 'd')",
                  "upload_date >= '2024-01-02' and subject_id = 'd'", "xml is null", "subject_id is null",
                  "upload_ts > '2024-01-02 12:00:00'"]:
        got, want = df.where(where).collect(), spark.createDataFrame(everything, df.schema).where(where).collect()
        assert sorted(map(str, got)) == sorted(map(str, want)), where
    parts = Container(c, 1 << 20).files(Container(c, 1 << 20).version(2)["parts"], lambda d: d == datetime.date(2024, 1, 2))
    assert {p.day for p in parts} == {datetime.date(2024, 1, 2)} and sum(len(p.paths) for p in parts) == 2
    assert " Filter " not in df.where("upload_date = '2024-01-02' and subject_id = 'd'")._jdf.queryExecution().executedPlan().toString()
    assert read_container(spark, str(tmp_path / "none")).collect() == []


def test_stream_reads_each_delivery_once(spark, tmp_path):
    c, out, check = (str(tmp_path / x) for x in ("c", "out", "check"))

    def run():
        stream_container(spark, c).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.subject_id for r in spark.read.parquet(out).collect())

    land(landed(spark, ("a", "2024-05-01 00:00:00", "<a/>")), c)
    assert run() == ["a"]
    land(landed(spark, ("b", "2024-01-01 00:00:00", "<b/>"), ("c", None, "<c/>")), c)      # earlier upload times
    land(landed(spark, ("d", "2024-05-01 00:00:00", "<d/>")), c)
    assert run() == ["a", "b", "c", "d"] == run()
