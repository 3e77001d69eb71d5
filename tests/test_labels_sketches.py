"""Records with labels from the data, and respondents over spans from stored sketches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from canvass.operators import labels, sketches

STREAM = "subject_id long, seq long, block long, element string, attribute string, value string"
Q, A = "FullVariable", "QuestionAnswer"


def walk(rows, sentinel):
    """(subject, rec) -> {label: last answer}, row by row."""
    out = {}
    for s in {r[0] for r in rows}:
        own = [r for r in sorted(rows, key=lambda r: r[1]) if r[0] == s]
        n = 0
        for i, r in enumerate(own):
            if r[3] != Q or r[5] is None:
                continue
            n += r[5] == sentinel
            nxt = own[i + 1] if i + 1 < len(own) else None
            rec = max(1, n) if sentinel else 1
            out.setdefault((s, rec), {})[r[5]] = nxt[5] if nxt and nxt[3] == A else None
    return out


def stream_of(rng, n=400, span=5):
    rows = []
    for s in range(6):
        for i in range(n if s == 0 else rng.randrange(1, 30)):
            e = rng.choice([Q, Q, A])
            v = rng.choice(["start", "a", "b b", "é`.", None]) if e == Q else rng.choice(["1", "2.5", "x", "", None, "007"])
            rows.append((s, i, i // span, e, "text", v))
    return rows


@pytest.mark.parametrize("sentinel", ["start", None])
def test_records_equal_a_walk(spark, sentinel):
    rows = stream_of(random.Random(3))
    answers = labels.labelled_answers(spark.createDataFrame(rows, STREAM).repartition(4), sentinel)
    want = walk(rows, sentinel)
    records = labels.label_records(answers)
    assert {(r.subject_id, r.rec): r.answers for r in records.collect()} == want
    table = labels.typed_records(records, {"a": "string", "é`.": "long", "none": "string"}).collect()
    assert len(table) == len(want)
    for r in table:
        mine = want[r.subject_id, r.rec]
        v = mine.get("é`.")
        assert r["a"] == mine.get("a") and r["none"] is None and r["é`."] == (int(v) if v in ("1", "007") else None)


def test_types(spark):
    cells = {"whole": ["1", "-20", None], "number": ["1", "2.5", "-3e4"], "code": ["007", "1"], "text": ["1", "x"],
             "never": [None, None], "blank": ["", "1"], "long": ["1234567890123456789012"]}
    rows = [(1, 1, k, v, i) for k, vs in cells.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "subject_id long, rec long, label string, answer string, seq long")
    d = labels.label_dictionary(df)
    assert labels.column_types(d) == {"blank": "string", "code": "string", "long": "double", "never": "string", "number": "double",
                                      "text": "string", "whole": "long"}
    assert {(r.label, r.questions, r.answered) for r in d.collect()} == {(k, len(v), sum(x is not None for x in v)) for k, v in cells.items()}
    with pytest.raises(ValueError):
        labels.column_types(d, max_columns=6)
    assert labels.column_types(d.where("false")) == {}
    assert labels.typed_records(labels.label_records(df.where("false")), {}).count() == 0


def days(n):
    return dt.date(2024, 1, 30) + dt.timedelta(days=n)


def test_spans_of_sketches(spark, tmp_path):
    rng = random.Random(4)
    rows = [(days(rng.randrange(10)), rng.choice(["x", "y", None]), rng.randrange(9000)) for _ in range(60_000)]
    rows += [(None, "x", 1), (days(0), "x", None)]
    df = spark.createDataFrame(rows, "day date, answer string, who long")
    s = sketches.period_sketches(df, "day", ["answer"], "who")
    path = str(tmp_path / "s")
    for part in (F.col("period") < days(5), F.col("period") >= days(5), F.col("period") == days(2)):
        sketches.store_sketches(s.where(part), path)
    stored = spark.read.schema(s.schema).parquet(path)
    assert stored.count() == 30
    wanted = [(days(0), days(9)), (days(3), days(3)), (days(2), days(6)), (days(2), days(6)), (days(8), days(20)), (days(40), days(41)),
              (days(5), days(4))]
    got = {(r.first, r.last, r.answer): r for r in
           sketches.respondents_per_span(stored, spark.createDataFrame(wanted, "first date, last date"), ["answer"]).collect()}
    want = {}
    for first, last in wanted:
        for d, a, w in rows:
            if d is not None and w is not None and first <= d <= last:
                want.setdefault((first, last, a), set()).add(w)
    assert got.keys() == want.keys()
    assert all(got[k].low <= len(w) <= got[k].high and abs(got[k].estimate / len(w) - 1) < 3 * sketches.standard_error()
               for k, w in want.items())
    one = {r.answer: r.estimate for r in sketches.respondents_in(stored, days(2), days(6), ["answer"]).collect()}
    assert one == {a: got[days(2), days(6), a].estimate for a in ("x", "y", None)}
    plan = sketches.respondents_in(stored, days(2), days(6), ["answer"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
