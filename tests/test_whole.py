"""Interviews read whole, in one pass, against the operators over their answer stream."""

import random

import pytest
from pyspark.sql import functions as F

from canvass.operators.whole import whole_of
from canvass.plans.catalog import BY_ID
from canvass.plans.interviews import _spread
from canvass.plans.spec import _in_one_pass, run_spec, spec_rejects
from canvass.sources.documents import documents_to_stream, interviews_once

SCHEMA = "subject_id long, xml string"


def interview(rng, spec):
    """Headers, questions, answers and grids in any order, with repeats, gaps and loop prefixes."""
    variables = [v for b in spec.blocks for v in b.variables[:4]] + [b.sentinel for b in spec.blocks if b.sentinel] * 2
    rows = []
    for _ in range(rng.randrange(14)):
        e = rng.choice(["FullVariable", "QuestionAnswer", "Text", "TopicAnswer", *spec.header[:3]])
        value = rng.choice(variables) if e in ("FullVariable", "Text") else rng.choice(["a (b)", "2024-01-02T03:04:05Z", "x, y", "DONE", "I_1_z"])
        if e == "FullVariable" and rng.random() < 0.5:
            value = f"I_{rng.randrange(3)}_{value}"
        more = rng.choice(["", "", " k='v'"])
        rows.append(f"<{e}{more}>{value.replace('<', '&lt;').replace('&', '&amp;')}</{e}>")
    return rng.choice(["<I>", "<I>", "<I><!-- c -->"]) + "".join(rows) + rng.choice(["</I>"] * 9 + ["<I>"])


def same(spec, docs):
    stream = documents_to_stream(docs)
    assert whole_of(stream) is not None and whole_of(stream.where("true")) is None
    a, b = run_spec(spec, stream), run_spec(spec, documents_to_stream(docs.select("*")))
    assert a.dtypes == b.dtypes
    got, want = (sorted(map(str, x.collect())) for x in (a, b))
    assert got == want
    return len(got)


@pytest.mark.parametrize("name", ["D01", "D05", "D10", "D21", "D33", "D37", "D38", "D40", "D42"])
def test_whole_interviews_read_as_their_stream(spark, name):
    spec, rng = BY_ID[name], random.Random(name)
    assert _in_one_pass(spec)
    rows = [(i if i else None, interview(rng, spec)) for i in range(150)] + [(500, None), (501, "<I/>")]
    docs = interviews_once(spark.createDataFrame(rows, SCHEMA).repartition(4, "subject_id"))
    assert same(spec, docs) > 20


def test_interviews_of_several_documents_are_read_as_a_stream(spark):
    rng = random.Random(9)
    rows = [(i % 70 or None, interview(rng, BY_ID["D05"])) for i in range(60)] + [(100 + i, interview(rng, BY_ID["D05"])) for i in range(60)]
    rows += [r for r in rows if r[0] and r[0] % 7 == 0]
    cells = spark.createDataFrame(rows, "k long, x string")
    docs = _spread(cells, F.col("k"), F.col("x"))
    whole = whole_of(documents_to_stream(docs))
    assert whole.rest is not None and whole.documents.count() + len({r[0] for r in rows if rows.count(r) > 1 or r[0] is None}) == 120
    assert same(BY_ID["D05"], docs) > 20


def test_one_pass_moves_and_parses_documents_once(spark):
    docs = _spread(spark.range(50), F.col("id"), F.format_string("<I><SubjectNum>%d</SubjectNum></I>", "id"))
    for name in ("D01", "D40"):
        plan = run_spec(BY_ID[name], documents_to_stream(docs))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "Window" not in plan


def test_rejects_of_whole_interviews(spark):
    spec, rng = BY_ID["D01"], random.Random(4)
    docs = interviews_once(spark.createDataFrame([(i, interview(rng, spec)) for i in range(120)] + [(500, None), (501, "<I/>")], SCHEMA))
    subjects = docs.union(spark.createDataFrame([(900, "")], SCHEMA))
    got, want = (sorted(map(str, spec_rejects(spec, documents_to_stream(d), subjects).collect())) for d in (docs, docs.select("*")))
    assert got == want and len({r.rsplit("reason", 1)[1] for r in got}) == 3
