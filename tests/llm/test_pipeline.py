"""The pipeline against its stages' brute-force forms on a small fixture."""

import hashlib

import corpus_pipeline
from canvass.llm import decontaminate, line_dedup, mixing, quality, simhash
from canvass.llm.common import documents

from .helpers import edge_docs
from .test_decontaminate import brute_tiles, words
from .test_line_dedup import brute as brute_lines
from .test_quality import brute as brute_quality
from .test_quality import normal
from .test_simhash import brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_rules", "dedup_lines", "near_duplicates", "decontaminate_benchmark", "mix"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(m for m in (quality, line_dedup, simhash, decontaminate, mixing))


def test_each_stage_on_its_own_input(spark):
    docs = documents(spark, SF)
    docs = spark.createDataFrame(docs.limit(90).collect(), docs.schema)
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        after = {r.doc_id: r.text for r in rows}
        if name == "quality_rules":
            verdicts = {v[0]: v for v in brute_quality(before)}
            assert set(after) == {i for i, v in verdicts.items() if v[-1]}
            assert all(len(after[r.doc_id].split("\n")) == len(r.text.split("\n")) for r in before
                       if r.doc_id in after and verdicts[r.doc_id][-3] == 0)
            assert not any(normal(x) for x in ()) and len(rows) == len(after)
        elif name == "line_dedup":
            gone = brute_lines(before)
            assert set(after) == {r.doc_id for r in before}
            left = sum(len(r.text.split("\n")) - len(gone.get((r.doc_id, r.text), ())) for r in before)
            assert left <= sum(max(1, len(t.split("\n"))) for t in after.values()) <= left + 3 + sum(not t for t in after.values())
        elif name == "simhash_near_dedup":
            prints = {r.doc_id: brute_fingerprint(r.text) for r in before}
            kept = set()
            up = {}
            for i in sorted(prints):
                near = [j for j in up if (prints[i] ^ prints[j]).bit_count() <= 2]
                up[i] = i
                for j in near:
                    a, b = sorted((_top(up, i), _top(up, j)))
                    up[b] = a
            kept = {_top(up, i) for i in prints}
            assert set(after) == kept
        else:
            items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            leaks = {r.doc_id for r in before for item in items
                     if set(item) <= set(words(r.text)) and brute_tiles(words(r.text), item) >= 0.6 * len(item)}
            assert set(after) == {r.doc_id for r in before} - leaks
        docs, before = spark.createDataFrame(rows, docs.schema), rows
    assert {r.doc_id for r in corpus_pipeline.mix(spark, docs, SF).collect()} == {r.doc_id for r in before}


def _top(up, x):
    while up[x] != x:
        x = up[x]
    return x


def test_run_agrees_with_itself(spark):
    rows = [sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and rows[0]
    assert len(hashlib.md5(str(rows[0]).encode()).hexdigest()) == 32


def test_stages_on_edge_cases(spark):
    for rows in (edge_docs(spark), edge_docs(spark).where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF).count() <= rows.count()
