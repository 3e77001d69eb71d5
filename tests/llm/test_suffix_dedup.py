import hashlib
import random
from collections import Counter

import pytest

from canvass.llm import suffix_dedup
from canvass.llm.common import documents

from .helpers import edge_docs, no_docs


def brute(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    where = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        mark = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if where[r[i:i + length]] > 1:
                mark[i:i + length] = b"\x01" * length
        spans = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((len(r), sum(mark), spans, hashlib.sha256(bytes(b for b, m in zip(r, mark) if not m)).hexdigest()))
    return out


def shuffled_passages():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(rng.choices(words, k=rng.randint(20, 90))) for _ in range(10)]
    rows = []
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += [p[a:rng.randrange(a, len(p)) + 1] if rng.random() < 0.6 else p, " ".join(rng.choices(words, k=rng.randint(0, 15)))]
        rows.append(" ".join(parts))
    return rows + ["a" * 500, "a" * 201, "ab" * 300, None, "", None, rows[0], rows[0], "x" * 199, "y" * 200, "y" * 200]


@pytest.mark.parametrize("hot,run,group", [(50_000, 50_000, 20_000), (2, 50_000, 20_000), (50_000, 30, 100)])
def test_equals_brute_force(spark, monkeypatch, hot, run, group):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = shuffled_passages()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r)[:5] for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts))]


def test_given_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = docs.collect()
    got = sorted(tuple(r)[:5] for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == sorted((r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows])))


def test_spans_are_what_goes(spark):
    docs = spark.createDataFrame([(1, "q" * 10 + "abcdefghij" * 30), (2, "abcdefghij" * 30 + "é")], "doc_id long, text string")
    for r, t in zip(sorted(suffix_dedup.remove_repeats(docs).collect()), docs.collect()):
        raw, at, kept = t.text.encode(), 0, b""
        for s, e in zip(r.starts, r.stops):
            kept, at = kept + raw[at:s], e
        assert hashlib.sha256(kept + raw[at:]).hexdigest() == r.kept_sha256 and len(r.starts) == r.n_spans


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(6)
    for k in (1, 2, 3, 7):
        keys = [[bytes(rng.choices(b"ab", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 20))] for _ in range(k)]
        runs = []
        for i, ks in enumerate(keys):
            held = {(x, len(x)): [(bytes([i]) * 16, j)] for j, x in enumerate(ks)}
            runs.append(suffix_dedup.Run(suffix_dedup.front_coded(0, held)[1:]))
        got = list(suffix_dedup.merged(runs))
        assert [g[0] for g in got] == sorted(x for ks in keys for x in set(ks))
        assert [g[1] for g in got[1:]] == [suffix_dedup.common_prefix(a[0], b[0]) for a, b in zip(got, got[1:])]


def test_edge_cases_and_no_rows(spark):
    docs = edge_docs(spark)
    got = sorted((tuple(r)[:5] for r in suffix_dedup.remove_repeats(docs).collect()), key=str)
    rows = docs.select("doc_id", "text").collect()
    assert got == sorted(((r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows]))), key=str)
    assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0
