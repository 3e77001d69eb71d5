import re
from collections import defaultdict

import pytest

from canvass.llm import mixing
from canvass.llm.common import documents

from .helpers import edge_docs, no_docs


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Resharing round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    free, rest = set(order), float(sum(sizes.values()))
    while free and rest > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += rest * weight[s] / total
        rest = sum(max(0.0, target[s] - cap * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= cap * sizes[s]:
                target[s] = float(cap * sizes[s])
                free.discard(s)
    return target


def check(docs, tolerance):
    rows = docs.collect()
    got = mixing.mix_sources(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(r.doc_id), size(r.text)) for r in rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= tolerance * want[s] + largest[s]
    return got


def test_targets_and_taken_words(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = check(docs, 0.02)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_sources(docs.repartition(7)).collect()))


def test_caps_that_follow_from_caps(spark):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate(
        [("a", 1)] * 3 + [("b", 9)] * 40 + [("c", 5)] * 100 + [("d", 2)] * 8 + [("e", 30)] * 5 + [(None, 4)] * 60)]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), 0.05)


def test_edge_cases_and_no_rows(spark):
    check(edge_docs(spark), 0.5)
    assert mixing.mix_sources(no_docs(spark)).count() == 0
    empty = spark.createDataFrame([(1, None, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [(r.size, r.target, r.taken) for r in mixing.mix_sources(empty).collect()] == [(0, 0.0, 0)]
