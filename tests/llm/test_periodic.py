import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from canvass.llm import periodic
from canvass.llm.queries import QUERIES

from .helpers import edge_docs, no_docs


def brute_runs(w):
    """Every maximal run, straight from the definition."""
    out = {}
    n = len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)          # the smallest period comes first
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digests(doc_id, w):
    runs = brute_runs(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), top[0], top[1], top[2], 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(brute_collapse(w, runs).encode()).hexdigest())


def random_words(rng):
    """Few letters, with stretches repeated whole and cut short."""
    w = [rng.choice("ab" if rng.random() < 0.5 else "abcde") for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 4)):
        if w:
            i = rng.randrange(len(w))
            unit = w[i:i + rng.randrange(1, 14)]
            w[i:i] = (unit * rng.randrange(2, 9))[:rng.randrange(1, 90)]
    return w


def found_in(lists):
    ids = np.array([ord(x[0]) if x else 0 for w in lists for x in w], np.int32)
    sizes = np.array([len(w) for w in lists])
    seg, q, start, stop = periodic.matches(ids, sizes, np.zeros(len(lists), np.int64), sizes, 0, 62, False)
    got = [[] for _ in lists]
    for d, p, s, e in zip(seg.tolist(), q.tolist(), start.tolist(), stop.tolist()):
        got[d].append((s, e - s + p, p))
    return [sorted(g) for g in got]


def test_runs_equal_brute_force():
    rng = random.Random(1)
    lists = [random_words(rng) for _ in range(1500)]
    assert found_in(lists) == [brute_runs(w) for w in lists]


def test_words_without_end_and_fibonacci_words():
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    thue = "a"
    while len(thue) < 1000:
        thue += thue.translate(str.maketrans("ab", "ba"))
    lists = [list("a" * 700), list("ab" * 350 + "a"), list(fib[-1]), list(thue), list(("a" * 12 + "b") * 40)]
    assert found_in(lists) == [brute_runs(w) for w in lists]


@pytest.mark.parametrize("octave", [0, 1, 3])
def test_stitched_tiles_equal_brute_force(spark, monkeypatch, octave):
    """Tiny tiles: every text is exploded, and its runs cross many tiles of several octaves."""
    monkeypatch.setattr(periodic, "TILE_OCTAVE", octave)
    monkeypatch.setattr(periodic, "SHORT_BYTES", 0)
    rng = random.Random(octave)
    rows = [(i, " ".join(random_words(rng))) for i in range(150)]
    rows += [(200, " ".join("x" * 500)), (201, " ".join(("abcdefghij" * 30) + "ab" * 100)), (202, " ".join("ab" * 300))]
    rows += [(203, rows[5][1]), rows[6], rows[6]]
    got = periodic.collapse_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(i, len(words(t)), brute_collapse(words(t), brute_runs(words(t))), brute_runs(words(t))) for i, t in rows]
    assert sorted((r.doc_id, r.n_words, r.text, [tuple(x) for x in r.runs]) for r in got) == sorted(want)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    small = [r for r in rows if len(words(r.text)) <= 1500]
    want = {r.doc_id: digests(r.doc_id, planted(r.doc_id, words(r.text))) for r in small}
    got = QUERIES["op11_periodic_runs"](spark, sf).collect()
    assert len(got) == len(rows) and len(small) > 0.8 * len(rows)
    assert {r.doc_id: tuple(r) for r in got if r.doc_id in want} == want
    assert any(r.n_runs and r.period > 20 for r in got)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = periodic.run_digests(periodic.collapse_runs(periodic.plant_repeats(docs)))
    want = []
    for i, t in rows:
        w = planted(i, words(t))
        want.append(digests(i, w) if len(w) < 5000 else (i, len(w)))
    have = [tuple(r) if r.n_runs != 2 or r.length < 5000 else None for r in got.collect()]
    short = [x for x in want if len(x) > 2]
    assert len(have) == len(rows) and all(have.count(x) == short.count(x) for x in short)
    assert periodic.collapse_runs(no_docs(spark)).collect() == []


def test_long_text_takes_the_tiles(spark):
    """A text of over a tile, with a run across tiles and a period of a higher octave."""
    rng = random.Random(3)
    far = [f"w{rng.randrange(10 ** 9)}" for _ in range(9001)]
    w = [f"v{rng.randrange(10 ** 9)}" for _ in range(30_000)] + ["a", "b"] * 9000 + far * 4 + ["z"]
    got = periodic.collapse_runs(spark.createDataFrame([(1, "\n".join(w))], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in got.runs] == [(30_000, 18_000, 2), (48_000, 4 * 9001, 9001)]
    assert got.text == " ".join(w[:30_002] + far + ["z"]) and got.n_words == len(w)
