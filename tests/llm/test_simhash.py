import random
import re

import numpy as np
import xxhash

from canvass.llm import simhash
from canvass.llm.components import components

from .helpers import components_of, edge_docs, no_docs


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    parts = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def signed(x):
    return int(np.uint64(x).view(np.int64))


def test_golay_code_is_perfect():
    errors = simhash.golay_errors()
    assert len(np.unique(errors)) == 1 << 11 and np.bitwise_count(errors).max() == 3
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 3000)
    a, b = rng.integers(0, 23, 3000), rng.integers(0, 23, 3000)
    y = x ^ (1 << a) ^ np.where(a == b, 0, 1 << b)
    kx, ky = simhash.golay_keys(x, errors), simhash.golay_keys(y, errors)
    assert all(set(p) & set(q) for p, q in zip(kx.tolist(), ky.tolist()))
    assert max(len(set(k)) for k in kx.tolist()) == 6


def test_links_equal_brute_force_also_for_large_buckets(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = set()
    for _ in range(700):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        fps.add(signed(x))
    want = components_of(fps, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for bucket in (256, 2):
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        got = {r.node: r.root for r in components(simhash.fingerprint_links(df)).collect()}
        assert {x: got.get(x, x) for x in fps} == want


def test_rows_edge_cases(spark):
    docs = edge_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    got = simhash.simhash_components(docs).collect()
    assert sorted((str(r.id), r.fp) for r in got) == sorted((str(r.doc_id), signed(brute_fingerprint(r.text))) for r in rows)
    zero = {r.component_id for r in got if r.fp == 0}
    assert zero == {1}                                # null, empty and blank texts are one component
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.root for r in got})


def test_no_rows(spark):
    assert simhash.simhash_components(no_docs(spark)).count() == 0
    assert simhash.keep_one_per_group(no_docs(spark)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(None, 1), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[2000 + i] == 1000 for i in range(300))
