import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from canvass.llm import collocations as C

from .helpers import CLASHES, edge_docs, no_docs

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    """Straight from the definition. rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    often = {g: a for g, a in f.items() if a >= least}
    within = Counter()
    for (lang, p), a in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                within[lang, p[i:i + k]] = max(within[lang, p[i:i + k]], a)
    best = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and not 100 * within[lang, p] >= 80 * a:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                    for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            best.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for lang, found in best.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def corpus(rng, docs):
    vocabulary = ["the", "of", "The", "a", "é", "Ω", "x1", "of.", "new", "york", "city", "hall", "\U0001F600", "so"]
    out = []
    for _ in range(docs):
        w = []
        while len(w) < 200:
            r = rng.random()
            if r < 0.1:
                w += ["new", "york", "city"] + (["hall"] if r < 0.09 else [])
            else:
                w.append(rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", "\n", "\t", "!a"]))
        out.append((rng.choice(["en", "fr", None, "und", ""]), rng.choice([" ", "  "]).join(w)))
    return out


@pytest.mark.parametrize("top", [2000, 7])
def test_equals_brute_force(spark, top):
    rows = corpus(random.Random(5), 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for c in CLASHES + ["words", "gram", "f", "id", "shard", "n", "rank"]:
        df = df.withColumn(c, F.lit("clash"))
    got = rows_of(C.collocations(df, least=20, top=top))
    assert got == brute(rows, 20, top) and len(got) > 20


def test_many_shards_and_flushes(spark, monkeypatch):
    rows = corpus(random.Random(6), 60)
    for name, value in [("SHARD_BYTES", 500), ("FLUSH", 64), ("PAIR_BITS", 9)]:   # the bitmap is nearly full
        monkeypatch.setattr(C, name, value)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert rows_of(C.collocations(df, least=10)) == brute(rows, 10)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert rows_of(C.collocations(docs)) == brute(rows)
    assert C.collocations(no_docs(spark)).collect() == []
    assert C.collocations(edge_docs(spark, [(1, "no phrase is frequent", "en", "a", 1)])).collect() == []


def test_hot_phrase_keeps_counts_exact(spark):
    rows = [("en", "hot pair " * 40_000)] * 3 + [("en", f"cold{i} pair") for i in range(50)]
    got = rows_of(C.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(4)))
    assert got == brute(rows) and got[0][3] == 120_000 - 3


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("bits", [2, 10, 16, 18, 32])
def test_permutation_is_invertible_and_filters_lossless(n, bits):
    rng = np.random.default_rng(n * bits)
    p = C.Packing(n, bits)
    ids = [rng.integers(0, 1 << bits, 5000, dtype=np.uint64) for _ in range(n)]
    packed = p.pack(ids)
    moved = p.permute(*packed)
    for a, b in zip(p.restore(*moved), packed):
        assert (a == b).all() and (a <= p.mask).all()
    for a, b in zip(p.unpack(*packed), ids):
        assert (a == b).all()
    left, right, counts = p.count(*moved)
    assert counts.sum() == 5000
    counts = counts * rng.choice([1, 254, 255, 10 ** 12], len(counts))
    for top in range(0, min(4, bits)):
        parts = []
        for number in range(1 << top):
            at = left >> np.uint64(p.h - top) == number if top else np.ones(len(left), bool)
            parts.append(C.from_filter(p, top, number, C.to_filter(p, top, left[at], right[at], counts[at])))
        for a, b in zip((np.concatenate(x) for x in zip(*parts)), (left, right, counts)):
            assert (a == b).all()
    two = p.count(np.concatenate([left, left]), np.concatenate([right, right]), np.concatenate([counts, counts]))
    assert (two[0] == left).all() and (two[1] == right).all() and (two[2] == 2 * counts).all()


def test_large_rows_make_small_pages_and_batches(spark, monkeypatch):
    """Rows of a megabyte: tables that hold them have small row groups and pages, and Python gets a few at a time."""
    import pyarrow.parquet as pq

    written, inner = [], C.shared_table

    def watched(df, large_rows=False):
        out = inner(df, large_rows)
        written.append((df.columns, large_rows, out.inputFiles()))
        return out

    monkeypatch.setattr(C, "shared_table", watched)
    monkeypatch.setattr(C, "SHARD_BYTES", 1 << 20)
    rng = random.Random(3)
    rows = [("en", " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(90_000))) for _ in range(40)]
    C.collocations(spark.createDataFrame(rows, "lang string, text string").coalesce(1))
    columns, large, files = written[0]
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata.row_group(0) for f in files]
    assert "seq" in columns and large and len(groups) == 1 and groups[0].num_rows < 40
    assert all(large for columns, large, _ in written if "ids" in columns or "gram" in columns)

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    big = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("t")).mapInArrow(sizes, "n long")
    got = inner(big, large_rows=True).collect()
    assert len(got) > 3 and sum(r.n for r in got) == 40
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > 8 << 20
