import random
import re

import numpy as np

from canvass.llm import decontaminate
from canvass.llm.common import documents

from .helpers import edge_docs, no_docs

UPPER = str.maketrans("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_tiles(doc, item, least=5):
    free_d, free_i, n = [True] * len(doc), [True] * len(item), 0
    while True:
        best, at = 0, None
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and free_i[i + k] and free_d[j + k] and item[i + k] == doc[j + k]:
                    k += 1
                if k > best:
                    best, at = k, (i, j)
        if best < least:
            return n
        for k in range(best):
            free_i[at[0] + k] = free_d[at[1] + k] = False
        n += best


def test_tiles_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        item = [rng.randrange(30) for _ in range(rng.randrange(40))]
        doc = []
        for _ in range(rng.randrange(6)):
            i = rng.randrange(len(item) + 1)
            doc += item[i:i + rng.randrange(12)] + [rng.randrange(30) for _ in range(3)]
        got = decontaminate.tiles(np.array(doc, np.uint64), np.array(item, np.uint64))
        assert sum(t[2] for t in got) == brute_tiles(doc, item)
        assert all(item[i:i + n] == doc[j:j + n] for i, j, n in got)


def test_given_tables_and_reordered_passages(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in bench.collect()}
    turned = []
    long = {i: w for i, w in items.items() if len(w) >= 15}          # thirds of five words or more
    for i, w in long.items():
        k = len(w) // 3
        turned.append((10_000 + i, "Before it. " + " ".join([*w[2 * k:], "between", *w[:k], "and", *w[k:2 * k]]).translate(UPPER), "en", "a", 1))
    docs = docs.union(spark.createDataFrame(turned, docs.schema))
    got = {(r.doc_id, r.item_id): (r.n_words, r.n_matched) for r in decontaminate.contamination(docs, bench).collect()}
    want = {}
    for r in docs.collect():
        w = words(r.text)
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for i, item in items.items():
            if sum(tuple(item[j:j + 5]) in grams for j in range(len(item) - 4)) * 5 >= len(item) * 0.6:
                n = brute_tiles(w, item)
                if n >= 0.6 * len(item):
                    want[r.doc_id, i] = (len(item), n)
    assert got == want
    assert long and all((10_000 + i, i) in got for i in long)
    kept = decontaminate.remove_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_edge_cases_and_no_rows(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "four words are few"), (4, "Same row twice! same ROW twice same row"),
                                   (5, "same row twice same row twice same row"), (5, "same row twice same row twice same row"),
                                   (None, "tie on the id other text")], "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(5, 4), (5, 5), (6, None)} and len(got) == 3
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.text) for r in kept.collect()) == sorted(
        str(r.text) for r in docs.collect() if not (r.text or "").startswith(("same row", "tie on the id, other")))
    assert decontaminate.contamination(no_docs(spark), bench).count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).count() == 0
    assert decontaminate.remove_contaminated(docs, bench.where("false")).count() == docs.count()


def brute_pairs(docs, items):
    """(doc, item) pairs at the threshold, straight from the words."""
    want = set()
    for d, text in docs.items():
        w, lines = words(text), [words(x) for x in (text or "").split("\n")]
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        for i, t in items.items():
            item = words(t)
            if 0 < len(item) < 5:
                hit = item in lines
            else:
                hit = sum(tuple(item[j:j + 5]) in grams for j in range(len(item) - 4)) * 5 >= len(item) * 0.6 > 0 \
                    and brute_tiles(w, item) >= 0.6 * len(item)
            if hit:
                want.add((d, i))
    return want


def test_passage_common_to_items_and_documents(spark):
    """Items that share a passage with most documents are joined on their own, rarer seeds."""
    rng = random.Random(11)
    some = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(n))
    common = some(12)
    items = {i: " ".join([some(rng.randrange(3, 30)), common, some(rng.randrange(3, 30))]) for i in range(25)} \
        | {25: common, 26: common + " " + some(8), 27: some(25)}
    docs = {i: " ".join([some(10), common, some(10)]) for i in range(60)}
    for i in range(28):
        w = items[i].split()
        for cut in (0.4, 0.55, 0.65, 1.0):
            docs[len(docs)] = some(6) + " " + " ".join(w[:round(cut * len(w))]) + " " + some(6)
    frame = spark.createDataFrame([(k, v, "en", "a", 1) for k, v in docs.items()], documents(spark, "/root/testdata/sf0.001").schema)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contamination(frame, bench).collect()}
    want = brute_pairs(docs, items)
    assert got == want and len({i for _, i in want}) == 28


def test_items_shorter_than_a_tile(spark):
    items = {1: "Blue whale", 2: "yes", 3: "the answer is four", 4: "...", 5: "five words make a tile"}
    docs = {1: "What is it?\nblue  WHALE!\nmore", 2: "the blue whale swims", 3: "yes", 4: "yes yes", 5: None, 6: "",
            7: "- the answer is four\r\n- yes", 8: "the answer\nis four", 9: "blue\nwhale", 10: "so five words make a tile here"}
    frame = spark.createDataFrame([(k, v, "en", "a", 1) for k, v in docs.items()], documents(spark, "/root/testdata/sf0.001").schema)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontaminate.contamination(frame, bench).collect()}
    assert set(got) == brute_pairs(docs, items) == {(1, 1), (3, 2), (7, 3), (7, 2), (10, 5)}
    assert set(got.values()) == {1.0}
