"""Benchmark decontamination by greedy string tiling.

Texts become word hashes (A-Z lower-cased, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`).
Seeds are five-word runs that a document shares with a benchmark item. A pair that can
reach the threshold shares a certain number of the item's seeds, so it shares one of
those that are left without the item's most frequent ones: a Spark join on these rare
seeds finds every such pair, and a passage common to many items and documents is seldom
joined on. For the pairs whose seeds could reach the threshold, running
Karp-Rabin matching marks the longest common run of words not yet marked again and
again; the share of an item's words that end up marked is its coverage. Passages
in another order count in full, since every tile counts wherever it stands.
An item of fewer words than a tile is one tile: it matches documents with a line of
just these words (a phrase of two or three words inside a sentence is no leak).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, alnum_table, in_sieve, lower_table, mix, row_key, runs_of, shared_table, sieve_of, slices, table, \
    text_bytes, unused, word_spans

MIN_TILE = 5              # words
COVERAGE = 0.6            # of an item's words


# --- words and seeds --------------------------------------------------------------

def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: np.ndarray):
    """(hashes, text number, line feeds before the word in the batch) of all words of a batch."""
    data = lower[data]
    s, e, doc = word_spans(data, offsets, inside)
    if not len(s):
        return np.zeros(0, np.uint64), doc, s
    return Rolling(data).ranges(s, e), doc, np.searchsorted(np.flatnonzero(data == 0x0A), s)


def seed_hashes(words: np.ndarray, k: int = MIN_TILE) -> np.ndarray:
    """Hash of the k words that begin at each word (meaningless across texts)."""
    n = max(0, len(words) - k + 1)
    h = np.full(n, MIN_TILE - k, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix(h)


def item_seeds(words: np.ndarray) -> np.ndarray:
    """An item's seeds: its runs of MIN_TILE words, or the whole of a shorter one."""
    return seed_hashes(words, max(1, min(MIN_TILE, len(words))))


def short_lines(words: np.ndarray, doc: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the lines with fewer words than a tile."""
    new = np.ones(len(words), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    at, n = runs_of(np.cumsum(new))
    hashes, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k in range(1, MIN_TILE):
        of = at[n == k]
        if len(of):
            hashes.append(seed_hashes(words, k)[of])
            texts.append(doc[of])
    return np.concatenate(hashes), np.concatenate(texts)


ITEMS = pa.schema([("item_id", pa.int64()), ("item", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64()))])


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside, lower = alnum_table(), lower_table()
    for b in slices(batches, "t"):
        w, doc, _ = word_hashes(*text_bytes(b.column(1)), inside, lower)
        at = np.searchsorted(doc, np.arange(b.num_rows + 1))
        items = [w[i:j] for i, j in zip(at[:-1], at[1:])]
        yield table(ITEMS, b.column(0), [x.view(np.int64) for x in items], [item_seeds(x).view(np.int64) for x in items])


DOCS = pa.schema([("row", pa.binary()), ("doc_id", pa.int64()), ("words", pa.list_(pa.int64())),
                  ("seeds", pa.list_(pa.int64()))])


def _touched(sieve):
    """(row, doc_id, t) -> words and possible seeds of the texts that have any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, lower, bits = alnum_table(), lower_table(), sieve.value
        for b in slices(batches, "t"):
            w, doc, line = word_hashes(*text_bytes(b.column(2)), inside, lower)
            g = seed_hashes(w)
            inner = doc[:len(g)] == doc[MIN_TILE - 1:][:len(g)]
            short, of = short_lines(w, doc, line)
            g, of = np.concatenate([g[inner], short]), np.concatenate([doc[:len(g)][inner], of])
            hit = in_sieve(bits, g)
            if not hit.any():
                continue
            g, of = g[hit], of[hit]
            order = np.argsort(of, kind="stable")
            g, of = g[order], of[order]
            texts = np.unique(of)
            at = np.searchsorted(doc, np.arange(b.num_rows + 1))
            cut = np.searchsorted(of, np.arange(b.num_rows + 1))
            pick = pa.array(texts)
            yield table(DOCS, b.column(0).take(pick), b.column(1).take(pick),
                        [w[at[i]:at[i + 1]].view(np.int64) for i in texts],
                        [np.unique(g[cut[i]:cut[i + 1]]).view(np.int64) for i in texts])
    return run


# --- tiling -------------------------------------------------------------------------

def _windows(h: np.ndarray, free: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the s-word runs without a marked word, and their places."""
    n = len(h) - s + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(taken[s:] == taken[:n])
    return Rolling(h, 0x2545F4914F6CDD1D).ranges(at, at + s), at


def tiles(doc: np.ndarray, item: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """(place in item, place in doc, words) of the tiles: longest matches first, no
    word in two tiles. Every match is compared word by word after its hash."""
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    out: list[tuple[int, int, int]] = []
    s = max(least, min(len(item), len(doc)))
    while len(item) >= least and len(doc) >= least:
        hi, ai = _windows(item, free_i, s)
        hd, ad = _windows(doc, free_d, s)
        order = np.argsort(hi, kind="stable")
        hi, ai = hi[order], ai[order]
        lo, up = np.searchsorted(hi, hd, side="left"), np.searchsorted(hi, hd, side="right")
        found = []
        for d in np.flatnonzero(up > lo).tolist():
            for i in ai[lo[d]:up[d]].tolist():
                j = int(ad[d])
                if i and j and free_i[i - 1] and free_d[j - 1] and item[i - 1] == doc[j - 1]:
                    continue                           # part of a match that begins earlier
                n = min(len(item) - i, len(doc) - j)
                same = (item[i:i + n] == doc[j:j + n]) & free_i[i:i + n] & free_d[j:j + n]
                n = n if same.all() else int(same.argmin())
                if n >= s:
                    found.append((n, i, j))
        found.sort(key=lambda m: (-m[0], m[1], m[2]))
        cut = False
        for n, i, j in found:
            if free_i[i:i + n].all() and free_d[j:j + n].all():
                free_i[i:i + n] = free_d[j:j + n] = False
                out.append((i, j, n))
            else:
                cut = True                             # what is left of it is searched again
        if cut:
            continue
        if s == least:
            break
        s = max(least, s // 2)
    return out


MATCHES = pa.schema([("row", pa.binary()), ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int64()),
                     ("n_matched", pa.int64()), ("n_tiles", pa.int64())])


def can_reach(doc: np.ndarray, item: np.ndarray, threshold: float) -> bool:
    """A tile of n words holds at least n / MIN_TILE of the item's seeds."""
    if len(item) < MIN_TILE:
        return len(item) > 0                           # joined on the whole of it
    return int(np.isin(item_seeds(item), seed_hashes(doc)).sum()) * MIN_TILE >= threshold * len(item)


def _tile(threshold: float):
    """(row, doc_id, item_id, words, item) -> matches of the pairs that can reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                doc, item = (b.column(c)[r].values.to_numpy().view(np.uint64) for c in (3, 4))
                if can_reach(doc, item, threshold):
                    got = tiles(doc, item, min(MIN_TILE, len(item)))
                    out.append((r, len(item), sum(t[2] for t in got), len(got)))
            if out:
                at, *counts = zip(*out)
                pick = pa.array(at, pa.int64())
                yield table(MATCHES, *(b.column(c).take(pick) for c in range(3)), *map(list, counts))
    return run


def rare_seeds(items: DataFrame, touched: DataFrame, threshold: float) -> DataFrame:
    """``(at, seed)``: every item's seeds but the most frequent ones among the documents. Of the
    s seeds (by place) of an item, a pair at the threshold shares r = words * threshold /
    MIN_TILE or more, so it shares one of any s - r + 1."""
    often = touched.select("row", F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count("*").alias("often"))
    placed = items.select("at", F.size("item").alias("n"), F.explode("seeds").alias("seed")).join(often, "seed")
    # seeds that no document has are the rarest: they take places in the prefix, not rows
    held = placed.groupBy("at", "n").agg(F.array_sort(F.collect_list(F.struct("often", "seed"))).alias("held"))
    least = F.greatest(F.ceil(F.col("n") * F.lit(threshold) / MIN_TILE - F.lit(1e-9)), F.lit(1)).cast("int")
    keep = F.greatest(F.size("held") - least + 1, F.lit(0))
    return held.select("at", F.explode(F.slice("held", F.lit(1), keep)).alias("s")).select("at", "s.seed").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """``(row, doc_id, item_id, n_words, n_matched, n_tiles, coverage)`` for every pair
    of a document and a benchmark item with coverage of ``threshold`` or more; ``row``
    is row_key(doc_id, text).

    Null texts have no words, items without words match nothing; one of under five words
    matches texts with a line of just its words. Rows equal in
    doc_id and text give one set of pairs; repeated items each give theirs. Other
    columns are ignored. Either table empty: empty."""
    spark = docs.sparkSession
    items = shared_table(benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                          F.col("text").cast("string").alias("t"))
                         .mapInArrow(_items, "item_id long, item array<long>, seeds array<long>")
                         .withColumn("at", F.xxhash64("item_id", "item")).dropDuplicates(["item_id", "item"]))
    sieve = spark.sparkContext.broadcast(sieve_of(items.select(F.explode("seeds").alias("seed")), "seed"))
    touched = shared_table(docs.select(row_key("doc_id", "text").alias("row"),
                                       F.col("doc_id").cast("long").alias("doc_id"),
                                       F.col("text").cast("string").alias("t"))
                           .mapInArrow(_touched(sieve), "row binary, doc_id long, words array<long>, seeds array<long>"))
    pairs = touched.select("row", F.explode("seeds").alias("seed")) \
        .join(rare_seeds(items, touched, threshold), "seed").select("row", "at").distinct()
    both = (pairs.join(touched.dropDuplicates(["row"]).drop("seeds"), "row")
            .join(items.drop("seeds"), "at").select("row", "doc_id", "item_id", "words", "item"))
    return both.mapInArrow(_tile(threshold), "row binary, doc_id long, item_id long, n_words long, n_matched long, n_tiles long") \
        .withColumn("coverage", F.col("n_matched") / F.col("n_words")).where(F.col("coverage") >= threshold)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE) -> DataFrame:
    """``docs`` without the rows that cover a benchmark item; columns as in ``docs``."""
    name = unused(docs, "_row")
    found = shared_table(contamination(docs, benchmark, threshold).select(F.col("row").alias(name)).distinct())
    return docs.withColumn(name, row_key("doc_id", "text")).join(found, name, "left_anti").select(*docs.columns)
