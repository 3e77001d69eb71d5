"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

A string of LENGTH bytes that starts in two places is found from the suffixes at
anchors. An anchor is the place whose GRAM bytes hash lowest (the last of equals) in
some LENGTH-byte window; it depends on the window's bytes alone, so equal windows
have their anchors at the same offset, and sorting the suffixes at anchors loses
nothing, with about one suffix in 75 bytes instead of every one. (The whole suffix
array of a corpus would move many times the corpus.)

1. Anchors whose gram hash occurs once are dropped by a count and a join.
2. Each task cuts the others' contexts out of the texts (the suffix to LENGTH bytes,
   then the bytes before the anchor, backwards), sorts them and emits front-coded
   runs, dealt by gram.
3. Each group's runs are merged by a loser tree that carries the length of the prefix
   each head shares with the last output, so no known prefix is compared again. The
   merge yields the common prefixes of neighbours.
4. A window at offset o before an anchor repeats if another context agrees on o bytes
   to the left and LENGTH - o to the right: same class in both orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HASH_BASE, mix, powers, runs_of, shared_table, slices, table, text_bytes

LENGTH = 200
GRAM = 50                 # bytes hashed at an anchor; LENGTH - GRAM + 1 grams in a window
SEGMENT = 1 << 21         # window starts handled at a time
RUN = 50_000              # contexts that a task sorts at a time
GROUP = 20_000            # contexts expected in a merge group
HOT = 50_000              # a gram with more places takes the path that deals out windows


# --- anchors -------------------------------------------------------------------------

def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n, step = len(a) - width + 1, 1
    while 2 * step <= width:
        a = np.minimum(a[:-step], a[step:])
        step *= 2
    return np.minimum(a[:n], a[width - step:width - step + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(place, gram hash) of the anchors of a batch of texts, by growing place."""
    places, hashes = [], []
    up = powers(min(len(data), SEGMENT + length), HASH_BASE)
    down = powers(min(len(data), SEGMENT + length), pow(HASH_BASE, -1, 1 << 64))
    low, width = np.uint64((1 << 24) - 1), length - gram + 1
    ends = offsets[1:]
    for c in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = data[c:c + SEGMENT + length - 1].astype(np.uint64)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * up[:len(part)], out=sums[1:])
        h = mix((sums[gram:] - sums[:-gram]) * down[:len(part) - gram + 1])
        at = np.arange(len(h), dtype=np.uint64)
        least = sliding_min((h & ~low) | (low - at), width)
        start = np.arange(len(least)) + c
        inside = start + length <= ends[np.searchsorted(ends, start, side="right")]
        flag = np.zeros(len(h), bool)
        flag[(low - (least[inside] & low)).astype(np.int64)] = True
        got = np.flatnonzero(flag)
        places.append(got + c)
        hashes.append(h[got])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h", pa.int64()), ("text", pa.binary()), ("at", pa.int32())])
    for b in slices(batches, "t"):
        data, offsets = text_bytes(b.column(1))
        place, h = anchors(data, offsets)
        doc = np.searchsorted(offsets, place, side="right") - 1
        yield table(schema, h.view(np.int64), b.column(0).take(pa.array(doc)), (place - offsets[doc]).astype(np.int32))


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h", pa.int64())])
    for b in slices(batches, "t"):
        yield table(schema, anchors(*text_bytes(b.column(0)))[1].view(np.int64))


# --- front-coded runs ------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are not looked at."""
    n = min(len(a), len(b))
    step = 64
    while step:
        while known + step <= n and a[known:known + step] == b[known:known + step]:
            known += step
        step >>= 1
    return known


# A context: suffix (to LENGTH bytes) + reversed bytes before it; ``right`` is the length of the first
RUNS = pa.schema([("grp", pa.int32()), ("shared", pa.binary()), ("size", pa.binary()), ("right", pa.binary()),
                  ("tails", pa.binary()), ("refs", pa.binary()), ("places", pa.binary()), ("texts", pa.binary())])
RUNS_DDL = ("grp int, shared binary, size binary, right binary, tails binary, refs binary, places binary, texts binary")


def front_coded(grp: int, contexts: dict[tuple[bytes, int], list[tuple[bytes, int]]]) -> tuple:
    """A sorted run: of each context only what its predecessor does not share."""
    shared, size, right, tails, refs, places, texts = [], [], [], [], [], [], []
    before = b""
    for key, r in sorted(contexts):
        n = common_prefix(before, key)
        shared.append(n)
        size.append(len(key) - n)
        right.append(r)
        tails.append(key[n:])
        who = contexts[key, r]
        refs.append(len(who))
        places += [p for _, p in who]
        texts += [t for t, _ in who]
        before = key
    u16 = lambda x: np.array(x, np.uint16).tobytes()
    return (grp, u16(shared), u16(size), u16(right), b"".join(tails), np.array(refs, np.uint32).tobytes(),
            np.array(places, np.int32).tobytes(), b"".join(texts))


def _context(raw: bytes, at: int) -> tuple[bytes, int]:
    suffix = raw[at:at + LENGTH]
    return suffix + raw[max(0, at - LENGTH + GRAM):at][::-1], len(suffix)


def _runs(groups: int):
    """(text, t, at, h) -> front-coded runs."""
    def flush(held: dict):
        rows = [front_coded(g, c) for g, c in held.items()]
        return table(RUNS, *map(list, zip(*rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        n = 0
        for b in slices(batches, "t"):
            for text, t, at, h in zip(*(c.to_pylist() for c in b.columns)):
                raw = t.encode()
                for a, g in zip(at, h):
                    held.setdefault(g % groups, {}).setdefault(_context(raw, a), []).append((text, a))
                    n += 1
                    if n >= RUN:
                        yield flush(held)
                        held, n = {}, 0
        if held:
            yield flush(held)
    return run


# --- merge --------------------------------------------------------------------------------

class Run:
    """A front-coded run, read once from the front."""

    def __init__(self, cols: tuple[bytes, ...]):
        shared, size, right, self.tails, refs, places, self.texts = cols
        self.shared, self.size, self.right = (np.frombuffer(x, np.uint16).tolist() for x in (shared, size, right))
        self.refs, self.places = np.frombuffer(refs, np.uint32).tolist(), np.frombuffer(places, np.int32).tolist()
        self.i = self.tail = self.ref = 0
        self.key: bytes | None = b""
        self.known = 0
        self.step()

    def step(self) -> None:
        """To the next context; ``known`` is what it shares with the one before."""
        if self.i == len(self.size):
            self.key = None
            return
        self.known, n = self.shared[self.i], self.size[self.i]
        self.key = self.key[:self.known] + self.tails[self.tail:self.tail + n]
        self.tail += n
        self.now_right, k = self.right[self.i], self.refs[self.i]
        self.now = [(self.texts[16 * j:16 * j + 16], self.places[j]) for j in range(self.ref, self.ref + k)]
        self.ref += k
        self.i += 1


def merged(runs: list[Run]) -> Iterator[tuple[bytes, int, int, list]]:
    """(key, bytes shared with the last key, right, references) in order, by a loser
    tree. A loser remembers how much it shares with the head that beat it; heads that
    share different lengths with the last output are ordered by those alone, and only
    equal ones are compared, from that length on."""
    size = 1
    while size < len(runs):
        size *= 2
    known = [0] * size
    heads = [*runs, *[None] * (size - len(runs))]

    def beats(a: int, b: int) -> bool:
        """Whether head a goes before b; the loser's known length becomes its share with the winner."""
        x = heads[a].key if heads[a] else None
        y = heads[b].key if heads[b] else None
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        n = common_prefix(x, y, known[a])
        first = len(x) == n or (len(y) > n and x[n] < y[n])
        known[b if first else a] = n
        return first

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    top = winners[1]
    while heads[top] is not None and heads[top].key is not None:
        r = heads[top]
        yield r.key, known[top], r.now_right, r.now
        r.step()
        known[top] = r.known
        node = (top + size) // 2
        while node:
            if not beats(top, losers[node]):
                top, losers[node] = losers[node], top
            node //= 2


def repeated(runs: list[Run]) -> Iterator[tuple[list, int, int]]:
    """(references, from, to): bytes that repeat around the anchors of a context, as
    offsets from the anchor."""
    keys, shared, right, refs = [], [], [], []
    for key, n, r, who in merged(runs):
        if keys and key == keys[-1] and r == right[-1]:
            refs[-1] = refs[-1] + who
        else:
            keys.append(key)
            shared.append(n)
            right.append(r)
            refs.append(who)
    m = len(keys)
    if not m:
        return
    refs = [list(dict.fromkeys(w)) for w in refs]
    many = np.array([len(w) > 1 for w in refs])
    right = np.array(right)
    lefts = [k[r:] for k, r in zip(keys, right.tolist())]
    left = np.array([len(x) for x in lefts])
    shared = np.array(shared)
    by = sorted(range(m), key=lefts.__getitem__)
    before = [0, *(common_prefix(lefts[a], lefts[b]) for a, b in zip(by, by[1:]))]
    by, before = np.array(by), np.array(before)
    highest, lowest = np.full(m, -1), np.full(m, -1)
    highest[many], lowest[many] = left[many], np.maximum(0, LENGTH - right[many])
    off = many & (lowest > left)
    highest[off] = lowest[off] = -1
    lc = np.empty(m, np.int64)
    if m > 1:
        for o in range(LENGTH - GRAM + 1):
            fits = np.flatnonzero((left >= o) & (right >= LENGTH - o))
            if len(fits) < 2:
                continue
            rc = np.cumsum(shared < LENGTH - o)
            lc[by] = np.cumsum(before < o)
            code = rc[fits] * (m + 1) + lc[fits]
            order = np.argsort(code, kind="stable")
            at, n = runs_of(code[order])
            hit = fits[order[np.repeat(n > 1, n)]]
            hit = hit[~many[hit]]
            highest[hit] = o
            lowest[hit] = np.where(lowest[hit] < 0, o, lowest[hit])
    for i in np.flatnonzero(highest >= 0):
        yield refs[i], -int(highest[i]), LENGTH - int(lowest[i])


SPANS = pa.schema([("text", pa.binary()), ("start", pa.int32()), ("stop", pa.int32())])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by group -> repeated spans of texts."""
    def spans(runs: list[Run]):
        text, start, stop = [], [], []
        for who, a, b in repeated(runs):
            for t, p in who:
                text.append(t)
                start.append(p + a)
                stop.append(p + b)
        if text:
            yield table(SPANS, text, start, stop)

    grp, runs = None, []
    for b in batches:
        for g, *cols in zip(*(c.to_pylist() for c in b.columns)):
            if g != grp:
                yield from spans(runs)
                grp, runs = g, []
            runs.append(Run(tuple(cols)))
    yield from spans(runs)


# --- grams with very many places ----------------------------------------------------------

def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, t, at) -> every window around the anchors: digest and start."""
    schema = pa.schema([("window", pa.binary()), ("text", pa.binary()), ("start", pa.int32())])
    for b in slices(batches, "t", 1 << 17):
        win, text, start = [], [], []
        for key, t, at in zip(*(c.to_pylist() for c in b.columns)):
            raw = t.encode()
            for s in sorted({a - o for a in at for o in range(LENGTH - GRAM + 1)}):
                if 0 <= s <= len(raw) - LENGTH:
                    win.append(hashlib.md5(raw[s:s + LENGTH]).digest())
                    text.append(key)
                    start.append(s)
        yield table(schema, win, text, start)


# --- Spark flow -----------------------------------------------------------------------------

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, t, spans) -> what is left of each text."""
    schema = pa.schema([("text", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept_sha256", pa.string()), ("starts", pa.list_(pa.int32())), ("stops", pa.list_(pa.int32()))])
    for b in slices(batches, "t"):
        out = []
        for key, t, spans in zip(*(c.to_pylist() for c in b.columns)):
            raw, whole = t.encode(), []
            for s, e in sorted((x["start"], x["stop"]) for x in spans):
                if whole and s <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], e)
                else:
                    whole.append([s, e])
            sha, at = hashlib.sha256(), 0
            for s, e in whole:
                sha.update(raw[at:s])
                at = e
            sha.update(raw[at:])
            out.append((key, sum(e - s for s, e in whole), len(whole), sha.hexdigest(),
                        [s for s, _ in whole], [e for _, e in whole]))
        yield table(schema, *map(list, zip(*out)))


def _text_key(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_bytes, n_removed,
    n_spans, kept_sha256 (of the bytes that stay), and starts, stops of the removed runs
    (bytes of the UTF-8 text).

    Null text: no bytes. Equal texts are worked on once; every one of LENGTH bytes or
    more goes whole, as its copy has all its strings. Null or repeated doc_ids do no
    harm; other columns are ignored. No rows: empty."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    keyed = src.withColumn("text", _text_key("t"))
    rows = shared_table(keyed.select("doc_id", "text", F.octet_length("t").cast("long").alias("n_bytes"),
                                     F.sha2("t", 256).alias("sha")))
    copies = rows.groupBy("text").agg(F.count("*").alias("copies"))
    places = keyed.select("text", "t").mapInArrow(_anchor_rows, "h long, text binary, at int")
    often = keyed.select("t").mapInArrow(_anchor_hashes, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    found = shared_table(places.join(often, "h").select("text", "at", "h", (F.col("n") > HOT).alias("hot")).distinct()
                         .groupBy("text", "hot").agg(F.collect_list(F.struct("at", "h")).alias("found")))
    counts = {r["hot"]: r["n"] for r in found.groupBy("hot").agg(F.sum(F.size("found")).alias("n")).collect()}
    texts = keyed.select("text", "t").dropDuplicates(["text"])
    of = found.select("text", "hot", F.col("found.at").alias("at"), F.col("found.h").alias("h"))
    runs = texts.join(of.where("not hot"), "text").select("text", "t", "at", "h") \
        .mapInArrow(_runs(max(1, counts.get(False, 0) // GROUP)), RUNS_DDL)
    spans = runs.repartition("grp").sortWithinPartitions("grp").mapInArrow(_merge, "text binary, start int, stop int")
    if counts.get(True):
        windows = texts.join(of.where("hot"), "text").select("text", "t", "at") \
            .mapInArrow(_windows, "window binary, text binary, start int").distinct()
        twice = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1")
        spans = spans.union(windows.join(twice, "window").select("text", "start", (F.col("start") + LENGTH).alias("stop")))
    single = copies.where("copies = 1").select("text")
    spans = spans.groupBy("text").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).join(single, "text", "left_semi")
    cut = texts.join(spans, "text").select("text", "t", "spans").mapInArrow(
        _cut, "text binary, n_removed long, n_spans long, kept_sha256 string, starts array<int>, stops array<int>")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    none = F.array().cast("array<int>")
    return rows.join(copies, "text").join(cut, "text", "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.array(F.lit(0))).otherwise(F.coalesce("starts", none)).alias("starts"),
        F.when(whole, F.array(F.col("n_bytes").cast("int"))).otherwise(F.coalesce("stops", none)).alias("stops"))
