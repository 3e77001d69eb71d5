"""Periodic runs of words, found at scales.

A run is a stretch with smallest period q, MIN_POWER * q words or more, that no
neighbouring word extends. Period octave k (2^k <= q < 2^(k+1)) sees a text as cells of 2^k words, and
a run of that octave holds whole cells. So for each cell and period of the octave:

* the cell must recur q words on: names of all 2^k-word blocks, made from the names of
  their halves, tell it for every place in one array comparison;
* the boundary Z-functions give how far the match goes on to the left of the first
  such cell and to the right of the last: common prefixes and suffixes of the text and
  its shift by q at a cell boundary, by descending through the shorter blocks' names.

A long text is exploded into overlapping tiles, wider for higher octaves, which Spark
deals out; each is solved alone, and the fragments meet again by document and period,
where those that touch are stitched. A text of one tile needs no exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, row_key, slices, space_table, text_bytes, word_spans

MIN_WORDS = 6
MIN_POWER = 4             # at least: the scales rest on it
TILE_OCTAVE = 12          # highest octave of the smallest tiles, whose cores are 8 of its cells
TILE = 8 << TILE_OCTAVE   # 32,768 words
SHORT_BYTES = 2 * TILE    # a text of so many bytes has TILE words at most
NAME = np.uint64(0x9E3779B97F4A7C15)

RUN_DDL = "array<struct<start:long,length:long,period:long>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.string()), ("runs", RUN_TYPE)])
RESULT_DDL = f"doc_id long, n_words long, text string, runs {RUN_DDL}"
TILES = pa.schema([("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32()), ("at", pa.int64()),
                   ("lo", pa.int64()), ("hi", pa.int64()), ("ids", pa.binary())])
TILES_DDL = "key binary, first int, last int, at long, lo long, hi long, ids binary"
PARTS = pa.schema([("key", pa.binary()), ("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
PARTS_DDL = "key binary, period long, start long, stop long"


# --- task side: words -----------------------------------------------------------

class Words:
    """The words of a batch of texts: bounds, text and an id (equal for equal words of the batch)."""

    def __init__(self, col: pa.Array):
        inside = space_table()
        self.data, self.offsets = text_bytes(col)
        self.s, self.e, self.text = word_spans(self.data, self.offsets, inside)
        self.mask = inside[self.data]
        self.per_text = np.bincount(self.text, minlength=len(col))
        size = self.e - self.s
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(size), [
            None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.data[self.mask]))])
        self.ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)

    def joined(self, dropped: np.ndarray) -> pa.Array:
        """Each text's words that are not ``dropped``, joined by one space."""
        kept = np.flatnonzero(~dropped)
        out, mask = self.data.copy(), self.mask
        if len(kept) < len(dropped):
            step = np.zeros(len(out) + 1, np.int8)
            np.add.at(step, self.s[kept], 1)
            np.add.at(step, self.e[kept], -1)
            mask = np.cumsum(step[:-1], dtype=np.int8) > 0
        else:
            mask = mask.copy()
        more = kept[:-1][self.text[kept[:-1]] == self.text[kept[1:]]] if len(kept) else kept
        out[self.e[more]] = 0x20                       # white space, as another word of the text follows
        mask[self.e[more]] = True
        ends = np.concatenate([[0], np.cumsum(mask)])[self.offsets].astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [
            None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(out[mask]))]).cast(pa.string())


# --- task side: runs --------------------------------------------------------------

class Scales:
    """Names of the 2^t-word blocks at every place, for all octaves t that are asked for."""

    def __init__(self, ids: np.ndarray):
        self.names = [mix(ids.astype(np.uint64) + NAME)]
        self.factor: np.ndarray | None = None

    def of(self, t: int) -> np.ndarray:
        while len(self.names) <= t:
            half, low = 1 << (len(self.names) - 1), self.names[-1]
            up = np.zeros(len(low), np.uint64)
            if half < len(low):
                up[:-half] = mix(low[:-half] * NAME + low[half:])
            self.names.append(up)
        return self.names[t]

    def agree(self, t: int, a: np.ndarray, b: np.ndarray, ok: np.ndarray) -> np.ndarray:
        names, last = self.of(t), len(self.names[0]) - 1
        return ok & (names[np.clip(a, 0, last)] == names[np.clip(b, 0, last)])

    def right(self, k: int, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Z-function to the right: the common prefix at a and b > a, under 2^k words, up to ``end``."""
        n = np.zeros(len(a), np.int64)
        for t in range(k - 1, -1, -1):
            n += self.agree(t, a + n, b + n, b + n + (1 << t) <= end).astype(np.int64) << t
        return n

    def left(self, k: int, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Z-function to the left: the common suffix before a < b, under 2^k words, from ``start``."""
        n = np.zeros(len(a), np.int64)
        for t in range(k - 1, -1, -1):
            step = 1 << t
            n += self.agree(t, a - n - step, b - n - step, a - n - step >= start).astype(np.int64) << t
        return n

    def primitive(self, k: int, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the q words at ``at`` (2^k <= q < 2^(k+1)) are no repetition of fewer words.
        If they are, the run has a smaller period; else q is its smallest."""
        if self.factor is None or len(self.factor) < 2 << k:
            self.factor = smallest_factors(2 << k)
        ok, rest = np.ones(len(q), bool), q.copy()
        while len(live := np.flatnonzero(rest > 1)):
            r = self.factor[rest[live]]
            a, d = at[live], q[live] // r
            size = q[live] - d
            t = np.frexp(size.astype(np.float64))[1] - 1
            for level in np.unique(t).tolist():
                x = np.flatnonzero(t == level)
                i, n, shift, step = a[x], size[x], d[x], 1 << level
                yes = np.ones(len(x), bool)
                ok[live[x]] &= ~(self.agree(level, i, i + shift, yes)
                                 & self.agree(level, i + n - step, i + n - step + shift, yes))
            rest[live] //= r
            while len(more := live[rest[live] % r == 0]):
                r = r[rest[live] % r == 0]
                live = more
                rest[live] //= r
        return ok


def smallest_factors(n: int) -> np.ndarray:
    f = np.arange(n, dtype=np.int64)
    for p in range(2, int(n ** 0.5) + 1):
        if f[p] == p:
            multiples = f[p * p::p]
            multiples[multiples > p] = np.minimum(multiples[multiples > p], p)
    return f


def matches(ids: np.ndarray, sizes: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: int, last: int,
            tiles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, period, start, stop) of the stretches of places whose word recurs a
    period later, for segments of ``sizes`` words one after the other. Cells start in
    [lo, hi) of their segment. Without ``tiles`` the stretches are whole, and only those
    of runs are given; else also those that reach the first or last cell."""
    scales = Scales(ids)
    start = np.cumsum(sizes) - sizes
    seg = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(ids))
    inner = place - start[seg]
    found = []
    k = 0
    while k <= last:
        size = 1 << k
        n = sizes[seg[place]]
        live = (inner >= size) & (inner + size <= n) & (n >= (2 if tiles else MIN_POWER) * size)
        place, inner = place[live], inner[live]
        if not len(place):
            break
        if k < first:
            k += 1
            continue
        names = scales.of(k)
        cell = ((inner >> k) - 1) << k
        at = place - inner + cell
        hit = names[at] == names[place]
        if tiles:
            hit &= (cell >= lo[seg[place]]) & (cell < hi[seg[place]])
        a, b, cell = at[hit], place[hit], cell[hit]
        if len(a):
            of = seg[a]
            end = start[of] + sizes[of]
            at_lo, at_hi = cell - size < lo[of], cell + size >= hi[of]
            yes = ~at_lo
            is_first = ~scales.agree(k, a - size, b - size, yes)
            is_last = ~scales.agree(k, a + size, b + size, ~at_hi & (b + 2 * size <= end))
            f, g = np.flatnonzero(is_first), np.flatnonzero(is_last)
            f = f[np.lexsort((a[f], b[f] - a[f]))]
            g = g[np.lexsort((a[g], b[g] - a[g]))]
            q = b[f] - a[f]
            begin = a[f] - scales.left(k, a[f], b[f], start[of[f]])
            stop = a[g] + size + scales.right(k, a[g] + size, b[g] + size, end[g])
            keep = stop - begin + q >= np.maximum(MIN_WORDS, MIN_POWER * q)
            if tiles:
                keep |= at_lo[f] | at_hi[g]
            keep = np.flatnonzero(keep)
            keep = keep[scales.primitive(k, begin[keep], q[keep])]
            base = start[of[f[keep]]]
            found.append((of[f[keep]], q[keep], begin[keep] - base, stop[keep] - base))
        k += 1
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*found))


def run_lists(n: int, seg: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    by = np.lexsort((period, start, seg))
    cuts = np.searchsorted(seg[by], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(
        [pa.array(start[by]), pa.array(length[by]), pa.array(period[by])], ["start", "length", "period"])).cast(RUN_TYPE)


def result(ids: pa.Array, w: Words, seg: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray,
           ) -> pa.RecordBatch:
    first = np.cumsum(w.per_text) - w.per_text
    step = np.zeros(len(w.s) + 1, np.int64)
    np.add.at(step, first[seg] + start + period, 1)
    np.add.at(step, first[seg] + start + length, -1)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(w.per_text), w.joined(np.cumsum(step[:-1]) > 0), run_lists(len(ids), seg, start, length, period)],
        schema=RESULT)


def _solve_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one tile each."""
    for b in slices(batches, "t"):
        w = Words(b.column(1))
        seg, q, start, stop = matches(w.ids, w.per_text, np.zeros(b.num_rows, np.int64), w.per_text, 0, 62, False)
        yield result(b.column(0), w, seg, start, stop - start + q, q)


def tiles_of(n: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(first octave, last octave, core start, window start, window end) of a text of n words."""
    first, last = 0, TILE_OCTAVE
    while MIN_POWER << first <= n:
        core = 8 << last
        for at in range(0, n, core):
            yield first, last, at, max(0, at - (1 << last)), min(n, at + core + (4 << last))
        first = last = last + 1


def _explode_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t", 1):                  # one text at a time
        w = Words(b.column(1))
        for first, last, core, lo, hi in tiles_of(len(w.ids)):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([first], pa.int32()), pa.array([last], pa.int32()), pa.array([lo]),
                 pa.array([core - lo]), pa.array([core - lo + (8 << last)]),
                 pa.array([w.ids[lo:hi].tobytes()], pa.binary())], schema=TILES)


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "ids", 1):                # one tile at a time
        first, last, at, lo, hi = (b.column(i)[0].as_py() for i in range(1, 6))
        ids = np.frombuffer(b.column(6)[0].as_py(), np.int32)
        _, q, start, stop = matches(ids, np.array([len(ids)]), np.array([lo]), np.array([hi]), first, last, True)
        yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[0].as_py()] * len(q), pa.binary()), pa.array(q),
                                          pa.array(start + at), pa.array(stop + at)], schema=PARTS)


def _drop_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "t", 1):
        w = Words(b.column(1))
        runs = b.column(2)[0].as_py() or []
        s, n, q = (np.array([r[c] for r in runs], np.int64) for c in ("start", "length", "period"))
        yield result(b.column(0), w, np.zeros(len(runs), np.int64), s, n, q)


# --- Spark side -------------------------------------------------------------------

def stitch(parts: DataFrame) -> DataFrame:
    """(key, runs): fragments (key, period, start, stop) of a period that touch are one stretch."""
    w = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    islands = parts.distinct().withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("long")) \
        .withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")) \
        .withColumn("length", F.col("stop") - F.col("start") + F.col("period")) \
        .where(F.col("length") >= F.greatest(F.lit(MIN_WORDS), MIN_POWER * F.col("period")))
    return whole.groupBy("key").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_words, text (without the
    words that a run holds after its first period; words joined by one space), runs (by
    start, then period; words numbered from 0).

    Null text: no words, an empty text. Rows equal in doc_id and text get equal results.
    Other columns are ignored. No rows: empty. A text may have any length; a task that
    solves a tile holds some 8 bytes for each word and octave of it."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t"))
    long = F.octet_length("t") > SHORT_BYTES
    short = src.where(~F.coalesce(long, F.lit(False)))
    keyed = src.where(long).withColumn("key", row_key("doc_id", "t"))
    tiles = keyed.select("key", "t").dropDuplicates(["key"]).mapInArrow(_explode_tiles, TILES_DDL)
    parts = tiles.repartition("key", "first", "at").mapInArrow(_solve_tiles, PARTS_DDL)
    runs = keyed.join(stitch(parts), "key", "left").select("doc_id", "t", "runs")
    return short.mapInArrow(_solve_texts, RESULT_DDL).unionByName(runs.mapInArrow(_drop_repeats, RESULT_DDL))


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeats in about one text of ten: from word a on, p words over and over.
    A null doc_id or a text without words stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = h % 10 == 0
    cut = docs.withColumn("_words", F.when(chosen, words))
    g, n = F.floor(h / 10), F.size("_words").cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    unit = F.slice("_words", (a + 1).cast("int"), p.cast("int"))
    copies = F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice("_words", F.lit(1), a.cast("int")), F.slice(copies, F.lit(1), (n - a).cast("int")))
    return cut.withColumn("text", F.when(chosen & (n > 0), F.array_join(planted, " ")).otherwise(F.col("text"))).drop("_words")


def run_digests(found: DataFrame) -> DataFrame:
    """The runs of collapse_runs() as counts, the greatest run and digests."""
    def text(r: Column) -> Column:
        return F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))

    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", text), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))
