"""Phrase collocations, counted in quotient filters.

Words are numbered by a dictionary that no task holds whole: texts are encoded in
shards with a dictionary each, the shards' entries meet in one table of the frequent
words, and each shard gets back the numbers of its own entries. A phrase is then a
pack of word ids. An invertible permutation (a Feistel network) spreads the packs
evenly; the top bits are the quotient, which only place tells, and all other bits the
remainder, kept in full, so a filter is a lossless counter of about five bytes an entry. Tasks
write sorted filters by ranges of quotients, and the filters of a range are merged in
one sorted pass.

A phrase can only be frequent if its parts are: words under the limit end phrases
before any counting, and a bitmap of the frequent pairs spares longer phrases with
another pair in them. The bitmap has a fixed size; what it lets pass is counted exactly.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_table, mix, runs_of, shared_table, slices, table, text_bytes, word_spans

MIN_COUNT = 30
LONGEST = 4
TOP = 2000
COVERED_PCT = 80
SHARD_BYTES = 3 << 20     # of text with a dictionary of its own
FLUSH = 1 << 19           # packed phrases that a task holds
RANGE_WORDS = 1 << 20     # words of the corpus for each range of quotients, at least
PAIR_BITS = 27            # the bitmap of frequent pairs: 16 MB
PAIR_SLICES = 64
BREAK = -1
ROUNDS = 4
SALT = np.uint64(0xD1342543DE82EF95)
SALTS = 64                # partial rankings of a language

# What ends a piece, what ends a word in it
PIECE_ENDS = [ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]
WORD_ENDS = [0x20, 0x09]


# --- phrases as packed ids, permuted ---------------------------------------------

class Packing:
    """Phrases of n words as two halves of h bits each."""

    def __init__(self, n: int, bits: int):
        self.n, self.bits, self.h = n, bits, n * bits // 2
        self.mask = np.uint64((1 << self.h) - 1)

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        b, w = np.uint64(self.bits), [x.astype(np.uint64) for x in ids]
        if self.n == 2:
            return w[0], w[1]
        if self.n == 4:
            return w[0] << b | w[1], w[2] << b | w[3]
        half = np.uint64(self.bits // 2)
        low = np.uint64((1 << (self.bits // 2)) - 1)
        return w[0] << half | w[1] >> half, (w[1] & low) << b | w[2]

    def unpack(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        b, one = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        if self.n == 2:
            return [left, right]
        if self.n == 4:
            return [left >> b, left & one, right >> b, right & one]
        half = np.uint64(self.bits // 2)
        low = np.uint64((1 << (self.bits // 2)) - 1)
        return [left >> half, (left & low) << half | right >> b, right & one]

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right * SALT + np.uint64(r)) & self.mask)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for r in range(ROUNDS - 1, -1, -1):
            left, right = right ^ (mix(left * SALT + np.uint64(r)) & self.mask), left
        return left, right

    def count(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None,
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct (left, right) with the sums of their counts."""
        if 2 * self.h <= 64:
            key = left << np.uint64(self.h) | right
            order = None if counts is None else np.argsort(key, kind="stable")
            key = np.sort(key) if order is None else key[order]
            at, size = runs_of(key)
            left, right = key[at] >> np.uint64(self.h), key[at] & self.mask
        else:
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            new = np.ones(len(left), bool)
            new[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(left)))
            left, right = left[at], right[at]
        if counts is not None:
            size = np.add.reduceat(counts[order], at) if len(at) else size
        return left, right, size


def bytes_for(bits: int) -> int:
    return (bits + 7) // 8


def cut_bytes(x: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def whole_words(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = raw.reshape(n, width)
    return out.reshape(-1).view("<u8")


def to_filter(p: Packing, top: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
    """A quotient filter of the sorted entries of one range (their first ``top`` bits are
    the range's). Quotients are told by a bit for each entry and quotient, remainders
    are kept in whole bytes, counts in one byte, or nine from 255 on."""
    n = len(left)
    q = min(max(1, n.bit_length()), p.h - top)
    low = p.h - top - q
    quotient = (left >> np.uint64(low)) & np.uint64((1 << q) - 1)
    places = np.zeros(n + (1 << q), np.uint8)
    places[np.arange(n) + quotient.astype(np.int64)] = 1
    rest = left & np.uint64((1 << low) - 1)
    big = counts[counts >= 255]
    head = np.array([n, q, len(big)], "<u8").tobytes()
    return b"".join([head, np.packbits(places).tobytes(), cut_bytes(rest, bytes_for(low)),
                     cut_bytes(right, bytes_for(p.h)), np.minimum(counts, 255).astype(np.uint8).tobytes(),
                     big.astype("<u8").tobytes()])


def from_filter(p: Packing, top: int, number: int, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(blob, np.uint8)
    n, q, big = (int(x) for x in raw[:24].view("<u8"))
    low = p.h - top - q
    at = 24

    def take(size: int) -> np.ndarray:
        nonlocal at
        at += size
        return raw[at - size:at]

    places = np.unpackbits(take(bytes_for(n + (1 << q))), count=n + (1 << q))
    quotient = (np.flatnonzero(places) - np.arange(n)).astype(np.uint64)
    rest = whole_words(take(n * bytes_for(low)), n, bytes_for(low))
    right = whole_words(take(n * bytes_for(p.h)), n, bytes_for(p.h))
    counts = take(n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * big).tobytes(), "<u8")
    left = (np.uint64(number) << np.uint64(p.h - top) if top else np.uint64(0)) | quotient << np.uint64(low) | rest
    return left, right, counts


# --- task side ----------------------------------------------------------------------

SHARDS = pa.schema([("shard", pa.int64()), ("words", pa.list_(pa.string())), ("langs", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64())), ("seq", pa.binary())])
SHARDS_DDL = "shard long, words array<string>, langs array<string>, counts array<long>, seq binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards: the distinct (lang, word) of some texts with their counts, and the texts as
    places in that list, with BREAK between pieces."""
    inside, ends_piece, lower = np.ones(256, bool), np.zeros(256, bool), lower_table()
    ends_piece[PIECE_ENDS] = True
    inside[PIECE_ENDS + WORD_ENDS] = False
    for b in slices(batches, "t", SHARD_BYTES):
        data, offsets = text_bytes(b.column(1))
        data = lower[data]
        s, e, text = word_spans(data, offsets, inside)
        if not len(s):
            continue
        ends = np.concatenate([[0], np.cumsum(e - s)]).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(s), [
            None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[inside[data]]))]).dictionary_encode()
        langs = b.column(0).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        pairs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(langs.dictionary) + lang
        distinct, local, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        piece = np.searchsorted(np.flatnonzero(ends_piece[data]), s)
        cut = np.flatnonzero((piece[1:] != piece[:-1]) | (text[1:] != text[:-1])) + 1
        seq = np.insert(local.astype(np.int32), cut, BREAK)
        columns = [coded.dictionary.take(pa.array(distinct // len(langs.dictionary))).cast(pa.string()),
                   langs.dictionary.take(pa.array(distinct % len(langs.dictionary))).cast(pa.string()), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int.from_bytes(os.urandom(8), "little", signed=True)]),
             *(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c).cast(SHARDS.field(i).type)
               for i, c in enumerate(columns, 1)), pa.array([seq.tobytes()], pa.binary())], schema=SHARDS)


ENCODED = pa.schema([("ids", pa.binary())])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with ids in place of places; words without one end pieces, and words alone go."""
    for b in slices(batches, "seq", 1):
        seq = np.frombuffer(b.column(0)[0].as_py(), np.int32)
        known = b.column(1)[0].values
        to = np.full(max(int(seq.max(initial=0)), 0) + 2, BREAK, np.int64)     # the last place: a break's
        to[known.field(0).to_numpy(zero_copy_only=False)] = known.field(1).to_numpy(zero_copy_only=False)
        ids = to[seq]
        real = np.concatenate([[False], ids != BREAK, [False]])
        keep = real[1:-1] & (real[:-2] | real[2:])
        keep |= np.concatenate([[False], keep[:-1]]) & ~real[1:-1]             # one break after a kept word
        yield table(ENCODED, [ids[keep].astype("<i8").astype("<u4").tobytes()])


FILTERS = pa.schema([("n", pa.int32()), ("range", pa.int32()), ("filter", pa.binary())])
FILTERS_DDL = "n int, range int, filter binary"


def _count(lengths: list[int], bits: int, top: int, pairs: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packing = {n: Packing(n, bits) for n in lengths}
        held: dict[int, list] = {n: [] for n in lengths}

        def flush(n: int) -> Iterator[pa.RecordBatch]:
            p, parts = packing[n], held[n]
            held[n] = []
            if not parts:
                return
            left, right, size = p.count(*(np.concatenate(x) for x in zip(*parts)))
            first = left >> np.uint64(p.h - top) if top else np.zeros(len(left), np.uint64)
            at, long = runs_of(first)
            for i, k in zip(at.tolist(), long.tolist()):
                yield table(FILTERS, [n], [int(first[i])],
                            [to_filter(p, top, left[i:i + k], right[i:i + k], size[i:i + k])])

        for b in slices(batches, "ids", 1):
            ids = np.frombuffer(b.column(0)[0].as_py(), "<u4")
            word = ids != np.uint32(0xFFFFFFFF)
            joint = word[:-1] & word[1:]
            if pairs is not None:
                joint &= in_pairs(pairs, ids[:-1], ids[1:])
            for n in lengths:
                ok = joint
                for j in range(1, n - 1):
                    ok = ok[:-1] & joint[j:len(joint)]
                at = np.flatnonzero(ok)
                for cut in range(0, len(at), FLUSH):
                    part = at[cut:cut + FLUSH]
                    p = packing[n]
                    held[n].append(p.permute(*p.pack([ids[part + j] for j in range(n)])))
                    if sum(len(x[0]) for x in held[n]) >= FLUSH:
                        yield from flush(n)
        for n in lengths:
            yield from flush(n)
    return run


GRAMS_DDL = "gram binary, f long"
GRAMS = pa.schema([("gram", pa.binary()), ("f", pa.int64())])


def _merge(bits: int, top: int, least: int):
    def run(key, filters):
        n, number = (k.as_py() for k in key)
        p = Packing(n, bits)
        left, right, counts = (np.concatenate(x) for x in zip(
            *(from_filter(p, top, number, x.as_py()) for x in filters.column("filter"))))
        left, right, counts = p.count(left, right, counts)
        often = counts >= least
        ids = p.unpack(*p.restore(left[often], right[often]))
        grams = np.stack(ids, axis=1).astype(">u4").tobytes() if often.any() else b""
        ends = np.arange(int(often.sum()) + 1, dtype=np.int32) * 4 * n
        return pa.table([pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(grams)]),
                         pa.array(counts[often])], schema=GRAMS)
    return run


def pair_slots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) >> np.uint64(64 - PAIR_BITS)


def in_pairs(bitmap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    slot = pair_slots(a, b)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


SLOTS = pa.schema([("slice", pa.int32()), ("slots", pa.binary())])


def _pair_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    per = np.uint64((1 << PAIR_BITS) // PAIR_SLICES)
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.frombuffer(b"".join(b.column(0).to_pylist()), ">u4").reshape(-1, 2)
        slots = np.unique(pair_slots(ids[:, 0], ids[:, 1]))
        at, size = runs_of(slots // per)
        for i, n in zip(at.tolist(), size.tolist()):
            yield table(SLOTS, [int(slots[i] // per)], [(slots[i:i + n] % per).astype("<u4").tobytes()])


def _pair_slice(key, rows):
    bits = np.zeros((1 << PAIR_BITS) // PAIR_SLICES, np.uint8)
    for x in rows.column("slots"):
        bits[np.frombuffer(x.as_py(), "<u4")] = 1
    return pa.table([pa.array([key[0].as_py()], pa.int32()),
                     pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], schema=SLOTS)


# --- Spark side ----------------------------------------------------------------------

def pair_bitmap(pairs: DataFrame) -> np.ndarray:
    """The bitmap of the pairs' slots, packed in slices by tasks; 16 MB reach the driver."""
    packed = pairs.select("gram").mapInArrow(_pair_slots, "slice int, slots binary") \
        .groupBy("slice").applyInArrow(_pair_slice, "slice int, slots binary")
    out = np.zeros((1 << PAIR_BITS) // 8, np.uint8)
    per = len(out) // PAIR_SLICES
    for r in packed.toLocalIterator():
        out[r["slice"] * per:(r["slice"] + 1) * per] = np.frombuffer(bytes(r["slots"]), np.uint8)
    return out


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` with an ``id`` of their own, about as small as their number, and its bits."""
    t = shared_table(words.withColumn("at", F.monotonically_increasing_id()))
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    parts = (t.agg(F.max(part)).first()[0] or 0) + 1
    t = t.withColumn("id", row * parts + part).drop("at")
    bits = max(2, int(t.agg(F.max("id")).first()[0] or 0).bit_length())
    if bits > 31:                                      # all ones is a break
        raise ValueError("more than 2^31 frequent words")
    return t, bits + bits % 2


def grams_of(texts: DataFrame, lengths: list[int], bits: int, top: int, least: int,
             pairs: np.ndarray | None = None) -> DataFrame:
    """(gram, f): phrases of ``lengths`` words that occur ``least`` times or more; a gram is
    four bytes for each word's id."""
    return shared_table(texts.mapInArrow(_count(lengths, bits, top, pairs), FILTERS_DDL)
                        .groupBy("n", "range").applyInArrow(_merge(bits, top, least), GRAMS_DDL), large_rows=True)


def part_of(gram: str, first: str, words: str) -> F.Column:
    """Words [first, first + words) of a gram, numbered from 0."""
    return F.expr(f"substring({gram}, 4 * ({first}) + 1, 4 * ({words}))")


def scored(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, a, k, l, r, score) at the lowest-scoring cut. ``counts`` has (gram, f) of all
    phrases that may be a part. Exact: products are decimals of 38 digits."""
    n = "(octet_length(gram) div 4)"
    cuts = grams.withColumn("k", F.explode(F.expr(f"sequence(1, {n} - 1)"))) \
        .withColumn("first", part_of("gram", "0", "k")).withColumn("rest", part_of("gram", "k", f"{n} - k"))
    both = cuts.join(counts.select(F.col("gram").alias("first"), F.col("f").alias("l")), "first") \
        .join(counts.select(F.col("gram").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("cast(2000000 as decimal(18,0)) * cast(f as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    best = both.groupBy("gram").agg(F.first("f").alias("a"), F.min(F.struct(
        score.cast("long").alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("cut"))
    return best.select("gram", "a", "cut.*")


def uncovered(candidates: DataFrame, grams: DataFrame) -> DataFrame:
    """Candidates without those whose words lie inside a longer phrase that holds
    COVERED_PCT % or more of their occurrences."""
    n = "(octet_length(gram) div 4)"
    inner = grams.where(f"{n} > 2").withColumn("words", F.explode(F.expr(f"sequence(2, {n} - 1)"))) \
        .withColumn("first", F.explode(F.expr(f"sequence(0, {n} - words)"))) \
        .select(part_of("gram", "first", "words").alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("within"))
    much = F.expr(f"100 * cast(within as decimal(20,0)) >= {COVERED_PCT} * cast(a as decimal(20,0))")
    return candidates.join(inner, "gram", "left").where(~F.coalesce(much, F.lit(False))).drop("within")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with lang and phrase, their words joined by a space."""
    at = phrases.select("gram", F.explode(F.expr("sequence(0, octet_length(gram) div 4 - 1)")).alias("i")) \
        .select("gram", "i", F.conv(F.hex(part_of("gram", "i", "1")), 16, 10).cast("long").alias("id"))
    text = at.join(words.select("id", "lang", "word"), "id").groupBy("gram").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))),
                                                                lambda x: x["word"]), " ").alias("phrase"))
    return phrases.join(text, "gram")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs(text, lang, ...)``: lang, rank,
    phrase, a, l, r, n, score (2,000,000 a / (l + r), floored, at the cut where it is
    lowest; a, l and r count the phrase and the cut's parts, n all words of the language).

    Phrases have 2 to LONGEST words, occur ``least`` times or more, and are no part of a
    longer phrase that holds most of their occurrences. Null lang: ``und``, as a lang of that
    name. Null or empty text: no words. Ties go by a, then by the phrase's UTF-8 bytes.
    Repeated rows count each. Other columns are ignored. No rows: empty. A text is a
    shard of its own if it is longer than one."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                      F.col("text").cast("string").alias("t"))
    shards = shared_table(src.mapInArrow(_encode, SHARDS_DDL), large_rows=True)
    entries = shards.select("shard", F.posexplode(F.arrays_zip("words", "langs", "counts")).alias("at", "e")) \
        .select("shard", "at", F.col("e.words").alias("word"), F.col("e.langs").alias("lang"), F.col("e.counts").alias("c"))
    totals = shared_table(entries.groupBy("lang", "word").agg(F.sum("c").alias("f")))
    sizes = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    words, bits = numbered(totals.where(F.col("f") >= least))
    known = entries.join(words.select("lang", "word", "id"), ["lang", "word"]) \
        .groupBy("shard").agg(F.collect_list(F.struct(F.col("at").cast("int").alias("at"), F.col("id"))).alias("known"))
    texts = shared_table(shards.select("shard", "seq").join(known, "shard").select("seq", "known")
                         .mapInArrow(_number, "ids binary"), large_rows=True)
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")),
                 (totals.agg(F.sum("f")).first()[0] or 0) // RANGE_WORDS)
    first_bits = min(max(0, ranges.bit_length() - 1), bits - 1)        # a pair's half has ``bits``
    pairs = grams_of(texts, [2], bits, first_bits, least)
    longer = grams_of(texts, list(range(3, LONGEST + 1)), bits, first_bits, least, pair_bitmap(pairs))
    grams = pairs.unionByName(longer)
    single = words.select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("gram"), "f")
    kept = spelled(uncovered(scored(grams, grams.unionByName(single)), grams), words)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", "salt").orderBy(*order)
    best = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))) \
        .withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = rf"""
WITH low AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM low),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
grams AS (
  SELECT lang, ws[i:i + k - 1] AS p, k, count(*) AS f FROM places, (VALUES (1), (2), (3), (4)) v(k)
  WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cuts AS (
  SELECT g.lang, g.p, g.k, g.f AS a, c, x.f AS l, y.f AS r, (2000000::HUGEINT * g.f) // (x.f + y.f) AS score
  FROM grams g, (VALUES (1), (2), (3)) v(c), grams x, grams y
  WHERE c < g.k AND x.lang = g.lang AND x.p = g.p[1:c] AND y.lang = g.lang AND y.p = g.p[c + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
within AS (
  SELECT lang, q, max(f) AS f FROM (
    SELECT lang, p[s:s + m - 1] AS q, f FROM grams, (VALUES (2), (3)) u(m), (VALUES (1), (2), (3)) v(s)
    WHERE m < k AND s + m - 1 <= k) GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN within x ON x.lang = b.lang AND x.q = b.p
  WHERE x.f IS NULL OR 100::HUGEINT * x.f < {COVERED_PCT} * b.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n.n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
