"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints: bit i is 1 if it is set in over half of the XXH64 hashes of a
text's word shingles. Two fingerprints link at a few differing bits. To find the
links, a fingerprint is cut into three segments, each padded to the 23 bits of
the perfect Golay code. Every 23-bit word decodes to one codeword within three
errors; the codewords that its one-bit neighbours decode to (one, or six for
words three errors off) are its keys. Two segments at most two errors apart have
a neighbour in common, so they share a key. Two errors over three segments leave
one segment equal (pigeonhole): a key is that segment's own bits plus a codeword
index of the next segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_table, row_key, shared_table, slices, space_table, table, text_bytes, unused, word_spans
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BUCKET = 256              # larger buckets take the neighbourhood path
SEGMENTS = [22, 21, 21]
# Fixed value: generator polynomial of the (23, 12) Golay code
GOLAY = 0b110001110101


# --- fingerprints ---------------------------------------------------------------

def _lanes() -> np.ndarray:
    """Byte -> eight counters of eight bits, one for each of its bits."""
    b = np.arange(256, dtype=np.uint64)
    return sum((((b >> np.uint64(i)) & np.uint64(1)) << np.uint64(8 * i) for i in range(8)), np.zeros(256, np.uint64))


def bit_counts(hashes: np.ndarray, at: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """For each run of hashes that begins at ``at``, how many have bit i set."""
    sizes = np.diff(np.append(at, len(hashes)))
    parts = -(-sizes // 255)                       # eight-bit counters hold 255
    first = np.cumsum(parts) - parts
    steps = np.arange(parts.sum()) - np.repeat(first, parts)
    cuts = np.repeat(at, parts) + 255 * steps
    by = hashes.view(np.uint8).reshape(-1, 8)
    out = np.empty((len(at), 64), np.int64)
    for j in range(8):
        sums = np.add.reduceat(lanes[by[:, j]], cuts)
        out[:, 8 * j:8 * j + 8] = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    return out


def _fingerprint(shingle: int, seed: int):
    lower, inside, lanes, digest = lower_table(), space_table(), _lanes(), xxhash.xxh64_intdigest

    def of(col: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(col)
        out = np.zeros(len(col), np.uint64)
        s, e, doc = word_spans(data, offsets, inside)
        if len(s) == 0:
            return out
        # words with one space after each, so that a shingle is one slice
        keep = inside[data]
        keep[e[e < len(data)]] = True
        spaced = np.where(inside[data], lower[data], np.uint8(32))
        place = np.cumsum(keep) - 1
        glued = np.zeros(len(data), bool)          # texts that touch without a space between
        joints = np.intersect1d(e, s)
        glued[joints] = True
        if len(joints):
            shift = np.cumsum(glued)
            place = place + shift
            buf = np.full(int(place[-1]) + 1 + 1, 32, np.uint8)
            # a word's last byte is followed by the space of the joint
            buf[place[keep & inside[data]]] = spaced[keep & inside[data]]
        else:
            buf = spaced[keep]
        ns, ne = place[s], place[e - 1] + 1
        n = np.bincount(doc, minlength=len(col))
        last = np.cumsum(n) - 1                     # last word of each text
        i = np.arange(len(s))
        full = i + shingle - 1 <= last[doc]
        short = (n[doc] < shingle) & (i == (last - n + 1)[doc])
        take = np.flatnonzero(full | short)
        till = np.minimum(take + shingle - 1, last[doc[take]])
        raw = buf.tobytes()
        h = np.fromiter((digest(raw[a:b], seed) for a, b in zip(ns[take].tolist(), ne[till].tolist())),
                        np.uint64, len(take))
        d = doc[take]
        at = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        sizes = np.diff(np.append(at, len(d)))
        bits = 2 * bit_counts(h, at, lanes) > sizes[:, None]
        out[d[at]] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
        return out
    return of


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED, tag: Column | None = None) -> DataFrame:
    """``(id, tag, fp LONG)`` per row, over whole texts. Fewer words than a shingle: the
    whole sequence is the one shingle; no words, or null: fingerprint zero."""
    schema = pa.schema([("id", pa.int64()), ("tag", pa.binary()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _fingerprint(shingle, seed)
        for b in slices(batches, "t"):
            yield table(schema, b.column(0), b.column(2), of(b.column(1)).view(np.int64))

    tag = F.lit(None).cast("binary") if tag is None else tag
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), tag.alias("tag")).mapInArrow(
        run, "id long, tag binary, fp long")


# --- Golay keys -----------------------------------------------------------------

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    r = words.copy()
    for i in range(22, 10, -1):
        r = np.where((r >> i) & 1, r ^ (GOLAY << (i - 11)), r)
    return r


def golay_errors() -> np.ndarray:
    """Syndrome -> the only error pattern of at most three bits with it."""
    one = 1 << np.arange(23, dtype=np.int64)
    two = np.array([a | b for i, a in enumerate(one) for b in one[:i]])
    three = np.array([a | b for a in two for b in one if b < (a & -a)])
    out = np.zeros(1 << 11, np.int64)
    for p in (one, two, three):
        out[_syndromes(p)] = p
    return out


def golay_keys(words: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices that a word and its one-bit neighbours decode to."""
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23)])[None, :]
    return (near ^ errors[_syndromes(near)]) >> 11


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
    errors = golay_errors()
    shifts = np.cumsum([0, *SEGMENTS])
    for b in batches:
        all_fp = b.column(0).to_numpy(zero_copy_only=False)
        for fp in np.array_split(all_fp, max(1, len(all_fp) // 20000)):
            seg = [((fp.view(np.uint64) >> np.uint64(a)).astype(np.int64)) & ((1 << w) - 1)
                   for a, w in zip(shifts, SEGMENTS)]
            for i in range(3):
                keys = np.sort(golay_keys(seg[(i + 1) % 3], errors), axis=1)
                new = np.ones(keys.shape, bool)
                new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                row, at = np.nonzero(new)
                yield table(schema, (np.int64(i) << 40) | (seg[i][row] << 12) | keys[row, at], fp[row])


# --- links ------------------------------------------------------------------------

def _bucket_links(max_bits: int):
    """Rows sorted by key -> links that connect what is within ``max_bits`` in each
    bucket (a star of each part, not all pairs). A bucket beyond BUCKET streams on
    as rows (fp, null) for the neighbourhood path."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def stars(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:   # (buckets, size)
        n = fp.shape[1]
        near = np.bitwise_count(fp[:, :, None] ^ fp[:, None, :]) <= max_bits
        lab = np.broadcast_to(np.arange(n), fp.shape)
        while True:
            new = np.where(near, lab[:, None, :], n).min(axis=2)
            if (new == lab).all():
                break
            lab = new
        r, c = np.nonzero(lab != np.arange(n))
        return fp[r, c], fp[r, lab[r, c]]

    def linked(key: np.ndarray, fp: np.ndarray):
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(at, len(key)))
        for n in np.unique(size):
            if n == 1:
                continue
            of = at[size == n]
            for part in np.array_split(of, max(1, len(of) * n * n // 2_000_000)):
                a, b = stars(fp[part[:, None] + np.arange(n)].view(np.uint64))
                if len(a):
                    yield table(schema, a.view(np.int64), b.view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = fp = np.zeros(0, np.int64)
        hot = None                                   # a key whose bucket is too large
        for b in batches:
            k, f = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if hot is not None:
                n = int(np.searchsorted(k, hot, side="right"))
                if n:
                    yield table(schema, f[:n], pa.nulls(n, pa.int64()))
                    k, f = k[n:], f[n:]
                if not len(k):
                    continue
                hot = None
            key, fp = np.concatenate([key, k]), np.concatenate([fp, f])
            at, size = np.unique(key, return_index=True, return_counts=True)[1:]
            big = np.flatnonzero(size > BUCKET)
            keep = np.ones(len(key), bool)
            for i in big:
                s = slice(at[i], at[i] + size[i])
                yield table(schema, fp[s], pa.nulls(int(size[i]), pa.int64()))
                keep[s] = False
            if len(big) and big[-1] == len(at) - 1:  # the last bucket may go on
                hot = key[-1]
            key, fp = key[keep], fp[keep]
            if not len(key):
                continue
            done = len(key) if hot is not None else int(np.searchsorted(key, key[-1]))
            yield from linked(key[:done], fp[:done])
            key, fp = key[done:], fp[done:]
        if len(key):
            yield from linked(key, fp)
    return run


def neighbourhood_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Exact links for fingerprints of very large buckets, with no pairs at all:
    everything within one bit of the same word is at most two bits apart, and
    anything two bits apart has such a word in common. A word has 65 neighbours,
    so a group is never larger. (``max_bits`` 1 or 0 is checked on the links.)"""
    near = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int")))))
    groups = (fps.select("fp", F.explode(near).alias("z")).groupBy("z")
              .agg(F.sort_array(F.collect_set("fp")).alias("g")).where(F.size("g") > 1))
    if max_bits >= 2:
        links = groups.select(F.explode(F.slice("g", 2, 65)).alias("a"), F.col("g")[0].alias("b"))
    else:
        links = groups.select("z", F.explode("g").alias("a")).where("a != z").select("a", F.col("z").alias("b")) \
            .join(fps.select(F.col("fp").alias("b")), "b", "left_semi")
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps(fp)`` distinct -> links (a, b) that connect all within ``max_bits``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the segments and keys are laid out for at most two bits")
    keys = fps.select("fp").mapInArrow(_keyed, "key long, fp long")
    found = shared_table(keys.repartition("key").sortWithinPartitions("key", "fp")
                         .mapInArrow(_bucket_links(max_bits), "a long, b long").distinct())
    hot = found.where("b is null").select(F.col("a").alias("fp"))
    return found.where("b is not null").union(neighbourhood_links(hot, max_bits))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS, tag: Column | None = None) -> DataFrame:
    """``(id, tag, fp, component_id)`` for every row of ``docs``: the fingerprint and
    the smallest id reachable over links of at most ``max_bits`` bits, itself
    included. ``tag`` is an optional binary expression carried through.

    Null ids are no candidates for the smallest id (null if a component has none
    other); null or empty texts have fingerprint zero and link like any other;
    repeated rows each give a row; other columns are ignored; no rows: empty.
    """
    prints = shared_table(fingerprints(docs, id_col, text_col, shingle, tag=tag))
    classes = shared_table(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(fingerprint_links(classes, max_bits))
    named = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.select("fp", "root").join(least, "root"), "fp") \
        .select("id", "tag", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each SimHash group of ``docs(doc_id, text, ...)``, with docs'
    columns: the one with the smallest doc_id (null last; rows that share it: the
    smallest digest of all columns; of equal rows one)."""
    key = row_key(*docs.columns)
    groups = simhash_components(docs, shingle=shingle, max_bits=max_bits, tag=key)
    name = unused(docs, "_key")
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "tag")).alias("w")) \
        .select(F.col("w.tag").alias(name))
    return docs.withColumn(name, key).join(best, name).dropDuplicates([name]).select(*docs.columns)
