"""Fuzzy line deduplication by MinHash.

Lines are normalised (A-Z lower-cased, ASCII white space runs as one space); lines
without a word are never touched. Character-shingle MinHash signatures are cut into bands;
lines that share a band are candidates, verified by exact Jaccard similarity of
their shingle sets; verified links form components, and one line of each
component stays: the first by (doc_id, digest of the document, line number).

What moves between machines is small: band values go through the shuffle packed
in blobs with a 64-bit line number each; texts and places only of lines that a
sieve over the candidates and exact copies lets pass, before the exact joins.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_sieve, mix, row_key, runs_of, shared_table, sieve_of, slices, table, unused
from .components import components

SHINGLE = 6               # characters
SIMILARITY = 0.8
BANDS, ROWS = 12, 5       # recall 1 - (1 - 0.8^5)^12 = 0.991 at the threshold, 0.9999 at 0.9
SEED = 20240501
CHUNK = 1 << 16           # shingles at a time: they stay in the processor's cache
FLUSH = 1 << 20           # band entries that a task packs at a time
BLOCK = 4096              # lines of a bucket that one task compares with each other
BLOCK_CHARS = 1 << 20     # and their characters, in a bucket that is cut into blocks
LONG = 1 << 10            # characters of a line that counts towards a heavy bucket
HEAVY_CHARS = 1 << 23     # characters of such lines from which a bucket is cut, however few its lines
PARTS = 16                # blob groups for each shuffle partition


ODD_SPACE = ("  ", "\t", "\r", "\x0b", "\x0c")
SPACES = re.compile(r"[ \t\r\x0b\x0c]+")


def normal_lines(text: str | None) -> list[str]:
    """The normalised form of each line of a text (empty without a word)."""
    if not text:
        return []
    text = text.encode().lower().decode()             # bytes: A-Z only
    if any(s in text for s in ODD_SPACE):
        text = SPACES.sub(" ", text)
    return [x.strip(" ") for x in text.split("\n")]


def line_key(line: str) -> bytes:
    return hashlib.md5(line.encode()).digest()


def numbers_of(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in keys), np.uint64)


def shingles(line: str, q: int = SHINGLE) -> set[str]:
    """All runs of q characters; a shorter line is its own only shingle."""
    return {line[i:i + q] for i in range(max(1, len(line) - q + 1))}


def code_points(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters of the lines, and each line's length and begin."""
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32), size, np.cumsum(size) - size


# --- signatures -----------------------------------------------------------------

def band_values(lines: list[str], bands: int = BANDS, rows: int = ROWS, q: int = SHINGLE) -> np.ndarray:
    """(lines, bands) 64-bit band values."""
    rng = np.random.default_rng(SEED)
    mult = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
    plus = rng.integers(0, 1 << 32, bands * rows, np.uint32)
    cp, size, begin = code_points(lines)
    many = np.maximum(size - q + 1, 1)
    out = np.empty((len(lines), bands), np.uint64)
    lo, ends = 0, np.cumsum(many)
    while lo < len(lines):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK, side="right")))
        part = np.append(cp[begin[lo]:begin[hi - 1] + size[hi - 1]], np.zeros(q, np.uint32)).astype(np.uint64)
        h = np.zeros(len(part) - q, np.uint64)
        for j in range(q):
            h = h * np.uint64(0x100000001B3) + part[j:j + len(h)] + np.uint64(1)
        n, at = many[lo:hi], begin[lo:hi] - begin[lo]
        first = np.cumsum(n) - n
        where = np.arange(n.sum()) + np.repeat(at - first, n)
        short = size[lo:hi] < q                      # the whole line, not what follows it
        h = mix(h[where])
        if short.any():
            for i in np.flatnonzero(short):
                v = 0
                for c in part[at[i]:at[i] + size[lo + i]].tolist():
                    v = (v * 0x100000001B3 + c + 1) & 0xFFFFFFFFFFFFFFFF
                h[first[i]] = mix(np.array([v ^ 0x5851F42D4C957F2D], np.uint64))[0]
        h32 = (h >> np.uint64(32)).astype(np.uint32)
        tmp = np.empty_like(h32)
        for b in range(bands):
            v = np.full(hi - lo, b + 1, np.uint64)
            for r in range(b * rows, (b + 1) * rows):
                np.multiply(h32, mult[r], out=tmp)
                np.add(tmp, plus[r], out=tmp)
                v = v * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(tmp, first)
            out[lo:hi, b] = mix(v)
        lo = hi
    return out


ENTRY = np.dtype([("band", "<u8"), ("line", "<u8")])


def pack(entries: np.ndarray, parts: int) -> tuple[np.ndarray, pa.Array]:
    """Entries as one blob for each part (by the top bits of the band value)."""
    part = (entries["band"] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    order = np.argsort(part, kind="stable")
    at, n = runs_of(part[order])
    raw = np.ascontiguousarray(entries[order]).tobytes()
    cuts = np.append(at, len(entries)) * ENTRY.itemsize
    return part[order][at].astype(np.int32), pa.array([raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())


def _bands(parts: int):
    schema = pa.schema([("part", pa.int32()), ("blob", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for b in slices(batches, "t"):
            times = Counter(x for t in b.column(0).to_pylist() for x in normal_lines(t) if x)
            if not times:
                continue
            lines, n = list(times), np.fromiter(times.values(), np.int64, len(times))
            number = numbers_of([line_key(x) for x in lines])
            bands = band_values(lines)
            e = np.empty(bands.shape, ENTRY)
            e["band"], e["line"] = bands, number[:, None]
            # one band of each line's own: what comes up twice there is an exact copy
            own = np.empty(len(lines) + int((n > 1).sum()), ENTRY)
            own["line"] = np.concatenate([number, number[n > 1]])
            own["band"] = mix(own["line"].copy())
            held.append(own)
            count += len(own)
            held.append(e.ravel())
            count += bands.size
            if count >= FLUSH:
                yield table(schema, *pack(np.concatenate(held), parts))
                held, count = [], 0
        if count:
            yield table(schema, *pack(np.concatenate(held), parts))
    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blobs sorted by part -> (bucket, number, n) for the bands that two or more (n) different
    lines share, and (null, number, null) for exact copies. A bucket is named by its lines,
    so equal ones of several bands fall together."""
    schema = pa.schema([("bucket", pa.int64()), ("number", pa.int64()), ("n", pa.int64())])

    def found(blobs: list[bytes]):
        e = np.frombuffer(b"".join(blobs), ENTRY)
        order = np.lexsort((e["line"], e["band"]))
        band, line = e["band"][order], e["line"][order]
        again = np.zeros(len(band), bool)
        again[1:] = (band[1:] == band[:-1]) & (line[1:] == line[:-1])
        copies = np.unique(line[again & (band == mix(line.copy()))])
        if len(copies):
            none = pa.nulls(len(copies), pa.int64())
            yield table(schema, none, copies.view(np.int64), none)
        band, line = band[~again], line[~again]
        at, n = runs_of(band)
        many = n > 1
        if many.any():
            line, n = line[np.repeat(many, n)], n[many]
            name = mix(np.add.reduceat(mix(line.copy()), np.cumsum(n) - n) + n.astype(np.uint64))
            yield table(schema, np.repeat(name, n).view(np.int64), line.view(np.int64), np.repeat(n, n))

    part, blobs = None, []
    for b in batches:
        for p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if p != part and blobs:
                yield from found(blobs)
                blobs = []
            part = p
            blobs.append(x)
    if blobs:
        yield from found(blobs)


# --- verification -----------------------------------------------------------------

def shingle_hashes(lines: list[str], q: int = SHINGLE) -> list[np.ndarray]:
    """Each line's shingle set, as sorted 64-bit hashes."""
    cp, size, begin = code_points(lines)
    wide = np.append(cp, np.zeros(q, np.uint32)).astype(np.uint64)
    h = np.zeros(len(cp), np.uint64)
    for j in range(q):
        h = h * np.uint64(0x9E3779B97F4A7C15) + wide[j:j + len(h)] + np.uint64(1)
    h = mix(h)
    out = []
    for x, b, n in zip(lines, begin.tolist(), size.tolist()):
        # a shorter line is its own only shingle; the top bit keeps it apart from the others
        s = np.sort(h[b:b + n - q + 1] >> np.uint64(1)) if n >= q else \
            np.frombuffer(line_key(x)[:8], np.uint64) | np.uint64(1 << 63)
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
    return out


def in_both(a: np.ndarray, b: np.ndarray) -> int:
    c = np.concatenate([a, b])
    c.sort()
    return int(np.count_nonzero(c[1:] == c[:-1]))


def link_lines(keys: list, sets: list[np.ndarray], similarity: float = SIMILARITY) -> list[tuple]:
    """Links that connect all lines of a bucket that are at least ``similarity`` alike
    (exact Jaccard over shingle sets)."""
    return linked_parts(keys, sets, similarity)[0]


def linked_parts(keys: list, sets: list[np.ndarray], similarity: float = SIMILARITY) -> tuple[list[tuple], list]:
    """Those links, and the parts they make, each as [hits, member]. A line is compared
    with a part's members, those with most hits first, until one links it to that part."""
    parts: list[list[list[int]]] = []                # of [hits, member]
    links = []
    for i in sorted(range(len(sets)), key=lambda i: len(sets[i])):
        a, own = sets[i], [[0, i]]
        rest = []
        for p in parts:
            for k, m in enumerate(p):
                b = sets[m[1]]
                if len(b) < similarity * len(a):     # lines come by growing size
                    continue
                both = in_both(a, b)
                if both >= similarity * (len(a) + len(b) - both):
                    m[0] += 1
                    links.append((keys[i], keys[m[1]]))
                    while k and p[k - 1][0] < p[k][0]:
                        p[k - 1], p[k] = p[k], p[k - 1]
                        k -= 1
                    own = p + own if len(p) >= len(own) else own + p
                    break
            else:
                rest.append(p)
        parts = [*rest, own]
    return links, parts


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, key, line) sorted by bucket -> links (a, b)."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    bucket, keys, sets = None, [], []
    out: list[tuple] = []
    for batch in slices(batches, "line"):
        lines = batch.column(2).to_pylist()
        for g, k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_hashes(lines)):
            if g != bucket:
                if len(keys) > 1:
                    out += link_lines(keys, sets)
                bucket, keys, sets = g, [], []
            keys.append(k)
            sets.append(x)
        if out:
            yield table(schema, *map(list, zip(*out)))
            out = []
    if len(keys) > 1 and (out := link_lines(keys, sets)):
        yield table(schema, *map(list, zip(*out)))


def _verify_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, key, line) sorted by block -> links (null, a, b), and (block, a, null) with
    the line of each block that most lines of its largest part were linked by."""
    schema = pa.schema([("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
    block, keys, sets = None, [], []

    def found():
        links, parts = linked_parts(keys, sets)
        hub = max(parts, key=len)[0][1]
        return table(schema, [None] * len(links) + [block], [a for a, _ in links] + [keys[hub]], [b for _, b in links] + [None])

    for batch in slices(batches, "line"):
        for g, k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_hashes(batch.column(2).to_pylist())):
            if g != block:
                if keys:
                    yield found()
                block, keys, sets = g, [], []
            keys.append(k)
            sets.append(x)
    if keys:
        yield found()


class Apart:
    """Lines outside their bucket's largest component, to be compared with others."""

    def __init__(self, lines: list[tuple[bytes, bytes, np.ndarray]]):
        self.keys, self.roots, sets = map(list, zip(*lines))
        self.size = np.array([len(x) for x in sets])
        hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        self.linked: set[tuple[bytes, bytes]] = set()

    def links(self, key: bytes, root: bytes, x: np.ndarray, inside: bool, similarity: float = SIMILARITY) -> list[tuple]:
        """New links of roots by one more line; of two lines ``inside`` the set the smaller key is compared."""
        lo, hi = np.searchsorted(self.hashes, x), np.searchsorted(self.hashes, x, side="right")
        n = hi - lo
        at = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
        both = np.bincount(self.owner[at], minlength=len(self.size))
        out = []
        for i in np.flatnonzero(both >= similarity * (self.size + len(x) - both)).tolist():
            pair = (self.roots[i], root)
            if pair[0] != root and pair not in self.linked and not (inside and key >= self.keys[i]):
                self.linked.add(pair)
                out.append(pair)
        return out


def _verify_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, side, key, root, inside, line) sorted by pair and side: the lines of side 0 are
    held (a block of them), those of side 1 compared with them one by one -> links (a, b)."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    pair, held, apart = None, [], None
    for batch in slices(batches, "line"):
        out = []
        pairs, side, key, root, inside, line = (batch.column(i).to_pylist() for i in range(6))
        for g, s, k, r, i, x in zip(pairs, side, key, root, inside, shingle_hashes(line)):
            if g != pair:
                pair, held, apart = g, [], None
            if s == 0:
                held.append((k, r, x))
            elif held:
                apart = apart or Apart(held)
                out += apart.links(k, r, x, i)
        if out:
            yield table(schema, *map(list, zip(*out)))


# --- Spark flow ---------------------------------------------------------------------

def _candidates(sieve):
    """(t) -> number, key and form of the different lines in the sieve, for a run of texts."""
    schema = pa.schema([("number", pa.int64()), ("key", pa.binary()), ("line", pa.string()), ("chars", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            lines = list({x for t in b.column(0).to_pylist() for x in normal_lines(t) if x})
            keys = [line_key(x) for x in lines]
            number = numbers_of(keys)
            hit = np.flatnonzero(in_sieve(sieve.value, number))
            yield table(schema, number[hit].view(np.int64), [keys[i] for i in hit], [lines[i] for i in hit],
                        [len(lines[i]) for i in hit])
    return run


def _places(sieve):
    """(id, row, t) -> key and place of every line in the sieve."""
    schema = pa.schema([("key", pa.binary()), ("id", pa.int64()), ("row", pa.binary()), ("no", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            doc, no, keys = [], [], []
            for d, t in enumerate(b.column(2).to_pylist()):
                for i, x in enumerate(normal_lines(t)):
                    if x:
                        doc.append(d)
                        no.append(i)
                        keys.append(line_key(x))
            hit = np.flatnonzero(in_sieve(sieve.value, numbers_of(keys)))
            of = pa.array([doc[i] for i in hit], pa.int32())
            yield table(schema, [keys[i] for i in hit], b.column(0).take(of), b.column(1).take(of), [no[i] for i in hit])
    return run


def _blocks():
    size = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("line")) / BLOCK_CHARS))
    return F.greatest(size, F.lit(1)).cast("long")


def _number(blocks: str):
    return F.pmod(F.xxhash64("key"), F.col(blocks))


def _large_links(lines: DataFrame) -> DataFrame:
    """``lines(bucket, key, line)`` of buckets over BLOCK lines -> links (a, b) that connect
    what link_lines would connect, with no task that holds a bucket: links inside blocks,
    then between the blocks' hubs; after that, every line outside the largest
    component of its bucket is compared with all lines of the bucket in other components."""
    sizes = lines.groupBy("bucket").agg(_blocks().alias("blocks"))
    big = shared_table(lines.join(sizes, "bucket").withColumn("no", _number("blocks"))
                       .withColumn("block", F.xxhash64("bucket", "no")))
    inside = shared_table(big.select("block", "key", "line").repartition("block").sortWithinPartitions("block", "key")
                          .mapInArrow(_verify_blocks, "block long, a binary, b binary"))
    hubs = big.join(inside.where("b is null").select("block", F.col("a").alias("key")), ["block", "key"])
    between = (hubs.select("bucket", "key", "line").repartition("bucket").sortWithinPartitions("bucket", "key")
               .mapInArrow(_verify, "a binary, b binary"))
    links = shared_table(inside.where("b is not null").select("a", "b").union(between))
    big = big.join(components(links).withColumnRenamed("node", "key"), "key", "left") \
        .withColumn("root", F.coalesce("root", "key"))
    big = shared_table(big)
    main = big.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket") \
        .agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    big = big.join(main, "bucket").withColumn("apart", F.col("root") != F.col("main"))
    apart = big.where("apart")
    chunks = shared_table(apart.groupBy("bucket").agg(_blocks().alias("chunks")))
    if not chunks.head(1):
        return links

    def numbers(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    held = apart.join(chunks, "bucket").withColumn("chunk", _number("chunks")).drop("no") \
        .withColumn("no", numbers("blocks")).withColumn("side", F.lit(0))
    other = big.join(chunks, "bucket").withColumn("chunk", numbers("chunks")).withColumn("side", F.lit(1))
    cross = held.unionByName(other, allowMissingColumns=True) \
        .select(F.xxhash64("bucket", "chunk", "no").alias("pair"), "side", "key", "root", "apart", "line") \
        .repartition("pair").sortWithinPartitions("pair", "side", "key")
    return links.union(shared_table(cross.mapInArrow(_verify_apart, "a binary, b binary").distinct()))


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """``(row, no)`` of every line that goes; ``row`` is row_key(doc_id, text)."""
    share = docs.sparkSession.sparkContext.broadcast
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * PARTS
    src = docs.select(F.col("doc_id").cast("long").alias("id"), row_key("doc_id", "text").alias("row"),
                      F.col("text").cast("string").alias("t"))
    buckets = shared_table(src.select("t").mapInArrow(_bands(parts), "part int, blob binary")
                           .repartition("part").sortWithinPartitions("part")
                           .mapInArrow(_buckets, "bucket long, number long, n long").distinct())
    near = buckets.where("bucket is not null")
    once = shared_table(src.select("t")
                        .mapInArrow(_candidates(share(sieve_of(near, "number"))), "number long, key binary, line string, chars int")
                        .join(near.select("number").distinct(), "number", "left_semi").dropDuplicates(["key"]))
    # shorter lines of up to BLOCK add BLOCK * LONG characters at most
    heavy = shared_table(near.where(F.col("n") <= BLOCK).join(once.where(F.col("chars") > LONG).select("number", "chars"), "number")
                         .groupBy("bucket").agg(F.sum("chars").alias("chars")).where(F.col("chars") > HEAVY_CHARS).select("bucket"))
    large = near.where(F.col("n") > BLOCK)
    small = near.where(F.col("n") <= BLOCK)
    if heavy.head(1):
        large = large.union(small.join(heavy, "bucket", "left_semi"))
        small = small.join(heavy, "bucket", "left_anti")
    links = shared_table(small.join(once, "number").select("bucket", "key", "line")
                         .repartition("bucket").sortWithinPartitions("bucket", "key")
                         .mapInArrow(_verify, "a binary, b binary").distinct())
    if large.head(1):
        links = links.union(_large_links(large.join(once, "number").select("bucket", "key", "line")))
    roots = components(links).withColumnRenamed("node", "key")
    places = shared_table(src.mapInArrow(_places(share(sieve_of(buckets, "number"))), "key binary, id long, row binary, no int"))
    rooted = places.join(roots, "key", "left").select(
        F.coalesce("root", "key").alias("root"),
        F.struct(F.col("id").isNull().alias("none"), "id", "row", "no").alias("place"))
    best = rooted.groupBy("root").agg(F.min("place").alias("best"), F.count("*").alias("n")).where("n > 1")
    return rooted.join(best.select("root", "best"), "root").where("place != best").select("place.row", "place.no")


def _removed_lists(docs: DataFrame) -> DataFrame:
    return shared_table(duplicate_lines(docs).groupBy("row").agg(F.array_sort(F.collect_set("no")).alias("removed")))


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_lines, n_removed and
    ``removed``, the numbers (from 0) of the lines that go as copies or near copies
    of lines elsewhere, earlier ones of the same text included.

    Null text: no lines. Rows equal in doc_id and text are one document given twice:
    they get equal results. Null doc_ids come last. Other columns are ignored.
    No rows: empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("row"),
                       F.size(F.split(F.col("text"), "\n", -1)).alias("n"))
    return rows.join(_removed_lists(docs), "row", "left").select(
        "doc_id", F.coalesce(F.when(F.col("n") >= 0, F.col("n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.col("removed")), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def _drop_lines(text_at: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, schema.names[text_at]):
            new = []
            for t, gone in zip(b.column(text_at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                if t is not None and gone:
                    bad = set(gone)
                    t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in bad)
                new.append(t)
            yield table(schema, *(pa.array(new, schema.field(j).type) if j == text_at else b.column(j)
                                  for j in range(len(schema))))
    return run


def remove_duplicate_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with those lines cut from its texts; columns as in ``docs``, and
    ``n_chars`` follows the text. A document keeps its row even if no line stays."""
    from pyspark.sql.pandas.types import to_arrow_schema

    row, removed = unused(docs, "_row"), unused(docs, "_removed")
    gone = _removed_lists(docs).select(F.col("row").alias(row), F.col("removed").alias(removed))
    out = docs.withColumn(row, row_key("doc_id", "text")).join(gone, row, "left")
    if "n_chars" in docs.columns:
        # null for now where the text changes
        out = out.withColumn("n_chars", F.when(F.col(removed).isNull(), F.col("n_chars")))
    out = out.select(*docs.columns, removed).mapInArrow(
        _drop_lines(docs.columns.index("text"), to_arrow_schema(docs.schema)), docs.schema)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce("n_chars", size))
    return out
