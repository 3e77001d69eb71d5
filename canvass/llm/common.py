"""Helpers shared by the operators: shared scratch tables, row keys, and
columnar text handling (all words of a batch of texts as NumPy arrays)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.session import ensure_checkpoint_dir

BATCH_BYTES = 1 << 20     # bytes of text that a task turns into arrays at a time
HASH_BASE = 0x9E3779B97F4A7C15

# The ASCII white space of the words `[^\x20\x09-\x0D]+`
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


# --- Spark side ---------------------------------------------------------------

# Parquet looks at a page's and a row group's size only after a hundred rows. Rows of megabytes
# would make pages of hundreds, which readers hold whole, and whose buffers they keep
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1",
              "parquet.block.size": str(16 << 20)}
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """Python tasks that start meanwhile get batches of about ``size`` bytes, not of many large rows."""
    old = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, old)


def shared_table(df: DataFrame, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back:
    a lineage cut that survives lost executors, is columnar, and is removed when
    the application ends. ``large_rows``: rows that are written, or handed to Python on
    the way, are up to megabytes each."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    if large_rows:
        with small_batches(spark):
            df.write.options(**LARGE_ROWS).parquet(path)
    else:
        df.write.parquet(path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*cols: str) -> Column:
    """16 bytes that identify a row by the content of ``cols`` (nulls differ from
    empty strings). Rows equal in all of them get equal results everywhere, so
    they may share a key; no row numbers are needed that a retried task could
    hand out differently."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(-1)).cast("string") for c in cols]
    return F.unhex(F.md5(F.concat_ws("|", *sizes, *parts)))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it none of df's columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


SIEVE_BITS = 26           # a sieve is a bitmap of 8 MB, however many values it holds


def sieve_of(values: DataFrame, column: str) -> np.ndarray:
    """Bitmap over the top bits of a column of 64-bit hashes. At most 2^20 rows of 64
    bits reach the driver, whatever the table's size, and tasks get 8 MB. It only
    spares rows that cannot match in an exact join that follows; a full one lets all
    pass."""
    slot = F.shiftrightunsigned(F.col(column), 64 - SIEVE_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    rows = values.select(F.shiftright(slot, 6).cast("int").alias("at"), bit.alias("bit")) \
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(1 << (SIEVE_BITS - 6), np.uint64)
    if rows:
        at, bits = zip(*rows)
        out[list(at)] = np.array(bits, np.int64).view(np.uint64)
    return out


# --- task side ----------------------------------------------------------------

def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES,
           ) -> Iterator[pa.RecordBatch]:
    """Record batches cut into runs of whole rows of about ``limit`` bytes in
    ``column`` (a longer text makes a run of its own)."""
    for b in batches:
        if b.num_rows == 0:
            continue
        col = b.column(b.schema.get_field_index(column))
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield b.slice(at, to - at)
            at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if col.null_count:
        col = pa.compute.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z only."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_table() -> np.ndarray:
    """True for bytes inside words `[^\\x20\\x09-\\x0D]+`."""
    t = np.ones(256, bool)
    t[SPACES] = False
    return t


def alnum_table() -> np.ndarray:
    """True for bytes inside words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`
    (digits, a-z and everything beyond ASCII)."""
    t = np.zeros(256, bool)
    t[0x30:0x3A] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray,
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number) of every word; words never cross texts."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = inside[data]
    start = m.copy()
    start[1:] &= ~m[:-1]
    end = m.copy()
    end[:-1] &= ~m[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    start[cuts] = m[cuts]
    end[cuts - 1] = m[cuts - 1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(offsets, s, side="right") - 1


def powers(n: int, base: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Polynomial hashes modulo 2^64 of any ranges of a byte array in O(1) each,
    from one prefix sum."""

    def __init__(self, data: np.ndarray, base: int = HASH_BASE):
        self.back = powers(len(data), pow(base, -1, 1 << 64))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = powers(len(data), base)[:-1]
        terms *= data.astype(np.uint64) + np.uint64(1)
        np.cumsum(terms, out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def in_sieve(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - SIEVE_BITS)
    return ((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def runs_of(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the runs of equal values."""
    if len(sorted_keys) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return at, np.diff(np.append(at, len(sorted_keys)))


def table(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type)
                                       for c, t in zip(cols, schema)], schema=schema)
