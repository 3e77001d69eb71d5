"""WARC archives: written by Spark's text writer, read by a Python data source.

A record is one string, and the blank line that ends it is the writer's line
separator, so archives are plain Spark output: any store, one file a task, committed
or not at all. The reader plans partitions of whole files (a record's start cannot be
told from a payload that quotes one), takes predicates on the record type and the
other headers from the query, and reads a block only if the record passes and a
column needs it.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from canvass.session import ensure_checkpoint_dir

# RFC 4648 base 32, header names, the WARC/1.1 profile of a repeated payload
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "refers_to": "warc-refers-to",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "content_type": "content-type",
    "payload_digest": "warc-payload-digest",
    "content_length": "content-length",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DDL = ("record_type string, record_id string, refers_to string, target_uri string, date string, "
              "content_type string, payload_digest string, content_length long, headers map<string,string>, "
              "payload_bytes long, payload binary")
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
FILE_BYTES = 128 << 20    # of whole files that one partition reads, unless the session says otherwise
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
ID = "urn:page:"


# --- writing ------------------------------------------------------------------

def base32(hex_digest: Column) -> Column:
    """A SHA-1 in hex as 32 base-32 characters."""
    def chars(v: Column) -> Column:                    # 5 hex digits are 4 characters
        return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)))

    parts = F.transform(F.array(hex_digest), lambda h: F.array(
        *(F.conv(F.substring(h, at, 5), 16, 10).cast("int") for at in range(1, 41, 5))))[0]
    return F.array_join(F.transform(parts, chars), "")


def record_uri(page_id: Column) -> Column:
    return F.concat(F.lit(ID), F.coalesce(F.url_encode(page_id.cast("string")), F.lit("")))


def page_of(uri: Column) -> Column:
    return F.nullif(F.url_decode(F.substring(uri, len(ID) + 1, 1 << 30)), F.lit(""))


def repeated_payloads(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(digest, n, h, keeper) for the payloads of ``min_bytes`` or more that several
    rows have; keeper is the largest page_id."""
    return pages.where(F.col("n") >= min_bytes).groupBy("digest", "n", "h") \
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1").drop("copies")


def warc_records(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A column ``value`` with one WARC/1.1 record for each row of ``pages(page_id, url, payload)``."""
    from .common import shared_table

    body = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    src = pages.select("page_id", F.col("url").cast("string").alias("url"), body.alias("body")) \
        .select("*", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("n"),
                F.xxhash64("body").alias("h"))
    # a table of its own, so that its size is known before the payloads are joined
    again = shared_table(repeated_payloads(src, min_bytes)).withColumn("repeated", F.lit(True))
    joined = src.join(again, ["digest", "n", "h"], "left")
    revisit = F.coalesce(F.col("repeated") & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.lit(False))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)     # null if the value is: left out

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("n"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<"), record_uri(F.col("page_id")), F.lit(">"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<"), record_uri(F.col("keeper")), F.lit(">")))),
        F.when(revisit, line("WARC-Profile", F.lit(SAME_PAYLOAD))),
        F.lit("Content-Type: application/http;msgtype=response"), line("Content-Length", block.cast("string")))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("body").cast("string"))     # bytes as they are
    return joined.select(F.concat(head, F.lit("\r\n\r\n"), http, payload).alias("value"))


def write_archives(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> str:
    """Write a record for each row of ``pages(page_id, url, payload, ...)`` and return the
    folder (by default a new one below ``spark.checkpoint.dir``, removed when the
    application ends).

    Of rows with equal payloads of ``min_bytes`` or more, the one with the largest
    page_id is a response and the others revisit it. Rows that tie on it are all
    responses (no payload hangs on an arbitrary choice); a null page_id is the smallest.
    Null payload: empty. Null url: no target. Line breaks in a url, which no header can
    hold, are percent-encoded. Payloads may be strings or any bytes. No rows: no
    records. Other columns are ignored."""
    if path is None:
        spark = pages.sparkSession
        path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    warc_records(pages, min_bytes).write.option("lineSep", "\r\n\r\n").text(path)
    return path


# --- reading ------------------------------------------------------------------

@dataclass
class Files(ds.InputPartition):
    paths: list[str]


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def pack(files: list[tuple[str, int]], limit: int) -> list[list[str]]:
    """Whole files in groups of about ``limit`` bytes, the largest first."""
    groups: list[list[str]] = []
    room = 0
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if not groups or size > room:
            groups.append([])
            room = limit
        groups[-1].append(path)
        room -= size
    return groups


def holds(f: ds.Filter, get) -> bool | None:
    """SQL truth of a filter over header values (None: unknown)."""
    if isinstance(f, ds.Not):
        inner = holds(f.child, get)
        return None if inner is None else not inner
    v = get(f.attribute[0])
    if isinstance(f, ds.IsNull):
        return v is None
    if isinstance(f, ds.IsNotNull):
        return v is not None
    if isinstance(f, ds.EqualNullSafe):
        return v == f.value
    if v is None:
        return None
    if isinstance(f, ds.In):
        return True if v in f.value else (None if None in f.value else False)
    if f.value is None:
        return None
    if isinstance(f, ds.StringStartsWith):
        return v.startswith(f.value)
    if isinstance(f, ds.StringEndsWith):
        return v.endswith(f.value)
    if isinstance(f, ds.StringContains):
        return f.value in v
    if isinstance(v, str):                             # Spark compares strings by their UTF-8 bytes
        v, other = v.encode(), f.value.encode()
    else:
        other = f.value
    return {ds.EqualTo: v == other, ds.GreaterThan: v > other, ds.GreaterThanOrEqual: v >= other,
            ds.LessThan: v < other, ds.LessThanOrEqual: v <= other}[type(f)]


KNOWN = (ds.EqualTo, ds.EqualNullSafe, ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual,
         ds.In, ds.IsNull, ds.IsNotNull, ds.StringStartsWith, ds.StringEndsWith, ds.StringContains)


def pushable(f: ds.Filter) -> bool:
    if isinstance(f, ds.Not):
        return pushable(f.child)
    return isinstance(f, KNOWN) and len(f.attribute) == 1 and f.attribute[0] in HEADERS


def field_lines(f, left: int | None = None) -> Iterator[tuple[str, str]]:
    """(lower-case name, value) of the header fields up to the blank line, at most
    ``left`` bytes of them. A folded line goes on with the field before it."""
    name = value = None
    while True:
        raw = f.readline() if left is None else f.readline(left)
        if left is not None:
            left -= len(raw)
        text = raw.rstrip(b"\r\n").decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name is not None and text.strip():
            value += " " + text.strip()
            continue
        if name is not None:
            yield name, value
        if not text:
            return
        name, _, value = text.partition(":")
        name, value = name.strip().lower(), value.strip()


def value_of(column: str, fields: dict[str, str]):
    v = fields.get(HEADERS[column])
    if v is None:
        return None
    if column == "content_length":
        return int(v)
    return v[1:-1] if column in ("record_id", "refers_to") and v[:1] == "<" and v[-1:] == ">" else v


def read_records(f, columns: Sequence[str], filters: Sequence[ds.Filter]) -> Iterator[dict]:
    """The records of an open archive that pass the filters. Headers come first; a
    block is only passed over if the record fails or no column needs its bytes, and
    a payload is only read if ``payload`` is asked for."""
    block = "payload" in columns or "payload_bytes" in columns
    while True:
        start = f.readline()
        if not start:
            return
        if not start.strip():
            continue
        if not start.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {start[:80]!r}")
        fields = dict(field_lines(f))
        left = int(fields["content-length"])
        end = f.tell() + left
        if all(holds(p, lambda c: value_of(c, fields)) for p in filters):
            out = {c: value_of(c, fields) for c in columns if c in HEADERS}
            if "headers" in columns:
                out["headers"] = list(fields.items())
            if block:
                http = fields.get("content-type", "").lower().startswith("application/http")
                said = {}
                if http:
                    said = dict(field_lines(f, left))
                    left = end - f.tell()
                size = left
                if fields.get("warc-type", "").lower() == "revisit":    # the block ends with the HTTP fields
                    n = said.get("content-length", "")
                    size = int(n) if n.isdigit() else None
                out["payload_bytes"] = size
                if "payload" in columns:
                    out["payload"] = None if size is None or size > left else f.read(left)
            yield out
        f.seek(end)


class WarcReader(ds.DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.columns = schema.names
        self.path = options["path"]
        self.limit = int(options.get("partitionbytes", FILE_BYTES))
        self.filters: list[ds.Filter] = []
        self.arrow = pa.schema([pa.field(n, ARROW[n]) for n in schema.names])

    def pushFilters(self, filters):
        for f in filters:
            if pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self):
        store, path = open_store(self.path)
        info = store.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else store.get_file_info(pafs.FileSelector(path, recursive=True))
        files = [(x.path, x.size) for x in found if x.is_file and not x.base_name.startswith(("_", "."))]
        return [Files(g) for g in pack(files, self.limit)] or [Files([])]

    def read(self, partition: Files):
        store, _ = open_store(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as buffered:
                f = gzip.GzipFile(fileobj=buffered) if path.endswith(".gz") else buffered
                for r in read_records(f, self.columns, self.filters):
                    rows.append(r)
                    size += len(r.get("payload") or b"")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, size = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c.name) for r in rows], c.type) for c in self.arrow],
                                          schema=self.arrow)


ARROW = {c: pa.string() for c in HEADERS} | {
    "content_length": pa.int64(), "headers": pa.map_(pa.string(), pa.string()), "payload_bytes": pa.int64(),
    "payload": pa.binary()}


class WarcSource(ds.DataSource):
    """``spark.read.format("warc").load(folder)``; a schema that names fewer columns spares
    the work for the others. Option partitionBytes: whole files that a partition takes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD_DDL

    def reader(self, schema: StructType) -> WarcReader:
        if unknown := set(schema.names) - set(ARROW):
            raise ValueError(f"no such WARC columns: {sorted(unknown)}")
        return WarcReader(schema, self.options)


UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def size_of(text: str) -> int:
    number = text.strip().lower().rstrip("bkmg")
    return int(number) * UNITS[text.strip().lower()[len(number):][:1]]


def read_archives(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """The records of the archives at ``path`` (a file or a folder; plain, or .gz), with
    ``columns`` of RECORD_DDL (all by default). Filters on header columns are applied
    before blocks are read.

    A header that a record lacks is null. ``payload`` is what follows the HTTP fields of
    an application/http block, else the block; a revisit that leaves it out has a null
    payload and, in payload_bytes, the size its HTTP fields give. No archives: no rows."""
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")
    ddl = [c.strip() for c in RECORD_DDL.split(", ")]
    ddl = [c for c in ddl if not columns or c.split()[0] in columns]
    return spark.read.format("warc").schema(", ".join(ddl)) \
        .option("partitionBytes", size_of(spark.conf.get("spark.sql.files.maxPartitionBytes", str(FILE_BYTES)))).load(path)


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """What archives of write_archives hold, a row for each record: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Responses are measured on the payloads read
    back; of revisits only the headers and HTTP fields are read."""
    told = ["record_type", "record_id", "refers_to", "payload_digest"]
    full = read_archives(spark, path, [*told, "payload"]).where(F.col("record_type") == "response") \
        .select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                base32(F.sha1("payload")).alias("digest"))
    short = read_archives(spark, path, [*told, "payload_bytes"]).where(F.col("record_type") == "revisit") \
        .select("*", F.substring("payload_digest", len("sha1:") + 1, 32).alias("digest"))
    cols = [page_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes",
            F.col("digest").alias("payload_digest"), "record_type",
            page_of(F.col("refers_to")).cast("long").alias("refers_to")]
    return full.select(*cols).unionByName(short.select(*cols))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
keepers AS (SELECT body, max(page_id) AS keeper, count(*) AS copies FROM p GROUP BY body),
d AS (
  SELECT p.page_id, strlen(p.body)::BIGINT AS payload_bytes, sha1(p.body) AS hex,
         copies > 1 AND p.page_id IS DISTINCT FROM keeper AS again, keeper
  FROM p JOIN keepers USING (body))
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}',
    (((('0x' || substr(hex, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN keeper END AS refers_to
FROM d
"""
