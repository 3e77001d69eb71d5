"""SRC-2 + SRC-4: landed interview documents as a Python data source.

A landing container is a versioned table (``sinks.versions``): a delivery is one load,
and its files hold many documents, by upload day. ``spark.read.format("landing")`` plans
partitions of files day by day, prunes days and documents by the query's filters, and reads only
the columns that the query's schema names.

``spark.readStream.format("landing")`` takes what each delivery brought. Its offset is
the last version read, not an upload time: a document that lands late, with an
upload time before the offset, is in a later version all the same, so it is neither
lost nor read twice.
"""

from __future__ import annotations

import datetime
import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sinks.versions import load_range

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no copy of the package

LANDING_DDL = "subject_id string, upload_ts timestamp, xml string, upload_date date"
ARROW = {"subject_id": pa.string(), "upload_ts": pa.timestamp("us", "UTC"), "xml": pa.string(), "upload_date": pa.date32()}
FILE_BYTES = 128 << 20
BATCH_ROWS = 1000
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def land(docs: DataFrame, path: str, load_id: str | None = None) -> int:
    """Deliver ``docs(subject_id, upload_ts, xml)`` to a container, whole or not at all. Ids are
    text. A document without an upload time belongs to no day and is kept."""
    out = docs.select(F.col("subject_id").cast("string").alias("subject_id"), F.col("upload_ts").cast("timestamp").alias("upload_ts"),
                      F.col("xml").cast("string").alias("xml"), F.to_date("upload_ts").alias("upload_date"))
    # a quiet day in one file, a hot day cut into several
    return load_range(out.repartitionByRange("upload_date", "subject_id"), path, append=True, load_id=load_id)


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class DayFiles(ds.InputPartition):
    """Files of one upload day (None: without one)."""

    day: datetime.date | None
    paths: list[str]


class Container:
    """The published versions of a container and their files."""

    def __init__(self, path: str, limit: int):
        self.uri, self.limit = path.rstrip("/"), limit

    def numbers(self) -> list[int]:
        store, root = store_of(self.uri)
        found = store.get_file_info(pafs.FileSelector(f"{root}/_versions", allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[0] != ".")

    def version(self, number: int) -> dict:
        store, root = store_of(self.uri)
        with store.open_input_stream(f"{root}/_versions/{number:020d}.json") as f:
            return json.loads(f.read())

    def files(self, parts: Sequence[dict], wanted) -> list[DayFiles]:
        """Partitions: the files of each wanted day, in groups of about ``limit`` bytes."""
        store, root = store_of(self.uri)
        out = []
        for p in sorted(parts, key=lambda p: (p["day"] is not None, p["day"], p["load"])):
            day = None if p["day"] is None else datetime.date.fromisoformat(p["day"])
            if not wanted(day):
                continue
            room = 0
            for f in store.get_file_info(pafs.FileSelector(f"{root}/data/load={p['load']}/upload_date={p['day'] or NO_DAY}")):
                if not f.is_file or f.base_name.startswith(("_", ".")):
                    continue
                if f.size > room or not out or out[-1].day != day:
                    out.append(DayFiles(day, []))
                    room = self.limit
                out[-1].paths.append(f.path)
                room -= f.size
        return out

    def read(self, part: DayFiles, names: Sequence[str], where) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.uri)
        stored = [n for n in names if n != "upload_date"]
        schema = pa.schema([pa.field(n, ARROW[n]) for n in names])
        scan = pads.dataset(part.paths, filesystem=store, format="parquet")
        for b in scan.to_batches(columns=stored, filter=where, batch_size=BATCH_ROWS):
            cols = []
            for n in names:
                if n == "upload_date":
                    c = pa.array([part.day] * b.num_rows, ARROW[n])
                else:
                    c = b.column(stored.index(n))
                    if n == "upload_ts" and c.type.tz is None:
                        c = c.cast(pa.timestamp("us"), safe=False)
                cols.append(c.cast(ARROW[n], safe=False))
            yield pa.RecordBatch.from_arrays(cols, schema=schema)


def day_test(f: ds.Filter):
    """A predicate on days for a filter on upload_date, or None if it has no such form."""
    if isinstance(f, ds.Not):
        inner = day_test(f.child)
        return None if inner is None else lambda d: d is not None and not inner(d)
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] != "upload_date":
        return None
    if isinstance(f, ds.IsNull):
        return lambda d: d is None
    if isinstance(f, ds.IsNotNull):
        return lambda d: d is not None
    if isinstance(f, ds.In):
        return lambda d: d is not None and d in f.value
    tests = {ds.EqualTo: lambda d: d == f.value, ds.GreaterThan: lambda d: d > f.value, ds.LessThan: lambda d: d < f.value,
             ds.GreaterThanOrEqual: lambda d: d >= f.value, ds.LessThanOrEqual: lambda d: d <= f.value}
    t = tests.get(type(f))
    return None if t is None or f.value is None else lambda d: d is not None and t(d)


def id_test(f: ds.Filter):
    """An Arrow predicate for a filter that names documents by id, or None."""
    if getattr(f, "attribute", None) != ("subject_id",):
        return None
    if isinstance(f, ds.IsNotNull):
        return pads.field("subject_id").is_valid()
    if isinstance(f, ds.EqualTo) and f.value is not None:
        return pads.field("subject_id") == f.value
    if isinstance(f, ds.In) and None not in f.value:
        return pads.field("subject_id").isin(list(f.value))
    return None


class LandingReader(ds.DataSourceReader):
    def __init__(self, names: list[str], container: Container):
        self.names, self.container = names, container
        self.days, self.ids = [], []

    def pushFilters(self, filters):
        for f in filters:
            if (day := day_test(f)) is not None:
                self.days.append(day)
            elif (ids := id_test(f)) is not None:
                self.ids.append(ids)
            else:
                yield f

    def partitions(self):
        last = max(self.container.numbers(), default=0)
        parts = self.container.version(last)["parts"] if last else []
        return self.container.files(parts, lambda d: all(t(d) for t in self.days)) or [DayFiles(None, [])]

    def read(self, partition: DayFiles):
        if partition.paths:
            where = None
            for t in self.ids:
                where = t if where is None else where & t
            yield from self.container.read(partition, self.names, where)


class LandingStreamReader(ds.DataSourceStreamReader):
    def __init__(self, names: list[str], container: Container):
        self.names, self.container = names, container

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max(self.container.numbers(), default=0)}

    def partitions(self, start: dict, end: dict):
        out = []
        for n in range(start["version"] + 1, end["version"] + 1):
            v = self.container.version(n)
            out += self.container.files([p for p in v["parts"] if p["load"] == v["load"]], lambda d: True)
        return out or [DayFiles(None, [])]

    def read(self, partition: DayFiles):
        if partition.paths:
            yield from self.container.read(partition, self.names, None)

    def commit(self, end: dict) -> None:
        pass


class LandingSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return LANDING_DDL

    def _container(self) -> Container:
        return Container(self.options["path"], int(self.options.get("partitionbytes", FILE_BYTES)))

    def reader(self, schema: StructType) -> LandingReader:
        return LandingReader(schema.names, self._container())

    def streamReader(self, schema: StructType) -> LandingStreamReader:
        return LandingStreamReader(schema.names, self._container())


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(LandingSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_container(spark: SparkSession, path: str, columns: Sequence[str] = tuple(ARROW)) -> DataFrame:
    """The documents landed so far."""
    _registered(spark)
    ddl = ", ".join(c for c in LANDING_DDL.split(", ") if c.split()[0] in columns)
    return spark.read.format("landing").schema(ddl).load(path)


def stream_container(spark: SparkSession, path: str) -> DataFrame:
    """The documents of each delivery, as it is published."""
    _registered(spark)
    return spark.readStream.format("landing").load(path)
