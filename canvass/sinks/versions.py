"""SNK-5: loads of a range of days that readers see whole or not at all.

A load writes Parquet partitions by day into a folder of its own, ``data/load=<id>``, and
then publishes a version: a small file that lists, for each day, the loads whose
partition of that day is in the table. Its name is the version's number, and it comes into being
by one rename that fails if the number is taken, so of two loads that started from
one version the second reads what the first published: it goes on from there if
they own different days, and fails with ``LoadConflict`` if not. A load that fails or
is lost midway leaves a folder that no version names. A version has an entry for
each day, never for each file or row.

The rename is atomic on HDFS and the like; on an object store without such a rename
one writer at a time is safe.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS, DATA, LOAD = "_versions", "data", "load"


class LoadConflict(RuntimeError):
    """Another load has published rows of the same days meanwhile."""


@dataclass(frozen=True)
class Part:
    """A day of a load (day None: its rows without a day, which belong to its range)."""

    day: str | None
    load: str
    rows: int
    range: str


@dataclass(frozen=True)
class Version:
    number: int = 0
    load: str = ""
    first: str | None = None
    last: str | None = None
    append: bool = False
    day_col: str = ""
    schema: str = ""
    parts: tuple[Part, ...] = ()

    def added(self) -> list[Part]:
        """What this version's own load brought."""
        return [p for p in self.parts if p.load == self.load]

    def text(self) -> str:
        return json.dumps(asdict(self))


def version_of(text: str) -> Version:
    d = json.loads(text)
    return Version(**d | {"parts": tuple(Part(**p) for p in d["parts"])})


def version_file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{VERSIONS}/{number:020d}.json"


def range_name(first: str | None, last: str | None) -> str:
    return f"{first or ''}..{last or ''}"


def owns(first: str | None, last: str | None, part: Part) -> bool:
    """Whether a load of [first, last] replaces the part. Rows without a day belong to the
    range that brought them, and to a load of all days."""
    if part.day is None:
        return (first is None and last is None) or part.range == range_name(first, last)
    return (first is None or first <= part.day) and (last is None or part.day <= last)


def meet(a: Version, first: str | None, last: str | None) -> bool:
    return (a.first is None or last is None or a.first <= last) and (a.last is None or first is None or first <= a.last)


# --- files, through Hadoop's interface: any store -------------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Write the version under its number; False if another load has taken it."""
    jvm = spark._jvm
    target = version_file(path, version.number)
    fs, dst = _fs(spark, target)
    _, tmp = _fs(spark, f"{path.rstrip('/')}/{VERSIONS}/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(version.text().encode()))
    out.close()
    plain = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()[0]   # no overwrite
    options = jvm.java.lang.reflect.Array.newInstance(plain.getClass(), 1)
    options[0] = plain
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(dst), options)
        return True
    except Exception:
        fs.delete(tmp, False)
        if fs.exists(dst):
            return False
        raise


# --- the table --------------------------------------------------------------------------

def version_numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path.rstrip('/')}/{VERSIONS}") if n.endswith(".json") and n[0] != ".")


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A published version, by default the last (number 0: an empty table)."""
    if number is None:
        number = max(version_numbers(spark, path), default=0)
    return version_of(_read(spark, version_file(path, number))) if number else Version()


def load_range(df: DataFrame, path: str, first_day: str | None = None, last_day: str | None = None,
               day_col: str = "upload_date", *, append: bool = False, load_id: str | None = None) -> int:
    """Afterwards the table holds ``df``'s rows for exactly the days of the range (an open
    end has no bound), and its old rows for all others; with ``append``, ``df``'s rows beside the
    old ones. Readers see the change at once or not at all. Returns the rows loaded.

    Rows without a day are kept: they belong to the range, and a re-run replaces them.
    A row of a day outside the range is an error. A ``load_id`` that the table
    holds already is not loaded again (a replayed micro-batch)."""
    spark = df.sparkSession
    path = path.rstrip("/")
    base = read_version(spark, path)
    if load_id is not None and (done := [p for p in base.parts if p.load == load_id]):
        return sum(p.rows for p in done)
    load = load_id or uuid.uuid4().hex
    folder = f"{path}/{DATA}/{LOAD}={load}"
    # a replay may find what a lost run left; no version names it
    df.write.mode("overwrite").partitionBy(day_col).parquet(folder)
    counts = spark.read.schema(df.schema).parquet(folder).groupBy(F.col(day_col).cast("string").alias("day")).count().collect()
    mine = tuple(Part(r["day"], load, r["count"], range_name(first_day, last_day)) for r in counts)
    if strange := [p.day for p in mine if p.day is not None and not owns(first_day, last_day, p)]:
        raise ValueError(f"rows of days outside {range_name(first_day, last_day)}: {sorted(strange)[:5]}")
    seen = base
    while True:
        kept = tuple(p for p in seen.parts if append or not owns(first_day, last_day, p))
        new = Version(seen.number + 1, load, first_day, last_day, append, day_col, df.schema.json(), kept + mine)
        if _publish(spark, path, new):
            return sum(p.rows for p in mine)
        for n in [n for n in version_numbers(spark, path) if n > seen.number]:
            other = read_version(spark, path, n)
            if meet(other, first_day, last_day) and not (append and other.append):
                raise LoadConflict(f"{path}: version {n} has loaded {range_name(other.first, other.last)} meanwhile")
            seen = other


def _of_parts(parts: Iterable[Part], day_col: str):
    by_load: dict[str, list[str | None]] = {}
    for p in parts:
        by_load.setdefault(p.load, []).append(p.day)
    out = F.lit(False)
    for load, days in by_load.items():
        day = F.col(day_col).cast("string").isin([d for d in days if d is not None])
        out = out | ((F.col(LOAD) == load) & (day | F.col(day_col).isNull() if None in days else day))
    return out


def read_table_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a published version, by default the last. Files never change, so
    what a version names can be read however many loads come after."""
    v = read_version(spark, path, number)
    if not v.number:
        raise FileNotFoundError(f"no version of {path}")
    schema = T.StructType.fromJson(json.loads(v.schema))
    if not v.parts:
        return spark.createDataFrame([], schema)
    root = f"{path.rstrip('/')}/{DATA}"
    loads = sorted({p.load for p in v.parts})
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])) \
        .option("basePath", root).parquet(*[f"{root}/{LOAD}={x}" for x in loads])
    return rows.where(_of_parts(v.parts, v.day_col)).select(*[F.col(f"`{f.name}`") for f in schema])


def expire(spark: SparkSession, path: str, keep: int = 1, older_than_s: float = 86_400) -> int:
    """Remove all but the last ``keep`` versions, and the folders of loads that none of
    those names and that nobody has written to for ``older_than_s`` (a load may be
    under way). Returns the folders removed."""
    numbers = version_numbers(spark, path)
    live = {p.load for n in numbers[-keep:] for p in read_version(spark, path, n).parts}
    fs, root = _fs(spark, f"{path.rstrip('/')}/{DATA}")
    now = spark._jvm.java.lang.System.currentTimeMillis()
    gone = [s.getPath() for s in (fs.listStatus(root) if fs.exists(root) else [])
            if s.getPath().getName().partition("=")[2] not in live and now - s.getModificationTime() >= older_than_s * 1000]
    for n in numbers[:-keep]:
        fs.delete(_fs(spark, version_file(path, n))[1], False)
    for p in gone:
        fs.delete(p, True)
    return len(gone)
