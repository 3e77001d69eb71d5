"""Sinks (SNK-1 .. SNK-6).

No sink funnels data through one task: exports and fan-outs write one file
per task and partition value; loads are made idempotent by dynamic partition
overwrite or an anti-join on the dataset key, never by a driver-side check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import normalise_name, strip


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                 max_records_per_file: int = 5_000_000) -> None:
    """SNK-1: append, no key (parquet)."""
    w = df.write.mode("append").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                batchsize: int = 1000, num_partitions: int | None = None) -> None:
    """SNK-2: batched multi-row inserts into a database table (``batchsize``
    rows per round trip; ``num_partitions`` bounds concurrent connections)."""
    out = df if num_partitions is None else df.coalesce(num_partitions)
    (out.write.mode("append").option("batchsize", batchsize)
     .jdbc(url, table, properties=properties))


def export_csv(df: DataFrame, folder: str) -> None:
    """SNK-3 re-aimed: spreadsheet-friendly CSV with a header line, one file
    per task in ``folder`` (``<dataset>_<start>_<end>``); never coalesced to
    one task."""
    df.write.mode("overwrite").option("header", True).csv(folder)


def fan_out(df: DataFrame, path: str, key: str, out_key: str = "table",
            mode: str = "append") -> None:
    """SNK-4: one sub-table per key value (the 35 SKU tables / 13 column
    tables) as ``partitionBy`` folders named by the normalised key (SC-8).
    The data is NOT repartitioned by the key first, so a hot key is written
    by every task in parallel instead of by one."""
    (df.withColumn(out_key, normalise_name(F.col(key)))
     .write.mode(mode).partitionBy(out_key).parquet(path))


NO_DAY = "__HIVE_DEFAULT_PARTITION__"    # Spark's folder for rows without a partition value


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def load_partitions_idempotent(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """SNK-5 (a): a re-run replaces exactly the partitions that it has rows for
    (dynamic partition overwrite, an option of this write only)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def load_days(df: DataFrame, path: str, first_day: str | None = None, last_day: str | None = None,
              day_col: str = "upload_date") -> int:
    """SNK-5 (a) for a requested range of days (an open end has no bound): afterwards
    the table holds ``df``'s rows for exactly those days, so a day that has
    become empty loses its old rows. Rows without a day stay, unless the load is of
    all days and has none. Returns the rows loaded. Only the list of days and the
    counts reach the driver. Readers may see a load under way; ``versions.load_range``
    publishes it at once."""
    from pyspark.sql import Observation

    spark = df.sparkSession
    obs = Observation()
    day = F.col(day_col).cast("string")
    load_partitions_idempotent(df.observe(obs, F.count(F.lit(1)).alias("rows"), F.collect_set(day).alias("days"),
                                          F.count_if(day.isNull()).alias("dayless")), path, [day_col])
    fs, root = _hadoop_path(spark, path)
    for s in fs.listStatus(root):
        name, _, day = s.getPath().getName().partition("=")
        if day == NO_DAY:
            old = first_day is None and last_day is None and not obs.get["dayless"]
        else:
            old = day not in obs.get["days"] and (first_day or "") <= day <= (last_day or "~")
        if name == day_col and old:
            fs.delete(s.getPath(), True)
    return obs.get["rows"]


def only_new_rows(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-5 (b): one row for each key that is not in the target yet. NULL is a key
    value like any other (null-safe left-anti join; both sides shuffle on the
    key, AQE splits hot keys)."""
    old = target.select(*[F.col(f"`{k}`").alias(f"__old_{k}") for k in keys]).distinct()
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__old_{k}`")) for k in keys]
    return df.dropDuplicates(list(keys)).join(old, same, "left_anti")


def append_new_rows(df: DataFrame, path: str, keys: Sequence[str],
                    partition_by: Sequence[str] = ()) -> int:
    """Append only unseen keys; returns the number of rows appended."""
    spark = df.sparkSession
    if table_exists(spark, path):
        new = only_new_rows(df, spark.read.parquet(path), keys)
    else:                                        # first load
        new = df.dropDuplicates(list(keys))
    new = new.cache()
    n = new.count()
    if n:
        append_table(new, path, partition_by)
    new.unpersist()
    return n


# SNK-6: typed summary tables (fixed values: the summary layouts).
SKU_SUMMARY = T.StructType([
    T.StructField("Period", T.DateType()), T.StructField("SubjectNum", T.StringType()),
    T.StructField("Date", T.TimestampType()), T.StructField("Upload", T.TimestampType()),
    T.StructField("Variable", T.StringType()), T.StructField("Visit_Availability", T.StringType()),
    T.StructField("In_Stock_Status", T.StringType()), T.StructField("No_of_Facings", T.StringType()),
    T.StructField("Display_Location", T.StringType()), T.StructField("Promotion_Active", T.StringType()),
    T.StructField("Type_of_Promotion", T.StringType()), T.StructField("Promo_Signage", T.StringType()),
    T.StructField("Delivery_Source", T.StringType())])
SKU_SALES_INFO = T.StructType([
    T.StructField("Period", T.DateType()), T.StructField("SubjectNum", T.StringType()),
    T.StructField("Date", T.TimestampType()), T.StructField("Upload", T.TimestampType()),
    T.StructField("Variable", T.StringType()),
    T.StructField("Quantity_Delivered", T.DecimalType(10, 2)), T.StructField("Price", T.DecimalType(10, 2)),
    T.StructField("Estimated_Sales", T.DecimalType(10, 2)), T.StructField("Pack_Quantity", T.IntegerType()),
    T.StructField("Keg_Quantity", T.IntegerType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a typed layout: missing columns NULL, text cast with
    ``try_cast`` (bad text -> NULL, counted by QUA), extra columns dropped."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f"`{f.name}`")
            c = strip(c).try_cast(f.dataType) if isinstance(df.schema[f.name].dataType, T.StringType) \
                and not isinstance(f.dataType, T.StringType) else c.cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """SNK-6: create the (empty, typed) table if it does not exist."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)


def append_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                   name: str = "load_counts") -> dict:
    """SNK-1 + AGG-5: append and count the loaded rows in the same pass with
    ``DataFrame.observe`` -- no second scan; only the metric reaches the
    driver."""
    from pyspark.sql import Observation

    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    append_table(observed, path, partition_by)
    return obs.get
