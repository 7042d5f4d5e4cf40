"""Reading and publishing the library's own tables, as versions behind a pointer.

A version is a directory that is written once; small numbered pointer files name versions, and the
one of the largest number the current version. Readers see the old version until the next pointer is
there, and a job that is run again writes its own version over. All file access goes through Spark's file systems.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfmark.operators.inventory import latest_by_key

POINTER = "CURRENT-{}.txt"
CORRUPT = "_corrupt_record"


def read_index(spark: SparkSession, path: str, schema: StructType, key: str, order: str = "seq") -> DataFrame:
    """A JSON-lines index: corrupt and blank lines and rows without the key are skipped, the last row of each key stays.

    Without an ``order`` column in the data, lines count in the order of files and lines.
    """
    raw = spark.read.schema(StructType([*[f for f in schema.fields if f.name != CORRUPT], StructField(CORRUPT, StringType())])).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    rows = raw.withColumn("__line", F.monotonically_increasing_id()).where(F.col(CORRUPT).isNull() & F.col(key).isNotNull() & (F.col(key).cast("string") != "")).drop(CORRUPT)
    by = order if order in raw.columns else "__line"
    return latest_by_key(rows, key, by, "__line").drop("__line")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def _pointers(spark: SparkSession, root: str, name: str) -> list[tuple[int, object]]:
    """(number, file) of the pointers, the newest last. A pointer is written under another name and then renamed, so it is whole."""
    fs, folder, _ = _fs(spark, f"{root}/{name}")
    found = fs.listStatus(folder) if fs.exists(folder) else []
    told = [(re.fullmatch(POINTER.format(r"(\d+)"), f.getPath().getName()), f.getPath()) for f in found]
    return sorted((int(m[1]), p) for m, p in told if m) if told else []


def current_version(spark: SparkSession, root: str, name: str) -> str | None:
    for number, _ in reversed(_pointers(spark, root, name)):
        return spark.read.text(f"{root}/{name}/{POINTER.format(f'{number:09d}')}").first()[0]
    return None


def point_to(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Make a version the current one by a new pointer of the next number; the older ones but the last go.

    At every moment some pointer is there, the one before until the new one's rename is done, so that a
    reader, or a run that follows one which stopped half-way, never finds the table empty.
    """
    old = _pointers(spark, root, name)
    number = old[-1][0] + 1 if old else 0
    fs, fresh, path = _fs(spark, f"{root}/{name}/_pointer-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    if not fs.rename(fresh, path(f"{root}/{name}/{POINTER.format(f'{number:09d}')}")):
        raise RuntimeError(f"{name} was published by another run at the same time")
    for _, p in old[:-1]:
        fs.delete(p, False)


def publish(df: DataFrame, root: str, name: str, version: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Write a version, then point to it. Publishing a version again replaces what an interrupted run left of it."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{root}/{name}/v={version}")
    point_to(df.sparkSession, root, name, version)
    return f"{root}/{name}/v={version}"


def read_published(spark: SparkSession, root: str, name: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The current version, or no rows if there is none."""
    version = current_version(spark, root, name)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(f"{root}/{name}/v={version}")


def publish_all(sections: dict[str, DataFrame], root: str, version: str) -> dict[str, str]:
    """All index sections under one version, one dataset and one pointer each. Sections that readers must see at one version
    together go to a ``snapshots.SnapshotStore``."""
    return {name: publish(df, root, name, version) for name, df in sections.items()}


def publish_daily(daily: DataFrame, root: str, version: str) -> str:
    """One partition per day; days that no longer exist are not in the new version."""
    return publish(daily.withColumn("day", F.col("date")), root, "daily", version, partition_by=["day"])


def publish_weekly(weekly: DataFrame, root: str, version: str) -> str:
    return publish(weekly.withColumn("iso_week", F.col("week")), root, "weekly", version, partition_by=["iso_week"])


def append_log(df: DataFrame, path: str) -> None:
    """Append a run's rows, one partition per run; error messages are cut to 500 characters."""
    if "error_message" in df.columns:
        df = df.withColumn("error_message", F.substring("error_message", 1, 500))
    df.write.mode("append").partitionBy("run_id").parquet(path)


def read_control_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV table with a header; rows that do not have the schema's width or types are dropped."""
    return spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").csv(path)
