"""What the operators of this package share: the shared work folder and small helpers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import time
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, a local session gets one of its own; a cluster raises, as its
    machines share no temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        known = sc._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = known.get() if known.isDefined() else "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


_TRIM_SECONDS, _trimmed = 5.0, [0.0]


def trim_driver(spark: SparkSession) -> None:
    """Have the driver's JVM return what its native code has freed to the machine.

    Jobs run on hundreds of short-lived threads (exchanges, broadcasts, compilers), whose allocations the C library keeps
    in arenas by thread; over a few hundred jobs these grow beyond the heap. JVMs without the command keep them.
    """
    if time.monotonic() - _trimmed[0] < _TRIM_SECONDS:
        return
    _trimmed[0] = time.monotonic()
    sc = spark.sparkContext
    jvm, array = sc._jvm, sc._gateway.new_array
    kinds, values = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[k] = jvm.java.lang.Class.forName(name)
    values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    with contextlib.suppress(Py4JJavaError):
        call = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    trim_driver(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete what ``table`` wrote, through the file system that Spark itself uses."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.table_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    trim_driver(df.sparkSession)
    return out


def give_back_memory() -> None:
    """Return freed memory to the machine: a worker that waits for its next task keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lower_ascii(col):
    return F.translate(col, UPPER, LOWER)


def compact(df: DataFrame, rows: int, per: int = 100_000) -> DataFrame:
    """Narrow rows in as many partitions as their number calls for, so that small frames of an
    iteration do not run hundreds of empty tasks each time."""
    return df.coalesce(max(1, -(-rows // per)))


def text_column(docs: DataFrame, name: str):
    """A string column by its exact name, even where names hold dots; null stays null."""
    return docs[f"`{name}`"].cast("string")


def row_key(df: DataFrame, *columns: str):
    """A string that equal rows, and only they, share in ``columns``; nulls differ from all values."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (df[f"`{n}`"].cast("string") for n in columns)]
    return F.sha2(F.concat(*parts), 256)
