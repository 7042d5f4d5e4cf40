"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where the session names none, a local session gets one of its own; a cluster
    raises, as its machines share no temporary folder."""
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
