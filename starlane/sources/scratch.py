"""Where intermediate tables go when the caller names no folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's scratch tables, on storage every executor reaches.

    It lies below ``spark.checkpoint.dir``, or below the warehouse folder where that is
    unset. Hadoop's file system makes it and removes it when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/starlane-scratch/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        system.mkdirs(path)
        system.deleteOnExit(path)
    return folder


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one run; it does not exist yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
