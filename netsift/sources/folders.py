"""Where tables between jobs and checkpoints of streams lie."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder named in spark.checkpoint.dir. Where that is unset: in the warehouse, which all executors
    share, or, with a local master, in a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-folders-"))
        base = _own[0]
    return f"{(base or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/netsift-{name}-{uuid.uuid4().hex}"


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    system, where = _at(spark, path)
    system.delete(where, True)
