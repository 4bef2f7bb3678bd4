"""Staging of intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_SCOPES: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the session's ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder, since
    there the driver and the tasks share one machine; it goes when Python ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="pulsewatch-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[context.applicationId], ignore_errors=True)
    return _LOCAL_DIRS[context.applicationId]


def stage_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return "/".join([staging_root(spark), "pulsewatch", app, *_SCOPES, f"{name}-{uuid.uuid4().hex}"])


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside are deleted at the end, also after a failure."""
    _SCOPES.append(f"run-{uuid.uuid4().hex}")
    folder = "/".join([staging_root(spark), "pulsewatch", spark.sparkContext.applicationId, *_SCOPES])
    try:
        yield folder
    finally:
        _SCOPES.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table and continue from the written copy.

    Cuts the lineage in a way that survives lost executors, and lets the later
    readers prune columns instead of repeating the fact scan.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
