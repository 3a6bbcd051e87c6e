"""Cutting lineage in storage that survives a lost executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for local sessions without it."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="recspark-")
    context.setCheckpointDir(configured)
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, beside the checkpoints."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside drop their shuffle files when they end, not at some later collection of garbage."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: written once to the shared folder, then read back by every user."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """The same as a compressed columnar table in the shared folder, for wide rows such as texts."""
    path = scratch_path(df.sparkSession, name)
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
