"""Item statistics and log appends over a stream of interaction files.

Both drain what has arrived and stop (``availableNow``); progress is kept in the stream
checkpoint, so the next run continues after a lost executor or driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import ITER
from ..sources.versions import VersionedTables

# After so many versions of changes the whole table is written as one version.
FULL_AFTER = 16


def file_stream(spark: SparkSession, folder: str, schema, name: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(folder)


def _drain(writer, checkpoint: str) -> None:
    query = (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    finally:
        query.stop()


def maintain_item_stats(stream: DataFrame, path: str, checkpoint: str, full_after: int = FULL_AFTER) -> None:
    """Keep (item_idx, pos, total) under ``path`` up to date with the stream.

    The state holds one row per item.  Each micro-batch commits the items it changed as a version of its own number, so a
    repeated batch changes nothing; now and then the whole table is committed instead, which bounds what a reader merges.
    """
    spark = stream.sparkSession
    stats = stream.groupBy("item_idx").agg(
        F.sum("relevance").alias("pos"), F.count("relevance").alias("total"))

    def save(batch: DataFrame, number: int) -> None:
        store = VersionedTables(spark, path)
        if number in store.versions():
            return
        recent = _parts(store)
        if len(recent) + 1 < full_after:
            store.save({"items": batch}, {"full": not recent}, number)
        else:
            store.save({"items": _merged([*recent, (number, batch)])}, {"full": True}, number)
            store.clear(keep=full_after)

    _drain(stats.writeStream.outputMode("update").foreachBatch(save), checkpoint)


def _parts(store: VersionedTables) -> list[tuple[int, DataFrame]]:
    """The newest whole table and the changes after it."""
    found = []
    for version in reversed(store.versions()):
        found.append((version, store.load(version)["items"]))
        if store.settings(version)["full"]:
            break
    return found[::-1]


def _merged(parts) -> DataFrame:
    rows = reduce(DataFrame.unionByName, [df.select("item_idx", "pos", "total", F.lit(v).alias("__version")) for v, df in parts])
    last = rows.groupBy("item_idx").agg(F.max_by(F.struct("pos", "total"), "__version").alias("s"))
    return last.select("item_idx", "s.pos", "s.total")


def latest_stats(spark: SparkSession, path: str) -> DataFrame:
    """Every item's newest committed numbers."""
    parts = _parts(VersionedTables(spark, path))
    if not parts:
        raise ValueError(f"no committed version in {path}")
    return _merged(parts)


def append_stream(stream: DataFrame, path: str, label: str, checkpoint: str) -> None:
    """Append every micro-batch to the iteration log, idempotently per batch number."""
    def save(batch: DataFrame, number: int) -> None:
        (batch.withColumn(ITER, F.lit(f"{label}_{number}")).write.partitionBy(ITER).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(path))

    _drain(stream.writeStream.foreachBatch(save), checkpoint)
