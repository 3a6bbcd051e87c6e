"""Schemas, the iteration log and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITER = "__iter"


def interaction_schema(user="user_idx", item="item_idx", timestamp="timestamp", rating="relevance",
                       has_timestamp=True, has_rating=True) -> T.StructType:
    """Schema of an interaction table with the wanted optional columns."""
    fields = [T.StructField(user, T.LongType()), T.StructField(item, T.LongType())]
    if has_timestamp:
        fields.append(T.StructField(timestamp, T.TimestampType()))
    if has_rating:
        fields.append(T.StructField(rating, T.DoubleType()))
    return T.StructType(fields)


RECS = interaction_schema(has_timestamp=False)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A small local table, for fixtures and settings; empty input needs a schema."""
    if not rows and schema is None:
        raise ValueError("empty input needs a schema")
    return spark.createDataFrame(rows, schema)


def check_schema(expected: T.StructType, actual: T.StructType) -> None:
    """Raise unless names and types agree; order and nullability do not matter."""
    def shape(s):
        return {(f.name, f.dataType.simpleString()) for f in s.fields if f.name != ITER}
    missing, extra = shape(expected) - shape(actual), shape(actual) - shape(expected)
    if missing or extra:
        raise ValueError(f"schema mismatch: missing {sorted(missing)}, unexpected {sorted(extra)}")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_tables(tables: dict, path: str) -> None:
    """Write each table to ``path/name``, replacing what is there."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def load_tables(spark: SparkSession, path: str, schemas: dict) -> dict:
    """Read tables back with explicit schemas, so nothing is inferred."""
    return {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.items()}


class IterationLog:
    """An append-only interaction log, one partition directory per iteration label."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema: T.StructType | None = None

    def append(self, df: DataFrame, iteration: str, replace: bool = False) -> None:
        """Write one iteration; an existing label is an error unless ``replace`` is set.

        With ``replace`` a re-run overwrites its own partition only, so a job that failed
        half-way can be repeated.
        """
        if self.schema is not None:
            check_schema(self.schema, df.schema)
            df = df.select(*[f.name for f in self.schema.fields])
        elif ITER in df.columns:
            df = df.drop(ITER)
        label = str(iteration)
        if not replace and _exists(self.spark, f"{self.path}/{ITER}={label}"):
            raise ValueError(f"iteration {label} is already logged")
        if self.schema is None:
            self.schema = df.schema
        (df.withColumn(ITER, F.lit(label)).write.partitionBy(ITER)
         .mode("overwrite" if replace else "append")
         .option("partitionOverwriteMode", "dynamic").parquet(self.path))

    def append_all(self, df: DataFrame, label_column: str) -> None:
        """Write many iterations at once, labelled by a column."""
        out = df.withColumnRenamed(label_column, ITER)
        self.schema = self.schema or T.StructType([f for f in out.schema.fields if f.name != ITER])
        check_schema(self.schema, out.schema)
        # spread each label over tasks by row: a heavy label is not written by one task
        out.write.partitionBy(ITER).mode("append").parquet(self.path)

    def read(self) -> DataFrame | None:
        """The whole log with the label as a string; None before the first append."""
        if self.schema is None:
            return None
        schema = T.StructType([*self.schema.fields, T.StructField(ITER, T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def of_users(self, users: DataFrame) -> DataFrame | None:
        """The part of the log that belongs to the given users."""
        log = self.read()
        return None if log is None else log.join(users.select("user_idx").distinct(), "user_idx", "left_semi")

    def clear(self) -> None:
        """Forget the schema; files stay."""
        self.schema = None


def store_result(df: DataFrame, path: str) -> None:
    """Append result rows to a table of evaluation results."""
    df.write.mode("append").parquet(path)
