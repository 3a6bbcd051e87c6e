"""Sources, sinks and the incremental forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.durable import scratch_path
from ..plans.leaderboard import status_counts
from ..sources import views as V
from ..sources.tables import IterationLog, load_tables, save_tables, store_result
from ..streaming.incremental import append_stream, file_stream, latest_stats, maintain_item_stats
from .analysis import SUBS, submissions
from .registry import query


def _users_schema():
    return T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_mktsegment", T.StringType()),
                         T.StructField("c_acctbal", T.DoubleType())])


@query("src1_read_tables", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def read_tables(spark, path):
    # an explicit schema: nothing is inferred and only these columns are read
    return spark.read.schema(_users_schema()).parquet(f"{path}/customer.parquet")


@query("snk1_save_and_load", V.with_views("SELECT segment, cast(count(*) as bigint) AS n FROM users GROUP BY segment", "users"))
def save_and_load(spark, path):
    folder, users = scratch_path(spark, "tables"), V.users(spark, path)
    save_tables({"users": users}, folder)
    return load_tables(spark, folder, {"users": users.schema})["users"].groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


def _stored_log(spark, path):
    sink = IterationLog(spark, scratch_path(spark, "log"))
    sink.append_all(V.log(spark, path).select("user_idx", "item_idx", "relevance", "iter"), "iter")
    return sink


@query("snk2_append_log", V.with_views(
    "SELECT iter AS __iter, cast(count(*) as bigint) AS n, cast(sum(relevance) as bigint) AS positive FROM log GROUP BY iter", "log"))
def append_log(spark, path):
    return _stored_log(spark, path).read().groupBy("__iter").agg(
        F.count(F.lit(1)).alias("n"), F.sum("relevance").alias("positive"))


@query("src2_partition_read", V.with_views(
    "SELECT user_idx, item_idx, relevance FROM log WHERE iter >= '2000-Q1'", "log"))
def partition_read(spark, path):
    # only the matching partition folders are listed and read
    return _stored_log(spark, path).read().filter(F.col("__iter") >= "2000-Q1").select("user_idx", "item_idx", "relevance")


@query("snk3_result_store", f"WITH {SUBS} SELECT status, cast(count(*) as bigint) AS n FROM subs GROUP BY status")
def result_store(spark, path):
    folder, rows = scratch_path(spark, "results"), submissions(spark, path)
    store_result(rows.filter(F.col("status") == "success"), folder)
    store_result(rows.filter(F.col("status") != "success"), folder)
    return status_counts(spark.read.schema(rows.schema).parquet(folder))


LINES = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
                      T.StructField("l_returnflag", T.StringType())])


def _line_stream(spark, path):
    lines = file_stream(spark, path, LINES, "lineitem.parquet")
    return lines.select("l_orderkey", F.col("l_partkey").alias("item_idx"),
                        F.when(F.col("l_returnflag") != "R", 1).otherwise(0).cast("bigint").alias("relevance"))


@query("ext1_stream_item_stats",
       "SELECT l_partkey AS item_idx, cast(count(CASE WHEN l_returnflag <> 'R' THEN 1 END) as bigint) AS pos,"
       " cast(count(*) as bigint) AS total FROM lineitem GROUP BY l_partkey")
def stream_item_stats(spark, path):
    folder = scratch_path(spark, "stream")
    maintain_item_stats(_line_stream(spark, path), f"{folder}/stats", f"{folder}/progress")
    return latest_stats(spark, f"{folder}/stats").select("item_idx", "pos", "total")


@query("ext5_stream_append",
       "SELECT cast(count(*) as bigint) AS n, cast(count(DISTINCT l_partkey) as bigint) AS items FROM lineitem")
def stream_append(spark, path):
    folder = scratch_path(spark, "stream")
    append_stream(_line_stream(spark, path), f"{folder}/log", "stream", f"{folder}/progress")
    return spark.read.parquet(f"{folder}/log").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_idx").alias("items"))
