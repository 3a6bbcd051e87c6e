"""Canonical recommendation tables over the supplied star schema.

users (user_idx, segment, acctbal, nation), items (item_idx, category, brand, price, size),
log (user_idx, item_idx, relevance, ts, amount, iter).  ``SQL`` holds the same views as
text for checks in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def users(spark, path) -> DataFrame:
    return table(spark, path, "customer").select(
        F.col("c_custkey").alias("user_idx"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nation"))


def items(spark, path) -> DataFrame:
    return table(spark, path, "part").select(
        F.col("p_partkey").alias("item_idx"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("size"))


def log(spark, path) -> DataFrame:
    lines = table(spark, path, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item_idx"),
        F.when(F.col("l_returnflag") != "R", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("relevance"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amount"))
    orders = table(spark, path, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_idx"), F.col("o_orderdate").alias("ts"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-Q"),
                 F.quarter("o_orderdate").cast("string")).alias("iter"))
    return lines.join(orders, "o_orderkey").select(
        "user_idx", "item_idx", "relevance", "ts", "amount", "iter",
        F.col("o_orderkey").alias("order_id"), "line")


def vectors(spark, path) -> DataFrame:
    return table(spark, path, "embeddings").select(F.col("vec_id").alias("__vec"), F.col("embedding").alias("vec"))


def _slots(spark, path, ids: DataFrame, key: str, step: int) -> DataFrame:
    """The number ``__vec`` of every id's vector; ids wrap around the vectors."""
    total = vectors(spark, path).agg(F.count(F.lit(1)).alias("__n"))
    slots = ids.select(key).crossJoin(total)  # one row of totals
    return slots.select(key, ((F.col(key) * step) % F.col("__n")).alias("__vec"))


def item_slots(spark, path) -> DataFrame:
    return _slots(spark, path, items(spark, path), "item_idx", 1)


def user_slots(spark, path) -> DataFrame:
    return _slots(spark, path, users(spark, path), "user_idx", 7)


def item_vectors(spark, path) -> DataFrame:
    return item_slots(spark, path).join(vectors(spark, path), "__vec").select("item_idx", "vec")


def user_vectors(spark, path) -> DataFrame:
    return user_slots(spark, path).join(vectors(spark, path), "__vec").select("user_idx", "vec")


SQL = {
    "users": "SELECT c_custkey AS user_idx, c_mktsegment AS segment, c_acctbal AS acctbal,"
             " c_nationkey AS nation FROM customer",
    "items": "SELECT p_partkey AS item_idx, p_type AS category, p_brand AS brand,"
             " p_retailprice AS price, p_size AS size FROM part",
    "log": "SELECT o_custkey AS user_idx, l_partkey AS item_idx,"
           " cast(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END as bigint) AS relevance,"
           " o_orderdate AS ts, l_extendedprice * (cast(1.0 as double) - l_discount) AS amount,"
           " concat(year(o_orderdate), '-Q', quarter(o_orderdate)) AS iter,"
           " o_orderkey AS order_id, l_linenumber AS line"
           " FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "item_vec": "SELECT p_partkey AS item_idx, embedding AS vec FROM part"
                " JOIN embeddings ON vec_id = p_partkey % (SELECT count(*) FROM embeddings)",
    "user_vec": "SELECT c_custkey AS user_idx, embedding AS vec FROM customer"
                " JOIN embeddings ON vec_id = (c_custkey * 7) % (SELECT count(*) FROM embeddings)",
}


def with_views(sql: str, *names: str, extra: str = "") -> str:
    """Prefix ``sql`` with the named views as common table expressions."""
    ctes = [f"{n} AS ({SQL[n]})" for n in names]
    if extra:
        ctes.append(extra)
    return f"WITH {', '.join(ctes)} {sql}"
