"""Every registered query against its SQL check on the smallest supplied tables."""

import pytest

from recspark.queries import QUERIES, SQL_CHECKS

from .oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL_CHECKS))
def test_matches_sql(spark, sf, con, name):
    assert compare(con, QUERIES[name](spark, sf), SQL_CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL_CHECKS)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark, sf):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.fixture(scope="module")
def cold(spark, tmp_path_factory):
    """Two orders years apart; user 3 and item 30 have no event."""
    path = str(tmp_path_factory.mktemp("cold"))
    tables = {
        "customer": ("SELECT * FROM VALUES (1L, 'A', 1.0D, 1), (2L, 'A', 1.0D, 1), (3L, 'B', 1.0D, 1)"
                     " t(c_custkey, c_mktsegment, c_acctbal, c_nationkey)"),
        "part": ("SELECT * FROM VALUES (10L, 'P', 'b', 1.0D, 1), (20L, 'P', 'b', 1.0D, 1), (30L, 'Q', 'b', 1.0D, 1)"
                 " t(p_partkey, p_type, p_brand, p_retailprice, p_size)"),
        "orders": "SELECT * FROM VALUES (1L, 1L, DATE'1995-02-01'), (2L, 2L, DATE'1998-05-01') t(o_orderkey, o_custkey, o_orderdate)",
        "lineitem": ("SELECT * FROM VALUES (1L, 1, 10L, 'N', 5.0D, 0.0D), (2L, 1, 10L, 'R', 5.0D, 0.0D), (2L, 2, 20L, 'N', 5.0D, 0.0D)"
                     " t(l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice, l_discount)")}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{path}/{name}.parquet")
    return path


def test_whole_log_with_cold_users_and_items(spark, cold):
    def got(name):
        return {tuple(r) for r in QUERIES[name](spark, cold).collect()}
    assert got("jn8_all_users_log") == {(1, 1), (2, 2), (3, 0)}
    assert {(r.item_idx, r.pos, r.total) for r in QUERIES["jn6_all_items_stats"](spark, cold).collect()} == {
        (10, 1, 2), (20, 1, 1), (30, 0, 0)}
    assert got("prj7_default_fill") == {(10, 0.5), (20, 0.666666667), (30, 0.5)}
