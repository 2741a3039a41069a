"""Every registered query against its check SQL, on the smallest tables."""

import os

import pytest

from workload.compare import connect, differences
from workload.oracles import ORACLES
from workload.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, name, DATA) == ""


def test_label_class_join_keeps_line_items_without_an_order(spark, con, tmp_path):
    for table, key, every in (("lineitem", "l_orderkey", "(l_partkey + l_suppkey) % 3"), ("orders", "o_orderkey", "o_custkey % 5")):
        con.execute(
            f"COPY (SELECT * REPLACE (CASE WHEN {every} <> 0 THEN {key} END AS {key}) FROM {table}) "
            f"TO '{tmp_path}/{table}.parquet' (FORMAT parquet)"
        )
    odd = connect(tmp_path)
    missing, whole = odd.execute("SELECT count(*) - count(l_orderkey), count(*) FROM lineitem").fetchone()
    assert 0 < missing < whole
    assert QUERIES["label_class_join"](spark, str(tmp_path)).where("patientId IS NULL").count() == missing
    assert differences(spark, odd, "label_class_join", str(tmp_path)) == ""


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 11
    assert set(entry.queries()) >= set(entry.oracle_sql())
