"""Scan helpers: column pruning, explicit spreading, shared work folders."""

from salesmart.session import shared_base, work_dir
from salesmart.sources import tables
from tests.conftest import SMALL


def test_scans_are_spread_only_when_asked(spark):
    plain = spark.read.parquet(f"{SMALL}/lineitem.parquet").rdd.getNumPartitions()
    assert tables.read_table(spark, SMALL, "lineitem").rdd.getNumPartitions() == plain
    tables.spread_scans(5)
    try:
        df = tables.read_table(spark, SMALL, "lineitem", ["l_orderkey", "l_shipdate"])
        assert df.rdd.getNumPartitions() == 5 and df.columns == ["l_orderkey", "l_shipdate"]
    finally:
        tables.spread_scans(0)
    assert tables.read_table(spark, SMALL, "lineitem").rdd.getNumPartitions() == plain


def test_work_dir_uses_shared_checkpoint_folder(spark):
    assert work_dir(spark, "x").startswith(shared_base(spark))
    assert work_dir(spark, "x") != work_dir(spark, "x")
