"""Session rules and totals beyond twelve digits."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.operators.recon import corruption_drill, reconcile


class Refusing:
    """A session whose settings can't be changed."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return "false"

        @staticmethod
        def set(key, value):
            raise RuntimeError(f"{key} is locked")

        @staticmethod
        def isModifiable(key):  # noqa: N802
            return False


def test_a_refused_result_setting_is_an_error():
    with pytest.raises(RuntimeError, match="locked"):
        session.ensure_conf(Refusing())


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():  # noqa: N802
            return None

    class Cluster:
        sparkContext = Context  # noqa: N815

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_totals_of_ten_trillion(spark):
    nets = spark.createDataFrame([("shopify", Decimal("10000000000000.00"))], "channel string, warehouse_net_revenue decimal(38,2)")
    bank = nets.select("channel", (F.col("warehouse_net_revenue") - 1).cast("decimal(38,2)").alias("bank_net_revenue"))
    (row,) = reconcile(nets, bank).collect()
    assert row.gap == Decimal("1.00") and row.gap_pct == Decimal("0.0000") and row.status == "RECONCILED"
    (row,) = corruption_drill(nets, bank).collect()
    assert row.warehouse_net_revenue == Decimal("20000000000000.00") and row.gap_pct == Decimal("1.0000")
    assert row.breaches_guardrail


def test_joined_partitions_are_small_unless_a_size_was_chosen(spark):
    """F6, F8, F10: a task's memory follows the advisory size, not the input."""
    size, folders = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    fresh = spark.newSession()
    assert session.ensure_conf(fresh).conf.get(size) == "8m" and fresh.conf.get(folders) == "64"
    chosen = spark.newSession()
    chosen.conf.set(size, "256m")
    assert session.ensure_conf(chosen).conf.get(size) == "256m"


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    """the disk holds the shuffles of running queries, whatever ran before."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    fresh = session.ensure_conf(spark.newSession())
    assert fresh.conf.get(key) == "true"
    chosen = spark.newSession()
    chosen.conf.set(key, "true")
    assert session.ensure_conf(chosen).conf.get(key) == "true"
    sums = fresh.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
    sums.write.parquet(str(tmp_path / "sums"))
    assert sorted(sums.collect()) == sorted(sums.collect()) == sorted(fresh.read.parquet(str(tmp_path / "sums")).collect())


def test_order_pages_leave_no_scratch_table(spark, tmp_path):
    """the order objects go when their pages are written."""
    import os

    from tallyhouse.sources import writers
    rows = spark.sql("select 'SHOP-1' as order_id, timestamp '1995-01-01' as created_at, 'BB-1' as sku, 1 as quantity, "
                     "cast(2 as decimal(12,2)) as price, 'order' as record_type, cast(null as decimal(12,2)) as refund_amount, "
                     "'p.json' as source_file")
    shared = session.shared_dir(spark).removeprefix("file:")
    before = {n for n in os.listdir(shared) if n.startswith("order-objects")}
    assert writers.write_order_pages(rows, str(tmp_path / "shopify"), "1995-01-05") == 1
    assert {n for n in os.listdir(shared) if n.startswith("order-objects")} == before
