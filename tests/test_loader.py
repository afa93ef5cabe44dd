"""Exactly-once landing (K-1..K-4, S7, S8), the publish ledger (K-5..K-7) and
the jobs (D-1..D-7)."""

import datetime as dt
import hashlib
import shutil

import pytest

from feeds import BANK_SEED, EXPECTED_ROWS, POS_01, make_landing, put
from tallyhouse.plans import jobs
from tallyhouse.sources import files as fs
from tallyhouse.sources import manifest as mf
from tallyhouse.sources import publish as pb


def counts(spark, wh):
    return {t: mf.read_raw(spark, wh, t).count() for t in mf.RAW_SCHEMAS}


@pytest.fixture
def landing(tmp_path):
    return make_landing(tmp_path / "landing")


@pytest.fixture
def wh(tmp_path):
    return mf.Warehouse(str(tmp_path / "wh"))


def test_hash_is_sha256_of_bytes(spark, landing):
    got = {r.file_name: r.file_hash for r in
           fs.with_hash(fs.read_files(spark, landing, "pos")).collect()}
    assert got["store_01_2024-07-01.csv"] == hashlib.sha256(POS_01.encode()).hexdigest()


def test_second_run_is_a_no_op(spark, landing, wh):
    first = jobs.run_load(spark, wh, landing)
    assert first["loaded_rows"] == sum(EXPECTED_ROWS.values())
    assert counts(spark, wh) == EXPECTED_ROWS
    again = jobs.run_load(spark, wh, landing)
    assert again["loaded_rows"] == 0 and again["skipped_files"] == 6
    assert counts(spark, wh) == EXPECTED_ROWS
    assert mf.manifest_coverage(spark, wh, landing, "amazon").count() == 0   # C-16


def test_crash_before_commit_then_rerun_equals_clean_run(spark, landing, wh):
    with pytest.raises(mf.CrashForTest):
        mf.load_source(spark, wh, landing, "pos", crash_before_commit=True)
    assert counts(spark, wh)["pos_transactions"] == 0        # written but invisible
    stats = mf.load_source(spark, wh, landing, "pos")
    assert stats["loaded_files"] == 2
    assert counts(spark, wh)["pos_transactions"] == EXPECTED_ROWS["pos_transactions"]


def test_same_bytes_twice_changed_bytes_and_empty_file(spark, landing, wh, tmp_path):
    mf.load_source(spark, wh, landing, "pos")
    root = tmp_path / "landing"
    shutil.copy(root / "pos/store_01_2024-07-01.csv", root / "pos/store_01_copy.csv")
    put(root / "pos/store_05_2024-07-04.csv", "store_id,timestamp,sku,quantity,amount,txn_type\n")
    stats = mf.load_source(spark, wh, landing, "pos")
    # the two loaded files and the copy are skipped by content; the header-only
    # file is loaded and recorded with 0 rows
    assert (stats["loaded_files"], stats["skipped_files"], stats["loaded_rows"]) == (1, 3, 0)
    man = {r.file_path.split("/")[-1]: r.rows_loaded for r in mf.read_manifest(spark, wh).collect()}
    assert man["store_05_2024-07-04.csv"] == 0
    # same name, new bytes: loaded again, old rows stay (append, quirk Q-2)
    put(root / "pos/store_01_2024-07-01.csv", POS_01 + "store_01,2024-07-01 13:00:00,BB-KIT-0002,1,5.00,sale\n")
    stats = mf.load_source(spark, wh, landing, "pos")
    assert stats["loaded_files"] == 1 and stats["loaded_rows"] == 3
    assert counts(spark, wh)["pos_transactions"] == EXPECTED_ROWS["pos_transactions"] + 3
    # option: the newest version of a path supersedes the older one
    assert mf.read_raw(spark, wh, "pos_transactions", supersede_by_path=True).count() == \
        EXPECTED_ROWS["pos_transactions"] + 1


def test_reset_empties_everything(spark, landing, wh):
    jobs.run_load(spark, wh, landing)
    mf.reset_schema(spark, wh)
    assert set(counts(spark, wh).values()) == {0}
    assert jobs.run_load(spark, wh, landing)["loaded_rows"] == sum(EXPECTED_ROWS.values())


def test_sense(spark, landing, tmp_path):
    assert jobs.sense_files(spark, landing)["present"]["pos"] == 2
    empty = tmp_path / "empty"
    (empty / "shopify").mkdir(parents=True)
    with pytest.raises(jobs.PipelineError, match="sense failed"):
        jobs.sense_files(spark, str(empty))
    # one store's files missing is tolerated (the source still has files)
    make_landing(tmp_path / "no_store_01")
    (tmp_path / "no_store_01" / "pos" / "store_01_2024-07-01.csv").unlink()
    assert jobs.sense_files(spark, str(tmp_path / "no_store_01"))["present"]["pos"] == 1
    # a partial source set passes when only it is required
    make_landing(tmp_path / "partial")
    shutil.rmtree(tmp_path / "partial" / "amazon")
    assert jobs.sense_files(spark, str(tmp_path / "partial"), ["shopify", "pos"])


def test_publish_upsert_and_gate(spark, wh):
    d = dt.date(2024, 7, 9)
    assert not pb.is_published(spark, wh, d)
    pb.publish(spark, wh, d, 10)
    pb.publish(spark, wh, d, 12)
    pb.publish(spark, wh, dt.date(2024, 7, 10), 3, status="unverified")
    rows = pb.read_ledger(spark, wh).collect()
    assert len(rows) == 2
    assert [r.rows_loaded for r in rows if r.run_date == d] == [12]
    assert pb.is_published(spark, wh, d)
    assert not pb.is_published(spark, wh, dt.date(2024, 7, 10))
    latest = pb.latest_publishes(pb.read_ledger(spark, wh)).collect()
    assert [r.run_date for r in latest] == [dt.date(2024, 7, 10), d]


def test_pipeline_and_backfill(spark, landing, wh, tmp_path):
    seed = tmp_path / "bank.csv"
    put(seed, BANK_SEED)
    bank = fs.read_bank_seed(spark, str(seed))
    cats = ("Decor", "Kitchen")
    out = jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 9), bank, categories=cats)
    assert out["publish"]["status"] == "published"
    assert out["build"]["fact_order_lines"] == 3 + 3    # deduped shopify lines + POS sale-type rows
    built = jobs.Built(spark, wh)
    assert built.build_id == out["build"]["build_id"]
    recon = {r.channel: r for r in built.revenue_reconciliation.collect()}
    assert recon["shopify"].status == "RECONCILED"          # 2*10+5+10 - 5 = 30
    res = jobs.backfill(spark, landing, wh, dt.date(2024, 7, 10), dt.date(2024, 7, 11), bank,
                        categories=cats)
    assert [r["status"] for r in res] == ["ok", "ok"] and res[0]["rows"] == 0
    # a failing gate is recorded and the loop continues
    bad = jobs.backfill(spark, landing, wh, dt.date(2024, 7, 12), dt.date(2024, 7, 13), bank,
                        categories=("Bedding",))
    assert [r["status"] for r in bad] == ["failed", "failed"]
    assert "accepted_values:dim_product.category" in bad[0]["error"]
    assert not pb.is_published(spark, wh, dt.date(2024, 7, 12))
    skip = jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 14), bank, skip_checks=True,
                             categories=cats)
    assert skip["publish"]["status"] == "unverified"
    assert not pb.is_published(spark, wh, dt.date(2024, 7, 14))
    load_only = jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 15), bank, skip_build=True,
                                  categories=cats)
    assert load_only["build"] is None and load_only["publish"]["status"] == "unverified"


def test_crash_mid_build_keeps_previous_build(spark, landing, wh, tmp_path, monkeypatch):
    seed = tmp_path / "bank.csv"
    put(seed, BANK_SEED)
    bank = fs.read_bank_seed(spark, str(seed))
    jobs.run_load(spark, wh, landing)
    first = jobs.run_build(spark, wh, bank)["build_id"]
    # a build that dies after writing some tables
    tables = jobs.BUILT_TABLES
    monkeypatch.setattr(jobs, "BUILT_TABLES", tables[:3] + ("no_such_model",))
    with pytest.raises(Exception):
        jobs.run_build(spark, wh, bank)
    monkeypatch.setattr(jobs, "BUILT_TABLES", tables)
    assert jobs.current_build(spark, wh) == first
    assert jobs.Built(spark, wh).dim_date.count() > 0


def test_views_and_cli(spark, landing, wh, tmp_path, capsys):
    from tallyhouse.__main__ import main
    seed = tmp_path / "bank.csv"
    put(seed, BANK_SEED)
    assert main(["ingest", "--raw-dir", landing, "--warehouse", wh.root]) == 0
    assert '"loaded_rows": 5' in capsys.readouterr().out
    assert main(["pipeline", "--raw-dir", landing, "--warehouse", wh.root, "--bank-seed", str(seed),
                 "--run-date", "2024-07-09", "--categories", "Decor,Kitchen"]) == 0
    views = jobs.register_views(spark, wh)
    assert {"fct_revenue_reconciliation", "fact_order_lines", "publish_log"} <= set(views)
    models = {v for v in views if v.startswith(("stg_", "int_", "dim_", "fact_", "fct_"))}
    assert len({v for v in models if v.startswith("stg_")}) == 4
    assert len({v for v in models if v.startswith("int_")}) == 4
    assert len({v for v in models if v.startswith(("dim_", "fact_", "fct_"))}) == 6
    assert spark.sql("SELECT count(*) AS n FROM stg_pos_transactions WHERE txn_type = 'training'"
                     ).first().n == 1
    # the runbook's two checks after a backfill, as plain SQL
    recon = spark.sql("SELECT * FROM fct_revenue_reconciliation").collect()
    assert {r.channel for r in recon} == {"amazon", "pos", "shopify"}
    latest = spark.sql("SELECT * FROM publish_log ORDER BY run_date DESC LIMIT 10").collect()
    assert [(str(r.run_date), r.status) for r in latest] == [("2024-07-09", "published")]
    assert main(["sql", "--warehouse", wh.root, "--published-only",
                 "SELECT count(*) AS n FROM fact_order_lines"]) == 0
    # no fact date is a published night here, so consumers see nothing
    assert "|0|" in capsys.readouterr().out.replace(" ", "")


def test_raw_reads_prune_partitions_without_a_join(spark, landing, wh):
    jobs.run_load(spark, wh, landing)
    plan = mf.read_raw(spark, wh, "pos_transactions")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch_id" in plan.split("PartitionFilters")[1][:200]
    assert "Join" not in plan and "Exchange" not in plan


def test_dead_batches_are_deleted(spark, landing, wh):
    with pytest.raises(mf.CrashForTest):
        mf.load_source(spark, wh, landing, "pos", crash_before_commit=True)
    mf.load_source(spark, wh, landing, "pos")
    assert mf.drop_dead_batches(spark, wh) == 1 and mf.drop_dead_batches(spark, wh) == 0
    assert counts(spark, wh)["pos_transactions"] == EXPECTED_ROWS["pos_transactions"]


def test_failed_gate_keeps_the_previous_build_and_unchanged_inputs_are_not_rebuilt(spark, landing, wh, tmp_path):
    seed = tmp_path / "bank.csv"
    put(seed, BANK_SEED)
    bank = fs.read_bank_seed(spark, str(seed))
    cats = ("Decor", "Kitchen")
    first = jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 9), bank, categories=cats)["build"]
    again = jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 10), bank, categories=cats)["build"]
    assert again["build_id"] == first["build_id"] and again["unchanged"] and not first["unchanged"]
    put(tmp_path / "landing/pos/store_02_2024-07-05.csv", POS_01.replace("store_01", "store_02"))
    with pytest.raises(jobs.PipelineError):
        jobs.run_pipeline(spark, landing, wh, dt.date(2024, 7, 11), bank, categories=("Bedding",))
    assert jobs.current_build(spark, wh) == first["build_id"]
    assert jobs.drop_old_builds(spark, wh) == 1
    assert jobs.Built(spark, wh).dim_date.count() > 0


def test_overlapping_loads_count_once(spark, landing, wh):
    def second():
        assert mf.load_source(spark, wh, landing, "pos")["loaded_files"] == 2

    mf.load_source(spark, wh, landing, "pos", before_commit=second)
    assert mf.read_manifest(spark, wh).count() == 4 and mf.loaded_files(spark, wh).count() == 2
    for supersede in (False, True):
        assert mf.read_raw(spark, wh, "pos_transactions", supersede).count() == EXPECTED_ROWS["pos_transactions"]


def test_rerun_opens_no_known_file_unless_verifying(spark, landing, wh, tmp_path):
    import os
    path = tmp_path / "landing/pos/store_01_2024-07-01.csv"
    mf.load_source(spark, wh, landing, "pos")
    stat = os.stat(path)
    put(path, POS_01.replace("10.00", "11.00"))            # same length and time, other bytes
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert mf.load_source(spark, wh, landing, "pos")["loaded_files"] == 0
    assert mf.load_source(spark, wh, landing, "pos", verify=True)["loaded_files"] == 1
    assert mf.load_source(spark, wh, landing, "pos")["loaded_files"] == 0


def test_republishing_many_dates_is_one_append(spark, wh):
    nights = spark.range(400).selectExpr("cast(date '2024-01-01' + cast(id as int) as date) as run_date",
                                         "id as rows_loaded", "'unverified' as status")
    pb.publish_all(spark, wh, nights)
    pb.publish_all(spark, wh, nights.selectExpr("run_date", "rows_loaded + 1 as rows_loaded", "'published' as status"))
    rows = pb.read_ledger(spark, wh).collect()
    assert len(rows) == 400 and {r.status for r in rows} == {"published"}
    assert sum(r.rows_loaded for r in rows) == sum(range(1, 401))
    assert pb.read_entries(spark, wh).select("version").distinct().count() == 2
