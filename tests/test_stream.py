"""ST-3: nightly landing folders through Structured Streaming + the loader."""

import shutil

from feeds import EXPECTED_ROWS, make_landing, put
from tallyhouse.sources import manifest as mf
from tallyhouse.streaming.drip import drip


def visible(spark, wh):
    return {t: mf.read_raw(spark, wh, t).count() for t in mf.RAW_SCHEMAS}


def test_drip_nights_restart_and_resent_file(spark, tmp_path):
    landing = tmp_path / "landing"
    make_landing(landing / "2024-07-01")
    wh = mf.Warehouse(str(tmp_path / "wh"))
    ckpt = str(tmp_path / "ckpt")

    stats = drip(spark, str(landing), wh, ckpt, max_files_per_trigger=2)
    assert len({s["batch"] for s in stats}) >= 3          # several micro-batches
    assert visible(spark, wh) == EXPECTED_ROWS

    # next night: one new POS file arrives; same checkpoint -> only it is read
    put(landing / "2024-07-02/pos/store_01_2024-07-02.csv",
        "store_id,timestamp,sku,quantity,amount,txn_type\n"
        "store_01,2024-07-02 10:00:00,BB-KIT-0002,1,5.00,sale\n")
    stats = drip(spark, str(landing), wh, ckpt)
    assert [(s["source"], s["files_seen"], s["loaded_rows"]) for s in stats] == [("pos", 1, 1)]

    # a night re-sent under another folder name, and a stream restarted from a
    # lost checkpoint: every path is offered again, no content is new
    shutil.copytree(landing / "2024-07-01", landing / "2024-07-01-resend")
    stats = drip(spark, str(landing), wh, str(tmp_path / "ckpt-lost"))
    assert sum(s["loaded_rows"] for s in stats) == 0
    want = dict(EXPECTED_ROWS)
    want["pos_transactions"] += 1
    assert visible(spark, wh) == want


def test_a_batch_lists_no_folder(spark, tmp_path, monkeypatch):
    """F2: the files of a micro-batch are named to the reader, so a batch's work does not
    grow with the landing; with too many to name they are found by listing."""
    from tallyhouse.sources import files as fs
    landing = tmp_path / "landing"
    make_landing(landing / "2024-07-01")
    seen = []
    only = fs.Feed.only
    monkeypatch.setattr(fs.Feed, "only", lambda self, chosen, since, paths=None: seen.append(paths) or only(self, chosen, since, paths))
    drip(spark, str(landing), mf.Warehouse(str(tmp_path / "wh")), str(tmp_path / "ckpt"), max_files_per_trigger=2)
    assert seen and all(p and len(p) <= 2 for p in seen)
    assert visible(spark, mf.Warehouse(str(tmp_path / "wh"))) == EXPECTED_ROWS
    monkeypatch.setattr(mf, "NAMED_FILES", 0)
    seen.clear()
    drip(spark, str(landing), mf.Warehouse(str(tmp_path / "wh2")), str(tmp_path / "ckpt2"))
    assert seen and not any(seen)
    assert visible(spark, mf.Warehouse(str(tmp_path / "wh2"))) == EXPECTED_ROWS


def test_pages_of_a_batch_are_read_as_they_were_offered(spark, tmp_path, monkeypatch):
    """a batch's pages and workbooks are found once, to see whether they changed."""
    from tallyhouse.sources import files as fs
    landing = tmp_path / "landing"
    make_landing(landing / "2024-07-01")
    found = []
    load = fs.Feed._load
    monkeypatch.setattr(fs.Feed, "_load", lambda self, *a, **k: found.append(self.source) or load(self, *a, **k))
    wh = mf.Warehouse(str(tmp_path / "wh"))
    stats = drip(spark, str(landing), wh, str(tmp_path / "ckpt"))
    assert {s["source"]: (s["files_seen"], s["loaded_files"], s["skipped_files"]) for s in stats} == {
        "shopify": (2, 2, 0), "amazon": (1, 1, 0), "pos": (2, 2, 0), "product": (1, 1, 0)}
    assert found.count("shopify") == found.count("product") == 1
    assert visible(spark, wh) == EXPECTED_ROWS
