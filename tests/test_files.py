"""Landing files, streams, stored results."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import clean
from tidemark.plans.batch import run_batch
from tidemark.sources import landing as L
from tidemark.sources import tables
from tidemark.streaming import ingest

GOOD = "KIT1,21698765432,M18,Pack,50M,El Menzah,Tunis,1001.0,36.85,10.19,El Menzah,Tunis,01/15/2024 10:30:00"


def write(folder, name, header, *lines):
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n")


def test_files_by_header(spark, tmp_path):
    write(tmp_path, "a.csv", fixed.REQUIRED_COLUMNS, GOOD, GOOD.replace("KIT1", "KIT2").replace(",Pack,", ",n/a,"))
    write(tmp_path, "b.csv", [c.lower() for c in reversed(fixed.REQUIRED_COLUMNS)] + ["Extra Column"], ",".join(reversed(GOOD.replace("KIT1", "KIT3").split(","))) + ",more")
    write(tmp_path, "c.csv", fixed.REQUIRED_COLUMNS[:-1], "x")
    write(tmp_path, "d.csv", [" " + c for c in fixed.REQUIRED_COLUMNS], GOOD)
    (tmp_path / "ignored.txt").write_text("x")
    rows, log = L.read_landing(spark, str(tmp_path))
    got = {r["kit_code"]: r for r in rows.collect()}
    assert set(got) == {"KIT1", "KIT2", "KIT3"}
    assert got["KIT2"]["offre"] is None and got["KIT3"]["extra_column"] == "more" and got["KIT1"]["extra_column"] is None
    assert got["KIT3"]["msisdn"] == "21698765432" and got["KIT1"]["postal_code"] == "1001.0"
    seen = {r["file"].rsplit("/", 1)[1]: (r["status"], r["rows"]) for r in log.collect()}
    assert seen == {"a.csv": ("processed", 2), "b.csv": ("processed", 1), "c.csv": ("failed", 0), "d.csv": ("failed", 0)}
    total = L.extract_log(log).first()
    assert tuple(total) == (4, 2, 2, 3)
    kept = clean.dedup_first(clean.valid_only(clean.validate(rows)), "msisdn", L.ORDER_COLUMNS).collect()
    assert [r["kit_code"] for r in kept] == ["KIT1"]


def test_empty_landing(spark, tmp_path):
    rows, log = L.read_landing(spark, str(tmp_path))
    assert rows.count() == 0 and log.count() == 0


def test_stream_in_two_runs_equals_batches(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "w")
    inbox.mkdir()
    number = lambda i: GOOD.replace("98765432", f"2000000{i}").replace("KIT1", f"KIT{i}")
    run = lambda: ingest.start_ingest(spark, str(inbox), root, f"{root}/cp", {"availableNow": True}).awaitTermination()
    write(inbox, "a.csv", fixed.REQUIRED_COLUMNS, number(1), number(2))
    run()
    write(inbox, "b.csv", fixed.REQUIRED_COLUMNS, number(2).replace("KIT2", "NEW").replace(",50M,", ",90M,"), number(3))
    run()
    run()
    store = tables.Warehouse(spark, root)
    got = {r["msisdn"][-1]: (r["kit_code"], r["debit"]) for r in store.read("fact_abonnements").collect()}
    assert got == {"1": ("KIT1", "50M"), "2": ("NEW", "50M"), "3": ("KIT3", "50M")}
    assert spark.read.parquet(f"{root}/raw_data").count() == 4
    first = {r["msisdn"][-1]: r["kit_code"] for r in store.read("fact_abonnements", before=2).collect()}
    assert first == {"1": "KIT1", "2": "KIT2"}


def test_stream_reads_by_header_and_refuses_bad_files(spark, tmp_path):
    inbox, root = tmp_path / "in", str(tmp_path / "w")
    inbox.mkdir()
    write(inbox, "a.csv", list(reversed(fixed.REQUIRED_COLUMNS)), ",".join(reversed(GOOD.split(","))))
    write(inbox, "b.csv", fixed.REQUIRED_COLUMNS[1:], GOOD.replace("KIT1,", ""))
    write(inbox, "c.csv", fixed.REQUIRED_COLUMNS, GOOD.replace("98765432", "20000001"), GOOD.replace("98765432", "20000002") + ",more,still more")
    write(inbox, "d.csv", fixed.REQUIRED_COLUMNS, GOOD.replace("98765432", "20000003").replace("Pack", '"Pack ""Pro"", 50M"'))
    for _ in range(2):
        ingest.start_ingest(spark, str(inbox), root, f"{root}/cp", {"availableNow": True}).awaitTermination()
    rows = {r.msisdn: r for r in tables.Warehouse(spark, root).read("clean_data").filter("is_valid").collect()}
    assert set(rows) == {"21698765432", "21620000003"}
    assert rows["21698765432"].kit_code == "KIT1" and rows["21620000003"].offre == 'Pack "Pro", 50M' and rows["21620000003"].city == "El Menzah"
    log = {r.file.rsplit("/", 1)[1]: (r.status, r.rows) for r in spark.read.parquet(f"{root}/landing_log").collect()}
    assert log == {"a.csv": ("processed", 1), "b.csv": ("failed", 0), "c.csv": ("failed", 0), "d.csv": ("processed", 1)}


def test_batches_without_an_id_follow_each_other(spark, tmp_path):
    root = str(tmp_path / "w")
    read = lambda name, *lines: (write(tmp_path, name, fixed.REQUIRED_COLUMNS, *lines), L.read_landing(spark, [f"{tmp_path}/{name}"])[0])[1]
    number = lambda i: GOOD.replace("98765432", f"2000000{i}").replace("KIT1", f"KIT{i}")
    none = run_batch(spark, read("z.csv", "KIT9,12,M18,Pack,,,,,,,,,x"), root, L.ORDER_COLUMNS)
    assert none["fact_abonnements"].count() == 0 and none["dim_time"].count() == 0
    run_batch(spark, read("a.csv", number(1), number(2)), root, L.ORDER_COLUMNS)
    third = read("b.csv", number(3).replace("2024", "2021"), number(4).replace(",M18,", ",,"))
    run_batch(spark, third, root, L.ORDER_COLUMNS, token="b")
    last = run_batch(spark, third, root, L.ORDER_COLUMNS, token="b")
    assert {r.kit_code for r in last["fact_abonnements"].collect()} == {"KIT1", "KIT2", "KIT3"}
    assert sorted({r.year for r in last["dim_time"].collect()}) == [2021, 2022, 2023, 2024]
    assert spark.read.parquet(f"{root}/raw_data").count() == 5
    kept = spark.read.parquet(f"{root}/fact_unmapped")
    assert [(r.msisdn, list(r.missing_keys)) for r in kept.collect()] == [("21620000004", ["dealer_id_pk"])]
    assert spark.read.parquet(f"{root}/etl_quality").count() == 3


def test_late_days_update_stored_counts(spark, tmp_path):
    source, root = tmp_path / "ev", str(tmp_path / "c")
    day = lambda d, n: spark.createDataFrame([(dt.datetime(2024, 1, d, 5),)] * n, "ts timestamp_ntz")
    day(1, 2).unionByName(day(3, 1)).write.parquet(f"{source}/x1")
    schema = "ts timestamp_ntz"

    def run():
        events = spark.readStream.schema(schema).parquet(f"{source}/*")
        ingest.start_daily_counts(events, root, f"{root}/cp", {"availableNow": True}).awaitTermination()
        return {r["date"].day: r["nb_abonnements"] for r in tables.Warehouse(spark, root).read("daily_counts").collect()}

    assert run() == {1: 2, 3: 1}
    day(1, 3).write.parquet(f"{source}/x2")
    assert run() == {1: 5, 3: 1}
    spark.createDataFrame([(dt.datetime(2022, 6, 20, 5),)], "ts timestamp_ntz").write.parquet(f"{source}/x3")
    assert run() == {1: 5, 3: 1, 20: 1}


def test_result_documents_round_trip(spark, tmp_path):
    runs = spark.createDataFrame([("A", 1.0, 2.0, 3.0, 4.0, 0.5), ("B", 2.0, 3.0, 4.0, 5.0, 0.1)], "model string, MAE double, RMSE double, MAPE double, sMAPE double, training_time double")
    tables.write_results(tables.result_documents(runs.withColumn("timestamp", F.lit("2024-01-01"))), str(tmp_path))
    assert {r["model"]: r["MAPE"] for r in tables.latest_results(spark, str(tmp_path)).collect()} == {"A": 3.0, "B": 4.0}
    indented = tmp_path / "one"
    indented.mkdir()
    (indented / "p.json").write_text('{\n "model": "P",\n "timestamp": "t",\n "metrics": {"MAE": 1.5, "MAPE": 2.5},\n "data_points": {"train_size": 7}\n}')
    r = tables.latest_results(spark, str(indented), one_per_file=True).first()
    assert (r["model"], r["MAE"], r["train_size"]) == ("P", 1.5, 7)


def test_missing_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from tidemark import session

    fake = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://x"), conf=SimpleNamespace(get=lambda *a: None)
    )
    with pytest.raises(ValueError):
        session.shared_dir(fake)


def test_bursts_of_files_are_one_batch_each(spark, tmp_path):
    """Files that come within one interval of the processing-time trigger form one batch, and batches do not overlap."""
    import time

    inbox, root = tmp_path / "in", str(tmp_path / "w")
    inbox.mkdir()
    number = lambda i: GOOD.replace("98765432", f"2000000{i}").replace("KIT1", f"KIT{i}")
    store, running = tables.Warehouse(spark, root), []

    def after(version):
        running.append(version)

    def wait(n):
        end = time.time() + 120
        while len(running) < n and time.time() < end:
            time.sleep(0.2)

    for i in (1, 2, 3):
        write(inbox, f"{i}.csv", fixed.REQUIRED_COLUMNS, number(i))
    query = ingest.start_ingest(spark, str(inbox), root, f"{root}/cp", {"processingTime": "60 seconds"}, after=after)
    try:
        wait(1)
        for i in (4, 5):  # within the minute before the next trigger
            write(inbox, f"{i}.csv", fixed.REQUIRED_COLUMNS, number(i))
        wait(2)
    finally:
        query.stop()
    assert len(running) == 2 and store.versions("fact_abonnements") == running
    loads = spark.read.parquet(f"{root}/raw_data").groupBy("load_id").count().collect()
    assert sorted(r["count"] for r in loads) == [2, 3]


def test_landing_files_move_after_the_load(spark, tmp_path):
    from tidemark.plans.batch import run_landing

    inbox, done, root = tmp_path / "in", tmp_path / "processed", str(tmp_path / "w")
    inbox.mkdir()
    number = lambda i: GOOD.replace("98765432", f"2000000{i}").replace("KIT1", f"KIT{i}")
    write(inbox, "a.csv", fixed.REQUIRED_COLUMNS, number(1), number(2))
    write(inbox, "bad.csv", fixed.REQUIRED_COLUMNS[1:], "x")
    assert run_landing(spark, str(inbox), str(done), root)["fact_abonnements"].count() == 2
    assert [f.name for f in inbox.glob("*.csv")] == ["bad.csv"] and [f.name for f in done.rglob("*.csv")] == ["a.csv"]
    write(inbox, "a.csv", fixed.REQUIRED_COLUMNS, number(3))  # a new file under a name that was there before
    assert run_landing(spark, str(inbox), str(done), root)["fact_abonnements"].count() == 3
    assert len(list(done.rglob("a.csv"))) == 2
    (inbox / "bad.csv").unlink()
    assert run_landing(spark, str(inbox), str(done), root) is None
    assert spark.read.parquet(f"{root}/raw_data").count() == 3


def test_a_landing_file_is_written_from_the_rows_dealt_to_it(spark, sf):
    """Each file's writer reads columnar parts of its own rows, not a shuffle of whole rows."""
    from tidemark.catalog.files import PARTS, landing_files

    root = landing_files(spark, sf)
    dealt = {k: sorted(r[0] for r in spark.read.parquet(f"{root}/dealt/file={k}").select("row_seq").collect()) for k in range(PARTS)}
    files = spark.read.option("header", True).csv(f"{root}/good").selectExpr("CAST(ROW_SEQ AS BIGINT) AS k", "_metadata.file_name AS f")
    held = {}
    for r in files.collect():
        held.setdefault(r.f, []).append(r.k)
    assert len(held) == PARTS and sorted(sorted(v) for v in held.values()) == sorted(dealt.values())
