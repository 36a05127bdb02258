"""Queries on landing files and streams."""

import datetime as dt
import json
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.catalog.base import TO_CLEAN, TO_FACT, TO_FIRST, TO_NORM, query, scratch, staged, with_
from tidemark.operators import clean, series
from tidemark.plans.batch import run_batch, run_landing
from tidemark.session import settle
from tidemark.sources import landing as L
from tidemark.sources.bridge import landing_view, read
from tidemark.sources.tables import Warehouse
from tidemark.streaming import ingest

PARTS = 4


def landing_files(spark, sf):
    """Landing view as CSV files: upper-case headers, an extra key column, one file group that lacks a required column.

    A file has one writer, which reads its rows as they were dealt into columnar parts, a fifth of what a shuffle would bring.
    """

    def build(root):
        view = landing_view(spark, sf).withColumn("file", F.pmod(F.hash("row_seq"), F.lit(PARTS)))
        view.write.partitionBy("file").parquet(f"{root}/dealt")
        dealt = spark.read.schema(view.schema).parquet(f"{root}/dealt")
        upper = dealt.select("file", F.col("row_seq").alias("ROW_SEQ"), *[F.col(c).alias(c.upper()) for c in fixed.LANDING_COLUMNS])
        files = [upper.filter(F.col("file") == k).drop("file").coalesce(1) for k in range(PARTS)]
        whole = reduce(lambda a, b: a.unionByName(b), files)
        whole.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{root}/good")
        upper = upper.drop("file")
        upper.drop("MSISDN").limit(3).write.option("header", True).csv(f"{root}/bad")
        return root

    return staged(spark, sf, "landing-files", build)


@query("landing_scan", with_(TO_NORM, "SELECT CAST(row_seq AS VARCHAR) AS row_seq, " + ", ".join(fixed.LANDING_COLUMNS) + " FROM norm"))
def landing_scan(spark, sf):
    rows, _ = L.read_landing(spark, f"{landing_files(spark, sf)}/good")
    return rows.select("row_seq", *fixed.LANDING_COLUMNS)


@query("landing_log", with_(TO_NORM, f"SELECT CAST({PARTS} AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS rows, 'processed' AS status FROM norm UNION ALL SELECT 1, 0, 'failed'"))
def landing_log(spark, sf):
    root = landing_files(spark, sf)
    logs = [L.read_landing(spark, f"{root}/{d}")[1] for d in ("good", "bad")]
    joined = settle(logs[0].unionByName(logs[1]))
    return joined.groupBy("status").agg(F.count("*").alias("files"), F.sum("rows").alias("rows")).select("files", "rows", "status")


@query("extract_log", with_(TO_NORM, f"SELECT CAST({PARTS + 1} AS BIGINT) AS files_found, CAST({PARTS} AS BIGINT) AS files_processed, CAST(1 AS BIGINT) AS files_failed, count(*) AS total_rows_extracted FROM norm"))
def extract_log(spark, sf):
    root = landing_files(spark, sf)
    logs = [L.read_landing(spark, f"{root}/{d}")[1] for d in ("good", "bad")]
    return L.extract_log(settle(logs[0].unionByName(logs[1])))


@query("raw_append", with_(TO_NORM, "SELECT count(*) AS rows, CAST(2 AS BIGINT) AS loads, count(msisdn) AS numbers FROM norm"))
def raw_append(spark, sf):
    """Both halves appended to the raw table, the second one twice under the same load id."""
    rows, _ = L.read_landing(spark, f"{landing_files(spark, sf)}/good")
    root = scratch(spark, "raw")
    for load, part in ((1, 0), (2, 1), (2, 1)):
        L.append_raw(rows.filter(F.col("row_seq").cast("bigint") % 2 == part), root, load, dt.datetime(2026, 1, load))
    raw = spark.read.parquet(f"{root}/raw_data")
    return raw.agg(F.count("*").alias("rows"), F.count_distinct("load_id").alias("loads"), F.count("msisdn").alias("numbers"))


@query("newly_loaded", with_(TO_NORM, "SELECT count(*) FILTER (row_seq % 2 = 1) AS new_records FROM norm"))
def newly_loaded(spark, sf):
    rows, _ = L.read_landing(spark, f"{landing_files(spark, sf)}/good")
    root = scratch(spark, "raw")
    for load, part in ((1, 0), (2, 1)):
        L.append_raw(rows.filter(F.col("row_seq").cast("bigint") % 2 == part), root, load, dt.datetime(2026, 1, load))
    return L.newly_loaded(spark.read.parquet(f"{root}/raw_data"), dt.datetime(2026, 1, 2, 0, 0, 30))


@query("stream_ingest", with_(TO_FACT, "SELECT * FROM fact"))
def stream_ingest(spark, sf):
    """Landing files taken up by the streaming batch."""
    root = scratch(spark, "stream")
    order = [F.col("row_seq").cast("bigint")]
    run = ingest.start_ingest(spark, f"{landing_files(spark, sf)}/good", root, f"{root}/checkpoint", {"availableNow": True}, order=order)
    run.awaitTermination()
    return Warehouse(spark, root).read("fact_abonnements")


@query("stream_replayed", with_(TO_FACT, "SELECT f.msisdn, f.kit_code, f.date_id, f.offre_id, f.geo_id, f.dealer_id_pk, f.debit, (SELECT count(*) FROM landing) AS raw_rows, CAST(1 AS BIGINT) AS batches FROM fact f"))
def stream_replayed(spark, sf):
    """A burst of files in one trigger, which fails after its batch is in and is run again: each file counts once."""
    root = scratch(spark, "replayed")
    source = f"{landing_files(spark, sf)}/good"

    def fail(version):
        raise RuntimeError("lost before the trigger was noted as done")

    def run(after=None):
        order = [F.col("row_seq").cast("bigint")]
        return ingest.start_ingest(spark, source, root, f"{root}/checkpoint", {"availableNow": True}, order=order, after=after)

    try:
        run(fail).awaitTermination()
    except StreamingQueryException as lost:
        if "lost before" not in str(lost):
            raise
    for _ in range(2):
        run().awaitTermination()
    store = Warehouse(spark, root)
    raw = spark.read.parquet(f"{root}/raw_data").count()
    return store.read("fact_abonnements").select(
        "msisdn", "kit_code", "date_id", "offre_id", "geo_id", "dealer_id_pk", "debit", F.lit(raw).cast("bigint").alias("raw_rows"),
        F.lit(len(store.versions("fact_abonnements"))).cast("bigint").alias("batches"))


@query("landing_moved", with_(TO_CLEAN, f"""SELECT (SELECT count(DISTINCT msisdn) FROM clean) AS numbers, (SELECT count(*) FROM landing) AS raw_rows, CAST({PARTS} AS BIGINT) AS files_moved,
 CAST(0 AS BIGINT) AS files_left, CAST(2 AS BIGINT) AS batches"""))
def landing_moved(spark, sf):
    """Landing files loaded in two runs, of which the first dies before it moves its files; a third finds none."""
    source, root = f"{landing_files(spark, sf)}/good", scratch(spark, "moved")
    inbox, done, store = f"{root}/in", f"{root}/processed", Warehouse(spark, f"{root}/w")
    files = L.list_files(spark, source)

    def bring(some):
        for f in some:
            L.copy_file(spark, f, f"{inbox}/{f.rsplit('/', 1)[1]}")

    bring(files[:2])
    died = store.claim("died")
    store.publish(f"etl_landing/taken/{died}", json.dumps(L.list_files(spark, inbox)))
    rows, _ = L.read_landing(spark, inbox)
    run_batch(spark, rows, store.root, [F.col("row_seq").cast("bigint")], died)
    bring(files[2:])
    for _ in range(2):
        run_landing(spark, inbox, done, store.root, [F.col("row_seq").cast("bigint")])
    raw = spark.read.parquet(f"{store.root}/raw_data").count()
    return store.read("clean_data").agg(F.count_distinct("msisdn").alias("numbers")).select(
        "numbers", *[F.lit(n).cast("bigint").alias(c) for c, n in (
            ("raw_rows", raw), ("files_moved", len(L.list_files(spark, f"{done}/*"))), ("files_left", len(L.list_files(spark, inbox))),
            ("batches", len(store.versions("fact_abonnements"))))])


@query("stream_daily_counts", "SELECT CAST(ts AS DATE) AS date, count(*) AS nb_abonnements FROM events GROUP BY 1")
def stream_daily_counts(spark, sf):
    root = scratch(spark, "counts")
    schema = read(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ingest.start_daily_counts(events, root, f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    return Warehouse(spark, root).read("daily_counts")


@query("stream_daily_counts_by_type", "SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS nb_abonnements FROM events GROUP BY 1, 2")
def stream_daily_counts_by_type(spark, sf):
    root = scratch(spark, "counts")
    schema = read(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ingest.start_daily_counts(events, root, f"{root}/checkpoint", {"availableNow": True}, by=("event_type",)).awaitTermination()
    return Warehouse(spark, root).read("daily_counts")


@query("file_order_dedup", with_(TO_FIRST, "SELECT count(*) AS rows, count(DISTINCT msisdn) AS numbers FROM firsts"))
def file_order_dedup(spark, sf):
    """Keep-first by file and line order."""
    rows, _ = L.read_landing(spark, f"{landing_files(spark, sf)}/good")
    kept = clean.dedup_first(clean.valid_only(clean.validate(rows)), "msisdn", L.ORDER_COLUMNS)
    return kept.agg(F.count("*").alias("rows"), F.count_distinct("msisdn").alias("numbers"))


@query("events_per_day", "SELECT CAST(ts AS DATE) AS date, count(*) AS nb_abonnements FROM events GROUP BY 1")
def events_per_day(spark, sf):
    rows = read(spark, sf, "events").select(F.to_date("ts").alias("creation_day"), F.lit(True).alias("is_valid"))
    return series.daily(rows)
