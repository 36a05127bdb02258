"""Streaming entry: new landing files run the batch, events update daily counts."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.batch import run_batch
from tidemark.session import prepare, settle
from tidemark.sources.landing import ORDER_COLUMNS, read_landing
from tidemark.sources.tables import Warehouse

#: A batch has few days beside all that are stored.
DAY_BUCKETS = 16


def landing_stream(spark: SparkSession, landing: str, archive: str | None = None, files_per_trigger=None) -> DataFrame:
    """Paths of new landing CSV files; their content is not read here. Read files move to `archive` if one is given."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", "*.csv")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(landing).select("path")


def start_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str, trigger=None, archive=None,
                 order=ORDER_COLUMNS, files_per_trigger=None, multiline=False, after=None) -> StreamingQuery:
    """Run the batch on every trigger over the files that came in since the last one.

    Files are read as the batch reads them: columns by header name, incomplete and malformed files logged and left out; the
    log of each trigger is kept as `landing_log`. Files that arrive within one trigger interval form one batch, and
    batches of a checkpoint never overlap. A batch that is run again after a failure has the version it had before, and
    tables that took it in stay as they are, so each file counts once; a new checkpoint goes on behind the versions there are.
    `after(version)` is called when a batch is in. The default trigger looks every 10 seconds; `{"availableNow": True}` takes
    what is there and stops.
    """
    prepare(spark)
    store = Warehouse(spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        token = f"{json.loads(store.noted('metadata'))['id']}/{batch_id}"
        rows, log = read_landing(session, [r.path for r in batch.collect()], multiline)
        version = Warehouse(session, root).claim(token)
        log.write.mode("overwrite").parquet(f"{root}/landing_log/batch={version}")
        run_batch(session, rows, root, list(order), version)
        if after:
            after(version)

    writer = landing_stream(spark, landing, archive, files_per_trigger).writeStream.foreachBatch(load)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def daily_counts(events: DataFrame, time_column="ts", by=()) -> DataFrame:
    """Events per day. A zoneless time keeps its day whatever zone the session is in."""
    return events.groupBy(F.col(time_column).cast("date").alias("date"), *by).agg(F.count("*").alias("nb_abonnements"))


def start_daily_counts(events: DataFrame, root: str, checkpoint: str, trigger=None, time_column="ts", by=()) -> StreamingQuery:
    """Keep the daily counts in a stored table: each batch adds its own counts to those before, however late its rows are.

    Only the buckets of its days are read and written again. Batches are counted without state, and a batch that is run again
    finds itself in the table, so each row counts once; a new checkpoint adds to what is there.
    """
    spark = prepare(events.sparkSession)
    store, marks = Warehouse(spark, root), Warehouse(spark, checkpoint)

    def merge(batch: DataFrame, batch_id: int) -> None:
        version = store.claim(f"{json.loads(marks.noted('metadata'))['id']}/{batch_id}")
        counted = settle(daily_counts(batch, time_column, by))

        def added(known, _):
            both = counted if known is None else known.unionByName(counted)
            return both.groupBy("date", *by).agg(F.sum("nb_abonnements").alias("nb_abonnements"))

        store.upsert("daily_counts", counted, ["date", *by], added, version, DAY_BUCKETS, True)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
