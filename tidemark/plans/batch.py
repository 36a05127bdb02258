"""One batch from landing rows to star tables, checks and audit row."""

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, clean, star
from tidemark.session import prepare, settle
from tidemark.sources.landing import ORDER_COLUMNS, append_raw, list_files, move_file, read_landing
from tidemark.sources.tables import Warehouse

#: Dimensions are small beside the fact.
DIMENSION_BUCKETS = 16
STORED_CLEAN = [c for c in clean.CLEAN_COLUMNS if c != "errors"] + ["validation_errors"]


def run_batch(spark: SparkSession, rows: DataFrame, root: str, order, batch_id: int | None = None, now: dt.datetime | None = None,
              critical_match="documented", token: str | None = None, keep: int | None = None) -> dict[str, DataFrame]:
    """Clean, upsert and report one batch on top of those before.

    A batch without an id claims a version of the warehouse that no other batch has; batches may run side by side, and each
    table takes them in one after another. Running a batch again under its id, or under a `token` that names its input,
    finishes what is missing and changes nothing else. Every table but the calendar is merged by hash buckets of its key:
    buckets without a key of the batch are neither read nor written. With `keep`, files that only older versions than the
    last `keep` need are deleted at the end. Rows without a dimension key, the quality row and the integrity row are kept
    per batch beside the audit row.

    The judged rows feed clean table, dimensions, fact and checks; they are written once and read back. Writes that do
    not depend on each other are submitted side by side, so that small ones do not leave the cluster idle.
    """
    prepare(spark)
    start = now or dt.datetime.now()
    store = Warehouse(spark, root)
    if batch_id is None:
        batch_id = store.claim(token or uuid.uuid4().hex)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    position = F.struct(*order)

    with ThreadPoolExecutor(5) as pool:
        raw = pool.submit(append_raw, rows, root, batch_id, start)
        judged = settle(clean.validate(rows, critical_match).withColumn("_order", position))
        valid = settle(clean.dedup_first(judged.filter("is_valid"), "msisdn", ["_order"]))
        cleaned = pool.submit(_write_clean, store, judged, valid, batch_id)
        members = {
            "offer": (star.offer_members(valid, "_order"), "offre_id", ["nom_offre"]),
            "geo": (star.geo_members(valid, "_order"), "geo_id", star.GEO_KEY),
            "dealer": (star.dealer_members(valid), "dealer_id_pk", ["dealer_id"]),
        }
        pending = {n: pool.submit(_write_dimension, store, n, *m, batch_id, start) for n, m in members.items()}
        dims = {"time": store.upsert("dim_time", valid, [], lambda known, _: star.dim_time_of(valid, known=known), batch_id, 1)}
        dims.update({n: p.result() for n, p in pending.items()})

        loaded, unmapped = star.build_fact(valid, dims)
        loaded = settle(loaded)
        quality = checks.quality_gate(judged, loaded.agg(F.count("*").alias("loaded")))
        counts = pool.submit(settle, quality.select(
            F.col("total_read").alias("read"), F.col("total_read").alias("processed"), "loaded",
            (F.col("total_read") - F.col("total_valid")).alias("rejected"),
        ))
        fact = store.upsert(
            "fact_abonnements", loaded, ["msisdn"],
            lambda known, _: loaded if known is None else star.upsert_fact(known, loaded), batch_id, order=["creation_day"],
        )
        integrity = checks.integrity(fact, dims["time"])
        kept = {"fact_unmapped": unmapped, "etl_quality": quality, "etl_integrity": integrity}
        kept = {n: pool.submit(_write_kept, df, f"{root}/{n}/batch={batch_id}") for n, df in kept.items()}
        counts, cleaned = counts.result(), cleaned.result()
        raw.result()
        kept = {n: f.result() for n, f in kept.items()}

    end = now or dt.datetime.now()
    audit = star.audit_row(spark, "subscription batch", "COMPLETED", start, end, counts)
    audit.write.mode("overwrite").parquet(f"{root}/etl_audit_log/batch={batch_id}")
    if keep:
        for name in ("clean_data", "fact_abonnements", "dim_time", *(f"dim_{n}" for n in members)):
            store.expire(name, keep)
    return {
        "clean_data": cleaned, **{f"dim_{n}": d for n, d in dims.items()}, "fact_abonnements": fact,
        "unmapped": kept["fact_unmapped"], "judged": judged.drop("_order"), "quality": kept["etl_quality"],
        "integrity": kept["etl_integrity"], "audit": spark.read.parquet(f"{root}/etl_audit_log"),
    }


def _write_kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_clean(store: Warehouse, judged: DataFrame, valid: DataFrame, batch_id: int) -> DataFrame:
    incoming = valid.withColumn("validation_errors", F.lit(None).cast("string")).select(*STORED_CLEAN)
    invalid = clean.error_text(judged.filter("NOT is_valid")).select(
        "msisdn", "kit_code", "is_valid", "validation_errors", "offer_category", "_order"
    )
    rows = settle(star.one_per_number(incoming, invalid, ["_order"]))
    return store.upsert(
        "clean_data", rows, ["msisdn"], lambda known, _: star.upsert_clean(rows.limit(0) if known is None else known, rows), batch_id)


def _write_dimension(store: Warehouse, name: str, members: DataFrame, id_column: str, key, batch_id: int, now) -> DataFrame:
    members = settle(members)

    def merged(known, meta):
        if known is None:
            return star.assign_ids(members, id_column, key).withColumn("updated_at", F.lit(now))
        return star.merge_dimension(known, members, id_column, key, now, meta["top"])

    def top(written, meta):
        """The highest key given so far, whichever buckets hold it."""
        return {"top": max(meta.get("top", 0), written.agg(F.max(id_column)).first()[0] or 0)}

    return store.upsert(f"dim_{name}", members, key, merged, batch_id, DIMENSION_BUCKETS, True, meta=top)


def run_landing(spark: SparkSession, landing: str, processed: str, root: str, order=ORDER_COLUMNS, now: dt.datetime | None = None,
                multiline=False) -> dict[str, DataFrame] | None:
    """Load what lies in a landing folder and move the files that were read to the `processed` folder.

    The move has two phases. A run first notes the files it takes under its version; when they are in the star it moves
    those that could be read and notes that it is done. A run that died in between is finished by the next one under the
    same version: its files are found where they are by then, loaded if they are not in, and moved. So each file counts once
    and none is lost. Files that cannot be read stay where they are and are logged by every run. Returns the tables of the
    last batch, or none if there was no file. Two runs on one landing folder must not overlap.
    """
    store = Warehouse(prepare(spark), root)
    tables = None
    open_ = [v for v in store.numbered("etl_landing/taken") if v not in set(store.numbered("etl_landing/done"))]
    found = list_files(spark, landing)
    claimed = {f for v in open_ for f in json.loads(store.noted(f"etl_landing/taken/{v}"))}
    fresh = [f for f in found if f not in claimed]
    if fresh:
        version = store.claim(uuid.uuid4().hex)
        store.publish(f"etl_landing/taken/{version}", json.dumps(fresh))
        open_.append(version)
    for version in open_:
        files = json.loads(store.noted(f"etl_landing/taken/{version}"))
        moved = {f: f"{processed}/{version}/{f.rsplit('/', 1)[1]}" for f in files}
        here = [f if store.exists(f) else moved[f] for f in files]
        rows, log = read_landing(spark, here, multiline)
        log = settle(log)
        log.write.mode("overwrite").parquet(f"{root}/landing_log/batch={version}")
        read = {r.file for r in log.filter("status = 'processed'").select("file").collect()}
        tables = run_batch(spark, rows, root, list(order), version, now)
        for file, at in zip(files, here):
            if at == file and at in read:
                move_file(spark, file, moved[file])
        store.publish(f"etl_landing/done/{version}", "")
    return tables


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views under the names that analysts query."""
    names = {
        "dim_time": "dim_temps", "dim_offer": "dim_offres", "dim_geo": "dim_geographie", "dim_dealer": "dim_dealers",
        "fact_abonnements": "fact_abonnements", "clean_data": "clean_data",
    }
    for name, view in names.items():
        tables[name].createOrReplaceTempView(view)
