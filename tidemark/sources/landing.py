"""Landing CSV files: header check per file, text-only scan, null tokens, per-file log, raw zone."""

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.text import na_to_null
from tidemark.session import settle

# Columns that give every landing row its place: file, start of the split, row counter within it.
ORDER_COLUMNS = ["_file", "_block", "_row"]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the landing CSV files (listing only, no content is read)."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    return sorted(r.path for r in listing.collect())


def copy_file(spark: SparkSession, path: str, target: str) -> None:
    """Copy a file to a place that may be on another file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, there = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, there.getFileSystem(conf), there, False, conf)


def move_file(spark: SparkSession, path: str, target: str) -> None:
    """Move a file; one that has been moved before is left alone."""
    jvm = spark.sparkContext._jvm
    source, there = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(target)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(there):
        return
    fs.mkdirs(there.getParent())
    if not fs.rename(source, there):
        raise OSError(f"cannot move {path} to {target}")


def read_header(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return next(csv.reader([(line or "").lstrip("﻿")]), [])


def missing_columns(header) -> list[str]:
    """Required columns that the header lacks. Case is ignored, blanks around a name are not."""
    have = {name.upper() for name in header}
    return [c for c in fixed.REQUIRED_COLUMNS if c not in have]


def normal_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def nulls_normalized(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]
    return df.withColumns({c: na_to_null(F.col(c)) for c in texts})


def read_landing(spark: SparkSession, path: str | list[str], multiline=False) -> tuple[DataFrame, DataFrame]:
    """Rows of all well-formed files of a folder, or of a list of files, and a log with one row per file.

    Files are grouped by header, one scan per distinct header, so columns are told by name whatever their order; every
    column is read as text, so that no value changes by type inference. Doubled quotes stand for one; line breaks within
    quotes need `multiline`, which reads each file in one task. Files without all required columns, and files with a row
    of more fields than the header, are logged as failed and left out as a whole. Rows carry ORDER_COLUMNS, which sort in
    file and line order.
    """
    files = list_files(spark, path) if isinstance(path, str) else sorted(path)
    with ThreadPoolExecutor(16) as pool:
        headers = dict(zip(files, pool.map(lambda f: tuple(read_header(spark, f)), files)))
    groups: dict[tuple, list[str]] = {}
    failed = []
    for file, header in headers.items():
        lacking = missing_columns(header)
        if lacking:
            failed.append((file, "failed", "Missing columns: " + ", ".join(lacking)))
        else:
            groups.setdefault(header, []).append(file)
    rows = None
    for header, members in groups.items():
        schema = T.StructType([T.StructField(normal_name(n), T.StringType()) for n in [*header, "_beyond"]])
        part = (
            spark.read.schema(schema).option("header", True).option("multiLine", multiline).option("escape", '"').csv(members)
            .withColumns({
                "_file": F.col("_metadata.file_path"),
                "_block": F.col("_metadata.file_block_start"),
                "_row": F.monotonically_increasing_id(),
            })
        )
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    if rows is None:
        empty = ", ".join(f"{c} string" for c in fixed.LANDING_COLUMNS)
        rows = spark.createDataFrame([], f"{empty}, _beyond string, _file string, _block bigint, _row bigint")
    counts = settle(rows.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("rows"), F.count("_beyond").alias("beyond")))
    outcome = spark.createDataFrame(
        failed + [(f, "processed", None) for members in groups.values() for f in members],
        "file string, status string, error string",
    )
    over = F.coalesce(F.col("beyond") > 0, F.lit(False))
    log = outcome.join(counts, "file", "left").select(
        "file", F.when(over, "failed").otherwise(F.col("status")).alias("status"),
        F.when(over, 0).otherwise(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows"),
        F.when(over, F.concat(F.col("beyond").cast("string"), F.lit(" rows with too many fields"))).otherwise(F.col("error")).alias("error"),
    )
    malformed = counts.filter("beyond > 0").select(F.col("file").alias("_file"))
    if not malformed.isEmpty():
        rows = rows.join(malformed, "_file", "left_anti")
    order = [c for c in rows.columns if c not in ("_beyond", *ORDER_COLUMNS)]
    return nulls_normalized(rows.select(*order, *ORDER_COLUMNS)), log


def extract_log(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("files_found"),
        F.count_if(F.col("status") == "processed").alias("files_processed"),
        F.count_if(F.col("status") == "failed").alias("files_failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows_extracted"),
    )


def append_raw(rows: DataFrame, root: str, load_id: int, ingest_ts) -> None:
    """Raw zone and raw table in one: landing columns as read, one folder per load, so that a repeated load adds nothing."""
    keep = [c for c in rows.columns if not c.startswith("_")]
    loaded = rows.select(*keep).withColumn("loaded_at", F.lit(ingest_ts))
    loaded.write.mode("overwrite").parquet(f"{root}/raw_data/load_id={load_id}")


def newly_loaded(raw: DataFrame, now, minutes=1) -> DataFrame:
    """Rows loaded within the last minutes before a given moment."""
    since = F.lit(now) - F.make_dt_interval(mins=F.lit(minutes))
    return raw.filter(F.col("loaded_at") > since).agg(F.count("*").alias("new_records"))
