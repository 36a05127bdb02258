"""Stored tables, result files and models."""

import hashlib
import json
import os
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BUCKETS = 64
#: Rows whose key is null match nothing: they are appended under this bucket and never read again by an upsert.
NO_KEY = -1


class Warehouse:
    """Tables under one folder, each in a fixed number of hash buckets of its key.

    A table's log has one small file per commit: the folders that hold each bucket, the batches that are in, the schema. A
    commit creates the next file of the log, which only one writer can; files are never changed once they are in the log. So
    readers see whole versions, writers lose no commit of others, a batch that comes again changes nothing, and a batch
    rewrites the buckets of its own keys alone. The folder's file system must refuse to link or rename onto a file that
    exists, as local disks and HDFS do.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def versions(self, name: str) -> list[int]:
        """Batches that are in the table."""
        head = self._head(name)[1]
        return [v for low, high in (head["done"] if head else []) for v in range(low, high + 1)]

    def read(self, name: str, before: int | None = None) -> DataFrame | None:
        """The table now, or as it was before the first batch from `before` on came in."""
        head = self._head(name, before)[1]
        return None if head is None else self._rows(name, head, head["buckets"])

    def files(self, name: str) -> dict[str, list[str]]:
        """The folders of each bucket."""
        head = self._head(name)[1]
        return head["buckets"] if head else {}

    def upsert(self, name: str, incoming: DataFrame, key, combine, batch: int, buckets: int = BUCKETS, null_safe: bool = False,
               order=(), meta=None) -> DataFrame:
        """Replace the buckets that the keys of `incoming` fall in by `combine(their rows or None, meta)`; returns the table.

        `incoming` is read more than once, so it should be a written table. `combine` gives rows with the keys of either side
        only. Without a key the table is one bucket. A null in the key makes a row keyless unless `null_safe`. `order` sorts
        the rows of a bucket. `meta(rows written, meta before)` is kept beside the table. If another batch commits meanwhile,
        the commit is repeated on top of it, and the merge too if both touch a bucket or there is `meta`.
        """
        key, touched = list(key), None
        while True:
            number, head = self._head(name)
            if head and _within(head["done"], batch):
                return self.read(name)
            count = head["count"] if head else buckets
            place = bucket_of(key, count, null_safe)
            if touched is None:
                touched = sorted(r.b for r in incoming.select(place.alias("b")).distinct().collect()) if key else [0]
            known = None if head is None else self._rows(name, head, [str(b) for b in touched if b != NO_KEY])
            rows = combine(known, head["meta"] if head else {})
            folder = f"data/{batch}-{uuid.uuid4().hex[:12]}"
            parts = max(1, min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
            placed = rows.withColumn("bucket", place).repartition(parts, "bucket").sortWithinPartitions("bucket", *order)
            placed.write.partitionBy("bucket").parquet(f"{self.root}/{name}/{folder}")
            made = {p.getName().split("=")[1] for p in self._glob(f"{name}/{folder}/bucket=*")}
            entry = {"batch": batch, "count": count, "schema": rows.schema.jsonValue()}
            new = {str(b): [f"{folder}/bucket={b}"] if str(b) in made else [] for b in touched if b != NO_KEY}
            if meta:
                written = self._rows(name, entry | {"buckets": new}, new)
                entry["meta"] = meta(written, head["meta"] if head else {})
            while True:
                before = head["buckets"] if head else {}
                keyless = before.get(str(NO_KEY), []) + ([f"{folder}/bucket={NO_KEY}"] if str(NO_KEY) in made else [])
                entry["buckets"] = before | new | ({str(NO_KEY): keyless} if keyless else {})
                entry["done"] = _with(head["done"] if head else [], batch)
                entry.setdefault("meta", head["meta"] if head else {})
                if self.publish(f"{name}/log/{number + 1:012d}.json", json.dumps(entry)):
                    return self.read(name)
                number, head = self._head(name)
                if meta or _within(head["done"], batch) or any(head["buckets"].get(b) != before.get(b) for b in new):
                    break

    def expire(self, name: str, keep: int = 1) -> list[str]:
        """Delete what only versions before the last `keep` need; returns the folders deleted. Folders of batches that are
        not in yet stay, as their writers may still be at work."""
        numbers = self._log(name)
        live = {folder for n in numbers[-keep:] for some in self._entry(name, n)["buckets"].values() for folder in some}
        done = self._head(name)[1]["done"] if numbers else []
        gone = []
        for path in self._glob(f"{name}/data/*/bucket=*"):
            folder = f"data/{path.getParent().getName()}/{path.getName()}"
            if folder not in live and _within(done, int(path.getParent().getName().split("-")[0])):
                gone.append(folder)
        for n in numbers[:-keep]:
            self._delete(f"{name}/log/{n:012d}.json")
        for folder in gone:
            self._delete(f"{name}/{folder}")
        return gone

    def claim(self, token: str) -> int:
        """The version of the batch known by this token: the one it was given before, or one that no other batch has or gets."""
        mark = f"etl_batches/{hashlib.md5(token.encode()).hexdigest()}"
        known = self.noted(mark)
        if known is None:
            taken = [int(p.getName()) for p in self._glob("etl_versions/*")]
            taken += [int(p.getName().split("=")[1]) for p in self._glob("raw_data/load_id=*")]
            number = max([0, *taken, *self.versions("clean_data"), *self.versions("fact_abonnements")]) + 1
            while not self.publish(f"etl_versions/{number}", token):
                number += 1
            self.publish(mark, str(number))  # if another run of the same batch was first, its version counts
            known = self.noted(mark)
        return int(known)

    def publish(self, name: str, text: str) -> bool:
        """Create a small file whole, or leave one that exists as it is and say False."""
        path, fs = self._at(name)
        part, _ = self._at(f"{name}.{uuid.uuid4().hex}.part")
        if fs.getUri().getScheme() == "file":
            here, there = part.toUri().getPath(), path.toUri().getPath()
            os.makedirs(os.path.dirname(there), exist_ok=True)
            with open(here, "w", encoding="utf-8") as out:
                out.write(text)
            try:
                os.link(here, there)
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(here)
        out = fs.create(part, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            moved = not fs.exists(path) and fs.rename(part, path)
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error.java_exception):
                raise
            moved = False
        if not moved:
            fs.delete(part, False)
        return moved

    def noted(self, name: str) -> str | None:
        path, fs = self._at(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def numbered(self, name: str) -> list[int]:
        """Numbers that name the small files of a folder."""
        return sorted(int(p.getName()) for p in self._glob(f"{name}/*"))

    def exists(self, path: str) -> bool:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _log(self, name: str) -> list[int]:
        return sorted(int(p.getName()[:-5]) for p in self._glob(f"{name}/log/*.json"))

    def _entry(self, name: str, number: int) -> dict:
        return json.loads(self.noted(f"{name}/log/{number:012d}.json"))

    def _head(self, name: str, before: int | None = None) -> tuple[int, dict | None]:
        """Number and content of the last entry of the log; with `before`, of the last one ahead of that batch."""
        numbers = self._log(name)
        if before is None:
            return (numbers[-1], self._entry(name, numbers[-1])) if numbers else (0, None)
        found = (0, None)
        for n in numbers:
            entry = self._entry(name, n)
            if entry["batch"] >= before:
                break
            found = (n, entry)
        return found

    def _rows(self, name: str, entry: dict, buckets) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        paths = [f"{self.root}/{name}/{folder}" for b in buckets for folder in entry["buckets"].get(b, [])]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _at(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)

    def _glob(self, pattern: str) -> list:
        path, fs = self._at(pattern)
        return [f.getPath() for f in fs.globStatus(path) or [] if not f.getPath().getName().endswith(".part")]


def bucket_of(key, buckets: int, null_safe: bool = False) -> Column:
    """The bucket of a row by its key columns."""
    if not key:
        return F.lit(0)
    place = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    lacking = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return place if null_safe else F.when(lacking, NO_KEY).otherwise(place)


def _within(ranges: list, number: int) -> bool:
    return any(low <= number <= high for low, high in ranges)


def _with(ranges: list, number: int) -> list:
    """The ranges with one more number; neighbours become one."""
    out = []
    for low, high in sorted([*map(list, ranges), [number, number]]):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def write_forecast(forecast: DataFrame, path: str, horizons=(30, 90)) -> None:
    """One CSV folder per horizon, rows `horizon <= n`."""
    for n in horizons:
        forecast.filter(F.col("horizon") <= n).write.mode("overwrite").option("header", True).csv(f"{path}/forecast_{n}d")


def write_results(results: DataFrame, path: str) -> None:
    """Metrics as nested JSON documents and as a flat CSV."""
    results.write.mode("append").json(f"{path}/json")
    flat = [
        F.col(f"{f.name}.{g.name}").alias(g.name) if hasattr(f.dataType, "fields") else F.col(f.name)
        for f in results.schema.fields
        for g in (f.dataType.fields if hasattr(f.dataType, "fields") else [f])
    ]
    results.select(*flat).write.mode("append").option("header", True).csv(f"{path}/csv")


RESULT_SCHEMA = (
    "model string, timestamp string, "
    "metrics struct<MAE:double,RMSE:double,MAPE:double,sMAPE:double,training_time:double,total_time:double>, "
    "data_points struct<train_size:bigint,test_size:bigint,prediction_length:bigint>"
)


def result_documents(metrics: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Rows of model metrics as result documents."""
    names = ["MAE", "RMSE", "MAPE", "sMAPE", "training_time", "total_time"]
    points = ["train_size", "test_size", "prediction_length"]
    have = set(metrics.columns)
    return metrics.select(
        "model",
        F.col("timestamp") if "timestamp" in have else F.lit(None).cast("string").alias("timestamp"),
        F.struct(*[(F.col(n) if n in have else F.lit(None)).cast("double").alias(n) for n in names]).alias("metrics"),
        F.struct(*[(F.col(n) if n in have else F.lit(None)).cast("bigint").alias(n) for n in points]).alias("data_points"),
    )


def latest_results(spark: SparkSession, path: str, one_per_file=False) -> DataFrame:
    """Newest result document per model, by file time and then by the document's own time.

    Files hold a document per line, as `write_results` leaves them, or with `one_per_file` one indented document each.
    """
    runs = (
        spark.read.schema(RESULT_SCHEMA).option("multiLine", one_per_file).option("recursiveFileLookup", True)
        .json(path, pathGlobFilter="*.json")
        .withColumn("_at", F.struct(F.col("_metadata.file_modification_time"), "timestamp"))
    )
    newest = runs.groupBy("model").agg(F.max_by(F.struct("timestamp", "metrics", "data_points"), "_at").alias("run"))
    return newest.select("model", "run.timestamp", "run.metrics.*", "run.data_points.*")


def save_model(model: PipelineModel, metadata: DataFrame, path: str) -> None:
    """Model and one row of metadata (features, top values, counts, date span)."""
    model.write().overwrite().save(f"{path}/model")
    metadata.write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/metadata")
