"""Session settings, shared scratch folder, and size-checked broadcast."""

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side is broadcast only when it has at most this many rows.
BROADCAST_ROWS = 200_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keeping a call site for every column expression doubles the time to build large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Spark 4.1 may skip the shuffle after a union although adaptive execution has cut its sides differently, and then
    # returns a group more than once.
    "spark.sql.unionOutputPartitioning": "false",
}


def get_session(app="tidemark", **conf) -> SparkSession:
    """Session with the library's settings; master and sizes come from spark-submit unless given in conf."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Put the setting that results depend on into a session made elsewhere, and the package onto its executors."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    ship(spark)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that tasks can import it wherever the driver started."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    handle, archive = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as packed:
        for path in sorted(package.rglob("*.py")):
            packed.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    atexit.register(os.remove, archive)  # executors fetch it from the driver when they start
    _SHIPPED.add(app)


def shared_dir(spark) -> str:
    """Folder all executors see: `spark.checkpoint.dir`. Local sessions without one get a fresh temp folder."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write a frame that several jobs read as a table in the shared folder and read it back.

    No lost executor forces a recompute, later jobs read only the columns they use, and their planner knows the size.
    """
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame, limit=BROADCAST_ROWS) -> DataFrame:
    """Mark a lookup side for broadcast after counting that it is small; larger sides stay a shuffled join."""
    if df.select(F.lit(1)).limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, *keys) -> DataFrame:
    """Spread few but costly rows over all shuffle partitions; the fixed number keeps adaptive execution from joining them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
