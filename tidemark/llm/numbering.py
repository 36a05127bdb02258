"""Gapless numbers per key over any number of rows, without one task per key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Chunks at least, and rows of a chunk on average at most.
CHUNKS, CHUNK_ROWS = 256, 20_000


def numbered(df: DataFrame, by: list[str], row: str, rows: int, name: str = "number") -> DataFrame:
    """Number the rows of each key from 0 in the order of a hash of `row`, a unique long; `rows` is about their count.

    Rows are numbered within chunks of a key, and each chunk begins after the rows of the key's chunks before it.
    """
    chunks = max(CHUNKS, -(-rows // CHUNK_ROWS))
    cut = df.withColumn("_h", F.xxhash64(row)).withColumn("_chunk", F.pmod("_h", F.lit(chunks)))
    sizes = cut.groupBy(*by, "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = cut.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy("_h", row)) - 1)
    return own.join(starts, [*by, "_chunk"]).withColumn(name, F.col("_start") + F.col("_own")).drop("_h", "_chunk", "_start", "_own")
