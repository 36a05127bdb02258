"""Profiles and quality checks."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates


def beside(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def profile(df: DataFrame, columns=None) -> DataFrame:
    """One row: rows, columns, missing values per column, exact copies, distinct msisdn, date span.

    Copies are counted by first grouping equal rows, which the map side already does.
    """
    columns = columns or fixed.LANDING_COLUMNS
    distinct = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    parsed = dates.parse_timestamp(F.col("creation_date")).cast("date")
    n = F.col("_n")
    return distinct.agg(
        F.sum("_n").alias("total_rows"),
        F.lit(len(columns)).cast("bigint").alias("total_columns"),
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), F.lit(0)).alias(f"missing_{c}") for c in columns],
        (F.sum("_n") - F.count("*")).alias("duplicates"),
        F.count_distinct("msisdn").alias("unique_msisdns"),
        F.min(parsed).alias("first_date"),
        F.max(parsed).alias("last_date"),
    )


def error_histogram(judged: DataFrame, top=None) -> DataFrame:
    counts = judged.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "error").limit(top) if top else counts


def quality_gate(judged: DataFrame, fact_rows: DataFrame) -> DataFrame:
    """One row of reject, valid and load rates against the targets. `fact_rows` has one row with column loaded.

    The load rate is loaded facts over valid rows left after duplicates went.
    """
    rows = judged.agg(
        F.count("*").alias("total_read"),
        F.count_if("is_valid").alias("total_valid"),
        F.count_distinct(F.when(F.col("is_valid"), F.col("msisdn"))).alias("unique_valid"),
    )
    counts = beside(rows, fact_rows.select("loaded"))
    pct = counts.withColumns({
        "reject_rate": F.coalesce(F.try_divide(F.col("total_read") - F.col("total_valid"), F.col("total_read")) * 100, F.lit(0.0)),
        "valid_rate": F.coalesce(F.try_divide("total_valid", "total_read") * 100, F.lit(0.0)),
        "load_rate": F.coalesce(F.try_divide("loaded", "unique_valid") * 100, F.lit(0.0)),
    }).withColumns({
        "reject_ok": F.col("reject_rate") <= fixed.MAX_REJECT_RATE,
        "valid_ok": F.col("valid_rate") >= fixed.MIN_VALID_RATE,
        "load_ok": F.col("load_rate") >= fixed.MIN_LOAD_RATE,
    })
    return pct.withColumn("passed", (F.col("total_read") == 0) | (F.col("reject_ok") & F.col("valid_ok") & F.col("load_ok")))


def null_keys(fact: DataFrame, key="date_id") -> DataFrame:
    return fact.agg(F.count_if(F.col(key).isNull()).alias("null_date_ids"))


def orphans(fact: DataFrame, dim: DataFrame, key="date_id") -> DataFrame:
    """Fact rows whose key has no dimension row; rows are first counted per key, so only distinct keys are joined."""
    per_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.join(dim.select(key), key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphaned_dates"))


def duplicate_keys(fact: DataFrame, key="msisdn") -> DataFrame:
    return fact.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def integrity(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    duplicates = duplicate_keys(fact).agg(F.count("*").alias("duplicate_msisdns"))
    return beside(null_keys(fact), orphans(fact, time_dim), duplicates)


def fact_quality(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("msisdn").alias("unique_msisdns"),
        F.count_if(F.col("msisdn").isNull()).alias("null_msisdns"),
    )
