"""Anomalies, drivers, what-if scenarios, summaries and report tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import series as S


def with_residuals(pred: DataFrame) -> DataFrame:
    r = F.col("y") - F.col("yhat")
    return pred.withColumn("residual", r).withColumn("residual_pct", F.try_divide(r, "yhat") * 100)


def anomalies(pred: DataFrame, share=fixed.ANOMALY_SHARE, by=S.KEY) -> DataFrame:
    """Robust score per series: distance of the residual from its median in units of the scaled median deviation.

    Days above the (1 - share) quantile of their series' scores are flagged. All statistics are windows over one series
    of days, so one shuffle serves them all.
    """
    w = Window.partitionBy(*by)
    away = with_residuals(pred).withColumn("_away", F.abs(F.col("residual") - F.percentile("residual", 0.5).over(w)))
    unit = F.greatest(F.percentile("_away", 0.5).over(w) * 1.4826, F.lit(fixed.METRIC_FLOOR))
    scored = away.withColumn("anomaly_score", F.round(F.col("_away") / unit, 9))
    limit = F.round(F.percentile("anomaly_score", 1 - share).over(w), 9)
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > limit).drop("_away")


def anomaly_rate(flagged: DataFrame, by=S.KEY) -> DataFrame:
    return flagged.groupBy(*by).agg(
        F.count_if("is_anomaly").alias("anomalies"), (F.avg(F.col("is_anomaly").cast("double")) * 100).alias("anomaly_rate")
    )


def what_if(forecast: DataFrame, rules=None, days=30) -> DataFrame:
    """Each forecast day under each rule (name, first day, last day, multiplier, addend)."""
    table = F.array(*[
        F.struct(F.lit(n).alias("scenario"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s"))
        for n, a, b, m, s in rules or fixed.WHAT_IF_RULES
    ])
    each = forecast.filter(F.col("horizon") <= days).withColumn("_r", F.explode(table))
    hit = F.col("horizon").between(F.col("_r.a"), F.col("_r.b"))
    value = F.when(hit, F.col("yhat") * F.col("_r.m") + F.col("_r.s")).otherwise(F.col("yhat"))
    return each.select("*", F.col("_r.scenario").alias("scenario"), value.alias("forecast")).drop("_r")


def what_if_totals(scenarios: DataFrame, by=S.KEY) -> DataFrame:
    totals = scenarios.groupBy(*by, "scenario").agg(F.sum("forecast").alias("total"), F.sum("yhat").alias("_base"))
    return totals.select(*by, "scenario", "total", (F.col("total") - F.col("_base")).alias("vs_baseline"))


def forecast_summary(forecast: DataFrame, by=S.KEY, yhat="yhat") -> DataFrame:
    return forecast.groupBy(*by).agg(
        F.count("*").alias("total_days"), F.round(F.sum(yhat), 2).alias("total_subscriptions"),
        F.round(F.avg(yhat), 2).alias("avg_daily"), F.round(F.min(yhat), 2).alias("min_daily"),
        F.round(F.max(yhat), 2).alias("max_daily"), F.min("date").alias("start_date"), F.max("date").alias("end_date"),
    )


def monthly_totals(forecast: DataFrame, by=S.KEY, yhat="yhat") -> DataFrame:
    """Totals per month, to the cent. They are rounded to six digits first, so that the order of adding decides no half cent."""
    month = F.trunc("date", "month").alias("month")
    return forecast.groupBy(*by, month).agg((F.floor(F.round(F.sum(yhat), 6) * 100 + 0.5) / 100).alias("total"), F.count("*").alias("days"))


def request_days(requests: DataFrame) -> DataFrame:
    """Requests (id, start_date, months, ..) as one row per day: whole months counted from the start date."""
    last = F.date_sub(F.add_months("start_date", F.col("months")), 1)
    return requests.withColumn("date", F.explode(F.sequence(F.col("start_date"), last)))


def drivers(importances: list[tuple[str, float]], spark, top=10) -> DataFrame:
    """Feature importances of a fitted model (one value per feature) as rows in descending order."""
    rows = spark.createDataFrame(importances, "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def scenario_statistics(scenarios: DataFrame, by=S.KEY) -> DataFrame:
    return scenarios.groupBy(*by, "scenario").agg(
        F.avg("forecast").alias("mean_daily"), F.sum("forecast").alias("total"), F.min("forecast").alias("min_daily"),
        F.max("forecast").alias("max_daily"), F.stddev_samp("forecast").alias("volatility"),
        (F.max_by("forecast", "horizon") - F.min_by("forecast", "horizon")).alias("trend"),
    )


def scenario_insights(stats: DataFrame, by=S.KEY) -> DataFrame:
    return stats.groupBy(*by).agg(
        F.avg("mean_daily").alias("avg_daily"), F.min("total").alias("lowest_total"), F.max("total").alias("highest_total"),
        F.max_by("scenario", "total").alias("best_case"), F.min_by("scenario", "total").alias("worst_case"),
        (F.max("total") - F.avg("total")).alias("best_gain"), (F.min("total") - F.avg("total")).alias("worst_loss"),
        F.min("volatility").alias("volatility_low"), F.max("volatility").alias("volatility_high"),
    )


def recommendations(summary: DataFrame, rates: DataFrame, by=S.KEY) -> DataFrame:
    """Rating of the model (a, b, c by mean backtest MAPE) and whether the anomalies of a series call for a review."""
    joined = summary.join(rates, list(by))
    rating = F.when(F.col("mape_mean") < fixed.RATING_EXCELLENT, "a").when(F.col("mape_mean") < fixed.RATING_GOOD, "b").otherwise("c")
    return joined.select(*by, "mape_mean", "anomalies", rating.alias("rating"), (F.col("anomalies") > 3).alias("review"))


def recent_anomalies(flagged: DataFrame, k=5, by=S.KEY) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("date"))
    hits = flagged.filter("is_anomaly").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return hits.select(*by, "date", "y", "yhat", "residual", "residual_pct", "rank")
