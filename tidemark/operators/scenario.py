"""Sampled scenarios from trend, seasonal means and correlated residuals."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.numbers import hashed_normal, restored
from tidemark.operators import series as S


def scenario_model(series: DataFrame, periods=(7, 30), max_lag=7, by=S.KEY, y="nb_abonnements") -> DataFrame:
    """One row per series: scale, trend line, seasonal means by phase, residual spread, autocorrelations by lag."""
    parts = S.decompose(series, periods, by, y, scale=True).filter("n > 1")  # one day says nothing of what comes
    phases = [
        F.transform(
            F.array_sort(F.collect_set(F.when(F.col("idx") < p, F.struct(F.col("idx"), F.col(f"seasonal_{p}").alias("v"))))),
            lambda s: s["v"],
        ).alias(f"pattern_{p}") for p in periods
    ]
    value = F.col(y).cast("double")
    auto = F.array(*[F.coalesce(c, F.lit(0.0)) for c in S.slice_correlations(max_lag)])
    return S.add_shifted(parts, max_lag, by).groupBy(*by).agg(
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.max("n").alias("n"), F.max("date").alias("last_date"),
        F.max("slope").alias("slope"), F.min_by("trend", "idx").alias("base"),
        F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("residual_std"), *phases, auto.alias("autocorr"),
    )


def scenarios(model: DataFrame, n_scenarios=10, horizon=fixed.SHORT_HORIZON, seed=42, noise=0.1, periods=(7, 30), by=S.KEY,
              start_at=None) -> DataFrame:
    """`n_scenarios` paths per series that go on after its last day: (.., scenario, horizon, date, forecast).

    Every draw depends on seed, series, scenario and step alone, so that runs repeat on any cluster. Residuals carry
    over: for each lag in turn a step takes the lag's share of the value that many steps earlier. With `start_at` the
    paths begin at that position of the series instead of after its end.
    """
    lags = range(1, 8)
    step = F.col("horizon")
    idx = (F.col("n") if start_at is None else F.lit(start_at)) + step - 1
    fixed_part = F.col("base") + F.col("slope") * idx
    for p in periods:
        fixed_part = fixed_part + F.coalesce(F.get(f"pattern_{p}", (idx % p).cast("int")), F.lit(0.0))

    def draw(kind):
        return hashed_normal(F.lit(seed), *[F.col(k) for k in by], F.col("scenario_no"), step, F.lit(kind))

    rows = (
        model.withColumn("scenario_no", F.explode(F.sequence(F.lit(1), F.lit(n_scenarios))))
        .withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .select(
            *by, "scenario_no", "horizon", F.date_add("last_date", step).alias("date"), "mean", "std",
            fixed_part.alias("_fixed"), (F.lit(float(noise)) * draw("noise")).alias("_noise"),
            (F.col("residual_mean") + F.col("residual_std") * draw("residual")).alias("_walk"),
            *[F.coalesce(F.get("autocorr", F.lit(k - 1)), F.lit(0.0)).alias(f"_a{k}") for k in lags],
        )
    )
    w = Window.partitionBy(*by, "scenario_no").orderBy("horizon")
    for k in lags:
        rows = rows.withColumn("_walk", F.col("_walk") + F.col(f"_a{k}") * F.coalesce(F.lag("_walk", k).over(w), F.lit(0.0)))
    value = restored(F.col("_fixed") + F.col("_walk") + F.col("_noise"), F.col("mean"), F.col("std"))
    return rows.select(
        *by, F.concat(F.lit("scenario_"), F.col("scenario_no")).alias("scenario"), "horizon", "date", value.alias("forecast")
    )


def quality(series: DataFrame, sampled: DataFrame, by=S.KEY, y="nb_abonnements") -> DataFrame:
    """Real and sampled mean, population deviation, minimum, maximum and first-to-last change with their differences."""

    def stats(df, value, order, prefix):
        v = F.col(value).cast("double")
        return df.groupBy(*by).agg(
            F.avg(v).alias(f"{prefix}_mean"), F.stddev_pop(v).alias(f"{prefix}_std"), F.min(v).alias(f"{prefix}_min"),
            F.max(v).alias(f"{prefix}_max"),
        )

    ends = series.groupBy(*by).agg((F.max_by(y, "date") - F.min_by(y, "date")).cast("double").alias("real_trend"))
    paths = sampled.groupBy(*by, "scenario").agg((F.max_by("forecast", "horizon") - F.min_by("forecast", "horizon")).alias("_t"))
    trend = paths.groupBy(*by).agg(F.avg("_t").alias("synthetic_trend"))
    joined = (
        stats(series, y, "date", "real").join(ends, list(by))
        .join(stats(sampled, "forecast", "horizon", "synthetic"), list(by)).join(trend, list(by))
    )
    out = {}
    for k in ("mean", "std", "min", "max", "trend"):
        diff = F.abs(F.col(f"real_{k}") - F.col(f"synthetic_{k}"))
        out[f"{k}_diff"] = diff
        out[f"{k}_rel_diff"] = F.coalesce(F.try_divide(diff, F.abs(F.col(f"real_{k}"))), diff)
    return joined.withColumns(out)
