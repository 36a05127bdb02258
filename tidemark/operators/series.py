"""Daily series. A series never has more rows than calendar days, which bounds every window and list per series."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates, text
from tidemark.operators.clean import valid_only

KEY = ["series_key"]


def daily(clean: DataFrame, by=(), date="creation_day") -> DataFrame:
    """Valid rows per day and optional segment columns."""
    return valid_only(clean).groupBy(*by, F.col(date).alias("date")).agg(F.count("*").alias("nb_abonnements"))


def detail(clean: DataFrame) -> DataFrame:
    """One row per valid subscription with calendar columns and category."""
    day = F.col("creation_day")
    features = dates.calendar_features(day)
    return valid_only(clean).select(
        day.alias("date"), "governorate", "debit",
        *[features[c].alias(c) for c in ("jour_semaine", "mois", "trimestre", "est_weekend", "est_ferie")],
        text.offer_category(F.col("offre")).alias("offre_categorie"),
    )


def daily_levels(clean: DataFrame, levels=("all", "governorate", "category", "governorate_category")) -> DataFrame:
    """Daily series of every segment: (series_key, date, nb_abonnements).

    Rows are counted once at the finest grain; the coarser levels add up those counts.
    """
    finest = daily(clean, ["governorate", "offer_category"])
    gov = F.concat(F.lit("governorate="), F.col("governorate"))
    cat = F.concat(F.lit("category="), F.col("offer_category"))
    keys = {"all": F.lit("all"), "governorate": gov, "category": cat, "governorate_category": F.concat(gov, F.lit("|"), cat)}
    named = finest.select("date", "nb_abonnements", F.explode(F.array(*[keys[n] for n in levels])).alias("series_key"))
    return (
        named.filter(F.col("series_key").isNotNull()).groupBy("series_key", "date")
        .agg(F.sum("nb_abonnements").alias("nb_abonnements"))
    )


def fill_gaps(series: DataFrame, by=KEY, y="nb_abonnements") -> DataFrame:
    """Every day between first and last of a series, missing days as 0. Each row brings forth the empty days after it."""
    following = F.lead("date").over(Window.partitionBy(*by).orderBy("date"))
    until = F.coalesce(F.date_sub(following, 1), F.col("date"))
    spread = series.withColumn("_until", until).withColumn("_day", dates.days_between(F.col("date"), F.col("_until")))
    return spread.select(
        *by, F.col("_day").alias("date"), F.when(F.col("_day") == F.col("date"), F.col(y)).otherwise(0).alias(y)
    )


def with_index(series: DataFrame, by=KEY) -> DataFrame:
    """Position `idx` from 0 and length `n` per series."""
    w = Window.partitionBy(*by)
    return series.withColumn("idx", F.row_number().over(w.orderBy("date")) - 1).withColumn("n", F.count("*").over(w))


def long_enough(series: DataFrame, by=KEY, minimum=60) -> DataFrame:
    w = Window.partitionBy(*by)
    return series.withColumn("_n", F.count("*").over(w)).filter(F.col("_n") >= minimum).drop("_n")


def add_lags(series: DataFrame, lags=fixed.LAGS, by=KEY, y="nb_abonnements") -> DataFrame:
    w = Window.partitionBy(*by).orderBy("date")
    return series.withColumns({f"lag_{k}": F.lag(y, k).over(w) for k in lags})


def add_rolling(series: DataFrame, windows=fixed.WINDOWS, by=KEY, y="nb_abonnements", exclude_current=False) -> DataFrame:
    """Rolling mean and sample deviation, null until the window is full. `exclude_current` ends it on the day before."""
    last = -1 if exclude_current else 0
    columns = {}
    for size in windows:
        w = Window.partitionBy(*by).orderBy("date").rowsBetween(last - size + 1, last)
        full = F.count(y).over(w) == size
        columns[f"rolling_mean_{size}"] = F.when(full, F.avg(y).over(w))
        columns[f"rolling_std_{size}"] = F.when(full, F.stddev_samp(y).over(w))
    return series.withColumns(columns)


def sequences(series: DataFrame, length: int, by=KEY, y="nb_abonnements") -> DataFrame:
    """Arrays of `length` successive values with the value that follows."""
    w = Window.partitionBy(*by).orderBy("date")
    lists = series.withColumn("sequence", F.collect_list(F.col(y).cast("double")).over(w.rowsBetween(1 - length, 0)))
    lists = lists.withColumn("target", F.lead(F.col(y).cast("double")).over(w))
    return lists.filter((F.size("sequence") == length) & F.col("target").isNotNull()).select(*by, "date", "sequence", "target")


def verification(series: DataFrame, y="nb_abonnements") -> DataFrame:
    return series.agg(F.sum(y).alias("total"), F.min("date").alias("start"), F.max("date").alias("end"))


def missing_days(series: DataFrame, by=KEY) -> DataFrame:
    expected = F.date_diff(F.max("date"), F.min("date")) + 1
    return series.groupBy(*by).agg(
        expected.cast("bigint").alias("expected_days"), (expected - F.count("*")).alias("missing_days")
    )


def mean_by_weekday(series: DataFrame, by=KEY, y="nb_abonnements") -> DataFrame:
    return series.groupBy(*by, F.weekday("date").alias("jour_semaine")).agg(F.avg(y).alias("mean"))


def describe(series: DataFrame, by=KEY, y="nb_abonnements") -> DataFrame:
    """Count, mean, sample deviation, quartiles, and skewness and excess kurtosis corrected for sample bias."""
    v = F.col(y).cast("double")
    raw = series.groupBy(*by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"), F.max(v).alias("max"),
        F.skewness(v).alias("_g1"), F.kurtosis(v).alias("_g2"),
    )
    n = F.col("count").cast("double")
    return raw.select(
        *by, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
        F.col("_q")[2].alias("q75"), "max",
        F.when(n > 2, F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, ((n + 1) * F.col("_g2") + 6) * (n - 1) / ((n - 2) * (n - 3))).alias("kurtosis"),
    )


def correlations(frame: DataFrame, columns=("est_weekend", "est_ferie", "mois"), by=KEY, y="nb_abonnements") -> DataFrame:
    """Pearson correlation of the value with each column; null for a series or column that never changes."""
    return frame.groupBy(*by).agg(*[
        F.try_divide(F.covar_pop(y, c), F.nullif(F.stddev_pop(y) * F.stddev_pop(c), F.lit(0.0))).alias(f"corr_{c}") for c in columns])


def add_shifted(series: DataFrame, max_lag=7, by=KEY, value="residual") -> DataFrame:
    """Columns _l1.. with the value that many rows before."""
    w = Window.partitionBy(*by).orderBy("date")
    return series.withColumns({f"_l{k}": F.lag(value, k).over(w) for k in range(1, max_lag + 1)})


def slice_correlations(max_lag=7, value="residual") -> list:
    """Aggregates over `add_shifted` rows: Pearson correlation per lag, each slice with its own mean."""
    return [F.corr(value, f"_l{k}") for k in range(1, max_lag + 1)]


def slice_correlation(series: DataFrame, max_lag=7, by=KEY, value="residual") -> DataFrame:
    """Correlation of a series with itself shifted: (.., lag, autocorrelation). A series of one day has none."""
    wide = add_shifted(long_enough(series, by, 2), max_lag, by, value).groupBy(*by).agg(F.array(*slice_correlations(max_lag, value)).alias("_a"))
    rows = wide.select(*by, F.posexplode("_a").alias("_pos", "autocorrelation"))
    return rows.select(*by, (F.col("_pos") + 1).alias("lag"), "autocorrelation")


def acf(series: DataFrame, max_lag=40, by=KEY, y="nb_abonnements") -> DataFrame:
    """Classic autocorrelation: centred products over the total variance, lag 0 to max_lag."""
    w = Window.partitionBy(*by)
    centred = series.withColumn("_c", F.col(y) - F.avg(y).over(w))
    shifted = centred.withColumns({f"_l{k}": F.lag("_c", k).over(w.orderBy("date")) for k in range(1, max_lag + 1)})
    total = F.sum(F.col("_c") * F.col("_c"))
    wide = shifted.groupBy(*by).agg(
        F.count("*").alias("_n"),
        *[F.coalesce(F.sum(F.col("_c") * F.col(f"_l{k}")), F.lit(0.0)).alias(f"_s{k}") for k in range(1, max_lag + 1)],
        total.alias("_s0"),
    )
    ratios = F.array(*[F.try_divide(f"_s{k}", "_s0") for k in range(max_lag + 1)])
    longer = wide.select(*by, "_n", F.posexplode(ratios).alias("lag", "acf"))
    return longer.filter(F.col("lag") < F.col("_n")).select(*by, "lag", "acf")


def pacf(acf_rows: DataFrame, by=KEY) -> DataFrame:
    """Partial autocorrelation from the autocorrelation by the Durbin-Levinson recursion, one fold per series."""
    rho = F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"])
    lists = acf_rows.groupBy(*by).agg(rho.alias("rho"))
    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(F.lit(1.0)).alias("out"))

    def step(state, k):
        phi, order = state["phi"], F.sequence(F.lit(1), k - 1)
        order = F.when(k > 1, order).otherwise(F.array().cast("array<int>"))
        num = F.aggregate(order, F.lit(0.0), lambda a, j: a + F.element_at(phi, j) * F.element_at(F.col("rho"), k - j + 1))
        den = F.aggregate(order, F.lit(0.0), lambda a, j: a + F.element_at(phi, j) * F.element_at(F.col("rho"), j + 1))
        last = F.try_divide(F.element_at(F.col("rho"), k + 1) - num, 1 - den)
        new = F.concat(F.transform(order, lambda j: F.element_at(phi, j) - last * F.element_at(phi, k - j)), F.array(last))
        return F.struct(new.alias("phi"), F.concat(state["out"], F.array(last)).alias("out"))

    folded = F.aggregate(F.sequence(F.lit(1), F.size("rho") - 1), start, step)
    return lists.filter(F.size("rho") > 1).select(*by, F.posexplode(folded["out"]).alias("lag", "pacf"))


def decompose(series: DataFrame, periods=(7, 30), by=KEY, y="nb_abonnements", scale=False) -> DataFrame:
    """Linear trend, seasonal means per period of the detrended series, and what is left.

    A period counts only if the series holds two of it. With `scale` the series is standardized first.
    Columns: idx, n, value, trend, seasonal_<p>, residual.
    """
    w = Window.partitionBy(*by)
    value = F.col(y).cast("double")
    if scale:
        dev = F.stddev_pop(value).over(w)
        value = (value - F.avg(value).over(w)) / F.when(dev == 0, 1.0).otherwise(dev)
    frame = with_index(series, by).withColumn("value", value)
    line = frame.withColumns({
        "_slope": F.coalesce(F.regr_slope(F.col("value"), F.col("idx")).over(w), F.lit(0.0)),
        "_mean": F.avg("value").over(w),
    })
    line = line.withColumn("trend", F.col("_mean") + F.col("_slope") * (F.col("idx") - (F.col("n") - 1) / 2))
    parts = line.withColumn("_detrended", F.col("value") - F.col("trend"))
    for p in periods:
        phase = Window.partitionBy(*by, F.col("idx") % p)
        parts = parts.withColumn(
            f"seasonal_{p}", F.when(F.col("n") >= 2 * p, F.avg("_detrended").over(phase)).otherwise(0.0)
        )
    left = F.col("_detrended")
    for p in periods:
        left = left - F.col(f"seasonal_{p}")
    return parts.withColumn("residual", left).drop("_mean", "_detrended").withColumnRenamed("_slope", "slope")


def fit_summary(parts: DataFrame, periods=(7, 30), max_lag=7, by=KEY) -> DataFrame:
    """Per series: trend slope, whether there is a trend, periods in use, residual mean and deviation, autocorrelations.

    A series of one day has no row."""
    auto = [c.alias(f"autocorr_{k + 1}") for k, c in enumerate(slice_correlations(max_lag))]
    return add_shifted(parts.filter("n > 1"), max_lag, by).groupBy(*by).agg(
        F.max("slope").alias("slope"),
        (F.abs(F.max_by("trend", "idx") - F.min_by("trend", "idx")) > 0.1).alias("has_trend"),
        *[F.max(F.col("n") >= 2 * p).alias(f"uses_{p}") for p in periods],
        F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("residual_std"), *auto,
    )
