"""Feature frames for training and for future days."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates
from tidemark.functions.text import one_hot
from tidemark.operators import series as S


def top_values(detail: DataFrame, column: str, k=fixed.TOP_VALUES) -> list[str]:
    """The k most frequent values, ties by name. Only these k names come to the driver."""
    counts = detail.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return [r[0] for r in counts.orderBy(F.desc("n"), column).limit(k).collect()]


def daily_counts(detail: DataFrame, column: str, values, prefix: str) -> DataFrame:
    """Rows per day of each given value as columns `prefix_value`, all values in one pass."""
    wide = detail.filter(F.col(column).isin(*values)).groupBy("date").pivot(column, values).count()
    return wide.select("date", *[F.col(f"`{v}`").alias(f"{prefix}_{v}") for v in values])


def add_daily_counts(frame: DataFrame, detail: DataFrame, govs, categories, lag=0, by=S.KEY) -> DataFrame:
    """Same-day counts of the top governorates and categories; with `lag` the counts of that many days before."""
    names = [f"gov_{v}" for v in govs] + [f"offre_{v}" for v in categories]
    for column, values, prefix in (("governorate", govs, "gov"), ("offre_categorie", categories, "offre")):
        frame = frame.join(daily_counts(detail, column, values, prefix), "date", "left")
    frame = frame.na.fill(0, names)
    if lag:
        w = Window.partitionBy(*by).orderBy("date")
        frame = frame.withColumns({c: F.lag(F.col(f"`{c}`"), lag).over(w) for c in names})
    return frame


def features(series: DataFrame, detail: DataFrame | None = None, lags=fixed.LAGS, windows=fixed.WINDOWS,
             exclude_current=False, by=S.KEY, govs=None, categories=None) -> DataFrame:
    """Gap-filled series with calendar, lag and rolling columns and daily counts of top values; whole rows only.

    `exclude_current` keeps the target's own day out of rolling windows and counts, as training needs it.
    """
    frame = S.add_rolling(S.add_lags(S.fill_gaps(series, by), lags, by), windows, by, exclude_current=exclude_current)
    frame = frame.withColumns(dates.calendar_features(F.col("date")))
    if detail is not None:
        govs = govs if govs is not None else top_values(detail, "governorate")
        categories = categories if categories is not None else top_values(detail, "offre_categorie")
        frame = add_daily_counts(frame, detail, govs, categories, 1 if exclude_current else 0, by)
    return frame.dropna()


def feature_columns(frame: DataFrame, by=S.KEY, y="nb_abonnements") -> list[str]:
    return [c for c in frame.columns if c not in (*by, "date", y)]


def last_known(frame: DataFrame, lags=fixed.LAGS, windows=fixed.WINDOWS, by=S.KEY, y="nb_abonnements") -> DataFrame:
    """Per series the last date, the k-th last values, the last rolling statistics and the mean of every count column."""
    back = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("date")))
    ranked = frame.withColumn("_back", back)
    counts = [c for c in frame.columns if c.startswith(("gov_", "offre_"))]
    recent = {f"lag_{k}": F.max(F.when(F.col("_back") == k, F.col(y))) for k in lags}
    for size in windows:
        tail = F.when(F.col("_back") <= size, F.col(y))
        recent[f"rolling_mean_{size}"] = F.avg(tail)
        recent[f"rolling_std_{size}"] = F.stddev_samp(tail)
    return ranked.groupBy(*by).agg(
        F.max("date").alias("last_date"), *[e.alias(n) for n, e in recent.items()],
        *[F.avg(F.col(f"`{c}`")).alias(c) for c in counts],
    )


def future_features(frame: DataFrame, horizon=fixed.HORIZON, lags=fixed.LAGS, windows=fixed.WINDOWS, by=S.KEY) -> DataFrame:
    """Feature rows of the next days: calendar of the day, everything else as last known."""
    known = last_known(frame, lags, windows, by)
    days = known.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    days = days.withColumn("date", F.date_add("last_date", F.col("horizon"))).drop("last_date")
    return days.withColumns(dates.calendar_features(F.col("date")))


def score_requests(requests: DataFrame, known: DataFrame, columns, govs, categories) -> DataFrame:
    """Feature rows for (date, governorate, offer) requests: calendar, one-hot place and category, last known rest.

    `known` has one row; columns of the model that nothing fills become 0.
    """
    hot = dict(zip([f"gov_{v}" for v in govs], one_hot(F.col("governorate"), govs, "gov")))
    hot.update(zip([f"offre_{v}" for v in categories], one_hot(F.col("offer"), categories, "offre")))
    calendar = dates.calendar_features(F.col("date"))
    last = known.first().asDict()
    values = {}
    for c in columns:
        values[c] = hot.get(c, calendar.get(c, F.lit(float(last[c])) if last.get(c) is not None else F.lit(0)))
    return requests.select("*", *[F.coalesce(v, F.lit(0)).cast("double").alias(c) for c, v in values.items()])
