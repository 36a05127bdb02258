"""Exponential smoothing: one pass over each series' values, with all parameter rows side by side."""

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import series as S
from tidemark.session import spread

PERIOD = 7
ALPHAS = [round(0.05 * i, 2) for i in range(1, 20)]
FEW_ALPHAS = [0.05, 0.1, 0.2, 0.4, 0.6, 0.8]
BETAS = [0.01, 0.05, 0.1, 0.3]
GAMMAS = [0.01, 0.05, 0.1, 0.3]

# kind -> rows of (level rate, trend rate, season rate)
GRIDS = {
    "SES": [(a, 0.0, 0.0) for a in ALPHAS],
    "Holt": [(a, b, 0.0) for a, b in product(FEW_ALPHAS, BETAS)],
    "Holt-Winters": list(product(FEW_ALPHAS, BETAS, GAMMAS)),
}


def series_lists(series: DataFrame, by=S.KEY, y="nb_abonnements") -> DataFrame:
    """One row per series: values in date order, last date."""
    values = F.transform(F.array_sort(F.collect_list(F.struct("date", F.col(y).cast("double").alias("v")))), lambda s: s["v"])
    return series.groupBy(*by).agg(values.alias("ys"), F.max("date").alias("last_date"))


def _folded(values: np.ndarray, kind: str, grid, period: int):
    """(place in the grid, level, trend, season from the next value on, squared error) of the best row, or none for a short series."""
    skip = period if kind == "Holt-Winters" else 1
    if len(values) < 2 * skip:
        return None
    alpha, beta, gamma = (np.array(x) for x in zip(*grid))
    level, trend = np.full(len(grid), values[0]), np.zeros(len(grid))
    season, sse = np.zeros((period, len(grid))), np.zeros(len(grid))
    if kind == "Holt-Winters":
        first, second = sum(values[:period]) / period, sum(values[period:2 * period]) / period
        level[:], trend[:] = first, (second - first) / period
        season[:] = (values[:period] - first)[:, None]
    elif kind == "Holt":
        trend[:] = values[1] - values[0]
    trend_rate, season_rate = alpha * beta, gamma * (1 - alpha)
    for t, v in enumerate(values[skip:]):
        head = season[t % period]
        error = v - (level + trend + head)
        level = level + trend + alpha * error
        trend = trend + trend_rate * error
        head += season_rate * error  # in its place in the season
        sse += error * error
    best = min(range(len(grid)), key=lambda i: (sse[i], *grid[i]))
    ahead = [season[(len(values) - skip + i) % period, best] for i in range(period)]
    return best, level[best], trend[best], ahead, sse[best]


def fit(lists: DataFrame, by=S.KEY, kinds=("SES", "Holt", "Holt-Winters"), period=PERIOD, grids=None) -> DataFrame:
    """Per series and kind the parameters with the least in-sample squared error, and the state at the end.

    `lists` comes from `series_lists`. Kinds that need more history than a series has give no row. Series are spread over
    all tasks; a task walks each list once per kind, however many parameter rows there are, and each list is moved once.
    """
    grids = grids or GRIDS
    types = dict(lists.dtypes)

    def fitted(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                values = np.asarray(row.ys, dtype=float)
                for kind in kinds:
                    found = _folded(values, kind, grids[kind], period)
                    if found:
                        out.append((*[getattr(row, k) for k in by], kind, *grids[kind][found[0]], *found[1:], len(values), row.last_date))
            yield pd.DataFrame(out, columns=[*by, "kind", "alpha", "beta", "gamma", "level", "trend", "season", "sse", "n", "last_date"])

    schema = ", ".join(f"{k} {types[k]}" for k in by) + ", kind string, alpha double, beta double, gamma double, level double, " \
        "trend double, season array<double>, sse double, n int, last_date date"
    return spread(lists.select(*by, "ys", "last_date"), *by).mapInPandas(fitted, schema)


def predict(fitted: DataFrame, horizon=fixed.HORIZON, by=S.KEY) -> DataFrame:
    steps = fitted.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    season = F.get("season", (F.col("horizon") - 1) % F.size("season"))
    return steps.select(
        *by, "kind", "horizon", F.date_add("last_date", F.col("horizon")).alias("date"),
        (F.col("level") + F.col("horizon") * F.col("trend") + season).alias("yhat"),
    )


def smooth(series: DataFrame, kind="SES", horizon=fixed.HORIZON, by=S.KEY, y="nb_abonnements") -> DataFrame:
    """Fit one kind on whole gap-free series and forecast."""
    return predict(fit(series_lists(series, by, y), by, (kind,)), horizon, by)
