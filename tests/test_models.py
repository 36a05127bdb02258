"""Models against brute force, and properties of forecasts and scenarios."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import insight, linear, scenario, smoothing, trees
from tidemark.plans import forecast as P


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    t = np.arange(240)
    return {
        "a": np.round(20 + 0.05 * t + 6 * np.sin(2 * np.pi * t / 7) + rng.normal(0, 1, 240)).clip(0),
        "b": np.round(8 + 3 * np.cos(2 * np.pi * t / 7) + rng.normal(0, 1, 240)).clip(0),
    }


@pytest.fixture(scope="module")
def series(spark, values):
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=i), int(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_key string, date date, nb_abonnements bigint")


def _smooth(v, kind, a, b, g, m=7):
    if kind == "SES":
        level, trend, season, start = v[0], 0.0, [0.0] * m, 1
    elif kind == "Holt":
        level, trend, season, start = v[0], v[1] - v[0], [0.0] * m, 1
    else:
        level = v[:m].mean()
        trend, season, start = (v[m : 2 * m].mean() - level) / m, list(v[:m] - level), m
    sse = 0.0
    for y in v[start:]:
        e = y - (level + trend + season[0])
        sse += e * e
        level, trend, season = level + trend + a * e, trend + a * b * e, season[1:] + [season[0] + g * (1 - a) * e]
    return sse, level, trend, season


def test_smoothing_against_brute_force(spark, series, values):
    fitted = {(r["series_key"], r["kind"]): r for r in smoothing.fit(smoothing.series_lists(series)).collect()}
    ahead = {(r["series_key"], r["kind"], r["horizon"]): r["yhat"] for r in smoothing.predict(smoothing.fit(smoothing.series_lists(series)), 9).collect()}
    for key, v in values.items():
        for kind, grid in smoothing.GRIDS.items():
            sse, level, trend, season = min((_smooth(v, kind, *p) for p in grid), key=lambda r: r[0])
            r = fitted[(key, kind)]
            assert r["sse"] == pytest.approx(sse, rel=1e-9) and r["level"] == pytest.approx(level, rel=1e-9)
            assert ahead[(key, kind, 9)] == pytest.approx(level + 9 * trend + season[8 % 7], rel=1e-9)


@pytest.mark.parametrize("order", [("x", (2, 1, 0), (1, 0, 0, 7)), ("x", (0, 0, 0), (2, 1, 0, 7)), ("x", (1, 0, 0), (0, 0, 0, 7)), ("x", (0, 1, 0), (0, 1, 0, 7))])
def test_autoregression_against_brute_force(spark, series, values, order):
    fitted = linear.fit_autoregression(smoothing.series_lists(series), [order])
    got = {(r["series_key"], r["horizon"]): r["yhat"] for r in linear.predict_autoregression(fitted, 20).collect()}
    _, (p, d, _), (sp, sd, _, s) = order
    for key, v in values.items():
        z, undo = v.copy(), []
        for step in [1] * d + [s] * sd:
            undo.append((step, list(z)))
            z = z[step:] - z[:-step]
        lags = sorted(set(range(1, p + 1)) | {s * k for k in range(1, sp + 1)})
        deep = max(lags, default=0)
        x = np.array([[1.0] + [z[t - k] for k in lags] for t in range(deep, len(z))])
        beta = np.linalg.lstsq(x, z[deep:], rcond=None)[0]
        path = list(z)
        for _ in range(20):
            path.append(beta[0] + sum(b * path[-k] for b, k in zip(beta[1:], lags)))
        for step, history in reversed(undo):
            new = path[-20:]
            for value in new:
                history.append(value + history[-step])
            path = history
        assert [got[(key, h)] for h in range(1, 21)] == pytest.approx(path[-20:], rel=1e-5, abs=1e-5)


def test_trend_model_follows_season(spark, series, values):
    rows = E.split(series)
    fitted = linear.fit_trend(rows.filter("role = 'train'"), configs=[(0.05, 10.0, "additive"), (0.05, 10.0, "multiplicative")])
    assert fitted.count() == 4
    test = rows.filter("role = 'test'").select("series_key", "date", F.col("nb_abonnements").alias("y"))
    pred = linear.predict_trend(fitted, test)
    errors = {(r["series_key"], r["mode"]): r["MAE"] for r in E.metrics(pred, ["series_key", "mode"]).collect()}
    for key, v in values.items():
        flat = np.abs(v[192:] - v[:192].mean()).mean()
        assert errors[(key, "additive")] < flat and errors[(key, "multiplicative")] < flat
    inside = pred.filter("y BETWEEN yhat_lower AND yhat_upper").count() / pred.count()
    assert inside > 0.6


def test_trend_coefficients_are_the_ridge_solution(spark, series):
    rows = E.split(series).filter("role = 'train' AND series_key = 'a'")
    got = linear.fit_trend(rows).first()
    design = rows.withColumn("x", linear.trend_design(F.col("date"), F.col("idx") / got["span"])).orderBy("idx").toPandas()
    x, y = np.array(design["x"].tolist()), design["nb_abonnements"].to_numpy(float)
    beta = np.array(got["beta"])
    gradient = x.T @ (y - x @ beta) - np.array(linear.trend_penalty(0.05, 10.0)) * beta
    np.testing.assert_allclose(gradient, 0, atol=1e-5)


def test_trees_beat_the_mean(spark, series, values):
    pred = P.split_predictions(series, ["Boosted Trees"], tree_settings={"maxIter": 10, "stepSize": 0.3})
    for r in E.metrics(pred, ["series_key"]).collect():
        v = values[r["series_key"]]
        assert r["MAE"] < np.abs(v[192:] - v[:192].mean()).mean()


def test_evaluate_pick_and_forecast(spark, series):
    settings = {"maxIter": 3}
    errors, predictions = P.evaluate_with_predictions(series, tree_settings=settings)
    rows = errors.collect()
    assert len(rows) == 2 * len(P.MODELS) and all(r["status"] == "fitted" and r["training_time"] > 0 for r in rows)
    best = E.best_model(errors)
    ahead = P.forecast(series, best, 30, tree_settings=settings, predictions=predictions).collect()
    assert all(r["yhat_lower"] <= r["yhat_upper"] and r["bounds"] in ("own", "pooled") for r in ahead)
    winners = E.winner_score(errors, ["series_key"]).collect()
    assert max(r["overall_rank"] for r in winners) >= 4
    covered = P.coverage(predictions).collect()
    assert len(covered) == 8 and all(0 <= r["covered"] <= 1 for r in covered)
    assert len(ahead) == 60 and {r["model"] for r in ahead} == {r["model"] for r in best.collect()}
    assert min(r["date"] for r in ahead) == dt.date(2024, 1, 1) + dt.timedelta(days=240)


def test_tuning_fits_trees_of_one_shape_once(spark, series, monkeypatch):
    fit, sizes = trees.fit, []
    monkeypatch.setattr(trees, "fit", lambda *a, **k: sizes.append(k["maxIter"]) or fit(*a, **k))

    def errors(grid):
        rows = P.tune_trees(series, grid=grid).collect()
        return {(r["series_key"], r["config"]): (r["MAE"], r["RMSE"], r["n_test"]) for r in rows}

    alone = errors([(2, 3, 0.1)]) | errors([(5, 3, 0.1)])
    assert sizes == [2, 5]
    together = errors([(5, 3, 0.1), (2, 3, 0.1)])
    assert sizes == [2, 5, 5] and together.keys() == alone.keys() and len(alone) == 4
    for key, want in alone.items():
        assert together[key] == pytest.approx(want)
    assert together["a", "trees=2 depth=3 rate=0.1"] != together["a", "trees=5 depth=3 rate=0.1"]


def test_named_configurations(spark, series):
    got = P.compare_orders(series).filter("series_key = 'a'").toPandas()
    assert len(got) == len(fixed.SEASONAL_CONFIGS) and got.loc[got["config"] == fixed.SEASONAL_CONFIGS[0][0], "MAPE_improvement"].iloc[0] == 0


def test_scenarios_repeat_and_keep_the_level(spark, series, values):
    model = scenario.scenario_model(series)
    a = scenario.scenarios(model, 40, 30, seed=7)
    b = scenario.scenarios(scenario.scenario_model(series.repartition(5)), 40, 30, seed=7)
    key = lambda df: sorted((r["series_key"], r["scenario"], r["horizon"], round(r["forecast"], 6)) for r in df.collect())
    assert key(a) == key(b) and len(key(a)) == 2 * 40 * 30
    q = {r["series_key"]: r for r in scenario.quality(series, a).collect()}
    for k in values:
        assert q[k]["mean_rel_diff"] < 0.3 and q[k]["std_rel_diff"] < 1.0


def test_what_if_rules(spark):
    days = spark.createDataFrame([("s", h, dt.date(2024, 1, h), 2.0) for h in range(1, 31)], "series_key string, horizon int, date date, yhat double")
    got = {r["scenario"]: r["vs_baseline"] for r in insight.what_if_totals(insight.what_if(days)).collect()}
    assert got == pytest.approx({"Baseline": 0.0, "Marketing Campaign (+25%, 14 days)": 7.0, "Ramadan Effect (+15%, 30 days)": 9.0, "New Dealer (+5/day)": 150.0})


def test_requests_use_trained_columns(spark, series):
    frame = X.features(series.filter("series_key = 'a'"), exclude_current=True)
    columns = X.feature_columns(frame) + ["gov_North", "offre_Pro", "unknown"]
    asked = spark.createDataFrame([(dt.date(2024, 9, 7), "North", "Villa")], "date date, governorate string, offer string")
    r = X.score_requests(asked, X.last_known(frame), columns, ["North"], ["Pro"]).first()
    assert (r["gov_North"], r["offre_Pro"], r["unknown"], r["est_weekend"], r["mois"]) == (1.0, 0.0, 0.0, 1.0, 9.0)


def test_importances_name_the_features(spark, series):
    frame = X.features(series, exclude_current=True)
    columns = X.feature_columns(frame)
    model = trees.fit(frame, columns, maxIter=3)
    named = dict(trees.importances(model))
    assert set(named) == set(columns) and sum(named.values()) == pytest.approx(1.0)


def test_models_that_are_refused_keep_their_row(spark, series):
    short = series.limit(0).unionByName(series.filter("series_key = 'a'").orderBy("date").limit(2).withColumn("series_key", F.lit("short")))
    errors = P.evaluate(series.unionByName(short), ["Exp Smoothing", "Trend", "Seasonal AR"])
    rows = {(r["series_key"], r["model"]): r for r in errors.collect()}
    assert len(rows) == 9
    refused = rows["short", "Seasonal AR"]
    assert (refused["status"], refused["MAPE"], refused["n_test"]) == ("refused", None, 0)
    assert rows["a", "Seasonal AR"]["status"] == "fitted" and rows["short", "Trend"]["n_test"] == 1
    best = {r["series_key"]: r["model"] for r in E.best_model(errors).collect()}
    assert set(best) == {"a", "b", "short"} and best["short"] != "Seasonal AR"
