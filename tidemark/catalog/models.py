"""Queries that fit models over all series, and queries on runs and stored results."""

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.catalog.base import FACT, TO_FIRST, query, rounded, scratch, staged, with_
from tidemark.catalog.series import (
    NAIVE, TO_FILLED, TO_NAIVE, clean_rows, filled, flagged, forecast_rows, metric_sql, naive, r6, smooth_sql, FORECAST, W,
)
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import insight, linear, smoothing, trees
from tidemark.operators import series as S
from tidemark.plans import forecast as P
from tidemark.session import settle
from tidemark.sources import tables


_SMOOTH = smooth_sql(tuple(smoothing.GRIDS))


@query("smoothing_fit", with_(TO_FILLED + _SMOOTH, f"""SELECT series_key, kind, CAST(a AS DOUBLE) AS alpha, CAST(b AS DOUBLE) AS beta, CAST(g AS DOUBLE) AS gamma, {r6('lev', 'level')}, {r6('tr', 'trend')}, {r6('sse', 'sse')} FROM bestp"""))
def smoothing_fit(spark, sf):
    fitted = smoothing.fit(smoothing.series_lists(filled(spark, sf)))
    return rounded(fitted.select("series_key", "kind", "alpha", "beta", "gamma", "level", "trend", "sse"))


@query("smoothing_forecast", with_(TO_FILLED + _SMOOTH, f"""SELECT series_key, kind, h AS horizon, CAST(last_date + h AS DATE) AS date, {r6('lev + h*tr + se[(h-1)%len(se)+1]', 'yhat')}
 FROM bestp, (SELECT CAST(unnest(generate_series(1, 90)) AS INTEGER) AS h)"""))
def smoothing_forecast(spark, sf):
    return rounded(smoothing.predict(smoothing.fit(smoothing.series_lists(filled(spark, sf)))))


def _test_rows(spark, sf):
    rows = E.split(filled(spark, sf))
    return rows.filter("role = 'train'"), rows.filter("role = 'test'")


# The same recursion over the first four fifths of each series, and its errors on the rest.
_TRAINED = ["fifths AS (SELECT *, idx < floor(n*0.8) AS early FROM ind)", _SMOOTH[0].replace("FROM filled GROUP", "FROM fifths WHERE early GROUP"), *_SMOOTH[1:], """
tried AS (SELECT b.series_key, b.kind AS model, CAST(p.nb_abonnements AS DOUBLE) AS y, lev + h*tr + se[(h-1)%len(se)+1] AS yhat
 FROM (SELECT *, CAST(unnest(generate_series(1, 10000)) AS INTEGER) AS h FROM bestp) b JOIN fifths p ON p.series_key = b.series_key AND NOT p.early AND p.date = CAST(last_date + h AS DATE)),
scored AS (SELECT series_key, model, avg(abs(y-yhat)/greatest(abs(y), 1e-8))*100 AS mape FROM tried GROUP BY 1, 2)"""]


@query("best_smoothing_kind", with_(TO_FILLED + _TRAINED, f"""SELECT series_key, model, {r6('mape/1e6', '"MAPE"')} FROM
 (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY mape, model) AS k FROM scored) WHERE k = 1"""))
def best_smoothing_kind(spark, sf):
    """Kind of smoothing with the best test MAPE per series; MAPE, huge because of zero days, in millions of percent."""
    train, test = _test_rows(spark, sf)
    fitted = smoothing.fit(smoothing.series_lists(train))
    days = test.groupBy("series_key").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0]
    pred = smoothing.predict(fitted, days).withColumnRenamed("kind", "model")
    actual = test.select("series_key", "date", F.col("nb_abonnements").alias("y"))
    best = E.best_model(E.metrics(actual.join(pred, ["series_key", "date"])))
    return rounded(best.withColumn("MAPE", F.col("MAPE") / 1e6))


@query("trend_model_test")
def trend_model_test(spark, sf):
    train, test = _test_rows(spark, sf)
    pred = linear.predict_trend(linear.fit_trend(train), test.select("series_key", "date", F.col("nb_abonnements").alias("y")))
    return rounded(E.metrics(pred, ["series_key"]))


@query("autoregression_forecast")
def autoregression_forecast(spark, sf):
    return rounded(linear.autoregression(filled(spark, sf)))


@query("seasonal_order_comparison")
def seasonal_order_comparison(spark, sf):
    return rounded(P.compare_orders(filled(spark, sf)))


@query("autoregression_tuning")
def autoregression_tuning(spark, sf):
    return rounded(P.tune_autoregression(filled(spark, sf)))


@query("trend_tuning")
def trend_tuning(spark, sf):
    return rounded(P.tune_trend(filled(spark, sf)))


@query("tree_tuning")
def tree_tuning(spark, sf):
    return rounded(P.tune_trees(filled(spark, sf)))


def _evaluation(spark, sf):
    """Test errors and test predictions of all models, kept between queries."""
    return staged(spark, sf, "evaluation", lambda root: tuple(map(settle, P.evaluate_with_predictions(filled(spark, sf)))))


@query("evaluate_models")
def evaluate_models(spark, sf):
    return rounded(_evaluation(spark, sf)[0])


@query("best_model")
def best_model(spark, sf):
    return rounded(E.best_model(_evaluation(spark, sf)[0]))


@query("top3_models")
def top3_models(spark, sf):
    return rounded(E.ranked_models(_evaluation(spark, sf)[0], top=3))


@query("best_model_forecast")
def best_model_forecast(spark, sf):
    errors, predictions = _evaluation(spark, sf)
    return rounded(P.forecast(filled(spark, sf), E.best_model(errors), predictions=predictions))


# The value of a week before as a held-out prediction: bounds from the earlier half of each series, held against the later.
_HALVES = [f"h AS (SELECT *, row_number() OVER {W} - 1 < floor(count(*) OVER (PARTITION BY series_key) / 2) AS early FROM naive)", """
own_q AS (SELECT count(*) AS k, series_key, quantile_cont(y - yhat, 0.025) AS low, quantile_cont(y - yhat, 0.975) AS high FROM h WHERE early GROUP BY series_key)""", """
pooled_q AS (SELECT quantile_cont(y - yhat, 0.025) AS low, quantile_cont(y - yhat, 0.975) AS high FROM h WHERE early)""", """
bounded AS (SELECT h.series_key, y, yhat + CASE WHEN k >= 30 THEN q.low ELSE p.low END AS lo, yhat + CASE WHEN k >= 30 THEN q.high ELSE p.high END AS hi,
 CASE WHEN k >= 30 THEN 'own' ELSE 'pooled' END AS bounds FROM h CROSS JOIN pooled_q p LEFT JOIN own_q q ON q.series_key = h.series_key WHERE NOT early)"""]


@query("interval_coverage", with_(TO_NAIVE + _HALVES, f"""SELECT series_key, 'lag 7' AS model, count(*) AS days, {r6('avg(CAST(y BETWEEN lo AND hi AS DOUBLE))', 'covered')}, min(bounds) AS bounds FROM bounded GROUP BY series_key"""))
def interval_coverage(spark, sf):
    return rounded(P.coverage(naive(spark, sf).withColumn("model", F.lit("lag 7"))))


@query("segment_forecasts", with_(TO_FILLED + smooth_sql(("Holt-Winters",)), f"""SELECT series_key, kind, h AS horizon, CAST(last_date + h AS DATE) AS date, {r6('lev + h*tr + se[(h-1)%len(se)+1]', 'yhat')}
 FROM bestp, (SELECT CAST(unnest(generate_series(1, 30)) AS INTEGER) AS h) WHERE series_key <> 'all'"""))
def segment_forecasts(spark, sf):
    """A forecast of its own for every governorate, every category and their pairs."""
    return rounded(smoothing.smooth(filled(spark, sf).filter("series_key <> 'all'"), "Holt-Winters", fixed.SHORT_HORIZON))


@query("tree_backtest")
def tree_backtest(spark, sf):
    frame = X.features(filled(spark, sf), exclude_current=True)
    folded = settle(E.folds(frame))
    pred = trees.backtest(folded, X.feature_columns(frame))
    return rounded(E.fold_report(folded, pred))


def _tree_model(spark, sf):
    """Frame, columns, top values and model of the series of all rows, fitted once per session."""
    return staged(spark, sf, "tree-model", lambda root: _fit_tree_model(spark, sf))


def _fit_tree_model(spark, sf):
    det = S.detail(clean_rows(spark, sf))
    govs, cats = X.top_values(det, "governorate"), X.top_values(det, "offre_categorie")
    frame = settle(X.features(filled(spark, sf).filter("series_key = 'all'"), det, exclude_current=True, govs=govs, categories=cats))
    columns = X.feature_columns(frame)
    return frame, columns, govs, cats, trees.fit(frame, columns)


@query("tree_drivers")
def tree_drivers(spark, sf):
    _, _, _, _, model = _tree_model(spark, sf)
    return rounded(insight.drivers(trees.importances(model), spark))


@query("batch_scoring")
def batch_scoring(spark, sf):
    """Predictions for one request per future day, governorate and category of the last valid rows, with a simple band."""
    frame, columns, govs, cats, model = _tree_model(spark, sf)
    requests = (
        S.valid_only(clean_rows(spark, sf)).filter(F.col("governorate").isNotNull())
        .groupBy("governorate", F.col("offer_category").alias("offer")).agg(F.max("creation_day").alias("last"))
        .withColumn("date", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", fixed.SHORT_HORIZON)))).drop("last")
    )
    rows = X.score_requests(requests, X.last_known(frame), columns, govs, cats)
    scored = trees.predict(model, rows).select("date", "governorate", "offer", "yhat")
    return rounded(E.simple_band(scored))


@query("scoring_summary")
def scoring_summary(spark, sf):
    return insight.forecast_summary(batch_scoring(spark, sf), ["governorate", "offer"])


@query("model_files")
def model_files(spark, sf):
    """Model and metadata written, read back and applied."""
    frame, columns, govs, cats, model = _tree_model(spark, sf)
    meta = frame.agg(F.count("*").alias("training_samples"), F.min("date").alias("data_start_date"), F.max("date").alias("data_end_date"))
    meta = meta.withColumns({"feature_columns": F.lit(columns), "top_govs": F.lit(govs), "top_offres": F.lit(cats)})
    path = scratch(spark, "model")
    tables.save_model(model, meta, path)
    again, info = tables.load_model(spark, path)
    names = info.first()["feature_columns"]
    return rounded(trees.predict(again, frame.select("date", "nb_abonnements", *names)).select("date", "nb_abonnements", "yhat"))


# ---- runs and stored results -------------------------------------------------------------------------------------

_RUNS = NAIVE.replace("naive AS", "n7 AS") + "," + NAIVE.replace("naive AS", "n14 AS").replace(", 7)", ", 14)") + "," + \
    NAIVE.replace("naive AS", "n1 AS").replace(", 7)", ", 1)") + """,
runs AS (SELECT 'lag 7' AS model, * FROM n7 UNION ALL SELECT 'lag 14', * FROM n14 UNION ALL SELECT 'lag 1', * FROM n1)"""
_MET = "met AS (" + metric_sql("series_key, model", "runs") + ")"
TO_RUNS = TO_FILLED + [_RUNS, _MET]


def runs(spark, sf):
    """Errors of three baselines: the value one, seven and fourteen days before. MAPE in millions of percent."""
    out = None
    for k in (7, 14, 1):
        part = E.weekly_naive(filled(spark, sf), lag=k).withColumn("model", F.lit(f"lag {k}"))
        out = part if out is None else out.unionByName(part)
    return rounded(E.metrics(out).withColumn("MAPE", F.col("MAPE") / 1e6))


@query("model_runs", with_(TO_RUNS, "SELECT * FROM met"))
def model_runs(spark, sf):
    return runs(spark, sf)


@query("run_ranking", with_(TO_RUNS, 'SELECT series_key, model, "sMAPE", CAST(rank() OVER (PARTITION BY series_key ORDER BY "sMAPE") AS INTEGER) AS rank FROM met'))
def run_ranking(spark, sf):
    return E.ranked_models(runs(spark, sf), score="sMAPE").select("series_key", "model", "sMAPE", "rank")


@query("run_best", with_(TO_RUNS, 'SELECT series_key, model, "sMAPE" FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY "sMAPE", model) AS k FROM met) WHERE k=1'))
def run_best(spark, sf):
    return E.best_model(runs(spark, sf), score="sMAPE")


@query("run_winner_score", with_(TO_RUNS, """SELECT series_key, model, CAST(4*CAST("MAE"=min("MAE") OVER w AS INTEGER) + 3*CAST("RMSE"=min("RMSE") OVER w AS INTEGER)
 + 2*CAST("sMAPE"=min("sMAPE") OVER w AS INTEGER) + CAST(n_test=min(n_test) OVER w AS INTEGER) AS INTEGER) AS overall_rank FROM met WINDOW w AS (PARTITION BY series_key)"""))
def run_winner_score(spark, sf):
    timed = runs(spark, sf).withColumn("training_time", F.col("n_test"))
    return E.winner_score(timed, ["series_key"]).select("series_key", "model", "overall_rank")


@query("run_improvement", with_(TO_RUNS, f"""SELECT m.series_key, m.model, {r6('(b."MAE"-m."MAE")/nullif(b."MAE", 0)*100', '"MAE_improvement"')},
 {r6('(b."sMAPE"-m."sMAPE")/nullif(b."sMAPE", 0)*100', '"sMAPE_improvement"')} FROM met m JOIN met b ON b.series_key=m.series_key AND b.model='lag 7'"""))
def run_improvement(spark, sf):
    rows = E.improvements(runs(spark, sf), "lag 7", ("MAE", "sMAPE"))
    return rounded(rows.select("series_key", "model", "MAE_improvement", "sMAPE_improvement"))


@query("latest_result_files", with_(TO_RUNS, 'SELECT model, \'2026-01-02\' AS timestamp, "MAE", "RMSE", "sMAPE" FROM met WHERE series_key=\'all\''))
def latest_result_files(spark, sf):
    """Two result documents per model written as JSON and CSV, the newest of each model read back."""
    root = scratch(spark, "results")
    rows = settle(runs(spark, sf).filter("series_key = 'all'"))
    for day, wrong in (("2026-01-01", 1.0), ("2026-01-02", 0.0)):
        documents = tables.result_documents(rows.withColumns({"timestamp": F.lit(day), "MAE": F.col("MAE") + wrong}))
        tables.write_results(documents, f"{root}/{day}")
    return tables.latest_results(spark, root).select("model", "timestamp", "MAE", "RMSE", "sMAPE")


@query("forecast_files", with_(TO_FILLED + FORECAST, """SELECT 30 AS file, series_key, CAST(date AS DATE) AS date, yhat, horizon FROM fc WHERE horizon<=30
 UNION ALL SELECT 90, series_key, date, yhat, horizon FROM fc"""))
def forecast_files(spark, sf):
    path = scratch(spark, "forecasts")
    tables.write_forecast(forecast_rows(spark, sf), path)
    out = None
    for n in (30, 90):
        part = spark.read.schema("series_key string, date date, yhat double, horizon int").option("header", True).csv(f"{path}/forecast_{n}d")
        part = part.select(F.lit(n).alias("file"), "*")
        out = part if out is None else out.unionByName(part)
    return out
