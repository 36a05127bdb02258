"""Queries on daily series: counts, gaps, windows, features, statistics, metrics, folds, scenarios."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.catalog.base import TO_FIRST, first_rows, query, rounded, staged, star_tables, with_
from tidemark.functions import numbers
from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import insight, reports, scenario, smoothing
from tidemark.operators import series as S

# ---- check SQL fragments -----------------------------------------------------------------------------------------

LEVELS = """
finest AS (SELECT creation_day AS date, governorate, offer_category, count(*) AS c FROM firsts GROUP BY ALL),
levels AS (SELECT series_key, date, CAST(sum(c) AS BIGINT) AS nb_abonnements FROM (
 SELECT 'all' AS series_key, date, c FROM finest UNION ALL SELECT 'governorate=' || governorate, date, c FROM finest
 UNION ALL SELECT 'category=' || offer_category, date, c FROM finest
 UNION ALL SELECT 'governorate=' || governorate || '|category=' || offer_category, date, c FROM finest)
 WHERE series_key IS NOT NULL GROUP BY ALL)"""
FILLED = """
spans AS (SELECT series_key, min(date) AS a, max(date) AS b FROM levels GROUP BY 1),
days AS (SELECT series_key, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM spans),
filled AS (SELECT d.series_key, d.date, coalesce(l.nb_abonnements, 0) AS nb_abonnements FROM days d LEFT JOIN levels l USING (series_key, date)),
ind AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date) - 1 AS idx, count(*) OVER (PARTITION BY series_key) AS n FROM filled)"""
TO_FILLED = TO_FIRST + [LEVELS, FILLED]
W = "(PARTITION BY series_key ORDER BY date)"
HOL = ", ".join(f"DATE '{d}'" for d in fixed.DATED_HOLIDAYS)
CAL = f"""CAST(isodow(date)-1 AS INTEGER) AS jour_semaine, CAST(day(date) AS INTEGER) AS jour_mois, CAST(month(date) AS INTEGER) AS mois,
 CAST(quarter(date) AS INTEGER) AS trimestre, CAST(weekofyear(date) AS INTEGER) AS semaine_annee,
 CAST(isodow(date)>=6 AS INTEGER) AS est_weekend, CAST(dayofyear(date) AS INTEGER) AS jour_annee,
 sin(2*pi()*dayofyear(date)/365.25) AS jour_annee_sin, cos(2*pi()*dayofyear(date)/365.25) AS jour_annee_cos,
 CAST(date IN ({HOL}) AS INTEGER) AS est_ferie"""
NAIVE = f"""
naive AS (SELECT * FROM (SELECT series_key, date, CAST(nb_abonnements AS DOUBLE) AS y,
 CAST(lag(nb_abonnements, 7) OVER {W} AS DOUBLE) AS yhat FROM filled) WHERE yhat IS NOT NULL)"""
TO_NAIVE = TO_FILLED + [NAIVE]


def r6(expr, name):
    return f"round({expr}, 6) + 0.0 AS {name}"


def rolling_sql(end=0):
    out = []
    for n in fixed.WINDOWS:
        frame = f"OVER (PARTITION BY series_key ORDER BY date ROWS BETWEEN {n - 1 - end} PRECEDING AND {f'{-end} PRECEDING' if end else 'CURRENT ROW'})"
        out.append(f"CASE WHEN count(*) {frame} = {n} THEN avg(nb_abonnements) {frame} END AS rolling_mean_{n}")
        out.append(f"CASE WHEN count(*) {frame} = {n} THEN stddev_samp(nb_abonnements) {frame} END AS rolling_std_{n}")
    return ", ".join(out)


LAG_SQL = ", ".join(f"lag(nb_abonnements, {k}) OVER {W} AS lag_{k}" for k in fixed.LAGS)
ROLL_NAMES = [f"rolling_{s}_{n}" for n in fixed.WINDOWS for s in ("mean", "std")]
CAL_INT = ["jour_semaine", "jour_mois", "mois", "trimestre", "semaine_annee", "est_weekend", "jour_annee", "est_ferie"]


# ---- frames ------------------------------------------------------------------------------------------------------


def clean_rows(spark, sf):
    """Valid rows of the clean table, with the columns that series are made of."""
    return first_rows(spark, sf).drop("row_seq")


def levels(spark, sf):
    return S.daily_levels(clean_rows(spark, sf))


def filled(spark, sf):
    """Gap-free daily series of all rows, every governorate, every category and their pairs, kept as a table between queries."""

    def build(root):
        S.fill_gaps(S.daily_levels(clean_rows(spark, sf))).write.parquet(root)
        return spark.read.parquet(root)

    return staged(spark, sf, "daily-series", build)


def naive(spark, sf):
    return E.weekly_naive(filled(spark, sf))


# ---- daily series ------------------------------------------------------------------------------------------------


@query("daily_counts", with_(TO_FIRST, "SELECT creation_day AS date, count(*) AS nb_abonnements FROM firsts GROUP BY 1"))
def daily_counts(spark, sf):
    return S.daily(clean_rows(spark, sf)).orderBy("date")


@query("daily_levels", with_(TO_FIRST + [LEVELS], "SELECT * FROM levels"))
def daily_levels(spark, sf):
    return levels(spark, sf)


@query("daily_by_governorate", with_(TO_FILLED, "SELECT substr(series_key, 13) AS governorate, date, nb_abonnements FROM filled WHERE series_key LIKE 'governorate=%' AND series_key NOT LIKE '%|%'"))
def daily_by_governorate(spark, sf):
    """Gap-filled daily subscriptions by governorate, from landing rows on."""
    from tidemark.catalog.base import judged
    from tidemark.operators import clean

    rows = clean.dedup_first(clean.valid_only(judged(spark, sf)), "msisdn", ["row_seq"])
    counts = S.daily(rows, ["governorate"]).filter(F.col("governorate").isNotNull())
    return S.fill_gaps(counts, ["governorate"])


@query("gap_fill", with_(TO_FILLED, "SELECT * FROM filled"))
def gap_fill(spark, sf):
    return S.fill_gaps(levels(spark, sf))


@query("detail_scan", with_(TO_FIRST, f"""SELECT date, governorate, debit, jour_semaine, mois, trimestre, est_weekend, est_ferie, offre_categorie FROM
 (SELECT creation_day AS date, governorate, debit, offer_category AS offre_categorie, {CAL.replace('date', 'creation_day').replace(' DATE ', ' DATE ')} FROM firsts)"""))
def detail_scan(spark, sf):
    return S.detail(clean_rows(spark, sf))


@query("daily_by_segment", with_(TO_FIRST, """SELECT 'governorate' AS segment, governorate AS value, creation_day AS date, count(*) AS n FROM firsts GROUP BY ALL
 UNION ALL SELECT 'category', offer_category, creation_day, count(*) FROM firsts GROUP BY ALL"""))
def daily_by_segment(spark, sf):
    rows = S.valid_only(clean_rows(spark, sf))
    segment = F.explode(F.array(
        F.struct(F.lit("governorate").alias("segment"), F.col("governorate").alias("value")),
        F.struct(F.lit("category").alias("segment"), F.col("offer_category").alias("value")),
    )).alias("s")
    counted = rows.groupBy("governorate", "offer_category", F.col("creation_day").alias("date")).agg(F.count("*").alias("c"))
    return counted.select("date", "c", segment).groupBy("s.segment", "s.value", "date").agg(F.sum("c").alias("n"))


@query("series_verification", with_(TO_FIRST + [LEVELS], "SELECT CAST(sum(nb_abonnements) AS BIGINT) AS total, min(date) AS start, max(date) AS \"end\" FROM levels WHERE series_key='all'"))
def series_verification(spark, sf):
    return S.verification(S.daily(clean_rows(spark, sf)))


@query("missing_days", with_(TO_FIRST + [LEVELS], "SELECT series_key, date_diff('day', min(date), max(date)) + 1 AS expected_days, date_diff('day', min(date), max(date)) + 1 - count(*) AS missing_days FROM levels GROUP BY 1"))
def missing_days(spark, sf):
    return S.missing_days(levels(spark, sf)).withColumn("missing_days", F.col("missing_days").cast("bigint"))


@query("long_series", with_(TO_FIRST + [LEVELS], "SELECT series_key, count(*) AS days FROM levels GROUP BY 1 HAVING count(*) >= 60"))
def long_series(spark, sf):
    return S.long_enough(levels(spark, sf)).groupBy("series_key").agg(F.count("*").alias("days"))


# ---- windows and features ----------------------------------------------------------------------------------------


@query("lag_features", with_(TO_FILLED, f"SELECT series_key, date, nb_abonnements, {LAG_SQL} FROM filled"))
def lag_features(spark, sf):
    return S.add_lags(filled(spark, sf))


@query("rolling_features", with_(TO_FILLED, f"SELECT series_key, date, {', '.join(r6(c, c) for c in ROLL_NAMES)} FROM (SELECT series_key, date, {rolling_sql()} FROM filled)"))
def rolling_features(spark, sf):
    return rounded(S.add_rolling(filled(spark, sf)).drop("nb_abonnements"))


@query("rolling_features_past", with_(TO_FILLED, f"SELECT series_key, date, {', '.join(r6(c, c) for c in ROLL_NAMES)} FROM (SELECT series_key, date, {rolling_sql(-1)} FROM filled)"))
def rolling_features_past(spark, sf):
    return rounded(S.add_rolling(filled(spark, sf), exclude_current=True).drop("nb_abonnements"))


_FEATURES = f"""feat AS (SELECT * FROM (SELECT series_key, date, nb_abonnements, {LAG_SQL}, {rolling_sql()}, {CAL} FROM filled) WHERE lag_30 IS NOT NULL),
tg AS (SELECT governorate AS v, row_number() OVER (ORDER BY count(*) DESC, governorate) AS k FROM firsts WHERE governorate IS NOT NULL GROUP BY 1),
tc AS (SELECT offer_category AS v, row_number() OVER (ORDER BY count(*) DESC, offer_category) AS k FROM firsts GROUP BY 1),
gd AS (SELECT f.creation_day AS date, {', '.join(f"count(*) FILTER (k={i}) AS gov_{i}" for i in (1, 2, 3))} FROM firsts f JOIN tg ON tg.v=f.governorate GROUP BY 1),
cd AS (SELECT f.creation_day AS date, {', '.join(f"count(*) FILTER (k={i}) AS offre_{i}" for i in (1, 2, 3))} FROM firsts f JOIN tc ON tc.v=f.offer_category GROUP BY 1)"""
_FRAME_COLS = ["nb_abonnements", *[f"lag_{k}" for k in fixed.LAGS], *CAL_INT]
_FRAME_DBL = [*ROLL_NAMES, "jour_annee_sin", "jour_annee_cos"]
_COUNTS = [f"{p}_{i}" for p in ("gov", "offre") for i in (1, 2, 3)]


def _frame(spark, sf, exclude_current=False):
    """Feature frame of the whole series, count columns named by rank."""
    det = S.detail(clean_rows(spark, sf))
    govs, cats = X.top_values(det, "governorate"), X.top_values(det, "offre_categorie")
    frame = X.features(
        filled(spark, sf).filter("series_key = 'all'"), det, exclude_current=exclude_current, govs=govs, categories=cats
    )
    names = {f"gov_{v}": f"gov_{i + 1}" for i, v in enumerate(govs)} | {f"offre_{v}": f"offre_{i + 1}" for i, v in enumerate(cats)}
    return frame.withColumnsRenamed(names)


@query("feature_frame", with_(TO_FILLED + [_FEATURES], f"""SELECT series_key, date, {', '.join(_FRAME_COLS)}, {', '.join(r6(c, c) for c in _FRAME_DBL)},
 {', '.join(f'coalesce({c}, 0) AS {c}' for c in _COUNTS)} FROM feat LEFT JOIN gd USING (date) LEFT JOIN cd USING (date) WHERE series_key='all'"""))
def feature_frame(spark, sf):
    return rounded(_frame(spark, sf))


@query("top_values", with_(TO_FILLED + [_FEATURES], "SELECT 'governorate' AS kind, k AS rank, v AS value FROM tg WHERE k<=3 UNION ALL SELECT 'category', k, v FROM tc WHERE k<=3"))
def top_values(spark, sf):
    det = S.detail(clean_rows(spark, sf))
    out = None
    for kind, column in (("governorate", "governorate"), ("category", "offre_categorie")):
        counts = det.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        w = Window.partitionBy("kind").orderBy(F.desc("n"), "value")
        top = counts.orderBy(F.desc("n"), "value").limit(fixed.TOP_VALUES).withColumn("kind", F.lit(kind))
        part = top.select("kind", F.row_number().over(w).cast("bigint").alias("rank"), "value")
        out = part if out is None else out.unionByName(part)
    return out


_LAST = f"""lk AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS back FROM filled),
known AS (SELECT series_key, max(date) AS last_date, {', '.join(f"max(nb_abonnements) FILTER (back={k}) AS lag_{k}" for k in fixed.LAGS)},
 {', '.join(f"{r6(f'avg(nb_abonnements) FILTER (back<={n})', f'rolling_mean_{n}')}, {r6(f'stddev_samp(nb_abonnements) FILTER (back<={n})', f'rolling_std_{n}')}" for n in fixed.WINDOWS)} FROM lk GROUP BY 1)"""


@query("last_known_values", with_(TO_FILLED + [_LAST], "SELECT * FROM known"))
def last_known_values(spark, sf):
    return rounded(X.last_known(filled(spark, sf)))


@query("future_features", with_(TO_FILLED + [_LAST], f"""SELECT series_key, horizon, date, {', '.join(f'lag_{k}' for k in fixed.LAGS)}, {', '.join(ROLL_NAMES)}, {', '.join(CAL_INT)},
 {r6('jour_annee_sin', 'jour_annee_sin')}, {r6('jour_annee_cos', 'jour_annee_cos')} FROM (SELECT *, {CAL} FROM
 (SELECT *, CAST(last_date + CAST(horizon AS INTEGER) AS DATE) AS date FROM known, (SELECT CAST(unnest(generate_series(1, 90)) AS INTEGER) AS horizon)))"""))
def future_features(spark, sf):
    return rounded(X.future_features(filled(spark, sf)))


@query("sequences", with_(TO_FILLED, """SELECT series_key, date, CAST(target AS DOUBLE) AS target, len(s) AS length, CAST(list_sum(s) AS DOUBLE) AS total, CAST(s[1] AS DOUBLE) AS first_value FROM
 (SELECT series_key, date, lead(nb_abonnements) OVER (PARTITION BY series_key ORDER BY date) AS target,
 list(nb_abonnements) OVER (PARTITION BY series_key ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s FROM filled)
 WHERE len(s)=7 AND target IS NOT NULL"""))
def sequences(spark, sf):
    rows = S.sequences(filled(spark, sf), 7)
    total = F.aggregate("sequence", F.lit(0.0), lambda a, v: a + v)
    return rounded(rows.select("series_key", "date", "target", F.size("sequence").cast("bigint").alias("length"), total.alias("total"), F.col("sequence")[0].alias("first_value")))


@query("min_max_scale", with_(TO_FILLED, f"SELECT series_key, date, {r6('coalesce((nb_abonnements - min(nb_abonnements) OVER w) / nullif(max(nb_abonnements) OVER w - min(nb_abonnements) OVER w, 0), 0)', 'scaled')} FROM filled WINDOW w AS (PARTITION BY series_key)"))
def min_max_scale(spark, sf):
    return rounded(filled(spark, sf).select("series_key", "date", numbers.min_max_scaled(F.col("nb_abonnements"), ["series_key"]).alias("scaled")))


@query("standard_scale", with_(TO_FILLED, f"SELECT series_key, date, {r6('(nb_abonnements - avg(nb_abonnements) OVER w) / coalesce(nullif(stddev_pop(nb_abonnements) OVER w, 0), 1)', 'scaled')} FROM filled WINDOW w AS (PARTITION BY series_key)"))
def standard_scale(spark, sf):
    return rounded(filled(spark, sf).select("series_key", "date", numbers.standardized(F.col("nb_abonnements"), ["series_key"]).alias("scaled")))


# ---- statistics --------------------------------------------------------------------------------------------------


@query("mean_by_weekday", with_(TO_FILLED, f"SELECT series_key, CAST(isodow(date)-1 AS INTEGER) AS jour_semaine, {r6('avg(nb_abonnements)', 'mean')} FROM filled GROUP BY 1, 2"))
def mean_by_weekday(spark, sf):
    return rounded(S.mean_by_weekday(filled(spark, sf)))


@query("describe_series", with_(TO_FILLED, f"""SELECT series_key, count(*) AS count, {r6('avg(y)', 'mean')}, {r6('stddev_samp(y)', 'std')}, min(y) AS min, {r6('quantile_cont(y, 0.25)', 'q25')},
 {r6('quantile_cont(y, 0.5)', 'q50')}, {r6('quantile_cont(y, 0.75)', 'q75')}, max(y) AS max, {r6('skewness(y)', 'skew')}, {r6('kurtosis(y)', 'kurtosis')}
 FROM (SELECT series_key, CAST(nb_abonnements AS DOUBLE) AS y FROM filled) GROUP BY 1"""))
def describe_series(spark, sf):
    return rounded(S.describe(filled(spark, sf)))


@query("driver_correlations", with_(TO_FILLED, f"""SELECT series_key, {r6('corr(nb_abonnements, est_weekend)', 'corr_est_weekend')}, {r6('corr(nb_abonnements, est_ferie)', 'corr_est_ferie')},
 {r6('corr(nb_abonnements, mois)', 'corr_mois')} FROM (SELECT series_key, nb_abonnements, {CAL} FROM filled) GROUP BY 1"""))
def driver_correlations(spark, sf):
    from tidemark.functions.dates import calendar_features

    frame = filled(spark, sf).withColumns({k: v for k, v in calendar_features(F.col("date")).items() if k in ("est_weekend", "est_ferie", "mois")})
    return rounded(S.correlations(frame))


@query("autocorrelation", with_(TO_FILLED, f"""SELECT a.series_key, CAST(k.lag AS INTEGER) AS lag, {r6('corr(b.nb_abonnements, a.nb_abonnements)', 'autocorrelation')} FROM ind a, (SELECT unnest(generate_series(1, 7)) AS lag) k, ind b
 WHERE a.series_key=b.series_key AND b.idx = a.idx + k.lag GROUP BY 1, 2"""))
def autocorrelation(spark, sf):
    return rounded(S.slice_correlation(filled(spark, sf), 7, value="nb_abonnements"))


_ACF = """
cen AS (SELECT series_key, idx, nb_abonnements - avg(nb_abonnements) OVER (PARTITION BY series_key) AS c FROM ind),
ac AS (SELECT a.series_key, CAST(k.lag AS INTEGER) AS lag, sum(a.c*b.c) / any_value(v.s) AS acf FROM cen a, (SELECT unnest(generate_series(0, 40)) AS lag) k, cen b,
 (SELECT series_key, sum(c*c) AS s FROM cen GROUP BY 1) v WHERE a.series_key=b.series_key AND v.series_key=a.series_key AND b.idx = a.idx + k.lag GROUP BY 1, 2)"""
# Durbin-Levinson: phi holds the weights of order k, r the autocorrelations from lag 0.
_PACF = """
rho AS (SELECT series_key, list(acf ORDER BY lag) AS r FROM ac GROUP BY 1 HAVING count(*) > 1),
pc AS (SELECT series_key, r, 1 AS k, [r[2]] AS phi, r[2] AS last FROM rho
 UNION ALL SELECT series_key, r, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - l*phi[k+1-j]), [l]), l FROM (
  SELECT *, (r[k+2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j]*r[k+2-j])))
   / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j]*r[j+1]))) AS l FROM pc WHERE k + 1 < len(r)))"""


@query("acf", with_(TO_FILLED + [_ACF], f"SELECT series_key, lag, {r6('acf', 'acf')} FROM ac"))
def acf(spark, sf):
    return rounded(S.acf(filled(spark, sf)))


@query("pacf", with_(TO_FILLED + [_ACF, _PACF], f"""SELECT series_key, 0 AS lag, 1.0::DOUBLE AS pacf FROM rho
 UNION ALL SELECT series_key, k, {r6('last', 'pacf')} FROM pc"""))
def pacf(spark, sf):
    return rounded(S.pacf(S.acf(filled(spark, sf))))


_PARTS = """
line AS (SELECT *, CAST(nb_abonnements AS DOUBLE) AS value, regr_slope(nb_abonnements, idx) OVER (PARTITION BY series_key) AS slope,
 avg(nb_abonnements) OVER (PARTITION BY series_key) AS m FROM ind),
det AS (SELECT *, m + slope*(idx - (n-1)/2) AS trend, value - (m + slope*(idx - (n-1)/2)) AS d FROM line),
season AS (SELECT *, CASE WHEN n>=14 THEN avg(d) OVER (PARTITION BY series_key, idx%7) ELSE 0 END AS seasonal_7,
 CASE WHEN n>=60 THEN avg(d) OVER (PARTITION BY series_key, idx%30) ELSE 0 END AS seasonal_30 FROM det),
res AS (SELECT *, d - seasonal_7 - seasonal_30 AS residual FROM season)"""
_SCALED = """
scal AS (SELECT *, (nb_abonnements - avg(nb_abonnements) OVER (PARTITION BY series_key)) / coalesce(nullif(stddev_pop(nb_abonnements) OVER (PARTITION BY series_key), 0), 1) AS value FROM ind),
line AS (SELECT *, regr_slope(value, idx) OVER (PARTITION BY series_key) AS slope, avg(value) OVER (PARTITION BY series_key) AS m FROM scal),
det AS (SELECT *, m + slope*(idx - (n-1)/2) AS trend, value - (m + slope*(idx - (n-1)/2)) AS d FROM line),
season AS (SELECT *, CASE WHEN n>=14 THEN avg(d) OVER (PARTITION BY series_key, idx%7) ELSE 0 END AS seasonal_7,
 CASE WHEN n>=60 THEN avg(d) OVER (PARTITION BY series_key, idx%30) ELSE 0 END AS seasonal_30 FROM det),
res AS (SELECT *, d - seasonal_7 - seasonal_30 AS residual FROM season),
auto AS (SELECT a.series_key, k.lag, corr(b.residual, a.residual) AS a FROM res a, (SELECT unnest(generate_series(1, 7)) AS lag) k, res b WHERE a.series_key=b.series_key AND b.idx = a.idx + k.lag GROUP BY 1, 2)"""


@query("decompose", with_(TO_FILLED + [_PARTS], f"SELECT series_key, date, {', '.join(r6(c, c) for c in ('trend', 'seasonal_7', 'seasonal_30', 'residual'))} FROM res"))
def decompose(spark, sf):
    return rounded(S.decompose(filled(spark, sf)).select("series_key", "date", "trend", "seasonal_7", "seasonal_30", "residual"))


@query("decomposition_summary", with_(TO_FILLED + [_SCALED], f"""SELECT s.*, {', '.join(r6(f'max(a) FILTER (lag={k})', f'autocorr_{k}') for k in range(1, 8))} FROM
 (SELECT series_key, {r6('any_value(slope)', 'slope')}, abs(arg_max(trend, idx) - arg_min(trend, idx)) > 0.1 AS has_trend, max(n)>=14 AS uses_7, max(n)>=60 AS uses_30,
 {r6('avg(residual)', 'residual_mean')}, {r6('stddev_pop(residual)', 'residual_std')} FROM res GROUP BY 1) s JOIN auto USING (series_key) GROUP BY ALL"""))
def decomposition_summary(spark, sf):
    return rounded(S.fit_summary(S.decompose(filled(spark, sf), scale=True)))


# ---- splits, metrics, intervals, anomalies on the week-before baseline --------------------------------------------


@query("time_split", with_(TO_FILLED, "SELECT series_key, date, CASE WHEN idx < floor(n*0.8) THEN 'train' ELSE 'test' END AS role FROM ind"))
def time_split(spark, sf):
    return E.split(filled(spark, sf)).select("series_key", "date", "role")


_FOLD = """
fold AS (SELECT * FROM (SELECT *, CASE WHEN idx < n - (6-f)*(n//6) THEN 'train' WHEN idx < n - (5-f)*(n//6) THEN 'test' END AS role FROM
 (SELECT ind.*, CAST(f AS INTEGER) AS f FROM ind, (SELECT unnest(generate_series(1, 5)) AS f))) WHERE role IS NOT NULL)"""


@query("expanding_folds", with_(TO_FILLED + [_FOLD], """SELECT series_key, f AS fold, count(*) FILTER (role='train') AS n_train, count(*) FILTER (role='test') AS n_test,
 min(date) FILTER (role='test') AS test_start, max(date) FILTER (role='test') AS test_end FROM fold GROUP BY 1, 2"""))
def expanding_folds(spark, sf):
    rows = E.folds(filled(spark, sf))
    test = F.when(F.col("role") == "test", F.col("date"))
    return rows.groupBy("series_key", "fold").agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"),
        F.min(test).alias("test_start"), F.max(test).alias("test_end"),
    )


def metric_sql(by, source="naive"):
    return f"""SELECT {by}, {r6('avg(abs(y-yhat))', '"MAE"')}, {r6('sqrt(avg((y-yhat)*(y-yhat)))', '"RMSE"')}, {r6('avg(abs(y-yhat)/greatest(abs(y), 1e-8))*100/1e6', '"MAPE"')},
 {r6('avg(abs(y-yhat)/greatest((abs(y)+abs(yhat))/2, 1e-8))*100', '"sMAPE"')}, {r6('sum(abs(y-yhat))/nullif(sum(abs(y)), 0)*100', '"WAPE"')}, count(*) AS n_test FROM {source} GROUP BY {by}"""


@query("forecast_metrics", with_(TO_NAIVE, metric_sql("series_key")))
def forecast_metrics(spark, sf):
    """Errors of the baseline; MAPE, huge because of zero days, in millions of percent."""
    return rounded(E.metrics(naive(spark, sf), ["series_key"]).withColumn("MAPE", F.col("MAPE") / 1e6))


@query("retrain_signal", with_(TO_NAIVE, "SELECT series_key, avg(abs(y-yhat)/greatest(abs(y), 1e-8))*100 > 25 AS retrain FROM naive GROUP BY 1"))
def retrain_signal(spark, sf):
    return E.retrain_flag(E.metrics(naive(spark, sf), ["series_key"])).select("series_key", "retrain")


_BT = f""",
fp AS (SELECT series_key, fold.f AS fold, date, CAST(nb_abonnements AS DOUBLE) AS y, naive.yhat FROM fold JOIN naive USING (series_key, date) WHERE role='test'),
fr AS (SELECT series_key, fold, avg(abs(y-yhat)) AS mae, avg(abs(y-yhat)/greatest(abs(y), 1e-8))*100 AS mape FROM fp GROUP BY 1, 2)"""


def _fold_rows(spark, sf):
    folded = E.folds(filled(spark, sf))
    test = folded.filter("role = 'test'").select("series_key", "fold", "date")
    pred = test.join(naive(spark, sf), ["series_key", "date"])
    return E.fold_report(folded, pred)


@query("backtest_folds", with_(TO_NAIVE + [_FOLD.strip()], _BT.strip() + f" SELECT series_key, fold, {r6('mae', 'mae')}, {r6('mape/1e6', 'mape')} FROM fr"))
def backtest_folds(spark, sf):
    return rounded(_fold_rows(spark, sf).withColumn("mape", F.col("mape") / 1e6).select("series_key", "fold", "mae", "mape"))


@query("backtest_summary", with_(TO_NAIVE + [_FOLD.strip()], _BT.strip() + f""" SELECT series_key, {r6('avg(mape/1e6)', 'mape_mean')}, {r6('stddev_samp(mape/1e6)', 'mape_std')}, {r6('avg(mae)', 'mae_mean')},
 {r6('stddev_samp(mae)', 'mae_std')}, CASE WHEN avg(mape) < 15 THEN 'Excellent' WHEN avg(mape) < 25 THEN 'Good' ELSE 'Needs Improvement' END AS rating FROM fr GROUP BY 1"""))
def backtest_summary(spark, sf):
    rows = E.backtest_summary(_fold_rows(spark, sf))
    return rounded(rows.withColumns({c: F.col(c) / 1e6 for c in ("mape_mean", "mape_std")}))


@query("prediction_interval", with_(TO_NAIVE, f"""SELECT n.series_key, date, yhat, {r6('yhat + lo', 'yhat_lower')}, {r6('yhat + hi', 'yhat_upper')}, 'own' AS bounds FROM naive n JOIN
 (SELECT series_key, quantile_cont(y-yhat, 0.025) AS lo, quantile_cont(y-yhat, 0.975) AS hi FROM naive GROUP BY 1) q USING (series_key)"""))
def prediction_interval(spark, sf):
    p = naive(spark, sf)
    return rounded(E.interval(p, p).drop("y"))


@query("pooled_interval", with_(TO_NAIVE, f"SELECT series_key, date, {r6('yhat + (SELECT quantile_cont(y-yhat, 0.025) FROM naive)', 'yhat_lower')}, {r6('yhat + (SELECT quantile_cont(y-yhat, 0.975) FROM naive)', 'yhat_upper')}, 'pooled' AS bounds FROM naive"))
def pooled_interval(spark, sf):
    p = naive(spark, sf)
    return rounded(E.interval(p, p, pooled=True).drop("y", "yhat"))


@query("simple_band", with_(TO_NAIVE, f"SELECT series_key, date, {r6('yhat*(1-0.15)', 'lower_bound')}, {r6('yhat*(1+0.15)', 'upper_bound')} FROM naive"))
def simple_band(spark, sf):
    return rounded(E.simple_band(naive(spark, sf)).drop("y", "yhat"))


@query("residuals", with_(TO_NAIVE, f"SELECT series_key, date, y, yhat, y-yhat AS residual, {r6('(y-yhat)/nullif(yhat, 0)*100', 'residual_pct')} FROM naive"))
def residuals(spark, sf):
    return rounded(insight.with_residuals(naive(spark, sf)))


_ANOM = """
med AS (SELECT *, y-yhat AS residual, quantile_cont(y-yhat, 0.5) OVER (PARTITION BY series_key) AS m FROM naive),
mad AS (SELECT *, quantile_cont(abs(residual-m), 0.5) OVER (PARTITION BY series_key) AS d FROM med),
sc AS (SELECT *, round(abs(residual-m)/greatest(d*1.4826, 1e-8), 9) AS score FROM mad),
anom AS (SELECT *, score > round(quantile_cont(score, 0.95) OVER (PARTITION BY series_key), 9) AS is_anomaly FROM sc)"""


def flagged(spark, sf):
    return insight.anomalies(naive(spark, sf))


@query("anomalies", with_(TO_NAIVE + [_ANOM], "SELECT series_key, date, residual, is_anomaly FROM anom"))
def anomalies(spark, sf):
    return rounded(flagged(spark, sf).select("series_key", "date", "residual", "is_anomaly"))


@query("anomaly_rate", with_(TO_NAIVE + [_ANOM], f"SELECT series_key, count(*) FILTER (is_anomaly) AS anomalies, {r6('avg(CAST(is_anomaly AS DOUBLE))*100', 'anomaly_rate')} FROM anom GROUP BY 1"))
def anomaly_rate(spark, sf):
    return rounded(insight.anomaly_rate(flagged(spark, sf)))


@query("recent_anomalies", with_(TO_NAIVE + [_ANOM], f"""SELECT * FROM (SELECT series_key, date, y, yhat, residual, {r6('residual/nullif(yhat, 0)*100', 'residual_pct')},
 CAST(row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS INTEGER) AS rank FROM anom WHERE is_anomaly) WHERE rank <= 5"""))
def recent_anomalies(spark, sf):
    return rounded(insight.recent_anomalies(flagged(spark, sf)))


@query("recommendations", with_(TO_NAIVE + [_FOLD.strip(), _ANOM], _BT.strip() + f""" SELECT a.series_key, {r6('s.mm/1e6', 'mape_mean')}, a.n AS anomalies,
 CASE WHEN s.mm < 15 THEN 'a' WHEN s.mm < 25 THEN 'b' ELSE 'c' END AS rating, a.n > 3 AS review
 FROM (SELECT series_key, avg(mape) AS mm FROM fr GROUP BY 1) s JOIN (SELECT series_key, count(*) FILTER (is_anomaly) AS n FROM anom GROUP BY 1) a USING (series_key)"""))
def recommendations(spark, sf):
    rows = insight.recommendations(E.backtest_summary(_fold_rows(spark, sf)), insight.anomaly_rate(flagged(spark, sf)))
    return rounded(rows.withColumn("mape_mean", F.col("mape_mean") / 1e6))


from tidemark.catalog.base import FACT, DIMS, KEYED, TIME  # noqa: E402

_CONTEXT = TO_FIRST + [TIME, DIMS, KEYED, FACT, LEVELS, FILLED, NAIVE, _ANOM]


@query("anomaly_context", with_(_CONTEXT, """SELECT date, dealer_id, governorate, categorie, nb, rank FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY nb DESC, dealer_id, governorate, categorie) AS INTEGER) AS rank FROM (
 SELECT f.creation_day AS date, d.dealer_id, g.governorate, o.categorie, count(*) AS nb FROM fact f JOIN dim_dealer d USING (dealer_id_pk)
 JOIN dim_geo g USING (geo_id) JOIN dim_offer o USING (offre_id) WHERE f.creation_day IN (SELECT date FROM anom WHERE is_anomaly AND series_key='all') GROUP BY ALL)) WHERE rank <= 3"""))
def anomaly_context(spark, sf):
    t = star_tables(spark, sf)
    days = flagged(spark, sf).filter("is_anomaly AND series_key = 'all'").select("date")
    return reports.day_context(days, t["fact_abonnements"], t["dim_dealer"], t["dim_geo"], t["dim_offer"])


# ---- what-if, summaries: on a forecast of 90 days by seasonal smoothing -------------------------------------------

_RULES = ", ".join(f"('{n}', {a}, {b}, {m}, {s})" for n, a, b, m, s in fixed.WHAT_IF_RULES)


def smooth_sql(kinds):
    """Smoothing of the filled series; the recursion walks all parameter rows of all series day by day."""
    grid = ", ".join(f"('{k}', {a}, {b}, {g})" for k in kinds for a, b, g in smoothing.GRIDS[k])
    return [f"""
lst AS (SELECT series_key, list(CAST(nb_abonnements AS DOUBLE) ORDER BY date) AS ys, max(date) AS last_date FROM filled GROUP BY 1)""", f"""
st AS (SELECT series_key, kind, a, b, g, CASE WHEN kind='Holt-Winters' THEN 7 ELSE 1 END AS t,
  CASE WHEN kind='Holt-Winters' THEN list_sum(ys[1:7])/7 ELSE ys[1] END AS lev,
  CASE kind WHEN 'SES' THEN 0.0 WHEN 'Holt' THEN ys[2]-ys[1] ELSE (list_sum(ys[8:14])/7 - list_sum(ys[1:7])/7)/7 END AS tr,
  CASE WHEN kind='Holt-Winters' THEN list_transform(ys[1:7], lambda v: v - list_sum(ys[1:7])/7) ELSE [0.0::DOUBLE] END AS se, 0.0::DOUBLE AS sse
 FROM lst, (VALUES {grid}) v(kind, a, b, g)
 UNION ALL
 SELECT s.series_key, kind, a, b, g, t+1, lev+tr+a*(l.ys[t+1]-(lev+tr+se[1])), tr+a*b*(l.ys[t+1]-(lev+tr+se[1])),
  list_concat(se[2:], [se[1]+g*(1-a)*(l.ys[t+1]-(lev+tr+se[1]))]), sse + (l.ys[t+1]-(lev+tr+se[1]))*(l.ys[t+1]-(lev+tr+se[1]))
 FROM st s JOIN lst l ON l.series_key=s.series_key WHERE t < len(l.ys))""", """
bestp AS (SELECT * FROM (SELECT st.*, last_date, row_number() OVER (PARTITION BY st.series_key, kind ORDER BY sse, a, b, g) AS rn FROM st JOIN lst l ON l.series_key=st.series_key AND t=len(l.ys)) WHERE rn=1)"""]


FORECAST = smooth_sql(("Holt-Winters",)) + [f"""
fc AS (SELECT series_key, CAST(last_date + h AS DATE) AS date, {r6('lev + h*tr + se[(h-1)%len(se)+1]', 'yhat')}, h AS horizon
 FROM bestp, (SELECT CAST(unnest(generate_series(1, 90)) AS INTEGER) AS h))"""]


def forecast_rows(spark, sf):
    """The 90 days after each series, kept as a table between queries."""

    def build(root):
        rows = smoothing.smooth(filled(spark, sf), "Holt-Winters")
        rounded(rows).select("series_key", "date", "yhat", "horizon").write.parquet(root)
        return spark.read.parquet(root)

    return staged(spark, sf, "forecast", build)


@query("what_if", with_(TO_FILLED + FORECAST, f"""SELECT series_key, scenario, {r6('sum(v)', 'total')}, {r6('sum(v) - sum(yhat)', 'vs_baseline')} FROM (
 SELECT series_key, r.scenario, yhat, CASE WHEN horizon BETWEEN r.a AND r.b THEN yhat*r.m + r.s ELSE yhat END AS v FROM fc, (VALUES {_RULES}) r(scenario, a, b, m, s) WHERE horizon <= 30) GROUP BY 1, 2"""))
def what_if(spark, sf):
    return rounded(insight.what_if_totals(insight.what_if(forecast_rows(spark, sf))))


@query("forecast_summary", with_(TO_FILLED + FORECAST, """SELECT series_key, count(*) AS total_days, round(sum(yhat), 2) AS total_subscriptions, round(avg(yhat), 2) AS avg_daily, round(min(yhat), 2) AS min_daily,
 round(max(yhat), 2) AS max_daily, min(date) AS start_date, max(date) AS end_date FROM fc GROUP BY 1"""))
def forecast_summary(spark, sf):
    return insight.forecast_summary(forecast_rows(spark, sf))


@query("monthly_totals", with_(TO_FILLED + FORECAST, "SELECT series_key, CAST(date_trunc('month', date) AS DATE) AS month, floor(round(sum(yhat), 6) * 100 + 0.5) / 100 AS total, count(*) AS days FROM fc GROUP BY 1, 2"))
def monthly_totals(spark, sf):
    return insight.monthly_totals(forecast_rows(spark, sf))


@query("request_days", with_(TO_FIRST, """SELECT msisdn, CAST(unnest(generate_series(creation_day, CAST(creation_day + INTERVAL 2 MONTH AS DATE) - 1, INTERVAL 1 DAY)) AS DATE) AS date FROM firsts"""))
def request_days(spark, sf):
    rows = S.valid_only(clean_rows(spark, sf)).select("msisdn", F.col("creation_day").alias("start_date"), F.lit(2).alias("months"))
    return insight.request_days(rows).select("msisdn", "date")


@query("horizon_heads", with_(TO_FILLED + FORECAST, "SELECT series_key, horizon, date, yhat FROM fc WHERE horizon <= 30"))
def horizon_heads(spark, sf):
    return forecast_rows(spark, sf).filter(F.col("horizon") <= fixed.SHORT_HORIZON).select("series_key", "horizon", "date", "yhat")


@query("month_span", with_(TO_FILLED, "SELECT series_key, CAST(min(date) + INTERVAL 5 MONTH AS DATE) AS period_end, strftime(min(date), '%B %Y') AS period_start FROM filled GROUP BY 1"))
def month_span(spark, sf):
    spans = filled(spark, sf).groupBy("series_key").agg(F.min("date").alias("d"))
    return spans.select("series_key", F.add_months("d", 5).alias("period_end"), F.date_format("d", "MMMM yyyy").alias("period_start"))


# ---- scenarios ---------------------------------------------------------------------------------------------------


def _scenario_sql(n_scenarios, horizon, seed=42, noise=0.1, start="n"):
    def u(kind, part):
        text = f"'{seed}|' || series_key || '|' || sc || '|' || i || '|{kind}|{part}'"
        return f"((CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) + 0.5) / 4294967296.0)"

    def normal(kind):
        return f"sqrt(-2*ln({u(kind, 'r')}))*cos(2*pi()*{u(kind, 'a')})"

    walk = [f"""
m AS (SELECT series_key, avg(nb_abonnements) AS mean, stddev_pop(nb_abonnements) AS std, max(n) AS n, max(date) AS last_date, any_value(slope) AS slope,
 arg_min(trend, idx) AS base, avg(residual) AS rm, stddev_pop(residual) AS rs FROM res GROUP BY 1),
pat AS (SELECT series_key, idx, seasonal_7, seasonal_30 FROM res WHERE idx < 30),
w0 AS (SELECT series_key, sc, i, rm + rs*{normal('residual')} AS w FROM m, (SELECT CAST(unnest(generate_series(1, {n_scenarios})) AS INTEGER) AS sc),
 (SELECT CAST(unnest(generate_series(1, {horizon})) AS INTEGER) AS i))"""]
    for k in range(1, 8):
        walk.append(f"""
w{k} AS (SELECT x.series_key, sc, i, w + coalesce(a.a, 0) * coalesce(lag(w, {k}) OVER (PARTITION BY x.series_key, sc ORDER BY i), 0) AS w
 FROM w{k - 1} x JOIN auto a ON a.series_key=x.series_key AND a.lag={k})""")
    walk.append(f"""
path AS (SELECT w.series_key, sc, i AS horizon, CAST(last_date + i AS DATE) AS date,
 (base + slope*({start}+i-1) + w + {noise}*({normal('noise')}) + p7.seasonal_7 + p30.seasonal_30)*std + mean AS forecast
 FROM (SELECT * FROM w7) w JOIN m USING (series_key) JOIN pat p7 ON p7.series_key=w.series_key AND p7.idx=({start}+i-1)%7
 JOIN pat p30 ON p30.series_key=w.series_key AND p30.idx=({start}+i-1)%30)""")
    return walk


def sampled(spark, sf, n, horizon):
    return scenario.scenarios(scenario.scenario_model(filled(spark, sf)), n, horizon)


@query("scenarios", with_(TO_FILLED + [_SCALED] + _scenario_sql(10, 30), f"SELECT series_key, 'scenario_' || sc AS scenario, horizon, date, {r6('forecast', 'forecast')} FROM path"))
def scenarios(spark, sf):
    return rounded(sampled(spark, sf, 10, 30))


_SSTAT = """sst AS (SELECT series_key, 'scenario_' || sc AS scenario, avg(forecast) AS mean_daily, sum(forecast) AS total, min(forecast) AS min_daily, max(forecast) AS max_daily,
 stddev_samp(forecast) AS volatility, arg_max(forecast, horizon) - arg_min(forecast, horizon) AS trend FROM path GROUP BY 1, 2)"""
_SCOLS = ("mean_daily", "total", "min_daily", "max_daily", "volatility", "trend")


@query("scenario_statistics", with_(TO_FILLED + [_SCALED] + _scenario_sql(10, 30) + [_SSTAT], f"SELECT series_key, scenario, {', '.join(r6(c, c) for c in _SCOLS)} FROM sst"))
def scenario_statistics(spark, sf):
    return rounded(insight.scenario_statistics(sampled(spark, sf, 10, 30)))


@query("scenario_insights", with_(TO_FILLED + [_SCALED] + _scenario_sql(10, 30) + [_SSTAT], f"""SELECT series_key, {r6('avg(mean_daily)', 'avg_daily')}, {r6('min(total)', 'lowest_total')}, {r6('max(total)', 'highest_total')},
 arg_max(scenario, total) AS best_case, arg_min(scenario, total) AS worst_case, {r6('max(total)-avg(total)', 'best_gain')}, {r6('min(total)-avg(total)', 'worst_loss')},
 {r6('min(volatility)', 'volatility_low')}, {r6('max(volatility)', 'volatility_high')} FROM sst GROUP BY 1"""))
def scenario_insights(spark, sf):
    return rounded(insight.scenario_insights(insight.scenario_statistics(sampled(spark, sf, 10, 30))))


_Q = ("mean", "std", "min", "max", "trend")


@query("scenario_quality", with_(TO_FILLED + [_SCALED] + _scenario_sql(20, 60) + ["""
rl AS (SELECT series_key, avg(nb_abonnements) AS real_mean, stddev_pop(nb_abonnements) AS real_std, CAST(min(nb_abonnements) AS DOUBLE) AS real_min,
 CAST(max(nb_abonnements) AS DOUBLE) AS real_max, CAST(arg_max(nb_abonnements, date) - arg_min(nb_abonnements, date) AS DOUBLE) AS real_trend FROM filled GROUP BY 1),
sy AS (SELECT series_key, avg(forecast) AS synthetic_mean, stddev_pop(forecast) AS synthetic_std, min(forecast) AS synthetic_min, max(forecast) AS synthetic_max FROM path GROUP BY 1),
tr AS (SELECT series_key, avg(t) AS synthetic_trend FROM (SELECT series_key, sc, arg_max(forecast, horizon)-arg_min(forecast, horizon) AS t FROM path GROUP BY 1, 2) GROUP BY 1)"""],
    "SELECT series_key, " + ", ".join(
        f"{r6(f'real_{k}', f'real_{k}')}, {r6(f'synthetic_{k}', f'synthetic_{k}')}, {r6(f'abs(real_{k}-synthetic_{k})', f'{k}_diff')}, "
        + r6(f"CASE WHEN real_{k}=0 THEN abs(real_{k}-synthetic_{k}) ELSE abs(real_{k}-synthetic_{k})/abs(real_{k}) END", f"{k}_rel_diff") for k in _Q
    ) + " FROM rl JOIN sy USING (series_key) JOIN tr USING (series_key)"))
def scenario_quality(spark, sf):
    return rounded(scenario.quality(filled(spark, sf), sampled(spark, sf, 20, 60)))
