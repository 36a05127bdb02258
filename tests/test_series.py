"""Series operators against pandas and numpy on small data."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.operators import features as X
from tidemark.operators import insight
from tidemark.operators import series as S


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    out = []
    for key, n in (("a", 200), ("b", 90)):
        for i in range(n):
            if i in (0, n - 1) or rng.random() > 0.2:
                out.append((key, dt.date(2024, 1, 1) + dt.timedelta(days=i), int(rng.poisson(4 + i % 7))))
    return pd.DataFrame(out, columns=["series_key", "date", "nb_abonnements"])


@pytest.fixture(scope="module")
def full(sample):
    parts = []
    for key, g in sample.groupby("series_key"):
        s = g.set_index(pd.to_datetime(g["date"]))["nb_abonnements"].resample("D").sum()
        parts.append(pd.DataFrame({"series_key": key, "date": s.index.date, "nb_abonnements": s.values}))
    return pd.concat(parts, ignore_index=True)


def frame(spark, pdf):
    return spark.createDataFrame(pdf, "series_key string, date date, nb_abonnements bigint")


def test_fill_gaps(spark, sample, full):
    got = S.fill_gaps(frame(spark, sample)).toPandas().sort_values(["series_key", "date"]).reset_index(drop=True)
    assert got["nb_abonnements"].tolist() == full["nb_abonnements"].tolist() and got["date"].tolist() == full["date"].tolist()


def test_rolling_and_lags(spark, full):
    got = S.add_rolling(S.add_lags(frame(spark, full)), exclude_current=False).toPandas().sort_values(["series_key", "date"])
    for key, g in full.groupby("series_key"):
        mine = got[got["series_key"] == key]
        np.testing.assert_allclose(mine["rolling_std_14"].astype(float), g["nb_abonnements"].rolling(14).std(), rtol=1e-9)
        np.testing.assert_allclose(mine["rolling_mean_30"].astype(float), g["nb_abonnements"].rolling(30).mean(), rtol=1e-9)
        np.testing.assert_allclose(mine["lag_7"].astype(float), g["nb_abonnements"].shift(7), rtol=0)


def test_describe(spark, full):
    got = S.describe(frame(spark, full)).toPandas().set_index("series_key")
    for key, g in full.groupby("series_key"):
        v = g["nb_abonnements"]
        np.testing.assert_allclose(
            got.loc[key, ["std", "q25", "skew", "kurtosis"]].astype(float), [v.std(), v.quantile(0.25), v.skew(), v.kurtosis()], rtol=1e-9
        )


def test_pacf_by_solving_the_equations(spark, full):
    got = S.pacf(S.acf(frame(spark, full), 12)).toPandas()
    for key, g in full.groupby("series_key"):
        v = g["nb_abonnements"].to_numpy(float)
        c = v - v.mean()
        rho = np.array([1.0] + [c[:-k] @ c[k:] / (c @ c) for k in range(1, 13)])
        mine = got[got["series_key"] == key].sort_values("lag")["pacf"].to_numpy()
        assert mine[0] == 1.0
        for k in range(1, 13):
            r = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
            assert mine[k] == pytest.approx(np.linalg.solve(r, rho[1 : k + 1])[-1], rel=1e-9, abs=1e-12)


def test_folds_never_overlap(spark, full):
    got = E.folds(frame(spark, full)).toPandas()
    for (key, fold), g in got.groupby(["series_key", "fold"]):
        n = int(g["n"].iloc[0])
        test = g[g["role"] == "test"]["idx"]
        train = g[g["role"] == "train"]["idx"]
        start = n - (6 - fold) * (n // 6)
        assert sorted(test) == list(range(start, start + n // 6)) and sorted(train) == list(range(start))


def test_split(spark, full):
    got = E.split(frame(spark, full)).toPandas()
    for key, g in got.groupby("series_key"):
        assert (g["role"] == "train").sum() == int(len(g) * 0.8)
        assert g[g["role"] == "train"]["date"].max() < g[g["role"] == "test"]["date"].min()


def test_metrics(spark):
    y, p = np.array([0.0, 2, 4, 5]), np.array([1.0, 2, 3, 7])
    df = spark.createDataFrame(list(zip(["s"] * 4, y.tolist(), p.tolist())), "series_key string, y double, yhat double")
    r = E.metrics(df, ["series_key"]).first()
    assert r["MAE"] == pytest.approx(np.mean(abs(y - p)))
    assert r["RMSE"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert r["MAPE"] == pytest.approx(np.mean(abs(y - p) / np.maximum(abs(y), 1e-8)) * 100)
    assert r["sMAPE"] == pytest.approx(np.mean(abs(y - p) / np.maximum((abs(y) + abs(p)) / 2, 1e-8)) * 100)


@pytest.mark.parametrize("n", [1, 2, 1000])
def test_exact_quantiles_with_a_hot_value(spark, n):
    v = [0.0 if i % 3 == 0 else float((i * 7919) % 1009) for i in range(n)]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    probs = [0.0, 0.025, 0.3, 0.5, 0.975, 1.0]
    got = {r["p"]: r["quantile"] for r in E.exact_quantiles(df, "v", probs, parts=5).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(v, p))


def test_interval_falls_back_to_all_series(spark):
    rows = [("long", float(i), 0.0) for i in range(100)] + [("short", 5.0, 0.0)]
    df = spark.createDataFrame(rows, "series_key string, y double, yhat double")
    got = {r["series_key"]: r for r in E.interval(df.filter("y = 5"), df).collect()}
    assert got["long"]["yhat_upper"] == pytest.approx(np.quantile(np.arange(100), 0.975))
    assert got["short"]["yhat_upper"] == pytest.approx(np.quantile(np.append(np.arange(100), 5), 0.975))


def test_anomaly_share(spark, full):
    flagged = insight.anomalies(E.weekly_naive(frame(spark, full)))
    for r in insight.anomaly_rate(flagged).collect():
        assert 0 < r["anomaly_rate"] <= 6


def test_best_model_skips_nan_and_takes_first_of_ties(spark):
    df = spark.createDataFrame([("s", "b", 1.0), ("s", "a", 1.0), ("s", "c", float("nan")), ("t", "c", None)], "series_key string, model string, MAPE double")
    assert [tuple(r) for r in E.best_model(df).collect()] == [("s", "a", 1.0)]


def test_future_rows_freeze_the_last_values(spark, full):
    future = X.future_features(X.features(frame(spark, full)), 10).filter("series_key = 'a'").orderBy("date").toPandas()
    tail = full[full["series_key"] == "a"]["nb_abonnements"].to_numpy()
    assert (future["lag_7"] == tail[-7]).all() and len(future) == 10
    assert future["rolling_mean_14"].iloc[0] == pytest.approx(tail[-14:].mean())
    assert future["jour_semaine"].tolist() == [d.weekday() for d in future["date"]]


def test_decomposition_adds_up(spark, full):
    parts = S.decompose(frame(spark, full)).toPandas()
    total = parts["trend"] + parts["seasonal_7"] + parts["seasonal_30"] + parts["residual"]
    np.testing.assert_allclose(total, parts["value"], atol=1e-9)
    g = full[full["series_key"] == "a"]["nb_abonnements"].to_numpy(float)
    slope, base = np.polyfit(np.arange(len(g)), g, 1)
    mine = parts[parts["series_key"] == "a"].sort_values("idx")
    np.testing.assert_allclose(mine["trend"], base + slope * np.arange(len(g)), atol=1e-8)
    d = g - (base + slope * np.arange(len(g)))
    np.testing.assert_allclose(mine["seasonal_7"], [d[i % 7 :: 7].mean() for i in range(len(g))], atol=1e-8)


def test_series_queries_build_no_star(spark, sf, monkeypatch):
    """Series come from the first valid row of each number, the rows that the star's clean table would hold."""
    from tidemark.catalog import base
    from tidemark.catalog.base import QUERIES

    stored = base.star_tables(spark, sf)["clean_data"].filter("is_valid")
    columns = list(base.SERIES_COLUMNS)
    assert sorted(map(tuple, base.first_rows(spark, sf).select(*columns).collect()), key=str) == sorted(map(tuple, stored.select(*columns).collect()), key=str)

    def refuse(*args, **settings):
        raise AssertionError("a star was built")

    monkeypatch.setattr(base, "_STAGED", {})
    monkeypatch.setattr(base, "run_batch", refuse)
    for name in ("missing_days", "run_ranking", "best_smoothing_kind"):
        assert QUERIES[name](spark, sf).count() > 0


def test_first_rows_go_before_line_items_are_joined(spark, tmp_path, monkeypatch):
    """Neither whole landing rows are written nor line items joined to rows that are not asked for; the rows stay the same."""
    from tidemark.catalog import base
    from tidemark.operators import clean
    from tidemark.sources import bridge

    day = dt.datetime(1996, 1, 5)
    tables = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "KENYA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, 0, None if c == 3 else "AUTO") for c in range(1, 9)], "c_custkey bigint, c_nationkey int, c_mktsegment string"),
        "orders": ([(k, None if k == 77 else k % 9, None if k == 78 else day + dt.timedelta(days=k % 50)) for k in range(1, 300)],
                   "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
        "lineitem": ([(k, p, 1) for k in range(1, 300) if k % 4 for p in (k % 3, 2)], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint"),
        "part": ([(0, "TIN", 3), (1, "TIN", 3), (1, "TIN", 3)], "p_partkey bigint, p_type string, p_size int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sf, columns, sizes = str(tmp_path), list(base.SERIES_COLUMNS), []

    def counted(*args):
        view = bridge.landing_view(*args)
        sizes.append(view.count())
        return view

    monkeypatch.setattr(base, "_STAGED", {})
    monkeypatch.setattr(base, "landing_view", counted)
    got = base.first_rows(spark, sf).select("row_seq", *columns)
    assert sizes[0] < 20 and not any(name == "landing" for _, _, name in base._STAGED)
    plain = clean.dedup_first(clean.valid_only(base.judged(spark, sf)), "msisdn", ["row_seq"]).select("row_seq", *columns)
    assert sizes[1] > 250 and got.count() == 8
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
