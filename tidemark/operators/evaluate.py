"""Error metrics, splits, folds, intervals, selection and run comparison."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.numbers import improvement_pct
from tidemark.operators import series as S
from tidemark.session import settle


def metrics(pred: DataFrame, by=("series_key", "model"), y="y", yhat="yhat") -> DataFrame:
    """MAE, RMSE, MAPE, sMAPE with floored denominators, and WAPE, which zero days leave intact."""
    a, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    floor = F.lit(fixed.METRIC_FLOOR)
    err = F.abs(a - p)
    return pred.groupBy(*by).agg(
        F.avg(err).alias("MAE"), F.sqrt(F.avg((a - p) * (a - p))).alias("RMSE"),
        (F.avg(err / F.greatest(F.abs(a), floor)) * 100).alias("MAPE"),
        (F.avg(err / F.greatest((F.abs(a) + F.abs(p)) / 2, floor)) * 100).alias("sMAPE"),
        (F.try_divide(F.sum(err), F.sum(F.abs(a))) * 100).alias("WAPE"),
        F.count("*").alias("n_test"),
    )


def retrain_flag(metric_rows: DataFrame) -> DataFrame:
    return metric_rows.withColumn("retrain", F.col("MAPE") > fixed.RETRAIN_MAPE)


def split(series: DataFrame, ratio=0.8, by=S.KEY) -> DataFrame:
    """Role `train` for the first part of each series in time, `test` for the rest."""
    indexed = S.with_index(series, by)
    role = F.when(F.col("idx") < F.floor(F.col("n") * ratio), "train").otherwise("test")
    return indexed.withColumn("role", role)


def folds(series: DataFrame, n_splits=5, by=S.KEY) -> DataFrame:
    """Expanding folds: equal test blocks at the end, all earlier rows train. Rows after a fold's block are left out."""
    block = F.expr(f"n DIV {n_splits + 1}")
    start = F.col("n") - (n_splits + 1 - F.col("fold")) * block
    each = S.with_index(series, by).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    role = F.when(F.col("idx") < start, "train").when(F.col("idx") < start + block, "test")
    return each.withColumn("role", role).filter(F.col("role").isNotNull())


def fold_report(folded: DataFrame, pred: DataFrame, by=S.KEY) -> DataFrame:
    """One row per fold: errors, test span, sizes. `pred` has the test rows with y and yhat."""
    keys = [*by, "fold"]
    sizes = folded.groupBy(*keys).agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"),
        F.min(F.when(F.col("role") == "test", F.col("date"))).alias("test_start"),
        F.max(F.when(F.col("role") == "test", F.col("date"))).alias("test_end"),
    )
    return metrics(pred, keys).select(*keys, F.col("MAE").alias("mae"), F.col("MAPE").alias("mape")).join(sizes, keys)


def backtest_summary(fold_rows: DataFrame, by=S.KEY) -> DataFrame:
    """Mean and sample deviation of fold errors, and a rating."""
    mape = F.avg("mape")
    rating = F.when(mape < fixed.RATING_EXCELLENT, "Excellent").when(mape < fixed.RATING_GOOD, "Good").otherwise("Needs Improvement")
    return fold_rows.groupBy(*by).agg(
        mape.alias("mape_mean"), F.stddev_samp("mape").alias("mape_std"), F.avg("mae").alias("mae_mean"),
        F.stddev_samp("mae").alias("mae_std"), rating.alias("rating"),
    )


def weekly_naive(series: DataFrame, by=S.KEY, y="nb_abonnements", lag=7) -> DataFrame:
    """Baseline prediction: the value one week before. Rows without one are left out."""
    w = Window.partitionBy(*by).orderBy("date")
    rows = series.select(*by, "date", F.col(y).cast("double").alias("y"), F.lag(F.col(y).cast("double"), lag).over(w).alias("yhat"))
    return rows.filter(F.col("yhat").isNotNull())


def best_model(metric_rows: DataFrame, by=S.KEY, score="MAPE") -> DataFrame:
    """Model with the lowest score per series; models without one are skipped, ties go to the first name."""
    usable = metric_rows.filter(F.col(score).isNotNull() & ~F.isnan(score))
    pick = F.min(F.struct(F.col(score), F.col("model")))
    return usable.groupBy(*by).agg(pick.alias("_b")).select(*by, F.col("_b.model").alias("model"), F.col(f"_b.{score}").alias(score))


def ranked_models(metric_rows: DataFrame, by=S.KEY, score="MAPE", top=None) -> DataFrame:
    usable = metric_rows.filter(F.col(score).isNotNull() & ~F.isnan(score))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    ranked = usable.withColumn("rank", F.rank().over(w.orderBy(score)))
    return ranked.filter(F.col("rank") <= top) if top else ranked


def winner_score(runs: DataFrame, by=()) -> DataFrame:
    """4 points for the best MAE, 3 for the best RMSE, 2 for the best sMAPE, 1 for the shortest training."""
    points = {"MAE": 4, "RMSE": 3, "sMAPE": 2, "training_time": 1}
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    score = sum((F.when(F.col(m) == F.min(m).over(w), p).otherwise(0) for m, p in points.items()), F.lit(0))
    return runs.withColumn("overall_rank", score)


def improvements(runs: DataFrame, baseline: str, names=("MAE", "RMSE", "MAPE", "sMAPE"), by=S.KEY, label="model") -> DataFrame:
    """Percent by which each run improves on the named baseline run of its series."""
    base = runs.filter(F.col(label) == baseline).select(*by, *[F.col(n).alias(f"_b_{n}") for n in names])
    joined = runs.join(base, list(by), "left")
    return joined.withColumns({f"{n}_improvement": improvement_pct(F.col(f"_b_{n}"), F.col(n)) for n in names}).drop(*[f"_b_{n}" for n in names])


def exact_quantiles(df: DataFrame, value: str, probs, parts=None) -> DataFrame:
    """Exact quantiles with linear interpolation over one column of any length: rows (p, quantile).

    Equal values are counted first, the distinct ones are range-partitioned and numbered within their partition, so
    that no task sees more than a slice; only one count per partition meets in one place.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    sliced = settle(counted.repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("part").agg(F.sum("c").alias("size"))
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not total:
        return spark.createDataFrame([], "p double, quantile double")
    wanted = F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.lit(i).cast("bigint").alias("place"), F.lit(share).alias("share"))
        for p in probs
        for pos in [p * (total - 1)]
        for i, share in ((int(pos), 1 - (pos - int(pos))), (int(pos) + 1, pos - int(pos)))
    ])).alias("w")
    last = F.sum("c").over(Window.partitionBy("part").orderBy("v")) + F.col("offset")
    placed = sliced.join(F.broadcast(offsets), "part").withColumn("last", last).withColumn("first", F.col("last") - F.col("c"))
    hits = placed.select("*", wanted).filter((F.col("w.place") >= F.col("first")) & (F.col("w.place") < F.col("last")))
    return hits.groupBy(F.col("w.p").alias("p")).agg(F.sum(F.col("v") * F.col("w.share")).alias("quantile"))


def interval(pred: DataFrame, residuals: DataFrame, level=0.95, by=S.KEY, min_rows=30, pooled=False) -> DataFrame:
    """Bounds from residual quantiles, and in `bounds` whose they are: `own` of the series or `pooled` of all together.

    A series with fewer than `min_rows` residuals takes the pooled ones, and with `pooled` every series does. The pooled
    quantiles are worked out only if some series takes them.
    """
    low, high = (1 - level) / 2, 1 - (1 - level) / 2
    r = residuals.withColumn("_r", F.col("y") - F.col("yhat"))
    own = r.groupBy(*by).agg(
        F.count("*").alias("_n"), F.percentile("_r", F.array(F.lit(low), F.lit(high))).alias("_own")
    )
    joined = pred.join(own, list(by), "left")
    uses_own = F.lit(False) if pooled else F.coalesce(F.col("_n") >= min_rows, F.lit(False))
    found = {}
    if pooled or not joined.filter(~uses_own).isEmpty():
        found = {row["p"]: row["quantile"] for row in exact_quantiles(r, "_r", [low, high]).collect()}
    rest = F.array(F.lit(found.get(low)).cast("double"), F.lit(found.get(high)).cast("double"))
    joined = joined.withColumn("_q", F.when(uses_own, F.col("_own")).otherwise(rest))
    return joined.withColumns({
        "yhat_lower": F.col("yhat") + F.col("_q")[0], "yhat_upper": F.col("yhat") + F.col("_q")[1],
        "bounds": F.when(uses_own, "own").otherwise("pooled"),
    }).drop("_n", "_own", "_q")


def simple_band(pred: DataFrame, share=fixed.BAND) -> DataFrame:
    return pred.withColumn("lower_bound", F.col("yhat") * (1 - share)).withColumn("upper_bound", F.col("yhat") * (1 + share))
