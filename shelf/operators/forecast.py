"""Demand forecasting: split, metrics, baselines, tree models, intervals, future days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelf.functions.noise import hashed_key, normal_pair, polar_pair
from shelf.functions.numeric import non_negative
from shelf.operators.boosting import BoostedModel, fit_boosted
from shelf.operators.features import MODEL_FEATURES, date_features, series_window
from shelf.operators.partitioning import by_series, spread
from shelf.schema import SERIES, present

TARGET = "actual_sales"
KEY = (*SERIES, "date")

Model = PipelineModel | BoostedModel


def split_date(df: DataFrame, ratio: float = 0.8, *, date: str = "date") -> DataFrame:
    """One row: the date found ``ratio`` of the way through the rows in date order.

    Rows are counted by date first, so the global order runs over days only.
    """
    so_far = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(date).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    placed = counts.withColumns(
        {"upto": F.sum("n").over(so_far), "total": F.sum("n").over(everything)}
    )
    return placed.where(F.col("upto") > F.floor(F.col("total") * ratio)).agg(
        F.min(date).alias("split_date")
    )


def time_split(
    df: DataFrame, ratio: float = 0.8, *, date: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """Train before the split date, test from it on; a day is never divided.

    The date is looked up at once; as a constant it reaches the scan of a stored table.
    """
    cut = F.lit(split_date(df, ratio, date=date).first()["split_date"])
    return df.where(F.col(date) < cut), df.where(F.col(date) >= cut)


def metrics(
    df: DataFrame,
    model: str,
    *,
    actual: str = TARGET,
    predicted: str = "predicted_sales",
    by: Sequence[str] = (),
) -> DataFrame:
    """MAE, RMSE, MAPE over non-zero actuals, and R2, in one aggregation."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    unexplained = F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))
    return df.groupBy(*by).agg(
        F.lit(model).alias("model"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(y != 0, F.abs(F.try_divide(error, y)))) * 100).alias("mape_pct"),
        (1 - unexplained).alias("r2"),
    )


def naive_forecast(
    train: DataFrame, test: DataFrame, *, days: int = 7, per_series: bool = False
) -> DataFrame:
    """Predict the mean of the last training rows, over all series or within each.

    Ties on the last day are broken by store and product.
    """
    if per_series:
        latest = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
        means = (
            train.withColumn("_rank", F.row_number().over(latest))
            .where(F.col("_rank") <= days)
            .groupBy(*SERIES)
            .agg(F.avg(TARGET).alias("predicted_sales"))
        )
        return test.join(means, list(SERIES), "left")
    last = train.orderBy(F.desc("date"), F.desc("store"), F.desc("product")).limit(days)
    return test.withColumn("predicted_sales", last.agg(F.avg(TARGET)).scalar())


def feature_names(df: DataFrame) -> list[str]:
    return present(df, MODEL_FEATURES)


INPUT = "_x_"


def model_input(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add each feature as a double with nulls as zero, beside the untouched column."""
    return df.withColumns(
        {INPUT + f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    )


def model_features(model: Model) -> list[str]:
    if isinstance(model, BoostedModel):
        return model.features
    return [name.removeprefix(INPUT) for name in model.stages[0].getInputCols()]


def _training_rows(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features as doubles without nulls and the label, spread over all cores."""
    label = F.col(TARGET).cast("double").alias("label")
    rows = spread(train, *present(train, KEY)).select(*features, label)
    return model_input(rows, features).select(*[INPUT + f for f in features], "label")


def random_forest(
    train: DataFrame,
    *,
    features: Sequence[str] | None = None,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    bins: int = 64,
) -> PipelineModel:
    features = list(features or feature_names(train))
    assembler = VectorAssembler(inputCols=[INPUT + f for f in features], outputCol="_features")
    # Without caching of node ids a deep tree is traversed again on every level. The sums of a
    # pass are held by every running task, so they are bounded for an executor's heap.
    regressor = RandomForestRegressor(
        numTrees=trees, maxDepth=depth, seed=seed, maxBins=bins, featureSubsetStrategy="all",
        cacheNodeIds=True, maxMemoryInMB=512, featuresCol="_features", predictionCol="_prediction",
    )
    return Pipeline(stages=[assembler, regressor]).fit(_training_rows(train, features))


def boosted_trees(
    train: DataFrame,
    *,
    features: Sequence[str] | None = None,
    rounds: int = 100,
    rate: float = 0.1,
    depth: int = 6,
    bins: int = 64,
    penalty: float = 1.0,
) -> BoostedModel:
    """Newton boosting with an L2 penalty on the leaves' values; see :mod:`shelf.operators.boosting`."""
    features = list(features or feature_names(train))
    model = fit_boosted(
        _training_rows(train, features), [INPUT + f for f in features], "label",
        rounds=rounds, rate=rate, depth=depth, bins=bins, penalty=penalty,
    )
    model.features = features
    return model


def predict(df: DataFrame, model: Model, *, output: str = "predicted_sales") -> DataFrame:
    """Add the model's prediction, never below zero."""
    if isinstance(model, BoostedModel):
        inputs = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in model.features]
        return df.select(*df.columns, non_negative(model.prediction(inputs)).alias(output))
    scored = model.transform(model_input(df, model_features(model)))
    return scored.select(*df.columns, non_negative(F.col("_prediction")).alias(output))


def feature_importance(spark: SparkSession, model: Model, n: int | None = None) -> DataFrame:
    """Table (feature, importance), most important first; the first ``n`` if given."""
    names = model_features(model)
    if isinstance(model, BoostedModel):
        weights = model.importance()
    else:
        weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return table if n is None else table.limit(n)


def jittered(
    df: DataFrame,
    features: Sequence[str],
    *,
    replicas: int = 50,
    noise: float = 0.05,
    seed: int = 42,
    key: Sequence[str] = KEY,
    keep: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Each row once as it is (``_replica`` 0) and ``replicas`` times with noise on its features.

    Noise is a function of the row's key, the replica and the feature's place, so it does not depend
    on how the rows are distributed. Null features count as zero; ``keep`` names further columns.
    """
    rows = df.select(
        *key, *[c.alias(f"_keep_{n}") for n, c in (keep or {}).items()],
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, f in enumerate(features)],
    ).withColumn("_replica", F.explode(F.sequence(F.lit(0), F.lit(replicas))))
    # Two features share a hash. Hash, radius and angle are columns of their own, so each is made once.
    pairs = range(0, len(features), 2)
    drawn = rows.withColumns({f"_h{i}": hashed_key([*key, "_replica", F.lit(i // 2)], seed) for i in pairs})
    polar = {i: polar_pair(F.col(f"_h{i}")) for i in pairs}
    drawn = drawn.withColumns({f"_{n}{i}": c for i in pairs for n, c in zip("ra", polar[i])})
    moves = {}
    for i in pairs:
        moves |= dict(zip((i, i + 1), normal_pair(F.col(f"_r{i}"), F.col(f"_a{i}"))))
    return drawn.select(
        *key, "_replica", *[F.col(f"_keep_{n}").alias(n) for n in keep or {}],
        *[
            F.when(F.col("_replica") == 0, F.col(f"_f{i}")).otherwise(F.col(f"_f{i}") + moves[i] * noise).alias(f)
            for i, f in enumerate(features)
        ],
    )


def scored_interval(
    df: DataFrame,
    model: Model,
    *,
    replicas: int = 50,
    level: float = 0.95,
    noise: float = 0.05,
    seed: int = 42,
    key: Sequence[str] = KEY,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row the prediction, the spread of predictions with noisy features, and the columns ``keep``.

    Rows are distributed by key before they are repeated, so the replicas are scored in one pass and
    reduced where they are made, and never shuffled. ``key`` identifies a row.
    """
    features = model_features(model)
    rows = spread(df, *key)
    copies = jittered(
        rows, features, replicas=replicas, noise=noise, seed=seed, key=key, keep={f"_own_{c}": F.col(c) for c in keep}
    )
    tail = (1 - level) / 2
    scored = predict(copies, model, output="_p")
    first = F.col("_replica") == 0
    bounds = scored.groupBy(*key).agg(
        F.max(F.when(first, F.col("_p"))).alias("predicted_sales"),
        F.percentile(F.when(~first, F.col("_p")), [tail, 1 - tail]).alias("_b"),
        *[F.max(F.when(first, F.col(f"_own_{c}"))).alias(c) for c in keep],
    )
    low, high = F.col("_b")[0], F.col("_b")[1]
    return bounds.select(*key, *keep, "predicted_sales", low.alias("pred_lower"), high.alias("pred_upper"))


def noise_interval(df: DataFrame, model: Model, **settings) -> DataFrame:
    """Per row the spread of predictions when the features are jittered."""
    return scored_interval(df, model, **settings).drop("predicted_sales")


def future_features(
    df: DataFrame, days: int = 30, *, target: str = TARGET, recent: int = 30
) -> DataFrame:
    """One row per series and future day with the features a model needs.

    Lags and rolling figures stay at the last known day for the whole horizon;
    so all days are made at once. Deviations here divide by n.
    """
    value = F.col(target)
    series = series_window()

    def back(n: int):
        return series.rowsBetween(1 - n, Window.currentRow)

    known = F.count(F.lit(1)).over(series.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def lag(n: int) -> Column:
        return F.coalesce(F.lag(value, n - 1).over(series), F.lit(0)).cast("double")

    def deviation(n: int) -> Column:
        return F.when(known >= n, F.stddev_pop(value).over(back(n))).otherwise(0.0)

    frozen = {
        **{f"lag_{n}d": lag(n) for n in (1, 7, 14, 30)},
        **{f"rolling_mean_{n}d": F.avg(value).over(back(n)) for n in (7, 14)},
        "rolling_mean_30d": F.avg(value).over(back(recent)),
        **{f"rolling_std_{n}d": deviation(n) for n in (7, 14)},
        "expanding_mean": F.avg(value).over(back(recent)),
    }
    latest = Window.partitionBy(*SERIES).orderBy("date")
    last = (
        by_series(df)
        .withColumns({**frozen, "_next": F.lead("date").over(latest)})
        .where(F.col("_next").isNull())
        .drop("_next")
    )
    zero = F.lit(0)
    future = (
        last.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .withColumn("date", F.date_add("date", F.col("_ahead")))
        .drop("_ahead")
    )
    return date_features(future).withColumns(
        {"is_promotion": zero, "promo_x_weekend": zero, "promo_lag1": zero}
    )


def future_forecast(
    df: DataFrame, model: Model, days: int = 30, *, model_name: str, target: str = TARGET
) -> DataFrame:
    """Quantity and revenue per series and future day, scored in one batch."""
    scored = predict(future_features(df, days, target=target), model, output="_qty")
    return scored.select(
        "date", *SERIES, "category",
        F.bround("_qty", 2).alias("forecast_qty"),
        "unit_price",
        F.bround(F.col("_qty") * F.col("unit_price"), 2).alias("forecast_revenue"),
        F.lit(model_name).alias("model"),
    )


def compare(*tables: DataFrame) -> DataFrame:
    """One table of the metric rows, four decimals."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table)
    return whole.withColumns(
        {c: F.bround(c, 4) for c in ("mae", "rmse", "mape_pct", "r2")}
    )


def improvement(comparison: DataFrame, baseline: str) -> DataFrame:
    """The model with the lowest MAE and its gain over the baseline in percent."""
    base = F.max(F.when(F.col("model") == baseline, F.col("mae")))
    best = F.min("mae")
    return comparison.agg(
        F.min_by("model", "mae").alias("best_model"),
        best.alias("best_mae"),
        (F.try_divide(base - best, base) * 100).alias("improvement_pct"),
    )
