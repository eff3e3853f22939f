"""Time-ordered folds, the seasonal-naive baseline, accuracy, and the boosted-tree model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.ordering import daily_positions, ranked
from stockweave.functions.quantiles import exact_quantiles
from stockweave.functions.scalars import half_even_int, mixed_hash, percentage_error
from stockweave.operators.attribution import attributed
from stockweave.operators.boosting import BoostedTrees, BoostParams, Run, boost
from stockweave.operators.demand import SERIES
from stockweave.params import ForecastParams
from stockweave.session import materialize

FORECAST_COLUMNS = (
    "order_date", "store_id", "product_name", "units_sold", "forecast_units", "model_type", "mape",
)


def time_series_folds(demand: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """Add ``position`` (1-based, in time order) and ``test_fold``.

    Fold f tests n // (folds + 1) rows and trains on everything before them; rows ahead of the
    first test block have a null fold. Positions come from per-day counts, not a global sort.
    """
    rows = demand.filter("units_sold > 0") if p.nonzero_only else demand
    n = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = daily_positions(rows, [], "order_date", list(SERIES), SERIES[0]).drop("prior_day")
    size = F.floor(n / F.lit(p.folds + 1))
    fold = F.floor(
        F.try_divide(F.col("position") - 1 - (n - size * F.lit(p.folds)), size)
    ) + F.lit(1)
    return placed.withColumn("_fold", fold).withColumn(
        "test_fold", F.when(F.col("_fold") >= 1, F.col("_fold").cast("int"))
    ).drop("_fold")


def fold_mape(scored: DataFrame, predictions: dict[str, Column]) -> DataFrame:
    """Per test fold: rows and mean absolute percentage error in percent of each prediction."""
    actual = F.col("units_sold")
    return (
        scored.filter("test_fold IS NOT NULL")
        .groupBy("test_fold")
        .agg(
            F.count(F.lit(1)).alias("test_rows"),
            *[
                (F.avg(percentage_error(actual, F.greatest(c, F.lit(0.0)))) * 100).alias(f"{name}_mape")
                for name, c in predictions.items()
            ],
        )
    )


def naive_prediction() -> Column:
    """Same weekday last week, of the same row."""
    return F.coalesce("lag_7d", F.lit(0)).cast("double")


def naive_baseline(folds: DataFrame) -> DataFrame:
    return fold_mape(folds, {"naive": naive_prediction()})


def forecast_accuracy(folds: DataFrame, prediction: Column) -> DataFrame:
    """One row: mean fold MAPE of the model and of the naive baseline, and the improvement in
    percent of the naive error."""
    per_fold = fold_mape(folds, {"model": prediction, "naive": naive_prediction()})
    mean = per_fold.agg(F.avg("model_mape").alias("mape"), F.avg("naive_mape").alias("naive_mape"))
    gain = F.try_divide(F.col("naive_mape") - F.col("mape"), F.col("naive_mape")) * 100
    return mean.select("mape", "naive_mape", gain.alias("improvement_pct"))


def as_forecast(rows: DataFrame, prediction: Column, model_type: str, mape: Column) -> DataFrame:
    """Forecast table: prediction clamped at 0 and rounded half to even."""
    return rows.withColumns(
        {
            "forecast_units": half_even_int(F.greatest(prediction, F.lit(0.0))),
            "model_type": F.lit(model_type),
            "mape": F.round(mape, 2),
        }
    ).select(*FORECAST_COLUMNS)


def naive_forecast(lagged: DataFrame, p: ForecastParams = ForecastParams()) -> DataFrame:
    """Forecast table of the seasonal-naive model."""
    error = naive_baseline(time_series_folds(lagged, p)).agg(F.avg("naive_mape").alias("m")).scalar()
    return as_forecast(lagged, naive_prediction(), "seasonal_naive", error)


def forecast_hit_rate(folds: DataFrame, prediction: Column, level: float = 0.8) -> DataFrame:
    """Mean absolute error, naive error, and the share of test rows inside the interval that
    the residuals ahead of the last fold span at ``level``."""
    rows = folds.withColumn("_p", prediction).withColumn("_r", F.col("units_sold") - F.col("_p"))
    last = F.col("test_fold") == folds.agg(F.max("test_fold").alias("m")).scalar()
    history = rows.filter(F.coalesce(~last, F.lit(True)))
    tail = (1.0 - level) / 2
    q = exact_quantiles(history, ["_r"], [tail, 1 - tail])
    ends = q.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("e")).scalar()
    tested = rows.filter(last).withColumn("_e", ends)
    hit = F.col("_r").between(F.col("_e.lo"), F.col("_e.hi")).cast("int")
    return tested.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.abs("_r")).alias("mae"),
        F.avg(F.abs(F.col("units_sold") - naive_prediction())).alias("naive_mae"),
        F.avg(hit).alias("hit_rate"),
    )


def residual_sketches(history: DataFrame, by: Sequence[str] = (), k: int = 200) -> DataFrame:
    """Per series (and ``by``, such as a day or month): ``n`` rows and a quantile sketch of ``_a``.

    Sketches of parts merge (``merged_sketches``), so a new part needs no look at the older ones; at
    k = 200 ranks are off by about 1.3 % of the rows at most.
    """
    return history.groupBy(*SERIES, *by).agg(
        F.count("_a").alias("n"), F.kll_sketch_agg_double("_a", k).alias("sketch")
    )


def merged_sketches(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*SERIES).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def conformal_rank(n: Column, level: float) -> Column:
    """The residual, by size, that the next one stays below with the chance ``level``."""
    return F.ceil((n + 1) * F.lit(level))


def sketched_bands(sketches: DataFrame, level: float, steps: int = 40) -> DataFrame:
    """(series, band) from sketches; series of too few rows have none.

    A sketch is asked for fixed ranks only: ``steps`` of them between ``level`` and 1, rounded up.
    """
    rank = conformal_rank(F.col("n"), level)
    asked = F.array(*[F.lit(level + (1.0 - level) * i / steps) for i in range(steps)], F.lit(1.0))
    at = F.ceil(F.round((rank / F.col("n") - F.lit(level)) / F.lit((1.0 - level) / steps), 9)).cast("int")
    return sketches.filter(rank <= F.col("n")).select(
        *SERIES, F.get(F.kll_sketch_get_quantile_double("sketch", asked), F.greatest(at, F.lit(0))).alias("band")
    )


def exact_bands(history: DataFrame, level: float) -> DataFrame:
    """(series, band), exact; a series has one row per day at most."""
    by_size = Window.partitionBy(*SERIES).orderBy("_a")
    ranked_rows = history.select(
        *SERIES, "_a", F.row_number().over(by_size).alias("_i"), F.count("_a").over(Window.partitionBy(*SERIES)).alias("_n")
    )
    return ranked_rows.filter(F.col("_i") == conformal_rank(F.col("_n"), level)).select(*SERIES, F.col("_a").alias("band"))


def interval_hit_rate(folds: DataFrame, prediction: Column, level: float = 0.8, sketched: bool = False) -> DataFrame:
    """Coverage of bands of each series' own, per tenth of the series by demand.

    (decile, test_rows, hit_rate, mean_band): the band around a prediction is the split-conformal rank of
    the series' absolute residuals ahead of the last fold; a series of too few rows has the band of all
    residuals. Series that first occur in the last fold have a null decile.
    """
    rows = folds.withColumn("_p", prediction).withColumn("_a", F.abs(F.col("units_sold") - F.col("_p")))
    last = F.col("test_fold") == folds.agg(F.max("test_fold").alias("m")).scalar()
    history = materialize(rows.filter(F.coalesce(~last, F.lit(True))).select(*SERIES, "units_sold", "_a"), "residuals")
    wide = exact_quantiles(history, ["_a"], [level]).agg(F.max("value").alias("v")).scalar()
    bands = sketched_bands(residual_sketches(history), level) if sketched else exact_bands(history, level)
    totals = history.groupBy(*SERIES).agg(F.sum("units_sold").alias("_units"))
    placed = ranked(totals, ["_units", *SERIES], "_place")
    size = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    deciles = placed.select(*SERIES, F.floor(F.col("_place") * 10 / size).cast("int").alias("decile"))
    tested = rows.filter(last).join(bands, list(SERIES), "left").join(deciles, list(SERIES), "left")
    tested = tested.withColumn("_band", F.coalesce("band", wide))
    return tested.groupBy("decile").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg((F.col("_a") <= F.col("_band")).cast("int")).alias("hit_rate"),
        F.avg("_band").alias("mean_band"),
    )


@dataclass(frozen=True)
class BoostedForecast:
    """The last fold's trees, the accuracy over the folds, the scored test rows, and all rows."""

    model: BoostedTrees
    accuracy: DataFrame
    scored: DataFrame
    rows: DataFrame


def boost_params(p: ForecastParams) -> BoostParams:
    return BoostParams(
        leaves=p.leaves, rounds=p.rounds, step=p.step, min_leaf_rows=p.min_leaf_rows, patience=p.patience, bins=p.bins
    )


def fit_boosted(features: DataFrame, p: ForecastParams = ForecastParams(), validation_share: float = 0.1) -> BoostedForecast:
    """Boosted trees per expanding fold; the newest tenth of a training block stops the rounds.

    All folds grow their trees in the same scans. The last fold's model is the one to score with.
    """
    used = [c for c in ("position", "test_fold", "lag_7d", *SERIES, "order_date", "units_sold") if c not in p.features]
    rows = materialize(time_series_folds(features, p).select(*used, *p.features), "forecast_rows")
    starts = {
        r["test_fold"]: r["start"]
        for r in rows.filter("test_fold IS NOT NULL").groupBy("test_fold").agg(F.min("position").alias("start")).collect()
    }  # one row per fold
    if not starts or min(starts.values()) < 2:
        raise ValueError("too few rows for the folds")
    folds = sorted(starts)
    runs = [Run(s - 1 - int((s - 1) * validation_share), s - 1) for s in (starts[f] for f in folds)]
    models = boost(rows, p.features, "units_sold", "position", runs, boost_params(p))
    tested = [
        rows.filter(F.col("test_fold") == f).select("test_fold", "units_sold", "lag_7d", m.predict().alias("prediction"))
        for f, m in zip(folds, models)
    ]
    scored = materialize(reduce(DataFrame.unionByName, tested), "scored_folds")
    return BoostedForecast(models[-1], forecast_accuracy(scored, F.col("prediction")), scored, rows)


def fold_report(fit: BoostedForecast) -> DataFrame:
    """Per test fold: rows, error of the model and of the naive baseline, improvement in percent."""
    folds = fold_mape(fit.scored, {"model": F.col("prediction"), "naive": naive_prediction()})
    gain = F.try_divide(F.col("naive_mape") - F.col("model_mape"), F.col("naive_mape")) * 100
    return folds.withColumn("improvement_pct", gain)


def boosted_forecast(features: DataFrame, fit: BoostedForecast, p: ForecastParams = ForecastParams()) -> DataFrame:
    """Every feature row scored by the last model (a backcast over the whole history)."""
    mape = fit.accuracy.select("mape").scalar()
    scored = features.withColumn("_prediction", fit.model.predict())
    return as_forecast(
        scored.withColumn("units_sold", F.col("units_sold").cast("long")), F.col("_prediction"), "boosted_trees", mape
    )


def feature_importance(fit: BoostedForecast, p: ForecastParams = ForecastParams()) -> DataFrame:
    """(feature, gain, mape_increase): share of the splits' gain and the rise in MAPE when the feature's
    values are exchanged between the test rows, all of them.

    Test rows are numbered in hash order; a feature's values move on by a shift of its own.
    """
    spark = fit.rows.sparkSession
    names = list(p.features)
    gains = spark.createDataFrame(
        list(zip(names, fit.model.gains())), "feature string, gain double"
    )
    tests = fit.rows.filter("test_fold IS NOT NULL").select(
        F.xxhash64("position", F.lit(p.seed)).alias("h"), "position", "units_sold",
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]).alias("x"),
    )
    rows = materialize(ranked(tests, ["h", "position"], "r").select("r", "units_sold", "x"), "importance_rows")
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    shift = mixed_hash(F.col("j"), p.seed) % F.greatest(size - 1, F.lit(1)) + 1
    # Only the one value that moves is shuffled to its new row.
    moved = rows.select("r", F.posexplode("x").alias("j", "other")).select(
        ((F.col("r") + shift) % size).alias("r"), "j", "other"
    )
    mixed = F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("other")).otherwise(v))
    plain = rows.select("units_sold", F.lit(-1).alias("j"), "x")
    exchanged = rows.join(moved, "r").select("units_sold", "j", mixed.alias("x"))
    scored = plain.unionByName(exchanged).withColumn(
        "prediction", fit.model.predict([F.col("x")[i] for i in range(len(names))])
    )
    errors = scored.groupBy("j").agg(
        (F.avg(percentage_error(F.col("units_sold"), F.greatest("prediction", F.lit(0.0)))) * 100).alias("m")
    )
    base = errors.agg(F.max(F.when(F.col("j") == -1, F.col("m"))).alias("b")).scalar()
    rise = errors.filter("j >= 0").select(
        F.get(F.array(*[F.lit(n) for n in names]), F.col("j")).alias("feature"),
        (F.col("m") - base).alias("mape_increase"),
    )
    return gains.join(rise, "feature").orderBy(F.desc("gain"), "feature")


def row_attributions(features: DataFrame, fit: BoostedForecast) -> DataFrame:
    """``features`` with ``contributions`` (one per model input) and ``expected``: they sum to the prediction."""
    size = len(fit.model.features)
    both = features.withColumn("_all", attributed(fit.model))
    return both.withColumn("contributions", F.slice("_all", 1, size)).withColumn("expected", F.col("_all")[size]).drop("_all")


def feature_attribution(fit: BoostedForecast) -> DataFrame:
    """(feature, mean_contribution): mean absolute contribution over all rows the folds are cut from."""
    names = fit.model.features
    rows = row_attributions(fit.rows, fit)
    wide = rows.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f"c{i}") for i in range(len(names))])
    cells = [F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("mean_contribution")) for i, n in enumerate(names)]
    return wide.select(F.inline(F.array(*cells))).orderBy(F.desc("mean_contribution"), "feature")
