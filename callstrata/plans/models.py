"""Volume and handling-time models: boosted trees, and a linear one as an MLlib pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder, StringIndexer, VarianceThresholdSelector, VectorAssembler,
)
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callstrata.operators.columns import require_columns
from callstrata.plans.boosting import BoostedModels, Growth, Loss, fit, load_boosted
from callstrata.plans.history import LAG_DAYS
from callstrata.schemas import FOLDED_SERVICE, SEGMENT
from callstrata.session import cut_lineage
from callstrata.sources.warehouse import load_model, save_model

CALENDAR = ["veckodag", "dag_pa_aret", "vecka_nr", "manad", "kvartal", "ar_arbetsdag"]
#: Calendar columns that are names and not numbers to the trees.
CATEGORIES = ["veckodag", "manad"]
VOLUME, HANDLING, LABEL = "Antal_Samtal", ("Snitt_Taltid", "Snitt_Vantetid"), "label"
#: Quantiles of the volume band, and the Tweedie loss's variance power (fixed values, as in the studied pipeline).
BAND, TWEEDIE_POWER = {"low": 0.10, "median": 0.50, "high": 0.90}, 1.5
#: The solver takes 4,096 inputs; each service is one, and calendar and lags take the rest.
MOST_SERVICES = 4_000


def _codes(columns: Sequence[str]) -> list[StringIndexer]:
    """Category codes learned once and stored with the model; unseen values get a code of
    their own instead of failing."""
    return [
        StringIndexer(inputCol=c, outputCol=f"{c}_code", handleInvalid="keep",
                      stringOrderType="alphabetAsc")
        for c in columns
    ]


def lag_columns(lags: Sequence[int] = LAG_DAYS) -> list[str]:
    return [f"Antal_Samtal_lag_{k}d" for k in lags]


def volume_inputs(given: Mapping[str, Column], lags: Sequence[int] = LAG_DAYS) -> dict[str, Column]:
    """Inputs of the linear volume model from calendar and lag columns.

    Lags are taken on a log scale to suit the log link; a lag before the start of the series
    falls back to last week and then to yesterday.
    """
    names = lag_columns(lags)
    recent = [given[n] for n in names[:2][::-1]]
    return {f"{n}_x": F.log1p(F.coalesce(given[n], *recent, F.lit(0)).cast("double")) for n in names} | {
        **{f"weekday_{k}_x": (given["veckodag"] == k).cast("double") for k in range(1, 7)},
        **{f"month_{k}_x": (given["manad"] == k).cast("double") for k in range(2, 13)},
    }


def volume_features(df: DataFrame, lags: Sequence[int] = LAG_DAYS) -> DataFrame:
    """Inputs of the linear volume model; an absent column is an error, never a silent 0."""
    wanted = [FOLDED_SERVICE, *CALENDAR, *lag_columns(lags)]
    require_columns(df, wanted)
    return df.withColumns(volume_inputs({c: F.col(c) for c in wanted}, lags))


def _tweedie_pipeline(lags: Sequence[int], penalty: float = 1e-5) -> Pipeline:
    """Weekday and month enter as switches with one left out, and of the other calendar columns
    only those that do not follow from them; otherwise the fit would be singular. The slight
    penalty settles what is left: service switches add up to the intercept, and closed days,
    which never have calls, would push their switch without end."""
    switches = [*[f"weekday_{k}_x" for k in range(1, 7)], *[f"month_{k}_x" for k in range(2, 13)]]
    numeric = ["ar_arbetsdag", *[f"{n}_x" for n in lag_columns(lags)]]
    return Pipeline(stages=[
        *_codes([FOLDED_SERVICE]),
        OneHotEncoder(inputCols=[f"{FOLDED_SERVICE}_code"], outputCols=[f"{FOLDED_SERVICE}_hot"]),
        VectorAssembler(
            inputCols=[f"{FOLDED_SERVICE}_hot", *switches, *numeric], outputCol="all"
        ),
        # Months the history does not reach are all 0 and have to go.
        VarianceThresholdSelector(featuresCol="all", outputCol="features"),
        GeneralizedLinearRegression(
            labelCol=LABEL, family="tweedie", variancePower=TWEEDIE_POWER, linkPower=0.0,
            regParam=penalty, maxIter=25,
        ),
    ])


def _volume_columns(lags: Sequence[int]) -> tuple[list[str], list[str]]:
    """(numeric, category) inputs of the boosted volume models, those of the studied pipeline."""
    return [*[c for c in CALENDAR if c not in CATEGORIES], *lag_columns(lags)], [FOLDED_SERVICE, *CATEGORIES]


def train_volume(
    training: DataFrame, lags: Sequence[int] = LAG_DAYS, learner: str = "boosted", growth: Growth = Growth(),
) -> BoostedModels | PipelineModel:
    """The operative volume model: boosted trees with Tweedie loss, or a Tweedie regression ("linear")."""
    if learner == "linear":
        data = volume_features(training, lags).withColumn(LABEL, F.col(VOLUME).cast("double"))
        services = data.agg(F.count_distinct(FOLDED_SERVICE).alias("n")).first()["n"]
        if services > MOST_SERVICES:
            raise ValueError(f"{services} services; the linear model takes at most {MOST_SERVICES}, boosted trees any number")
        return _tweedie_pipeline(lags).fit(data)
    if learner != "boosted":
        raise ValueError(f"unknown learner {learner}")
    return fit(training, VOLUME, *_volume_columns(lags), {"operative": Loss("tweedie", power=TWEEDIE_POWER)}, growth)


def linear_column(model: PipelineModel, given: Mapping[str, Column], lags: Sequence[int] = LAG_DAYS) -> Column:
    """The linear model's prediction as one column: the exponential of a weighted sum.

    The weight of a service is looked up by name, 0 for one never seen.
    """
    indexer, assembler, selector, line = model.stages[0], model.stages[2], model.stages[3], model.stages[4]
    services = indexer.labels
    inputs = volume_inputs(given, lags) | {c: given[c] for c in CALENDAR}
    wide = [*[None] * len(services), *assembler.getInputCols()[1:]]
    weights = dict(zip(selector.selectedFeatures, line.coefficients.toArray().tolist(), strict=True))
    own = F.map_from_arrays(F.lit(services), F.lit([weights.get(i, 0.0) for i in range(len(services))]))
    total = F.lit(float(line.intercept)) + F.coalesce(F.try_element_at(own, given[FOLDED_SERVICE]), F.lit(0.0))
    for i, weight in sorted(weights.items()):
        if wide[i] is not None:
            total = total + F.lit(weight) * inputs[wide[i]].cast("double")
    return F.exp(total)


def predict_volume(
    model: BoostedModels | PipelineModel, features: DataFrame, lags: Sequence[int] = LAG_DAYS
) -> DataFrame:
    """features with `prediction`."""
    if isinstance(model, BoostedModels):
        return model.with_scores(features, prediction="operative")
    return model.transform(volume_features(features, lags))


def save_volume(model: BoostedModels | PipelineModel, path: str) -> None:
    if isinstance(model, BoostedModels):
        model.save(path)
    else:
        save_model(model, path)


def load_volume(spark: SparkSession, path: str) -> BoostedModels | PipelineModel | None:
    return load_boosted(spark, path) or load_model(spark, path)


@dataclass(frozen=True)
class VolumeBand:
    """Quantile models; per service the residual quantiles of a held-out period, and by how much the band has to
    be widened for eight in ten of that period's days to lie in it."""

    models: BoostedModels
    residuals: DataFrame

    def predict(self, features: DataFrame) -> DataFrame:
        """``low``, ``median`` and ``high`` for every row, none below zero and none crossing another."""
        raw = self.models.predict(features, **{f"_{name}": name for name in BAND})
        # One row per service on both ends of the join; sized by AQE.
        joined = raw.join(self.residuals.select(FOLDED_SERVICE, "widen"), FOLDED_SERVICE, "left")
        widen = F.coalesce("widen", F.lit(0.0))
        bounds = {"low": F.col("_low") - widen, "median": F.col("_median"), "high": F.col("_high") + widen}
        ordered = F.array_sort(F.array(*[F.greatest(x, F.lit(0.0)) for x in bounds.values()]))
        return joined.withColumn("_band", ordered).withColumns(
            {name: F.get("_band", F.lit(i)) for i, name in enumerate(BAND)}).drop("_band", "widen", *[f"_{name}" for name in BAND])


def train_volume_band(
    training: DataFrame, lags: Sequence[int] = LAG_DAYS, holdout_days: int = 28, growth: Growth = Growth(),
) -> VolumeBand:
    """Quantile trees for 0.10, 0.50 and 0.90, and how they err in the last weeks.

    Trees grown this deep follow their training days too closely, so the band is widened (or narrowed) per
    service by what models that have not seen the held-out days (``early_``) need there. The models returned
    are fitted on all days. What is kept per service is bounded by the held-out days.
    """
    cut = F.date_sub(training.agg(F.max("ds")).scalar(), holdout_days)
    data = cut_lineage(training.withColumn("_early", F.when(F.col("ds") <= cut, F.col(VOLUME))).withColumn(
        "_late", F.col("ds") > cut))
    losses = {name: Loss("quantile", alpha) for name, alpha in BAND.items()} | {
        f"early_{name}": Loss("quantile", alpha) for name, alpha in BAND.items()}
    models = fit(data, {m: "_early" if m.startswith("early") else VOLUME for m in losses}, *_volume_columns(lags), losses, growth)
    held_out = models.predict(data.where("_late"), low="early_low", median="early_median", high="early_high")
    low, _, high = BAND.values()
    outside = F.greatest(F.col("low") - F.col(VOLUME), F.col(VOLUME) - F.col("high"))
    residuals = residual_quantiles(held_out, F.col(VOLUME) - F.col("median"), low, high)
    widths = held_out.groupBy(FOLDED_SERVICE).agg(F.percentile(outside, F.lit(high - low)).alias("widen"))
    return VolumeBand(models, cut_lineage(residuals.join(widths, FOLDED_SERVICE)))


def residual_quantiles(scored: DataFrame, error: Column, low: float = 0.10, high: float = 0.90) -> DataFrame:
    """Per service two quantiles of the errors of a held-out period, whose days bound them."""
    return scored.groupBy(FOLDED_SERVICE).agg(
        F.percentile(error, F.lit(low)).alias("residual_low"),
        F.percentile(error, F.lit(high)).alias("residual_high"),
    )


def train_handling(training: DataFrame, growth: Growth = Growth()) -> BoostedModels:
    """Mean talk time (``Snitt_Taltid``) and wait time (``Snitt_Vantetid``) per segment and day, squared loss."""
    return fit(training, {t: t for t in HANDLING}, [c for c in CALENDAR if c not in CATEGORIES], [SEGMENT, *CATEGORIES],
               {t: Loss("squared") for t in HANDLING}, growth)
