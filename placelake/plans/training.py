"""Train, evaluate and save the price model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelake.operators.aggregates import regression_metrics
from placelake.operators.price_model import REG_PARAM, PriceModel, coefficient_table, fit_price_model, predict, save_model
from placelake.operators.sampling import SEED, TRAIN_SHARE, in_training
from placelake.plans import names


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model with its metrics on the "train" and "test" part and its coefficients."""

    model: PriceModel
    metrics: DataFrame
    coefficients: DataFrame


def train_price_model(rows: DataFrame, key: str, category: str = names.NEIGHBORHOOD, label: str = "price",
                      reg: float = REG_PARAM, share: float = TRAIN_SHARE, seed: int = SEED,
                      path: str | None = None, overwrite: bool = False) -> TrainedModel:
    """Fit on the training share of the rows and save the model if ``path`` is given.

    Both parts are measured by one scan, when ``metrics`` is used.
    """
    training = in_training(key, share, seed)
    parts = rows.select(category, label, F.when(training, "train").otherwise("test").alias("part"))
    model = fit_price_model(rows.where(training), category, label, reg)
    if path is not None:
        save_model(model, path, overwrite)
    metrics = regression_metrics(predict(model, parts), label, by=["part"])
    return TrainedModel(model, metrics, coefficient_table(model))
