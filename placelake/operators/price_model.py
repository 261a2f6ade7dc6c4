"""A price regression on one category: in closed form over aggregates, or as a Spark ML pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placelake.operators.joins import bounded_join
from placelake.settings import stored

# Settings of the regression.
MAX_ITER = 10
REG_PARAM = 0.1

_CATEGORY = "__category"
_ENTRY_BYTES = 32
_SETTINGS = "category string, intercept double, keeps boolean, n_bytes long"


def category_indexer(column: str, alias: str | None = None, invalid: str = "skip") -> StringIndexer:
    """Indexer by falling frequency; "skip" drops null and unseen categories, "keep" pools them."""
    return StringIndexer(inputCol=column, outputCol=alias or f"{column}_index", handleInvalid=invalid)


def category_index(df: DataFrame, column: str, alias: str | None = None, invalid: str = "skip") -> DataFrame:
    """Add the index of each row's category; equally frequent categories rank by name.

    As ``category_indexer`` does, but by a join with :func:`category_ranks`, so that no machine holds all categories. Null is
    left out ("skip"), pooled under the next index ("keep"), or refused ("error").
    """
    if invalid not in ("skip", "keep", "error"):
        raise ValueError(f"invalid is 'skip', 'keep' or 'error', not {invalid!r}")
    ranks = category_ranks(df, column)
    return index_by_ranks(df, ranks, column, alias, invalid)


def category_ranks(df: DataFrame, column: str) -> DataFrame:
    """The categories (as text) with their ranks by falling frequency, then name: (category, rank).

    Ranges of (count, name) are sorted apart from each other; a rank is a place in a range plus the sizes of the ranges before.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("category")]
    ranged = counts.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    placed = stored(ranged, "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range, however many categories there are.
    offsets = placed.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    return placed.withColumn("place", place).join(F.broadcast(offsets), "range").select("category", (F.col("offset") + F.col("place")).alias("rank"))


def index_by_ranks(df: DataFrame, ranks: DataFrame, column: str, alias: str | None = None, invalid: str = "skip") -> DataFrame:
    """Add the index of each row's category by a table of ranks; null and unseen categories are skipped, kept or refused."""
    name = alias or f"{column}_index"
    table = stored(ranks.select(F.col("category").alias(_CATEGORY), F.col("rank").cast("double").alias(name)), "ranks")
    joined = bounded_join(df.withColumn(_CATEGORY, F.col(column).cast("string")), table, [_CATEGORY], "inner" if invalid == "skip" else "left").drop(_CATEGORY)
    if invalid == "skip":
        return joined
    if invalid == "keep":
        return joined.withColumn(name, F.coalesce(name, F.lit(float(table.count()))))
    unknown = F.raise_error(F.concat(F.lit(f"{column} has an unknown category: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
    return joined.withColumn(name, F.coalesce(F.col(name), unknown.cast("double")))


def price_pipeline(category: str, label: str = "price", reg: float = REG_PARAM, invalid: str = "skip") -> Pipeline:
    """Category index, one-hot vector without its last level, and a linear regression."""
    index, vector = f"{category}_index", f"{category}_vector"
    return Pipeline(
        stages=[
            category_indexer(category, index, invalid),
            OneHotEncoder(inputCol=index, outputCol=vector),
            LinearRegression(featuresCol=vector, labelCol=label, maxIter=MAX_ITER, regParam=reg),
        ]
    )


@dataclass(frozen=True)
class PriceModel:
    """One coefficient per category, as a table (category, coefficient), and the intercept.

    ``keeps`` says that null and unseen categories are predicted, by the intercept; else their rows are left
    out. ``n_bytes`` is the table's size, by which a prediction chooses its join.
    """

    category: str
    coefficients: DataFrame
    intercept: float
    keeps: bool
    n_bytes: int


def fit_price_model(rows: DataFrame, category: str, label: str = "price", reg: float = REG_PARAM,
                    invalid: str = "skip") -> PriceModel:
    """The regression that ``price_pipeline`` fits, in closed form, for any number of categories.

    With one category per row a coefficient is the distance of its mean from the intercept, shrunk by the
    penalty and the category's share of the rows; the rarest category (or the missing one, if kept)
    is the baseline at 0. So one aggregate over the rows gives counts and means, and the rest are
    aggregates over those groups. Rows without a label are left out. The groups are persisted, as long as the
    model's table is in use.
    """
    if invalid not in ("skip", "keep"):
        raise ValueError(f"invalid is 'skip' or 'keep', not {invalid!r}")
    keeps = invalid == "keep"
    known = rows.where(F.col(label).isNotNull())
    groups = (
        (known if keeps else known.where(F.col(category).isNotNull()))
        .groupBy(F.col(category).cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), F.var_pop(label).alias("spread"))
        .persist()
    )
    total = groups.agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.count("category").alias("categories"), F.min("n").alias("least"),
        F.coalesce(F.sum(F.octet_length("category") + _ENTRY_BYTES), F.lit(0)).alias("n_bytes"),
    ).first()
    if total.categories + keeps < 2:
        groups.unpersist()
        raise ValueError(f"{category} needs two distinct values at least")
    center = F.lit(total["mean"])
    variance = groups.agg((F.sum(F.col("n") * (F.col("spread") + F.pow(F.col("mean") - center, 2))) / total.n).alias("v")).first().v
    baseline = None if keeps else groups.where(F.col("n") == total.least).agg(F.max("category").alias("c")).first().c
    is_base = F.col("category").isNull() if keeps else F.col("category") == F.lit(baseline)
    weight = reg / variance ** 0.5 if variance > 0 else None  # labels that are all equal leave no effect
    kept = F.lit(0.0) if weight is None else F.when(is_base, 0.0).otherwise(1 / (1 + weight * (1 - F.col("n") / total.n)))
    shrunk = groups.withColumn("kept", kept)
    free = F.col("n") * (1 - F.col("kept"))
    base = shrunk.agg(F.try_divide(F.sum(free * F.col("mean")), F.sum(free)).alias("b")).first().b
    intercept = float(total["mean"] if base is None else base)
    table = shrunk.where(F.col("category").isNotNull()).select("category", (F.col("kept") * (F.col("mean") - intercept)).alias("coefficient"))
    return PriceModel(category, table, intercept, keeps, int(total.n_bytes))


def predict(model: PriceModel, df: DataFrame) -> DataFrame:
    """Add the prediction to the rows, batch or streaming, by a join with the coefficients."""
    table = model.coefficients.select(
        F.col("category").alias(_CATEGORY), (F.col("coefficient") + model.intercept).alias("prediction")
    )
    keyed = df.withColumn(_CATEGORY, F.col(model.category).cast("string"))
    joined = bounded_join(keyed, table, [_CATEGORY], "left" if model.keeps else "inner", side_bytes=model.n_bytes).drop(_CATEGORY)
    return joined.fillna(model.intercept, "prediction") if model.keeps else joined


def coefficient_table(model: PriceModel) -> DataFrame:
    """One row per category with its coefficient and the intercept; the baseline has 0.

    Where missing categories are kept, they are the baseline and have no row.
    """
    return model.coefficients.withColumn("intercept", F.lit(model.intercept))


def save_model(model: PriceModel, path: str, overwrite: bool = False) -> None:
    """Save a fitted model as two tables; an existing one is only replaced on request."""
    mode = "overwrite" if overwrite else "error"
    settings = [(model.category, model.intercept, model.keeps, model.n_bytes)]
    model.coefficients.write.mode(mode).parquet(f"{path}/coefficients")
    frame = model.coefficients.sparkSession.createDataFrame(settings, _SETTINGS)
    frame.coalesce(1).write.mode(mode).parquet(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> PriceModel:
    settings = spark.read.schema(_SETTINGS).parquet(f"{path}/settings").first()
    table = spark.read.schema("category string, coefficient double").parquet(f"{path}/coefficients")
    return PriceModel(settings.category, table, settings.intercept, settings.keeps, settings.n_bytes)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the prediction of a fitted ``price_pipeline`` and the columns it was made from."""
    return model.transform(df)
