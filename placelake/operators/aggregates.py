"""Grouped counts and averages, arranged so that joins only see pre-aggregated sides."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str, carry: Iterable[str], alias: str = "count_list",
                  weight: str | None = None) -> DataFrame:
    """Rows per non-null key with one carried value of each other column, the smallest.

    Rows are first counted by key and carried values, which hashes; the smallest text per key
    needs a sort, and then sorts those few groups instead of all rows. ``weight`` names a
    column that says how many rows each row stands for.
    """
    carry = list(carry)
    groups = _keyed(df, key).groupBy(key, *carry).agg(_row_count(weight).alias("__n"))
    return groups.groupBy(key).agg(*[F.min(c).alias(c) for c in carry], F.sum("__n").alias(alias))


def average(column: str, decimals: int | None = None) -> Column:
    """The average of a column; with ``decimals`` in exact arithmetic, so that it depends on no order of rows.

    The values are then whole multiples of 10 ** -decimals. They are summed as integers, and divided once.
    """
    if decimals is None:
        return F.avg(column)
    units = F.sum(F.round(F.col(column) * 10**decimals).cast("decimal(28,0)"))
    return F.try_divide(units.cast("double"), (F.count(column) * 10**decimals).cast("double"))


def fanout_avg(facts: DataFrame, measures: DataFrame, key: str, dims: Iterable[str], fact_column: str,
               measure_column: str, fact_alias: str, measure_alias: str, decimals: int | None = None) -> DataFrame:
    """Two averages by key and dimensions over the many-to-many join of facts and measures.

    Within a key every fact meets every measure, which leaves both averages as they are on
    their own side. So each side is averaged first and the join is one row per group. ``decimals``
    makes the averages exact, see ``average``.
    """
    dims = list(dims)
    left = _keyed(facts, key).groupBy(key, *dims).agg(average(fact_column, decimals).alias(fact_alias))
    right = _keyed(measures, key).groupBy(key).agg(average(measure_column, decimals).alias(measure_alias))
    return left.join(right, key).select(measure_alias, fact_alias, key, *dims)


def fanout_count(facts: DataFrame, others: DataFrame, key: str, dims: Iterable[str], categories: Iterable[str],
                 alias: str, mode: str = "compat", weight: str | None = None) -> DataFrame:
    """Rows of the many-to-many join of facts and others by key, dimensions and categories.

    "compat" counts joined rows, facts times others; "distinct_facts" counts the others only.
    Both sides are counted before the join, so no pair of rows is ever formed. ``weight``
    names a column of the facts that says how many facts a row stands for.
    """
    if mode not in ("compat", "distinct_facts"):
        raise ValueError(f"mode is 'compat' or 'distinct_facts', not {mode!r}")
    dims, categories = list(dims), list(categories)
    left = _keyed(facts, key).groupBy(key, *dims).agg(_row_count(weight).alias("__n_facts"))
    right = _keyed(others, key).groupBy(key, *categories).agg(F.count(F.lit(1)).alias("__n_others"))
    n = F.col("__n_others") if mode == "distinct_facts" else F.col("__n_facts") * F.col("__n_others")
    return left.join(right, key).select(key, *categories, n.alias(alias), *dims)


def summarize(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Count, mean, stddev, min and max of the columns, one row per statistic, as text."""
    return df.describe(*columns)


def regression_metrics(df: DataFrame, label: str = "price", prediction: str = "prediction",
                       by: Iterable[str] = ()) -> DataFrame:
    """Row count, RMSE, r2 and MAE of the predictions, per group of ``by``, from a single pass.

    Rows without a label or prediction do not count; labels that are all equal have no r2.
    """
    by = list(by)
    y, e = F.col("y"), F.col("e")
    label_value = F.col(label).cast("double")
    errors = df.select(*by, label_value.alias("y"), (label_value - F.col(prediction)).alias("e"))
    return errors.where(y.isNotNull() & e.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
    )


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def _row_count(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)
