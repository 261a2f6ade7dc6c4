"""The four result tables over formatted listings, income and commerce tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.functions.ddl import STRING_TYPES
from placelake.operators.aggregates import average, count_per_key, fanout_avg, fanout_count
from placelake.operators.joins import attach_averages, attach_group_avg, group_averages
from placelake.plans import names
from placelake.sources.snapshots import SnapshotTables
from placelake.sources.tables import JdbcTables, Tables, read_table, write_table

KEY, PLACE_NAMES = names.NEIGHBORHOOD, names.PLACE_NAMES
_WEIGHT = "n_listings"


def listings_per_neighborhood(listings: DataFrame, weight: str | None = None) -> DataFrame:
    carry = ["district_id", "district_n_reconciled", "neighborhood_n_reconciled"]
    return count_per_key(listings, KEY, carry, "count_list", weight)


def avg_price_index(listings: DataFrame, income: DataFrame, decimals: int | None = None) -> DataFrame:
    """``decimals`` here and below: how many decimals prices and indices have; their averages are then exact."""
    return fanout_avg(listings, income, KEY, PLACE_NAMES, "price", "index_rfid", "avg_price", "avg_index", decimals)


def price_vs_index(listings: DataFrame, income: DataFrame, decimals: int | None = None) -> DataFrame:
    rows = attach_group_avg(listings.select("price", KEY, *PLACE_NAMES), income, KEY, "index_rfid", "avg_index", decimals=decimals)
    return rows.select("avg_index", "price", KEY, *PLACE_NAMES)


def commerce_categories(listings: DataFrame, commercial: DataFrame, mode: str = "compat",
                        weight: str | None = None) -> DataFrame:
    return fanout_count(listings, commercial, KEY, PLACE_NAMES, names.CATEGORIES, "n_commerces", mode, weight)


def listing_groups(listings: DataFrame, decimals: int | None = None) -> DataFrame:
    """Listing count and average price by place: all that three of the four tables need."""
    return listings.groupBy(KEY, *PLACE_NAMES).agg(F.count(F.lit(1)).alias(_WEIGHT), average("price", decimals).alias("avg_price"))


def exploit_tables(spark: SparkSession, formatted: Tables, results: Tables | SnapshotTables,
                   partition_columns: Mapping[str, str | None] | None = None,
                   schemas: Mapping[str, T.StructType] | None = None, decimals: int | None = None) -> None:
    """``run_exploitation`` over the formatted tables.

    ``partition_columns`` names by table the key that splits reads from a database. A database table without an
    entry is refused; None as its entry asks for one task. ``schemas`` gives the columns of
    parquet tables, which saves reading all their footers.
    """
    inputs = (names.LISTINGS_TABLE, names.INCOME_TABLE, names.COMMERCIAL_TABLE)
    columns = dict(partition_columns or {})
    if isinstance(formatted, JdbcTables) and (missing := [name for name in inputs if name not in columns]):
        raise ValueError(f"name a partition column, or None for one task, for {', '.join(missing)}")
    listings, income, commercial = (
        read_table(spark, formatted, name, columns.get(name), schema=(schemas or {}).get(name)) for name in inputs
    )
    run_exploitation(listings, income, commercial, results, decimals)


def run_exploitation(listings: DataFrame, income: DataFrame, commercial: DataFrame, tables: Tables | SnapshotTables,
                     decimals: int | None = None) -> None:
    """Overwrite the four result tables; in :class:`SnapshotTables` all at once, in others one after another.

    The listings are scanned twice, once in groups and once in rows, the other tables once: a group's
    average stands in for its rows wherever an average is taken. Groups and averages are held for the
    run only.
    """
    groups = listing_groups(listings, decimals).persist()
    averages = group_averages(income, KEY, "index_rfid", "avg_index", decimals)
    prices = attach_averages(listings.select("price", KEY, *PLACE_NAMES), averages, KEY, "avg_index")
    by_place = groups.where(F.col(KEY).isNotNull()).join(averages, KEY)
    results = {
        names.COUNT_TABLE: listings_per_neighborhood(groups, _WEIGHT),
        names.AVERAGES_TABLE: by_place.select("avg_index", "avg_price", KEY, *PLACE_NAMES),
        names.PRICES_TABLE: prices.select("avg_index", "price", KEY, *PLACE_NAMES),
        names.CATEGORIES_TABLE: commerce_categories(groups, commercial, weight=_WEIGHT),
    }
    try:
        if isinstance(tables, SnapshotTables):
            tables.commit(results)
        else:
            for table, df in results.items():
                write_table(df, tables, table, "overwrite", type_map=STRING_TYPES)
    finally:
        groups.unpersist()
        averages.unpersist()
