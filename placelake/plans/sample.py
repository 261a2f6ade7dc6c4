"""Listings, income and commerce tables derived from the sample star schema.

A nation stands for a neighborhood and a region for a district; orders are listings,
suppliers income rows and customers commerces. Some neighborhoods are made unknown or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelake.plans.formatting import format_commercial, format_income, format_listings


# Columns of the sample tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_extendedprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a table as a stream; the glob lets a table be one file or a folder."""
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parque[t]")


def _with_place(rows: DataFrame, nation_key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows joined with one table after the other, so that each join sees the size of the table itself."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return rows.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(
        F.col("r_name").alias("district"),
        F.col("n_name").alias("neighborhood"),
        F.col("r_regionkey").alias("district_id"),
        F.upper("r_name").alias("district_n_reconciled"),
        F.col("n_nationkey").alias("neighborhood_id"),
        F.upper("n_name").alias("neighborhood_n_reconciled"),
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    owned = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _with_place(owned, "c_nationkey", spark, sf_dir).select(
        F.col("o_orderkey").alias("listing_id"),
        F.col("r_name").alias("district"),
        _neighborhood("o_orderkey").alias("neighborhood"),
        F.col("o_totalprice").alias("price"),
        F.struct(F.col("o_orderstatus").alias("typology"), F.col("o_orderpriority").alias("subTypology")).alias("detailedType"),
        F.array("r_name", "o_orderpriority").alias("suggestedTexts"),
    )


def raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_place(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir).select(
        F.col("s_suppkey").alias("income_id"),
        F.col("r_name").alias("Nom_Districte"),
        _neighborhood("s_suppkey").alias("Nom_Barri"),
        F.col("s_acctbal").alias("index_rfid"),
    )


def raw_commercial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_place(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir).select(
        F.col("c_custkey").alias("commerce_id"),
        F.col("r_name").alias("Nom_Districte"),
        _neighborhood("c_custkey").alias("Nom_Barri"),
        F.length("c_mktsegment").cast("int").alias("Codi_Grup_Activitat"),
        F.col("c_mktsegment").alias("Nom_Grup_Activitat"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_listings(raw_listings(spark, sf_dir), lookup(spark, sf_dir))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_income(raw_income(spark, sf_dir), lookup(spark, sf_dir))


def commercial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_commercial(raw_commercial(spark, sf_dir), lookup(spark, sf_dir))


def _neighborhood(key: str) -> Column:
    return F.when(F.col(key) % 17 == 0, "UNKNOWN").when(F.col(key) % 23 != 0, F.col("n_name"))


# The same tables in standard SQL, for comparison with another engine.
SAMPLE_SQL = """
WITH lookup AS (
  SELECT r_name AS district, n_name AS neighborhood, r_regionkey AS district_id,
         upper(r_name) AS district_n_reconciled, n_nationkey AS neighborhood_id,
         upper(n_name) AS neighborhood_n_reconciled
  FROM nation JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT o_orderkey AS listing_id, r_name AS district,
         CASE WHEN o_orderkey % 17 = 0 THEN 'UNKNOWN' WHEN o_orderkey % 23 = 0 THEN NULL ELSE n_name END AS neighborhood,
         o_totalprice AS price,
         '{"typology":"' || o_orderstatus || '","subTypology":"' || o_orderpriority || '"}' AS "detailedType",
         '["' || r_name || '","' || o_orderpriority || '"]' AS "suggestedTexts"
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_income AS (
  SELECT s_suppkey AS income_id, r_name AS "Nom_Districte",
         CASE WHEN s_suppkey % 17 = 0 THEN 'UNKNOWN' WHEN s_suppkey % 23 = 0 THEN NULL ELSE n_name END AS "Nom_Barri",
         s_acctbal AS index_rfid
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
raw_commercial AS (
  SELECT c_custkey AS commerce_id, r_name AS "Nom_Districte",
         CASE WHEN c_custkey % 17 = 0 THEN 'UNKNOWN' WHEN c_custkey % 23 = 0 THEN NULL ELSE n_name END AS "Nom_Barri",
         CAST(length(c_mktsegment) AS INT) AS "Codi_Grup_Activitat", c_mktsegment AS "Nom_Grup_Activitat"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
listing AS (SELECT * FROM raw LEFT JOIN lookup USING (district, neighborhood)),
income AS (
  SELECT * FROM raw_income LEFT JOIN lookup ON "Nom_Districte" = district AND "Nom_Barri" = neighborhood),
commercial AS (
  SELECT * FROM raw_commercial LEFT JOIN lookup ON "Nom_Districte" = district AND "Nom_Barri" = neighborhood)
"""
