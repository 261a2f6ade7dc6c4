"""Queries over the sample tables, one or more per operator, with the same result in standard SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.functions.columns import (
    INPUT_FILE,
    PROCESS_TIME,
    bad_rows,
    nested_to_json,
    normalize_columns,
    split_message,
    with_error,
    with_lineage,
)
from placelake.operators.aggregates import fanout_avg, fanout_count, regression_metrics, summarize
from placelake.operators.joins import pending_files, reconcile
from placelake.operators.price_model import (
    REG_PARAM,
    PriceModel,
    category_index,
    coefficient_table,
    fit_price_model,
    load_model,
    predict,
    price_pipeline,
    score,
)
from placelake.operators.sampling import TRAIN_SHARE, in_training, preview, random_split, train_test_split
from placelake.plans import exploitation, names, sample
from placelake.plans.formatting import format_listings, format_load, format_sources, format_stream
from placelake.plans.training import train_price_model
from placelake.settings import scratch_path, stored
from placelake.sources.compaction import compact
from placelake.sources.files import read_landing, read_lookup
from placelake.sources.ledger import append_ledger, fold_ledger, unlogged
from placelake.sources.registry import Source, read_registry
from placelake.sources.snapshots import SnapshotTables
from placelake.sources.tables import ParquetTables, read_table, write_table
from placelake.streaming import jobs
from placelake.streaming.messages import read_messages
from placelake.streaming.sinks import run_available, stream_to_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

PLACE = ["district_id", "district_n_reconciled", "neighborhood_id", "neighborhood_n_reconciled"]
PLACE_SQL = ", ".join(PLACE)

# The training share of the orders, written for another engine: 70% of the digests of seed and key.
TRAINING_SQL = "substr(md5('24:' || CAST({key} AS VARCHAR)), 1, 8) < 'b3333333'"

# Timestamps of the sample tables have no zone.
EVENT_MESSAGE = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("neighborhood_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
    ]
)
COUNTED_MESSAGE = T.StructType([*EVENT_MESSAGE.fields[:2], T.StructField("price", T.LongType())])
ORDER_MESSAGE = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)


def _exact_avg(column: str) -> str:
    """Cents summed as integers and divided once: the same number whatever the order of rows."""
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS DOUBLE) / CAST(count({column}) * 100 AS DOUBLE)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if it has one."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run

    return register


# Formatting


_LISTINGS_SQL = f"""{sample.SAMPLE_SQL}
SELECT listing_id, district, neighborhood, price, "detailedType", "suggestedTexts", {PLACE_SQL} FROM listing"""


@query("format_listings", _LISTINGS_SQL)
def format_listings_places(spark, sf_dir):
    return sample.listings(spark, sf_dir)


@query("format_income", f"""{sample.SAMPLE_SQL}
SELECT income_id, "Nom_Districte", "Nom_Barri", index_rfid, district, neighborhood, {PLACE_SQL} FROM income""")
def format_income(spark, sf_dir):
    return sample.income(spark, sf_dir)


@query("format_commercial", f"""{sample.SAMPLE_SQL}
SELECT commerce_id, "Nom_Districte", "Nom_Barri", "Codi_Grup_Activitat", "Nom_Grup_Activitat", district, neighborhood, {PLACE_SQL}
FROM commercial""")
def format_commercial(spark, sf_dir):
    return sample.commercial(spark, sf_dir)


@query("reconcile_expand", f"{sample.SAMPLE_SQL} SELECT income_id, index_rfid, l.neighborhood, l.neighborhood_id "
       "FROM raw_income LEFT JOIN lookup l ON \"Nom_Districte\" = l.district")
def reconcile_expand(spark, sf_dir):
    rows = reconcile(sample.raw_income(spark, sf_dir), sample.lookup(spark, sf_dir), {"Nom_Districte": "district"})
    return rows.select("income_id", "index_rfid", "neighborhood", "neighborhood_id")


@query("reconcile_first", f"{sample.SAMPLE_SQL} SELECT income_id, index_rfid, l.neighborhood, l.neighborhood_id FROM raw_income LEFT JOIN "
       "(SELECT *, row_number() OVER (PARTITION BY district ORDER BY neighborhood) AS rn FROM lookup) l "
       "ON \"Nom_Districte\" = l.district AND l.rn = 1")
def reconcile_first(spark, sf_dir):
    lookup = sample.lookup(spark, sf_dir)
    rows = reconcile(sample.raw_income(spark, sf_dir), lookup, {"Nom_Districte": "district"}, on_duplicate="first")
    return rows.select("income_id", "index_rfid", "neighborhood", "neighborhood_id")


@query("nested_to_json", """
SELECT event_id, '{"user":' || CAST(user_id AS VARCHAR) || ',"kind":"' || event_type || '"}' AS as_struct,
       '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]' AS as_array,
       '{"' || event_type || '":' || CAST(event_id AS VARCHAR) || '}' AS as_map
FROM events""")
def nested_columns_to_json(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events")
    return nested_to_json(
        events.select(
            "event_id",
            F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("kind")).alias("as_struct"),
            F.array("event_type", F.col("user_id").cast("string")).alias("as_array"),
            F.create_map("event_type", "event_id").alias("as_map"),
        )
    )


@query("normalize_columns", """
SELECT s_suppkey AS "Codi", s_name AS "Poblacio_Propria_ç", s_nationkey AS "INDEX", s_acctbal AS index_rfid FROM supplier""")
def normalized_columns(spark, sf_dir):
    suppliers = sample.table(spark, sf_dir, "supplier")
    accented = suppliers.toDF("Códi", "Població_Própria_ç", "ÍNDEX", "Índex_Renda")
    return normalize_columns(accented, last="index_rfid")


@query("with_lineage", "SELECT count(*) AS n_rows, true AS one_time, count(*) AS n_with_file FROM orders")
def lineage_columns(spark, sf_dir):
    rows = with_lineage(sample.table(spark, sf_dir, "orders"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.min(PROCESS_TIME) == F.max(PROCESS_TIME)).alias("one_time"),
        F.count_if(F.col(INPUT_FILE).contains("orders.parquet")).alias("n_with_file"),
    )


@query("pending_files", "SELECT event_id FROM events WHERE event_type <> 'purchase'")
def pending_events(spark, sf_dir):
    events = sample.table(spark, sf_dir, "events")
    logged = events.where(F.col("event_type") == "purchase")
    return pending_files(events.select("event_id"), logged, "event_id")


@query("bucketed_ledger", "SELECT concat('landing/', event_id) AS file_name FROM events WHERE event_type IN ('click', 'signup')")
def bucketed_ledger(spark, sf_dir):
    """Events stand for files. Some are logged and folded, others logged and folded later, or not folded; the rest is pending."""
    root, at = scratch_path(spark, "bucketed-ledger"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    files = sample.table(spark, sf_dir, "events").select(F.format_string("landing/%d", "event_id").alias("file_name"), "event_type")
    for kind in ("view", "error", "purchase"):
        append_ledger(files.where(F.col("event_type") == kind), root, kind, at)
        if kind != "purchase":
            fold_ledger(spark, root, at_least=1)
    return unlogged(files.select("file_name"), root)


@query("format_load", "SELECT * FROM events")
def format_load_once(spark, sf_dir):
    """The files of a table loaded twice over one ledger; the second load finds nothing to do."""
    root = scratch_path(spark, "format-load")
    source, tables = Source("events", f"{sf_dir}/events.parquet", "events"), ParquetTables(f"{root}/tables")
    for _ in range(2):
        format_load(spark, source, f"{root}/ledger", tables)
    return read_table(spark, tables, "events").drop(PROCESS_TIME, INPUT_FILE)


@query("format_load_listings", _LISTINGS_SQL)
def format_load_listings(spark, sf_dir):
    """Listings and their lookup landed as files, then loaded through the listings step."""
    root = scratch_path(spark, "format-listings")
    sample.raw_listings(spark, sf_dir).write.parquet(f"{root}/landing")
    sample.lookup(spark, sf_dir).write.parquet(f"{root}/lookup")
    source, tables = Source(names.LISTINGS_SOURCE, f"{root}/landing", names.LISTINGS_TABLE), ParquetTables(f"{root}/tables")
    format_load(
        spark, source, f"{root}/ledger", tables,
        lambda df: format_listings(df, read_lookup(spark, f"{root}/lookup"), names.LISTING_JSON),
    )
    return read_table(spark, tables, source.table).drop(PROCESS_TIME, INPUT_FILE)


# Result tables


@query("listings_per_neighborhood", f"{sample.SAMPLE_SQL} SELECT neighborhood_id, min(district_id) AS district_id, "
       "min(district_n_reconciled) AS district_n_reconciled, min(neighborhood_n_reconciled) AS neighborhood_n_reconciled, "
       "count(*) AS count_list FROM listing WHERE neighborhood_id IS NOT NULL GROUP BY neighborhood_id")
def listings_per_neighborhood(spark, sf_dir):
    return exploitation.listings_per_neighborhood(sample.listings(spark, sf_dir))


@query("avg_price_index", f"{sample.SAMPLE_SQL} SELECT {_exact_avg('i.index_rfid')} AS avg_index, {_exact_avg('l.price')} AS avg_price, "
       "l.neighborhood_id, l.neighborhood_n_reconciled, l.district_id, l.district_n_reconciled "
       "FROM listing l JOIN income i ON l.neighborhood_id = i.neighborhood_id GROUP BY 3, 4, 5, 6")
def avg_price_index(spark, sf_dir):
    return exploitation.avg_price_index(sample.listings(spark, sf_dir), sample.income(spark, sf_dir), decimals=2)


@query("price_vs_index", f"{sample.SAMPLE_SQL} SELECT CAST(avg_index AS FLOAT) AS avg_index, price, {PLACE_SQL} FROM listing JOIN "
       f"(SELECT neighborhood_id, {_exact_avg('index_rfid')} AS avg_index FROM income GROUP BY neighborhood_id) USING (neighborhood_id)")
def price_vs_index(spark, sf_dir):
    return exploitation.price_vs_index(sample.listings(spark, sf_dir), sample.income(spark, sf_dir), decimals=2)


def _categories_sql(count: str) -> str:
    return f"""{sample.SAMPLE_SQL} SELECT l.neighborhood_id, c."Codi_Grup_Activitat", c."Nom_Grup_Activitat",
  {count} AS n_commerces, l.neighborhood_n_reconciled, l.district_id, l.district_n_reconciled
FROM listing l JOIN commercial c ON l.neighborhood_id = c.neighborhood_id GROUP BY 1, 2, 3, 5, 6, 7"""


@query("commerce_categories", _categories_sql("count(*)"))
def commerce_categories(spark, sf_dir):
    return exploitation.commerce_categories(sample.listings(spark, sf_dir), sample.commercial(spark, sf_dir))


@query("commerce_categories_distinct", _categories_sql("count(DISTINCT c.commerce_id)"))
def commerce_categories_distinct(spark, sf_dir):
    listings, commercial = sample.listings(spark, sf_dir), sample.commercial(spark, sf_dir)
    return exploitation.commerce_categories(listings, commercial, "distinct_facts")


@query("fanout_count", """
SELECT f.c_nationkey, o.c_mktsegment, count(*) AS n FROM (SELECT c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey) f
JOIN customer o ON f.c_nationkey = o.c_nationkey GROUP BY 1, 2""")
def orders_by_segment(spark, sf_dir):
    """Orders times customers by nation and segment: the fan-out without any lookup."""
    orders, customers = sample.table(spark, sf_dir, "orders"), sample.table(spark, sf_dir, "customer")
    facts = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey")
    return fanout_count(facts, customers, "c_nationkey", [], ["c_mktsegment"], "n")


@query("fanout_avg", f"""
SELECT {_exact_avg('s_acctbal')} AS avg_balance, {_exact_avg('o_totalprice')} AS avg_price, s_nationkey AS nation, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON c_nationkey = s_nationkey GROUP BY 3, 4""")
def averages_by_segment(spark, sf_dir):
    orders, customers = sample.table(spark, sf_dir, "orders"), sample.table(spark, sf_dir, "customer")
    facts = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "nation")
    suppliers = sample.table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation")
    return fanout_avg(facts, suppliers, "nation", ["c_mktsegment"], "o_totalprice", "s_acctbal", "avg_price", "avg_balance", decimals=2)


_RESULTS = ["neighborhood_id", "district_id", "district_n_reconciled", "neighborhood_n_reconciled", "code", "category", "n", "price", "avg_index"]
_CATEGORY = ['"Codi_Grup_Activitat"', '"Nom_Grup_Activitat"']


def _exploited_sql(listing: str = "listing", income: str = "income", commercial: str = "commercial") -> str:
    """Every row of the four result tables under shared columns."""
    code, category = _CATEGORY
    return f"""
SELECT '{names.COUNT_TABLE}' AS table_name, neighborhood_id, min(district_id) AS district_id, min(district_n_reconciled) AS district_n_reconciled,
  min(neighborhood_n_reconciled) AS neighborhood_n_reconciled, NULL AS code, NULL AS category, count(*) AS n,
  CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS avg_index
FROM {listing} WHERE neighborhood_id IS NOT NULL GROUP BY neighborhood_id
UNION ALL SELECT '{names.AVERAGES_TABLE}', l.neighborhood_id, district_id, district_n_reconciled, neighborhood_n_reconciled, NULL, NULL, NULL,
  {_exact_avg('l.price')}, min(i.avg_index) FROM {listing} l JOIN
  (SELECT neighborhood_id, {_exact_avg('index_rfid')} AS avg_index FROM {income} GROUP BY 1) i ON l.neighborhood_id = i.neighborhood_id GROUP BY 2, 3, 4, 5
UNION ALL SELECT '{names.PRICES_TABLE}', l.neighborhood_id, district_id, district_n_reconciled, neighborhood_n_reconciled, NULL, NULL, NULL,
  l.price, CAST(CAST(i.avg_index AS FLOAT) AS DOUBLE) FROM {listing} l JOIN
  (SELECT neighborhood_id, {_exact_avg('index_rfid')} AS avg_index FROM {income} GROUP BY 1) i ON l.neighborhood_id = i.neighborhood_id
UNION ALL SELECT '{names.CATEGORIES_TABLE}', l.neighborhood_id, l.district_id, l.district_n_reconciled, l.neighborhood_n_reconciled,
  CAST(c.{code} AS VARCHAR), CAST(c.{category} AS VARCHAR), count(*), NULL, NULL
FROM {listing} l JOIN {commercial} c ON l.neighborhood_id = c.neighborhood_id GROUP BY 2, 3, 4, 5, 6, 7"""


def _exploited(spark: SparkSession, tables: ParquetTables) -> DataFrame:
    own = {
        names.COUNT_TABLE: {"n": "count_list"}, names.AVERAGES_TABLE: {"price": "avg_price", "avg_index": "avg_index"},
        names.PRICES_TABLE: {"price": "price", "avg_index": "avg_index"},
        names.CATEGORIES_TABLE: {"n": "n_commerces", "code": "Codi_Grup_Activitat", "category": "Nom_Grup_Activitat"},
    }
    kinds = {"n": "long", "price": "double", "avg_index": "double"}
    parts = []
    for name, columns in own.items():
        df = read_table(spark, tables, name)
        found = columns | {c: c for c in PLACE if c in df.columns}
        parts.append(df.select(F.lit(name).alias("table_name"), *[
            (F.col(found[c]) if c in found else F.lit(None)).cast(kinds[c] if c in kinds else df.schema[c].dataType if c in df.columns else "string").alias(c)
            for c in _RESULTS]))
    return reduce(DataFrame.unionByName, parts)


@query("run_exploitation", f"{sample.SAMPLE_SQL}{_exploited_sql()}")
def run_exploitation(spark, sf_dir):
    """All four result tables written, then read back row by row."""
    tables = ParquetTables(scratch_path(spark, "exploitation"))
    exploitation.run_exploitation(
        sample.listings(spark, sf_dir), sample.income(spark, sf_dir), sample.commercial(spark, sf_dir), tables, decimals=2
    )
    return _exploited(spark, tables)


@query("whole_flow", f"{sample.SAMPLE_SQL}{_exploited_sql()}")
def whole_flow(spark, sf_dir):
    """Raw tables land, a registry names them, the loads format them, and the result tables follow."""
    root = scratch_path(spark, "flow")
    landed = {
        names.LISTINGS_SOURCE: (sample.raw_listings, names.LISTINGS_TABLE), names.INCOME_SOURCE: (sample.raw_income, names.INCOME_TABLE),
        names.COMMERCIAL_SOURCE: (sample.raw_commercial, names.COMMERCIAL_TABLE),
        names.LISTINGS_LOOKUP: (sample.lookup, ""), names.OPEN_DATA_LOOKUP: (sample.lookup, ""),
    }
    schemas = {}
    for name, (raw, _) in landed.items():
        rows = raw(spark, sf_dir)
        rows.write.parquet(f"{root}/landing/{name}")
        schemas[name] = rows.schema
    entries = [(name, f"{root}/landing/{name}", table) for name, (_, table) in landed.items()]
    spark.createDataFrame(entries, "name string, dest_path_landing string, dest_table string").write.json(f"{root}/registry")
    formatted, results = ParquetTables(f"{root}/formatted"), ParquetTables(f"{root}/results")
    format_sources(spark, read_registry(spark, f"{root}/registry"), f"{root}/ledger", formatted, schemas=schemas)
    exploitation.exploit_tables(spark, formatted, results, decimals=2)
    return _exploited(spark, results)


@query("registry_entries", """
SELECT s_name AS name, '/landing/' || CAST(s_suppkey AS VARCHAR) AS dest_path_landing, 'nation_' || CAST(s_nationkey AS VARCHAR) AS dest_table
FROM supplier""")
def registry_entries(spark, sf_dir):
    """A registry of an entry per supplier: one half as lines in part files, the other as a list per nation."""
    root = scratch_path(spark, "registry")
    supplier = sample.table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    entries = supplier.select("s_suppkey", "s_nationkey", F.to_json(F.struct(
        F.col("s_name").alias("name"), F.concat(F.lit("/landing/"), key).alias("dest_path_landing"), F.concat(F.lit("nation_"), nation).alias("dest_table"))).alias("value"))
    entries.where("s_suppkey % 2 = 0").select("value").repartition(4).write.text(f"{root}/lines")
    lists = entries.where("s_suppkey % 2 = 1").groupBy("s_nationkey").agg(F.concat(F.lit("["), F.concat_ws(",\n", F.collect_list("value")), F.lit("]")).alias("value"))
    # A file may hold one list, so each is written by its own task of a folder of its own.
    lists.write.partitionBy("s_nationkey").text(f"{root}/lists")
    found = read_registry(spark, f"{root}/lines").unionByName(read_registry(spark, f"{root}/lists/*"))
    return found.select("name", "dest_path_landing", "dest_table")


@query("read_drifted_files", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS o_orderstatus, o_totalprice FROM orders""")
def read_drifted_files(spark, sf_dir):
    """Orders landed in three writes with keys of two lengths, prices of three types, and a column that one of them lacks."""
    root = scratch_path(spark, "drifted")
    orders = sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kinds = [{"o_custkey": "int"}, {"o_orderkey": "int"}, {}]
    for k, kind in enumerate(kinds):
        rows = orders.where(F.col("o_orderkey") % 3 == k).withColumns({c: F.col(c).cast(t) for c, t in kind.items()})
        whole = F.col("o_totalprice") == F.floor("o_totalprice")
        rows = rows.drop("o_orderstatus") if k == 1 else rows
        if k == 2:  # whole prices as integers, as tools do that guess types by file
            rows.where(whole).withColumn("o_totalprice", F.col("o_totalprice").cast("long")).write.parquet(f"{root}/whole")
            rows = rows.where(~whole)
        rows.write.parquet(f"{root}/{k}")
    return read_landing(spark, [f"{root}/{name}" for name in ("0", "1", "2", "whole")]).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("snapshot_swap", f"{sample.SAMPLE_SQL}{_exploited_sql()}")
def snapshot_swap(spark, sf_dir):
    """The four result tables committed over half of the listings, then over all, then by a run that fails: all of the second are read."""
    tables = SnapshotTables(scratch_path(spark, "snapshots"))
    listings, income, commercial = (f(spark, sf_dir) for f in (sample.listings, sample.income, sample.commercial))
    for rows in (listings.where("listing_id % 2 = 0"), listings):
        exploitation.run_exploitation(rows, income, commercial, tables, decimals=2)
    lost = commercial.withColumn("Nom_Grup_Activitat", F.raise_error(F.lit("lost")).cast("string"))
    try:
        exploitation.run_exploitation(listings.where("listing_id % 2 = 1"), income, lost, tables, decimals=2)
    except SparkRuntimeException:
        pass
    return _exploited(spark, tables)


@query("read_lookup", "SELECT n_nationkey AS neighborhood_id, upper(n_name) AS neighborhood_n_reconciled FROM nation")
def whole_lookup(spark, sf_dir):
    """A lookup written as three part files, next to an older one."""
    path = scratch_path(spark, "lookup")
    sample.lookup(spark, sf_dir).where("district_id = 0").write.parquet(path)
    sample.lookup(spark, sf_dir).repartition(3).write.mode("append").parquet(path)
    return read_lookup(spark, path).select("neighborhood_id", "neighborhood_n_reconciled")


@query("format_stream", "SELECT * FROM events")
def format_stream_once(spark, sf_dir):
    """The files of a table loaded by two runs on one checkpoint; the second finds nothing to do."""
    root = scratch_path(spark, "format-stream")
    events = sample.table(spark, sf_dir, "events")
    events.write.parquet(f"{root}/landing")
    source, tables = Source("events", f"{root}/landing", "events"), ParquetTables(f"{root}/tables")
    for _ in range(2):
        run_available(format_stream(spark, source, f"{root}/checkpoint", tables, events.schema))
    return read_table(spark, tables, "events").drop(PROCESS_TIME, INPUT_FILE)


# Model


@query("category_index", """
SELECT o_orderkey, o_orderpriority, idx FROM orders JOIN
  (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx
   FROM orders GROUP BY o_orderpriority) USING (o_orderpriority)""")
def order_category_index(spark, sf_dir):
    orders = sample.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return category_index(orders, "o_orderpriority", "idx")


@query("train_test_split", f"SELECT o_orderkey, CASE WHEN {TRAINING_SQL.format(key='o_orderkey')} THEN 'train' ELSE 'test' END AS part FROM orders")
def train_test_parts(spark, sf_dir):
    """The part of each order, from one scan."""
    orders = sample.table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.withColumn("part", F.when(in_training("o_orderkey"), "train").otherwise("test"))


@query("random_split", "SELECT count(*) AS n_rows, true AS near_share FROM orders")
def random_split_shares(spark, sf_dir):
    """Which rows the random split draws is not fixed; that it loses none and keeps the share is."""
    train, test = random_split(sample.table(spark, sf_dir, "orders").select("o_orderkey"))
    drawn = train.select(F.lit(1).alias("drawn")).unionAll(test.select(F.lit(0)))
    return drawn.agg(F.count(F.lit(1)).alias("n_rows"), (F.abs(F.avg("drawn") - TRAIN_SHARE) < 0.05).alias("near_share"))


@query("summarize", """
SELECT 'count' AS summary, CAST(count(o_totalprice) AS DOUBLE) AS o_totalprice FROM orders
UNION ALL SELECT 'mean', CAST((sum(CAST(round(o_totalprice * 100) AS HUGEINT)) * 20000 + count(o_totalprice)) // (2 * count(o_totalprice)) AS DOUBLE) / 1000000 FROM orders
UNION ALL SELECT 'stddev', round(stddev_samp(o_totalprice), 4) FROM orders
UNION ALL SELECT 'min', min(o_totalprice) FROM orders
UNION ALL SELECT 'max', max(o_totalprice) FROM orders""")
def price_summary(spark, sf_dir):
    """Prices as decimals, of which Spark averages exactly; a deviation has no ties to round."""
    prices = sample.table(spark, sf_dir, "orders").select(F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    value = F.col("o_totalprice").cast("double")
    return summarize(prices, ["o_totalprice"]).withColumn(
        "o_totalprice", F.when(F.col("summary") == "stddev", F.round(value, 4)).otherwise(value))


# The regularised fit in closed form. With one category per row, a category's coefficient is its
# distance from the intercept, shrunk by its share of the rows; the rarest category is the baseline.
_FIT_SQL = f"""
groups AS (SELECT category, count(*) AS n, avg(price) AS mean, row_number() OVER (ORDER BY count(*), category DESC) AS rarity
  FROM placed WHERE training GROUP BY category),
total AS (SELECT count(*) AS n, stddev_pop(price) AS sd FROM placed WHERE training),
shrunk AS (SELECT category, g.n, mean,
  CASE WHEN rarity = 1 THEN 0 ELSE 1 / (1 + {REG_PARAM} / sd * (1 - CAST(g.n AS DOUBLE) / t.n)) END AS kept FROM groups g CROSS JOIN total t),
base AS (SELECT sum(n * (1 - kept) * mean) / sum(n * (1 - kept)) AS intercept FROM shrunk),
fitted AS (SELECT category, kept * (mean - intercept) AS coefficient, intercept FROM shrunk CROSS JOIN base),
scored AS (SELECT placed.*, intercept + coefficient AS prediction, price - (intercept + coefficient) AS error
  FROM placed JOIN fitted USING (category))"""

_LISTING_MODEL_SQL = f"""{sample.SAMPLE_SQL},
placed AS (SELECT listing_id, CAST(neighborhood_id AS VARCHAR) AS category, price, {TRAINING_SQL.format(key='listing_id')} AS training
  FROM listing WHERE neighborhood_id IS NOT NULL),{_FIT_SQL}"""

_TEST_SCORES_SQL = f"""{_LISTING_MODEL_SQL}
SELECT listing_id, price, round(prediction, 2) AS prediction, round(error, 2) AS error FROM scored WHERE NOT training"""

_METRICS_SQL = f"""{_LISTING_MODEL_SQL}
SELECT CASE WHEN training THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(sqrt(avg(error * error)), 2) AS rmse,
  round(1 - avg(error * error) / var_pop(price), 8) AS r2, round(avg(abs(error)), 2) AS mae FROM scored GROUP BY 1"""


def _placed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.listings(spark, sf_dir).select("listing_id", "neighborhood_id", "price")


def _listing_model(listings: DataFrame) -> PriceModel:
    train, _ = train_test_split(listings, "listing_id")
    return fit_price_model(train, "neighborhood_id")


def _rounded_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({"rmse": F.round("rmse", 2), "r2": F.round("r2", 8), "mae": F.round("mae", 2)})


@query("score", _TEST_SCORES_SQL)
def score_test_listings(spark, sf_dir):
    listings = _placed_listings(spark, sf_dir)
    train, test = train_test_split(listings, "listing_id")
    scored = with_error(score(price_pipeline("neighborhood_id").fit(train), test))
    return scored.select("listing_id", "price", F.round("prediction", 2).alias("prediction"), F.round("error", 2).alias("error"))


@query("predict", _TEST_SCORES_SQL)
def predict_test_listings(spark, sf_dir):
    listings = _placed_listings(spark, sf_dir)
    _, test = train_test_split(listings, "listing_id")
    scored = with_error(predict(_listing_model(listings), test))
    return scored.select("listing_id", "price", F.round("prediction", 2).alias("prediction"), F.round("error", 2).alias("error"))


@query("regression_metrics", _METRICS_SQL)
def model_metrics(spark, sf_dir):
    listings = _placed_listings(spark, sf_dir)
    parts = listings.withColumn("part", F.when(in_training("listing_id"), "train").otherwise("test"))
    return _rounded_metrics(regression_metrics(predict(_listing_model(listings), parts), by=["part"]))


@query("coefficient_table", f"""{_LISTING_MODEL_SQL}
SELECT category, round(coefficient, 2) AS coefficient, round(intercept, 2) AS intercept FROM fitted""")
def model_coefficients(spark, sf_dir):
    table = coefficient_table(_listing_model(_placed_listings(spark, sf_dir)))
    return table.withColumns({c: F.round(c, 2) for c in ("coefficient", "intercept")})


@query("fit_many_categories", f"""
WITH placed AS (SELECT CAST(l_orderkey AS VARCHAR) AS category, l_extendedprice AS price, true AS training FROM lineitem),{_FIT_SQL}
SELECT category, round(coefficient, 2) AS coefficient, round(intercept, 2) AS intercept FROM fitted""")
def fit_many_categories(spark, sf_dir):
    """A category per order: far more than a solver that holds them all on one machine would take."""
    lines = sample.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice")
    table = coefficient_table(fit_price_model(lines, "l_orderkey", "l_extendedprice"))
    return table.withColumns({c: F.round(c, 2) for c in ("coefficient", "intercept")})


@query("preview", "SELECT 5 AS n_rows, true AS all_there")
def preview_orders(spark, sf_dir):
    """Which rows a preview shows is not fixed; how many, and that they are the table's, is."""
    orders = sample.table(spark, sf_dir, "orders").select("o_orderkey")
    shown = preview(orders, 5).withColumnRenamed("o_orderkey", "shown")
    met = shown.join(orders, F.col("shown") == F.col("o_orderkey"), "left")
    return met.agg(F.count_distinct("shown").cast("int").alias("n_rows"), (F.count("o_orderkey") == F.count(F.lit(1))).alias("all_there"))


@query("train_price_model", _METRICS_SQL)
def train_and_save(spark, sf_dir):
    """Train, save, load again, and measure the loaded model."""
    path = scratch_path(spark, "price-model")
    listings = _placed_listings(spark, sf_dir)
    train_price_model(listings, "listing_id", path=path)
    parts = listings.withColumn("part", F.when(in_training("listing_id"), "train").otherwise("test"))
    return _rounded_metrics(regression_metrics(predict(load_model(spark, path), parts), by=["part"]))


# Streams


def _event_messages(events: DataFrame) -> DataFrame:
    return events.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ("ts", "user_id", "value")]).alias("value"))


@query("split_message", "SELECT ts AS date, user_id AS neighborhood_id, value AS price FROM events")
def split_messages(spark, sf_dir):
    return split_message(_event_messages(sample.table(spark, sf_dir, "events")), EVENT_MESSAGE).drop("value")


@query("bad_rows", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup')")
def bad_messages(spark, sf_dir):
    """Messages that end in a word where a number is due, or end early."""
    events = sample.table(spark, sf_dir, "events")
    last = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") != "signup", F.col("event_id").cast("string"))
    messages = events.select("event_id", F.concat_ws(",", F.col("ts").cast("string"), F.col("user_id").cast("string"), last).alias("value"))
    return bad_rows(split_message(messages, COUNTED_MESSAGE), COUNTED_MESSAGE).select("event_id")


@query("ingest_prices", "SELECT ts AS date, user_id AS neighborhood_id, value AS price FROM events")
def ingest_messages(spark, sf_dir):
    """Event messages streamed into a table by two runs on one checkpoint."""
    root = scratch_path(spark, "ingest")
    tables = ParquetTables(f"{root}/tables")
    for _ in range(2):
        stream = _event_messages(sample.table_stream(spark, sf_dir, "events"))
        run_available(jobs.ingest_prices(stream, tables, f"{root}/checkpoint", fields=EVENT_MESSAGE, available_now=True))
    return read_table(spark, tables, names.MESSAGES_TABLE).drop("value")


@query("ingest_text_messages", "SELECT ts AS date, user_id AS neighborhood_id, value AS price FROM events")
def ingest_text_messages(spark, sf_dir):
    """Messages that lie in text files, read by the message source and streamed into a table by two runs."""
    root = scratch_path(spark, "messages")
    _event_messages(sample.table(spark, sf_dir, "events")).write.text(f"{root}/messages")
    tables = ParquetTables(f"{root}/tables")
    for _ in range(2):
        stream = read_messages(spark, "text", {"path": f"{root}/messages"})
        run_available(jobs.ingest_prices(stream, tables, f"{root}/checkpoint", fields=EVENT_MESSAGE, available_now=True))
    return read_table(spark, tables, names.MESSAGES_TABLE).drop("value")


@query("compact_batches", "SELECT ts AS date, user_id AS neighborhood_id, value AS price FROM events")
def compact_batches(spark, sf_dir):
    """Messages streamed in eight batches, folded twice, with a folded batch repeated in between."""
    root = scratch_path(spark, "compact")
    tables, table = ParquetTables(f"{root}/tables"), names.MESSAGES_TABLE
    _event_messages(sample.table(spark, sf_dir, "events")).repartition(8, "value").write.text(f"{root}/messages")
    stream = read_messages(spark, "text", {"path": f"{root}/messages", "maxFilesPerTrigger": "1"})
    done = run_available(jobs.ingest_prices(stream, tables, f"{root}/checkpoint", fields=EVENT_MESSAGE, available_now=True))
    part = {"stream_id": done.id, "batch_id": 0}
    first = stored(spark.read.parquet(tables.part_path(table, part)), "first")
    compact(spark, tables.root, table)
    write_table(first, tables, table, part=part)
    compact(spark, tables.root, table)
    return read_table(spark, tables, table).drop("value")


@query("dead_letters", """
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN 'bad' ELSE 'good' END AS table_name FROM events""")
def dead_letters(spark, sf_dir):
    """Messages of which some end in a word or early, streamed into one table of good and one of bad ones."""
    root = scratch_path(spark, "letters")
    last = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") != "signup", F.col("event_id").cast("string"))
    events = sample.table_stream(spark, sf_dir, "events")
    stream = events.select(F.concat_ws(",", F.col("ts").cast("string"), F.col("user_id").cast("string"), last, F.concat(F.lit("id "), F.col("event_id").cast("string"))).alias("value"))
    stream = stream.withColumn("value", F.when(F.size(F.split("value", ",")) == 3, F.regexp_replace("value", ",id", ",,id")).otherwise(F.col("value")))
    tables = ParquetTables(f"{root}/tables")
    run_available(jobs.ingest_prices(stream, tables, f"{root}/checkpoint", "good", COUNTED_MESSAGE, available_now=True, bad_table="bad"))
    event = F.regexp_extract("value", r"id (\d+)$", 1).cast("long").alias("event_id")
    return reduce(DataFrame.unionByName, [read_table(spark, tables, t).select(event, F.lit(t).alias("table_name")) for t in ("good", "bad")])


@query("score_stream", f"""
WITH placed AS (SELECT o_orderdate AS date, o_orderpriority AS category, o_totalprice AS price,
  {TRAINING_SQL.format(key='o_orderkey')} AS training FROM orders),{_FIT_SQL}
SELECT date, category AS o_orderpriority, price, round(prediction, 2) AS prediction, round(error, 2) AS error FROM scored""")
def score_messages(spark, sf_dir):
    """Order messages scored as a stream by a model fitted on the training share of the orders."""
    train, _ = train_test_split(sample.table(spark, sf_dir, "orders"), "o_orderkey")
    model = fit_price_model(train, "o_orderpriority", "o_totalprice")
    stream = sample.table_stream(spark, sf_dir, "orders").select(
        F.concat_ws(",", *[F.col(c).cast("string") for c in ("o_orderdate", "o_orderpriority", "o_totalprice")]).alias("value")
    )
    root = scratch_path(spark, "score")
    tables = ParquetTables(f"{root}/tables")
    scored = jobs.score_stream(stream, model, ORDER_MESSAGE)
    run_available(stream_to_table(scored, tables, "scored", f"{root}/checkpoint", available_now=True))
    return read_table(spark, tables, "scored").withColumns({c: F.round(c, 2) for c in ("prediction", "error")})
