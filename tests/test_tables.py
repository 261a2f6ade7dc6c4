import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake import settings
from placelake.functions.ddl import STRING_TYPES
from placelake.plans import exploitation, names, sample
from placelake.sources.tables import JdbcTables, ParquetTables, read_table, write_table

SF = "/root/testdata/sf0.001"
DATABASE = JdbcTables("jdbc:any:db", {"user": "me", "password": "secret", "driver": "any.Driver"})


def test_parquet_modes_and_parts(spark, tmp_path):
    store = ParquetTables(str(tmp_path))
    df = spark.range(3)
    write_table(df, store, "t")
    write_table(df, store, "t")
    assert read_table(spark, store, "t").count() == 6
    write_table(df, store, "t", "overwrite")
    assert read_table(spark, store, "t").count() == 3
    for part in ("a", "b", "a"):
        write_table(df, store, "parted", part={"load_id": part})
    parted = read_table(spark, store, "parted")
    assert parted.count() == 6 and parted.columns == ["id"]
    assert read_table(spark, store, "parted", schema=df.schema).columns == ["id"]


def test_parquet_parts_of_all_kinds_make_one_table(spark, tmp_path):
    store = ParquetTables(str(tmp_path))
    df = spark.range(2).withColumn("load_id", F.lit("data"))
    for part in (None, {"load_id": "a"}, {"stream_id": "s", "batch_id": 0}, {"stream_id": "s", "batch_id": 1}, {"stream_id": "s", "batch_id": 0}):
        write_table(df, store, "t", part=part)
    got = read_table(spark, store, "t")
    assert got.count() == 8 and got.columns == ["id", "load_id"] and got.where("load_id = 'data'").count() == 8


def test_parquet_parts_may_differ_in_columns(spark, tmp_path):
    store = ParquetTables(str(tmp_path))
    write_table(spark.range(1), store, "t", part={"load_id": "a"})
    write_table(spark.range(1).withColumn("x", F.lit("y")), store, "t", part={"load_id": "b"})
    assert {r.x for r in read_table(spark, store, "t").collect()} == {None, "y"}


def test_database_write_options():
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("open", T.BooleanType()), T.StructField("n", T.LongType())])
    opts = DATABASE.write_options(schema, "t", STRING_TYPES)
    assert opts["createTableColumnTypes"] == "`name` VARCHAR(1024)" and opts["batchsize"] == "10000" and opts["user"] == "me"
    numbers = T.StructType([T.StructField("n", T.LongType())])
    assert "createTableColumnTypes" not in DATABASE.write_options(numbers, "t", STRING_TYPES)
    assert "numPartitions" not in opts
    longer = JdbcTables("jdbc:any:db", types={T.StringType: "VARCHAR(9000)"})
    assert longer.write_options(schema, "t", STRING_TYPES)["createTableColumnTypes"] == "`name` VARCHAR(9000)"
    assert JdbcTables("jdbc:any:db", write_connections=8).write_options(schema, "t", {})["numPartitions"] == "8"


def test_database_reads_are_split_between_the_smallest_and_largest_key(spark, monkeypatch):
    asked = []

    def read(self, spark, table, schema=None):
        asked.append(self.read_options(table))
        return spark.createDataFrame([(3, 99)], "lo int, hi int")

    monkeypatch.setattr(JdbcTables, "read", read)
    read_table(spark, DATABASE, "listings", "id", 16)
    assert asked[0]["dbtable"] == "(SELECT min(id) AS lo, max(id) AS hi FROM listings) span"
    assert "partitionColumn" not in asked[0]
    assert {k: asked[1][k] for k in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "dbtable": "listings", "partitionColumn": "id", "lowerBound": "3", "upperBound": "99", "numPartitions": "16",
    }


def test_the_database_source_gets_the_options(spark):
    with pytest.raises(Exception, match="any.Driver"):
        read_table(spark, DATABASE, "listings")
    with pytest.raises(Exception, match="any.Driver"):
        write_table(spark.range(1), DATABASE, "listings")


def test_an_empty_database_table_is_read_whole(spark, monkeypatch):
    asked = []

    def read(self, spark, table, schema=None):
        asked.append(self.read_options(table))
        return spark.createDataFrame([(None, None)], "lo int, hi int")

    monkeypatch.setattr(JdbcTables, "read", read)
    read_table(spark, DATABASE, "listings", "id")
    assert len(asked) == 2 and "partitionColumn" not in asked[1]


def test_scratch_paths_lie_in_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = settings.scratch_path(spark, "x"), settings.scratch_path(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master, applicationId = "yarn", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settings.shared_root(Session())
    Session.sparkContext.master = "local[2]"
    assert settings.shared_root(Session()) == settings.shared_root(Session())


def test_exploitation_tables_equal_the_jobs_run_one_by_one(spark, tmp_path):
    listings, income, commercial = sample.listings(spark, SF), sample.income(spark, SF), sample.commercial(spark, SF)
    store = ParquetTables(str(tmp_path))
    exploitation.run_exploitation(listings, income, commercial, store)
    exploitation.run_exploitation(listings, income, commercial, store)
    single = {
        names.COUNT_TABLE: exploitation.listings_per_neighborhood(listings),
        names.AVERAGES_TABLE: exploitation.avg_price_index(listings, income),
        names.PRICES_TABLE: exploitation.price_vs_index(listings, income),
        names.CATEGORIES_TABLE: exploitation.commerce_categories(listings, commercial),
    }
    for table, want in single.items():
        got = read_table(spark, store, table)
        assert got.columns == want.columns
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
        assert got.count() == want.count() > 0
        assert got.select(rounded).exceptAll(want.select(rounded)).count() == 0


def test_exploit_tables_reads_the_formatted_tables(spark, tmp_path):
    formatted, results = ParquetTables(str(tmp_path / "formatted")), ParquetTables(str(tmp_path / "results"))
    listings, income, commercial = sample.listings(spark, SF), sample.income(spark, SF), sample.commercial(spark, SF)
    write_table(listings, formatted, names.LISTINGS_TABLE)
    write_table(income, formatted, names.INCOME_TABLE)
    write_table(commercial, formatted, names.COMMERCIAL_TABLE)
    exploitation.exploit_tables(spark, formatted, results)
    want = exploitation.listings_per_neighborhood(listings)
    assert read_table(spark, results, names.COUNT_TABLE).exceptAll(want).count() == 0
    assert read_table(spark, results, names.CATEGORIES_TABLE).count() > 0


def test_result_columns_come_in_their_order(spark):
    listings, income, commercial = sample.listings(spark, SF), sample.income(spark, SF), sample.commercial(spark, SF)
    place = ["neighborhood_id", "neighborhood_n_reconciled", "district_id", "district_n_reconciled"]
    assert exploitation.listings_per_neighborhood(listings).columns == [
        "neighborhood_id", "district_id", "district_n_reconciled", "neighborhood_n_reconciled", "count_list"]
    assert exploitation.avg_price_index(listings, income).columns == ["avg_index", "avg_price", *place]
    assert exploitation.price_vs_index(listings, income).columns == ["avg_index", "price", *place]
    assert exploitation.commerce_categories(listings, commercial).columns == [
        "neighborhood_id", "Codi_Grup_Activitat", "Nom_Grup_Activitat", "n_commerces", *place[1:]]
