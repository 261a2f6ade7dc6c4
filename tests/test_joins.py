import pytest
from pyspark.sql import functions as F

from placelake.operators import joins
from placelake.operators.joins import attach_group_avg, bounded_join, measured_bytes, pending_files, reconcile

# Plenty, nothing (so both sides are shuffled), and nothing with salted keys.
WAYS = [{}, {"max_bytes": 0}, {"max_bytes": 0, "salts": 5}]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    data = [("D1", "N1", 1), ("D1", "N1", 1), ("D1", "N2", 2), ("D1", None, 3), (None, "N1", 4), ("D9", "N9", 5)]
    return spark.createDataFrame(data, "district string, neighborhood string, price int")


@pytest.fixture(scope="module")
def lookup(spark):
    data = [("D1", "N1", "d1", "n1"), ("D1", "N2", "d1", "n2"), ("D1", "N2", "d1", "n0"), (None, "N1", "x", "x"), ("D1", None, "y", "y")]
    return spark.createDataFrame(data, "district string, neighborhood string, district_id string, neighborhood_id string")


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("how", ["left", "inner"])
def test_bounded_join_gives_the_same_rows_every_way(rows, lookup, way, how):
    keys = ["district", "neighborhood"]
    joined = bounded_join(rows, lookup, keys, how, **way)
    plain = rows.join(lookup, keys, how)
    assert joined.columns == plain.columns
    assert sorted_rows(joined) == sorted_rows(plain)


@pytest.mark.parametrize("way", WAYS)
def test_bounded_join_keeps_both_keys_of_differing_names(rows, lookup, way):
    theirs = rows.toDF("Nom_Districte", "Nom_Barri", "index_rfid")
    joined = bounded_join(theirs, lookup, {"Nom_Districte": "district", "Nom_Barri": "neighborhood"}, "left", **way)
    assert joined.columns == theirs.columns + lookup.columns
    plain = theirs.join(lookup, (theirs.Nom_Districte == lookup.district) & (theirs.Nom_Barri == lookup.neighborhood), "left")
    assert sorted_rows(joined) == sorted_rows(plain)


def test_small_sides_are_broadcast_and_large_ones_are_not(spark, rows, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(**way):
            df = bounded_join(rows, lookup, ["district", "neighborhood"], **way)
            return df._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan()
        assert "SortMergeJoin" in plan(max_bytes=0) and "Broadcast" not in plan(max_bytes=0)
        assert "__salt" not in plan(max_bytes=0) and "__salt" in plan(max_bytes=0, salts=4)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert "__salt" in plan(max_bytes=0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_a_hot_key_is_spread_over_salts(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), "id").union(spark.range(10).select(F.lit("cold"), "id"))
    side = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    joined = bounded_join(hot, side, ["k"], max_bytes=0, salts=8)
    assert joined.count() == 3010
    spread = hot.groupBy(F.pmod(joins.row_hash(hot), F.lit(8))).count()
    assert spread.count() == 8 and spread.agg(F.max("count")).first()[0] < 600


def test_copies_of_one_row_are_spread_too(spark):
    copies = spark.range(0, 3200, 1, 32).select(F.lit("hot").alias("k"))
    assert copies.groupBy(F.pmod(joins.row_hash(copies), F.lit(8))).count().agg(F.max("count")).first()[0] <= 1600
    side = spark.createDataFrame([("hot", 1)], "k string, v int")
    assert bounded_join(copies, side, ["k"], max_bytes=0, salts=8).count() == 3200


def test_row_hash_takes_maps(spark):
    df = spark.createDataFrame([({"a": 1}, [{"b": 2}])], "m map<string,int>, l array<map<string,int>>")
    assert df.select(joins.row_hash(df)).first()[0] is not None


def test_measured_bytes_counts_text_and_rows(spark):
    df = spark.createDataFrame([("abc", 1), ("", 2), (None, 3), ("é", 4)], "s string, n int")
    assert measured_bytes(df) == 4 * (16 + 4) + 5
    assert measured_bytes(df.limit(0)) == 0
    nested = spark.createDataFrame([([1, 2],)], "l array<int>")
    assert measured_bytes(nested) > 16


def test_reconcile_expands_duplicates_and_keeps_unmatched_rows(rows, lookup):
    got = sorted_rows(reconcile(rows, lookup, ["district", "neighborhood"]).select("price", "neighborhood_id"))
    assert got == sorted([(1, "n1"), (1, "n1"), (2, "n2"), (2, "n0"), (3, None), (4, None), (5, None)], key=repr)


def test_reconcile_first_takes_the_smallest_entry(rows, lookup):
    got = reconcile(rows, lookup, ["district", "neighborhood"], on_duplicate="first")
    assert got.columns == ["district", "neighborhood", "price", "district_id", "neighborhood_id"]
    assert sorted_rows(got.where("price = 2").select("neighborhood_id")) == [("n0",)]
    assert got.count() == rows.count()


def test_reconcile_error_names_the_duplicate_key(rows, lookup):
    with pytest.raises(ValueError, match="N2"):
        reconcile(rows, lookup, ["district", "neighborhood"], on_duplicate="error")
    nulls_twice = lookup.where("neighborhood is null").union(lookup.where("neighborhood is null"))
    assert reconcile(rows, nulls_twice, ["district", "neighborhood"], on_duplicate="error").count() == rows.count()
    with pytest.raises(ValueError, match="often"):
        reconcile(rows, lookup, ["district", "neighborhood"], on_duplicate="often")


@pytest.mark.parametrize("way", [{}, {"max_bytes": 0}])
def test_attach_group_avg(spark, way):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, price int")
    measures = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None), (None, 9.0)], "k string, m double")
    got = attach_group_avg(rows, measures, "k", "m", "avg_m", **way)
    assert dict(got.dtypes)["avg_m"] == "float"
    assert sorted_rows(got.select("price", "avg_m")) == [(1, 1.5), (2, 1.5), (3, None)]


def test_pending_files_compares_whole_names(spark):
    listing = spark.createDataFrame([("file:/a/x",), ("file:/b/x",), ("file:/b/y",)], "file_name string")
    ledger = spark.createDataFrame([("file:/a/x", 1), ("file:/a/x", 2)], "file_name string, n int")
    assert sorted_rows(pending_files(listing, ledger)) == [("file:/b/x",), ("file:/b/y",)]
    assert pending_files(listing, ledger.limit(0)).count() == 3
    assert pending_files(listing, listing).count() == 0
