import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from placelake.plans import formatting, names
from placelake.plans.formatting import format_load, format_sources
from placelake.sources.files import list_files, read_landing, read_lookup
from placelake.sources.ledger import append_ledger, ledger_rows, read_ledger
from placelake.sources.registry import Source, read_registry, select_sources, source_named, sources_of
from placelake.sources.tables import ParquetTables, read_table
from placelake.streaming.sinks import run_available


def land(spark, path, rows, schema):
    """One more parquet file in a landing folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def source(tmp_path):
    return Source("things", str(tmp_path / "landing"), "things")


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path / "tables"))


@pytest.fixture
def ledger(tmp_path):
    return str(tmp_path / "ledger")


def ids(spark, tables, table="things"):
    return sorted(r.id for r in read_table(spark, tables, table).collect())


def test_list_files_gives_uris_without_opening_files(spark, tmp_path):
    land(spark, tmp_path / "in", [(1,)], "id int")
    (tmp_path / "in" / "notes.txt").write_text("no table")
    files = list_files(spark, str(tmp_path / "in"))
    assert [c for c in files.columns] == ["file_name", "modified_at", "n_bytes"]
    assert files.count() == 2 and files.first().file_name.startswith("file:/")
    assert list_files(spark, str(tmp_path / "in"), "*.parquet").count() == 1


def test_read_landing_keeps_columns_of_every_file(spark, tmp_path):
    land(spark, tmp_path / "a", [(1,)], "id int")
    land(spark, tmp_path / "b", [(2, "x")], "id int, extra string")
    df = read_landing(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert {(r.id, r.extra) for r in df.collect()} == {(1, None), (2, "x")}
    fixed = read_landing(spark, [str(tmp_path / "a")], df.schema)
    assert fixed.columns == ["id", "extra"]


def test_read_lookup_takes_the_newest_file(spark, tmp_path):
    folder = tmp_path / "lookup"
    land(spark, folder, [(1,)], "id int")
    old = next(folder.glob("*.parquet"))
    land(spark, folder, [(2,)], "id int")
    os.utime(old, (1, 1))
    assert [r.id for r in read_lookup(spark, str(folder)).collect()] == [2]


def test_read_lookup_takes_all_parts_of_the_newest_folder(spark, tmp_path):
    spark.range(5).repartition(3).write.parquet(str(tmp_path / "lookup" / "v1"))
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "lookup" / "v2"))
    for old in (tmp_path / "lookup" / "v1").glob("*.parquet"):
        os.utime(old, (1, 1))
    assert read_lookup(spark, str(tmp_path / "lookup")).count() == 10
    os.makedirs(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        read_lookup(spark, str(tmp_path / "none"))


def test_read_lookup_takes_every_part_of_one_write(spark, tmp_path):
    path = str(tmp_path / "lookup")
    spark.range(30).repartition(3).write.parquet(path)
    assert read_lookup(spark, path).count() == 30
    for old in (tmp_path / "lookup").glob("*.parquet"):
        os.utime(old, (1, 1))
    spark.range(50, 57).repartition(2).write.mode("append").parquet(path)
    assert sorted(r.id for r in read_lookup(spark, path).collect()) == list(range(50, 57))


def test_read_lookup_compares_files_with_folders_by_time(spark, tmp_path):
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "made"))
    os.makedirs(tmp_path / "lookup")
    single = tmp_path / "lookup" / "places.parquet"
    next((tmp_path / "made").glob("*.parquet")).rename(single)
    os.utime(single, (1, 1))
    spark.range(50).repartition(2).write.parquet(str(tmp_path / "lookup" / "v2"))
    assert read_lookup(spark, str(tmp_path / "lookup")).count() == 50
    os.utime(single)
    for old in (tmp_path / "lookup" / "v2").glob("*.parquet"):
        os.utime(old, (1, 1))
    assert read_lookup(spark, str(tmp_path / "lookup")).count() == 5


def test_files_of_any_name_are_loaded(spark, tmp_path, ledger):
    os.makedirs(tmp_path / "in")
    for k, name in enumerate(["2021_01.parquet", "2021_02", "2021_03.PARQUET"]):
        spark.range(5 * k, 5 * k + 5).coalesce(1).write.parquet(str(tmp_path / f"w{k}"))
        next((tmp_path / f"w{k}").glob("*.parquet")).rename(tmp_path / "in" / name)
    source, tables = Source("s", str(tmp_path / "in"), "t"), ParquetTables(str(tmp_path / "tables"))
    assert format_load(spark, source, ledger, tables) == 3
    assert read_table(spark, tables, "t").count() == 15
    (tmp_path / "in" / "notes.txt").write_text("no table")
    with pytest.raises(Exception, match="notes.txt"):
        format_load(spark, source, ledger, tables)


@pytest.mark.parametrize("written", [True, False])
def test_a_load_ends_whose_claimed_file_has_gone(spark, tmp_path, ledger, written, monkeypatch):
    """The load is cut off after its write, or before; then the landing file goes, and another one comes."""
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    source, tables = Source("s", str(tmp_path / "in"), "t"), ParquetTables(str(tmp_path / "tables"))

    def cut_off(*args, **kwargs):
        raise RuntimeError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(formatting, "append_ledger" if written else "write_table", cut_off)
        with pytest.raises(RuntimeError):
            format_load(spark, source, ledger, tables)
    for gone in (tmp_path / "in" / "a").glob("*.parquet"):
        gone.rename(tmp_path / gone.name)
    spark.range(100, 103).coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    format_load(spark, source, ledger, tables)
    assert read_table(spark, tables, "t").count() == (8 if written else 3)
    assert format_load(spark, source, ledger, tables) == 0


def test_ledger_round_trip(spark, ledger):
    assert read_ledger(spark, ledger).count() == 0
    at = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    append_ledger(spark.createDataFrame([("file:/a",), ("file:/b",)], "file_name string"), ledger, "one", at)
    append_ledger(spark.createDataFrame([("file:/a",)], "file_name string"), ledger, "two", at)
    assert sorted(r.file_name for r in read_ledger(spark, ledger).collect()) == ["file:/a", "file:/b"]
    times = ledger_rows(spark, ledger).select(F.unix_seconds("processed_at")).distinct().collect()
    assert [r[0] for r in times] == [int(at.timestamp())]


def test_folders_of_a_first_write_that_never_ended_are_empty_tables(spark, source, tables, ledger):
    for table in ("processed", "claimed"):
        os.makedirs(f"{ledger}/{table}/_temporary/0")
    assert read_ledger(spark, ledger).count() == 0
    land(spark, source.landing_path, [(1,)], "id int")
    assert format_load(spark, source, ledger, tables) == 1


def test_each_file_is_loaded_once(spark, source, tables, ledger):
    land(spark, source.landing_path, [(1,), (2,)], "id int")
    assert format_load(spark, source, ledger, tables) == 1
    assert format_load(spark, source, ledger, tables) == 0
    land(spark, source.landing_path, [(3,)], "id int")
    assert format_load(spark, source, ledger, tables) == 1
    assert ids(spark, tables) == [1, 2, 3]
    assert read_table(spark, tables, "things").columns == ["id", "_process_time", "_input_file_name"]


def test_tables_landed_as_folders_are_loaded(spark, source, tables, ledger, tmp_path):
    land(spark, source.landing_path, [(1,)], "id long")
    spark.range(5, 9).repartition(2).write.parquet(f"{source.landing_path}/more.parquet")
    assert format_load(spark, source, ledger, tables) == 3
    assert ids(spark, tables) == [1, 5, 6, 7, 8]
    streamed = ParquetTables(str(tmp_path / "streamed"))
    run_available(formatting.format_stream(spark, source, str(tmp_path / "c"), streamed, spark.range(0).schema), 120)
    assert ids(spark, streamed) == [1, 5, 6, 7, 8]


def test_files_logged_for_another_source_are_skipped_too(spark, source, tables, ledger):
    land(spark, source.landing_path, [(1,)], "id int")
    listed = list_files(spark, source.landing_path)
    append_ledger(listed, ledger, "other", datetime.now(timezone.utc))
    assert format_load(spark, source, ledger, tables) == 0


def test_small_chunks_load_every_file(spark, source, tables, ledger):
    for i in range(7):
        land(spark, source.landing_path, [(i,)], "id int")
    assert format_load(spark, source, ledger, tables, files_per_chunk=2) == 7
    assert ids(spark, tables) == list(range(7))
    times = read_table(spark, tables, "things").select("_process_time").distinct()
    assert times.count() == 1


def test_a_load_cut_off_before_its_log_entry_is_finished_once(spark, source, tables, ledger, monkeypatch):
    for i in range(6):
        land(spark, source.landing_path, [(i,)], "id int")
    real, calls = formatting.append_ledger, []

    def cut_off(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(formatting, "append_ledger", cut_off)
    with pytest.raises(RuntimeError):
        format_load(spark, source, ledger, tables, files_per_chunk=1)
    monkeypatch.setattr(formatting, "append_ledger", real)
    land(spark, source.landing_path, [(6,)], "id int")
    format_load(spark, source, ledger, tables, files_per_chunk=3)
    assert ids(spark, tables) == list(range(7))
    assert format_load(spark, source, ledger, tables) == 0


def test_a_load_cut_off_during_its_write_is_finished_once(spark, source, tables, ledger, monkeypatch):
    land(spark, source.landing_path, [(1,)], "id int")
    real = formatting.write_table

    def cut_off(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(formatting, "write_table", cut_off)
    with pytest.raises(RuntimeError):
        format_load(spark, source, ledger, tables)
    monkeypatch.setattr(formatting, "write_table", real)
    assert format_load(spark, source, ledger, tables) == 1
    assert ids(spark, tables) == [1]


def test_a_stream_loads_each_file_once_too(spark, source, tables, tmp_path):
    schema = spark.range(0).schema
    for i in range(3):
        land(spark, source.landing_path, [(i,)], "id long")
        query = formatting.format_stream(spark, source, str(tmp_path / "checkpoint"), tables, schema, files_per_batch=1)
        run_available(query, 120)
    assert ids(spark, tables) == [0, 1, 2]
    loaded = read_table(spark, tables, "things")
    assert loaded.where("_input_file_name LIKE '%.parquet' AND _process_time IS NOT NULL").count() == 3


REGISTRY = [
    {"name": names.LISTINGS_SOURCE, "format": "json", "source_path": "/l", "group_regex": "(\\d{4}).*", "dest_table": names.LISTINGS_TABLE},
    {"name": names.INCOME_SOURCE, "format": "csv", "source_path": "/i", "dest_table": names.INCOME_TABLE},
    {"name": names.COMMERCIAL_SOURCE, "format": "csv", "source_path": "/c", "dest_table": names.COMMERCIAL_TABLE},
    {"name": names.LISTINGS_LOOKUP, "format": "csv", "source_path": "/ll", "dest_table": "unused"},
    {"name": names.OPEN_DATA_LOOKUP, "format": "csv", "source_path": "/lo", "dest_table": "unused"},
]


@pytest.fixture
def registry(spark, tmp_path):
    path = tmp_path / "registry.json"
    path.write_text(json.dumps([{**e, "dest_path_landing": str(tmp_path / "landing" / e["name"])} for e in REGISTRY], indent=2))
    return read_registry(spark, str(path))


def test_registry(registry):
    assert registry.count() == 5
    found = sources_of(select_sources(registry, [names.INCOME_SOURCE, names.LISTINGS_SOURCE, "other"]))
    assert [s.name for s in found] == [names.LISTINGS_SOURCE, names.INCOME_SOURCE]
    assert source_named(registry, names.INCOME_SOURCE).table == names.INCOME_TABLE
    assert registry.where("name = 'idealista'").first().group_regex == "(\\d{4}).*"
    with pytest.raises(KeyError):
        source_named(registry, "other")


def test_all_sources_are_formatted_with_their_own_step(spark, registry, tmp_path, tables, ledger):
    places = ("district string, neighborhood string, district_id string, district_n_reconciled string, "
              "neighborhood_id string, neighborhood_n_reconciled string")
    lookup = [("D", "N", "d1", "D one", "n1", "N one")]
    landing = tmp_path / "landing"
    land(spark, landing / names.LISTINGS_LOOKUP, lookup, places)
    land(spark, landing / names.OPEN_DATA_LOOKUP, lookup, places)
    land(spark, landing / names.LISTINGS_SOURCE, [(1, "D", "N", 10.0, ("flat",), ("t", "s")), (2, "D", None, 20.0, None, None)],
         "id int, district string, neighborhood string, price double, detailedType struct<typology:string>, "
         "suggestedTexts struct<title:string,subtitle:string>")
    land(spark, landing / names.INCOME_SOURCE, [(1, "D", "N", 7.5)], "id int, Nom_Districte string, Nom_Barri string, index_rfid double")
    land(spark, landing / names.COMMERCIAL_SOURCE, [(1, "D", "X", 3, "food")],
         "id int, Nom_Districte string, Nom_Barri string, Codi_Grup_Activitat int, Nom_Grup_Activitat string")

    assert format_sources(spark, registry, ledger, tables) == {
        names.LISTINGS_SOURCE: 1, names.INCOME_SOURCE: 1, names.COMMERCIAL_SOURCE: 1,
    }
    listings = {r.id: r for r in read_table(spark, tables, names.LISTINGS_TABLE).collect()}
    assert listings[1].neighborhood_id == "n1" and listings[2].neighborhood_id is None
    assert listings[1].detailedType == '{"typology":"flat"}' and listings[2].detailedType is None
    assert listings[1].suggestedTexts == '{"title":"t","subtitle":"s"}'
    income = read_table(spark, tables, names.INCOME_TABLE).first()
    assert (income.Nom_Barri, income.neighborhood, income.neighborhood_id) == ("N", "N", "n1")
    commerce = read_table(spark, tables, names.COMMERCIAL_TABLE).first()
    assert (commerce.Nom_Barri, commerce.neighborhood) == ("X", None)
    assert set(format_sources(spark, registry, ledger, tables).values()) == {0}
