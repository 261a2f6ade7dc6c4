import os

import pytest

from placelake.sources import compaction
from placelake.sources.commits import CommitConflict, CommitLog
from placelake.sources.compaction import compact
from placelake.sources.tables import ParquetTables, read_table, write_table


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path))


def batch(spark, tables, stream, number, *values):
    df = spark.createDataFrame([(v,) for v in values], "n long")
    write_table(df, tables, "t", part={"stream_id": stream, "batch_id": number})


def values(spark, tables):
    return sorted(r.n for r in read_table(spark, tables, "t").collect())


def test_folds_leave_the_newest_batch_and_later_ones_add_to_them(spark, tables):
    assert compact(spark, tables.root, "t") == 0
    for k in range(5):
        batch(spark, tables, "a", k, k, 10 + k)
    batch(spark, tables, "b", 0, 100)
    write_table(spark.createDataFrame([(200,)], "n long"), tables, "t", part={"load_id": "x"})
    want = sorted([0, 1, 2, 3, 4, 10, 11, 12, 13, 14, 100, 200])
    assert values(spark, tables) == want
    assert compact(spark, tables.root, "t") == 4 and values(spark, tables) == want
    assert compact(spark, tables.root, "t") == 0
    for k in range(5, 8):
        batch(spark, tables, "a", k, k)
    assert compact(spark, tables.root, "t") == 3
    assert values(spark, tables) == sorted([*want, 5, 6, 7])
    left = os.listdir(f"{tables.root}/t/stream_id=a")
    assert "batch_id=7" in left and "batch_id=0" not in left
    assert len([p for p in compaction.live_paths(spark, tables.root, "t") if "_folded" in p]) == 1


def test_a_repeated_batch_adds_nothing(spark, tables):
    for k in range(4):
        batch(spark, tables, "a", k, k)
    compact(spark, tables.root, "t")
    batch(spark, tables, "a", 1, 1)
    assert values(spark, tables) == [0, 1, 2, 3] == values(spark, tables)
    batch(spark, tables, "a", 3, 3)  # the newest one, in full once more
    batch(spark, tables, "a", 4, 4)
    compact(spark, tables.root, "t")
    batch(spark, tables, "a", 0, 0)
    batch(spark, tables, "a", 5, 5)
    compact(spark, tables.root, "t")
    assert values(spark, tables) == [0, 1, 2, 3, 4, 5]


def test_a_reader_of_before_ends(spark, tables):
    for k in range(4):
        batch(spark, tables, "a", k, k)
    before = read_table(spark, tables, "t")
    compact(spark, tables.root, "t")
    assert sorted(r.n for r in before.collect()) == [0, 1, 2, 3]


def test_one_of_two_folds_counts(spark, tables, monkeypatch):
    for k in range(4):
        batch(spark, tables, "a", k, k)
    commit = CommitLog.commit

    def late(self, number, entry):
        monkeypatch.setattr(CommitLog, "commit", commit)
        compact(spark, tables.root, "t")
        commit(self, number, entry)

    monkeypatch.setattr(CommitLog, "commit", late)
    with pytest.raises(CommitConflict):
        compact(spark, tables.root, "t")
    assert values(spark, tables) == [0, 1, 2, 3] and len(os.listdir(f"{tables.root}/_folded/t")) == 1


def test_large_folds_are_not_folded_again(spark, tables):
    for k in range(3):
        batch(spark, tables, "a", k, k)
    compact(spark, tables.root, "t", file_bytes=1)
    folded = os.listdir(f"{tables.root}/_folded/t")
    batch(spark, tables, "a", 3, 3)
    compact(spark, tables.root, "t", file_bytes=1)
    assert set(folded) < set(os.listdir(f"{tables.root}/_folded/t")) and values(spark, tables) == [0, 1, 2, 3]
