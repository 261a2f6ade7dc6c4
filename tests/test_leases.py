import threading

import pytest

from placelake.plans import formatting
from placelake.plans.formatting import format_load
from placelake.sources.leases import Lease, LeaseHeld
from placelake.sources.ledger import ledger_rows
from placelake.sources.registry import Source
from placelake.sources.tables import ParquetTables, read_table


class Clock:
    now = 1000.0

    def __call__(self):
        return self.now


@pytest.fixture
def lease(spark, tmp_path):
    clock = Clock()
    return clock, lambda: Lease(spark, str(tmp_path / "lease"), 60, clock)


def test_one_holder_at_a_time(lease):
    clock, new = lease
    with new() as first:
        with pytest.raises(LeaseHeld, match="60 more seconds"):
            new().__enter__()
        clock.now += 50
        first.renew()
        clock.now += 50
        with pytest.raises(LeaseHeld):
            new().__enter__()
    with new():
        pass


def test_takeover_after_the_lease_ran_out(lease):
    clock, new = lease
    dead = new().__enter__()
    clock.now += 61
    with new() as heir:
        with pytest.raises(LeaseHeld, match="another holder"):
            dead.renew()
        dead.__exit__()  # gives nothing back that is another's
        heir.renew()
        with pytest.raises(LeaseHeld):
            new().__enter__()


def test_two_loads_at_once_log_each_file_once(spark, tmp_path, monkeypatch):
    spark.range(40).repartition(8).write.parquet(str(tmp_path / "landing"))
    source, tables, ledger = Source("s", str(tmp_path / "landing"), "t"), ParquetTables(str(tmp_path / "tables")), str(tmp_path / "ledger")
    inside, go = threading.Event(), threading.Event()
    read = formatting.read_landing

    def slow(*args, **kwargs):
        inside.set()
        go.wait(60)
        return read(*args, **kwargs)

    monkeypatch.setattr(formatting, "read_landing", slow)
    first = threading.Thread(target=format_load, args=(spark, source, ledger, tables))
    first.start()
    assert inside.wait(60)
    with pytest.raises(LeaseHeld):
        format_load(spark, source, ledger, tables)
    go.set()
    first.join()
    assert format_load(spark, source, ledger, tables) == 0
    rows = [r.file_name for r in ledger_rows(spark, ledger).collect()]
    assert len(rows) == len(set(rows)) == 8 and read_table(spark, tables, "t").count() == 40


def test_a_load_that_lost_its_lease_writes_nothing_more(spark, tmp_path, monkeypatch):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "landing"))
    source, tables, ledger = Source("s", str(tmp_path / "landing"), "t"), ParquetTables(str(tmp_path / "tables")), str(tmp_path / "ledger")
    read = formatting.read_landing

    def overtaken(*args, **kwargs):
        monkeypatch.setattr(formatting, "read_landing", read)
        assert format_load(spark, source, ledger, tables) == 2
        return read(*args, **kwargs)

    monkeypatch.setattr(formatting, "read_landing", overtaken)
    with pytest.raises(LeaseHeld):
        format_load(spark, source, ledger, tables, lease_seconds=0)
    assert read_table(spark, tables, "t").count() == 10
