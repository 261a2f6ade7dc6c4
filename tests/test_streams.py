import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from placelake.functions.columns import split_message, with_error
from placelake.operators.price_model import fit_price_model, predict
from placelake.plans import names
from placelake.sources.tables import ParquetTables, read_table
from placelake.streaming import sinks
from placelake.streaming.history import StreamHistory
from placelake.streaming.jobs import ingest_prices, score_stream
from placelake.streaming.messages import PRICE_MESSAGE, SCORED_MESSAGE, read_messages
from placelake.streaming.sinks import run_available, stream_to_console, stream_to_memory, stream_to_table

FILES = [
    ["2022-05-22 12:43:23.276091,Q1,371515", "2022-05-22 12:44:00,Q2,10"],
    ["2022-05-22 12:45:00,Q1,cheap", "broken"],
    ["2022-05-22 12:46:00,Q9,30"],
]


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    for i, lines in enumerate(FILES):
        (folder / f"{i}.txt").write_text("\n".join(lines))
    return folder


def messages(spark, inbox):
    return read_messages(spark, "text", {"path": str(inbox), "maxFilesPerTrigger": "1"})


@pytest.fixture
def tables(tmp_path):
    return ParquetTables(str(tmp_path / "tables"))


def run(spark, inbox, tables, checkpoint):
    return run_available(ingest_prices(messages(spark, inbox), tables, str(checkpoint), available_now=True), 120)


def test_read_messages_has_one_text_column(spark, inbox):
    df = messages(spark, inbox)
    assert df.isStreaming and df.dtypes == [("value", "string")]


def test_ingest_equals_the_batch_and_a_restart_adds_nothing(spark, inbox, tables, tmp_path):
    run(spark, inbox, tables, tmp_path / "checkpoint")
    run(spark, inbox, tables, tmp_path / "checkpoint")
    got = read_table(spark, tables, names.MESSAGES_TABLE)
    want = split_message(spark.read.text(str(inbox)), PRICE_MESSAGE)
    assert got.columns == ["value", "date", "neighborhood", "price"]
    assert got.dtypes == want.dtypes
    assert got.count() == 5 and got.exceptAll(want).count() == 0


def test_a_repeated_batch_replaces_itself(spark, inbox, tables, tmp_path, monkeypatch):
    real, seen = sinks.write_table, []

    def fails_after_writing(*args):
        real(*args)
        seen.append(args[4])
        if len(seen) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "write_table", fails_after_writing)
    with pytest.raises(Exception, match="lost"):
        run(spark, inbox, tables, tmp_path / "checkpoint")
    run(spark, inbox, tables, tmp_path / "checkpoint")
    assert seen[1] == seen[2]
    assert read_table(spark, tables, names.MESSAGES_TABLE).count() == 5


def test_a_new_checkpoint_leaves_older_batches_alone(spark, inbox, tables, tmp_path):
    run(spark, inbox, tables, tmp_path / "one")
    other = tmp_path / "other"
    other.mkdir()
    (other / "x.txt").write_text("2022-05-23 00:00:00,Q7,7")
    run(spark, other, tables, tmp_path / "two")
    assert read_table(spark, tables, names.MESSAGES_TABLE).count() == 6


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.createDataFrame([("Q1", 100.0), ("Q1", 200.0), ("Q2", 30.0), ("Q2", 20.0)], "neighborhood_id string, price double")
    return fit_price_model(rows, "neighborhood_id")


def test_score_stream_equals_scoring_the_batch(spark, inbox, tables, tmp_path, model):
    scored = score_stream(messages(spark, inbox), model)
    assert scored.columns == ["date", "neighborhood_id", "price", "prediction", "error"]
    run_available(stream_to_table(scored, tables, "scored", str(tmp_path / "checkpoint"), available_now=True), 120)
    got = read_table(spark, tables, "scored")
    batch = predict(model, split_message(spark.read.text(str(inbox)), SCORED_MESSAGE))
    want = with_error(batch.select("date", "neighborhood_id", "price", "prediction"))
    assert got.count() == 3 and got.exceptAll(want).count() == 0
    assert got.where("neighborhood_id = 'Q1' AND price IS NULL AND error IS NULL").count() == 1


def test_memory_sink_is_queried_by_name(spark, inbox, model):
    query = stream_to_memory(score_stream(messages(spark, inbox), model), "predict")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.sql("SELECT * FROM predict").count() == 3


def test_console_sink(spark, inbox, tmp_path, model):
    scored = score_stream(messages(spark, inbox), model)
    query = run_available(stream_to_console(scored, str(tmp_path / "checkpoint"), available_now=True), 120)
    assert not query.isActive and query.exception() is None


def test_run_available_stops_a_stream_that_goes_on(spark, inbox):
    query = stream_to_memory(messages(spark, inbox), "endless")
    with pytest.raises(TimeoutError):
        run_available(query, 1)
    assert not query.isActive


def test_other_sources_need_a_value_column(spark, inbox):
    rates = read_messages(spark, "rate", {"rowsPerSecond": "1"})
    assert rates.dtypes == [("value", "string")]
    with pytest.raises(AnalysisException):
        read_messages(spark, "kafka", {"kafka.bootstrap.servers": "h:1", "subscribe": "t"})


def both(spark, tables):
    return [sorted(r.value for r in read_table(spark, tables, t).collect()) for t in ("good", "bad")]


def run_routes(spark, inbox, tables, checkpoint):
    stream = ingest_prices(messages(spark, inbox), tables, str(checkpoint), "good", available_now=True, bad_table="bad")
    return run_available(stream, 120)


def test_bad_messages_go_to_a_table_of_their_own(spark, inbox, tables, tmp_path):
    run_routes(spark, inbox, tables, tmp_path / "checkpoint")
    flat = [x for lines in FILES for x in lines]
    assert both(spark, tables) == [sorted(x for x in flat if x not in FILES[1]), sorted(FILES[1])]
    assert read_table(spark, tables, "bad").columns == ["value", "date", "neighborhood", "price"]


def test_a_restart_between_the_two_tables_adds_nothing(spark, inbox, tables, tmp_path, monkeypatch):
    real, calls = sinks.write_table, []

    def fails_before_the_second_table(*args):
        calls.append((args[2], args[4]["batch_id"]))
        if len(calls) == 4:
            raise RuntimeError("lost")
        real(*args)

    monkeypatch.setattr(sinks, "write_table", fails_before_the_second_table)
    with pytest.raises(Exception, match="lost"):
        run_routes(spark, inbox, tables, tmp_path / "checkpoint")
    assert calls[2:4] == [("good", 1), ("bad", 1)]
    run_routes(spark, inbox, tables, tmp_path / "checkpoint")
    assert calls[4] == ("good", 1) and [len(x) for x in both(spark, tables)] == [3, 2]


def test_history_has_a_row_per_batch(spark, inbox, tables, tmp_path):
    history = StreamHistory(spark, tables)
    spark.streams.addListener(history)
    try:
        query = run(spark, inbox, tables, tmp_path / "checkpoint")
        wait_for(lambda: ended(spark, tables, 1))
    finally:
        spark.streams.removeListener(history)
    rows = read_table(spark, tables, "stream_history").collect()
    batches = {r.batch_id: r.input_rows for r in rows if r.batch_id is not None}
    counted = {int(r.b): r["count"] for r in read_table(spark, tables, names.MESSAGES_TABLE).groupBy(
        F.regexp_extract(F.col("_metadata.file_path"), r"batch_id=(\d+)", 1).alias("b")).count().collect()}
    assert batches == counted and sum(batches.values()) == 5 and {r.stream_id for r in rows} == {str(query.id)}


def test_history_tells_of_a_failure(spark, inbox, tables, tmp_path, monkeypatch):
    def fails(*_):
        raise RuntimeError("disk is gone")

    history = StreamHistory(spark, tables)
    spark.streams.addListener(history)
    try:
        monkeypatch.setattr(sinks, "write_table", fails)
        with pytest.raises(Exception, match="disk is gone"):
            run(spark, inbox, tables, tmp_path / "checkpoint")
        wait_for(lambda: ended(spark, tables, 1))
    finally:
        spark.streams.removeListener(history)
    assert any("disk is gone" in (r.failure or "") for r in read_table(spark, tables, "stream_history").collect())


def ended(spark, tables, n):
    try:
        return read_table(spark, tables, "stream_history").where("batch_id IS NULL").count() == n
    except AnalysisException:
        return False


def wait_for(done, seconds=60):
    end = time.monotonic() + seconds
    while not done():
        assert time.monotonic() < end, "not in time"
        time.sleep(0.2)
