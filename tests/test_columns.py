from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.functions.columns import (
    bad_rows,
    fold_name,
    nested_to_json,
    normalize_columns,
    split_message,
    with_error,
    with_lineage,
)
from placelake.functions.ddl import STRING_TYPES, column_types_ddl
from placelake.streaming.messages import PRICE_MESSAGE


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_split_message_reads_good_rows_and_nulls_the_rest(spark):
    rows = split_message(
        messages(
            spark,
            "2022-05-22 12:43:23.276091,Q3751076,371515",
            "2022-05-22 12:43:23,Q1",
            "2022-05-22 12:43:23,Q1,10,more",
            "2022-05-22 12:43:23,Q1,dear",
            "2022-05-22 12:43:23,Q1, 12 ",
            "2022-05-22 12:43:23,Q1,99999999999",
            "2022-05-22 12:43:23,Q1,1.5",
            "soon,Q1,5",
            "",
            None,
        ),
        PRICE_MESSAGE,
    ).collect()
    assert rows[0].date == datetime(2022, 5, 22, 12, 43, 23, 276091)
    assert [r.price for r in rows] == [371515, None, 10, None, 12, None, None, 5, None, None]
    assert [r.neighborhood for r in rows][:2] == ["Q3751076", "Q1"]
    assert rows[7].date is None and rows[8].neighborhood is None and rows[9].neighborhood is None
    assert rows[0].value.endswith("371515")


def test_split_message_takes_the_separator_literally(spark):
    fields = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())])
    assert split_message(messages(spark, "x.|-5"), fields, ".|").select("a", "b").first() == ("x", -5)


@pytest.mark.parametrize("sep", [",", "|", ".", "\\", "\t", " ", "x", "é", "^", "::", "$*"])
def test_every_separator_is_taken_literally(spark, sep):
    fields = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    row = split_message(messages(spark, sep.join(["1-2", "", "3"])), fields, sep).first()
    assert (row.a, row.b, row.c) == ("1-2", "", "3")


def test_the_number_check_agrees_with_a_plain_cast(spark):
    texts = ["1", "+1", "-1", "--1", " 7\t", "\n8", "", "+", "1e3", "0x1", "1_000", "9223372036854775807",
             "9223372036854775808", "１", " 1", "1\x7f", "1 2", None]
    fields = T.StructType([T.StructField("n", T.LongType())])
    rows = split_message(messages(spark, *texts), fields, "|").select("n", F.col("value").try_cast("bigint").alias("plain"))
    assert all(r.n == r.plain for r in rows.collect())


def test_bad_rows_are_those_that_lost_a_part(spark):
    df = split_message(messages(spark, "2022-05-22 12:43:23,Q1,10", "x,Q1,10", None, ""), PRICE_MESSAGE)
    assert {r.value for r in bad_rows(df, PRICE_MESSAGE).collect()} == {"x,Q1,10", None, ""}


def test_with_error_reads_text_labels(spark):
    df = spark.createDataFrame([("10", 4.0), ("ten", 4.0), (None, 4.0)], "price string, prediction double")
    assert [r.error for r in with_error(df).collect()] == [6.0, None, None]


def test_nested_to_json(spark):
    schema = "id int, s struct<a:int,b:string>, l array<int>, m map<string,int>, t string"
    df = spark.createDataFrame([(1, (1, None), [], {"k": 2}, "x"), (2, None, [1, 2], {}, "y")], schema)
    rows = nested_to_json(df).collect()
    assert rows[0] == (1, '{"a":1}', "[]", '{"k":2}', "x")
    assert rows[1] == (2, None, "[1,2]", "{}", "y")
    assert nested_to_json(df, ["s"]).schema["l"].dataType == T.ArrayType(T.IntegerType())
    with pytest.raises(ValueError, match="t"):
        nested_to_json(df, ["s", "t"])


def test_nested_to_json_without_nested_columns(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert nested_to_json(df).columns == ["id"]


def test_fold_name_folds_five_vowels_only():
    assert fold_name("áéíóúÁÉÍÓÚ") == "aeiouAEIOU"
    assert fold_name("ñçàüÑÇÀÜ") == "ñçàüÑÇÀÜ"


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Població", "Renda Família", "Índex"])
    assert normalize_columns(df, last="index_rfid").columns == ["Poblacio", "Renda Familia", "index_rfid"]
    assert normalize_columns(df, {"Poblacio": "p"}).columns == ["p", "Renda Familia", "Index"]
    clash = spark.createDataFrame([(1, 2)], ["preu_á", "PREU_A"])
    with pytest.raises(ValueError, match="preu_á"):
        normalize_columns(clash)


def test_with_lineage(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(10).repartition(2).write.parquet(path)
    rows = with_lineage(spark.read.parquet(path)).collect()
    assert len({r._process_time for r in rows}) == 1
    assert all(r._input_file_name.startswith("file:/") and r._input_file_name.endswith(".parquet") for r in rows)
    at = datetime(2024, 2, 3, 4, 5, 6, 789012, tzinfo=timezone.utc)
    pinned = with_lineage(spark.read.parquet(path), at).select(F.unix_micros("_process_time")).distinct().collect()
    assert [r[0] for r in pinned] == [int(at.timestamp()) * 1_000_000 + 789012]


def test_column_types_ddl(spark):
    schema = T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("open `now`", T.BooleanType()),
            T.StructField("n", T.LongType()),
        ]
    )
    ddl = column_types_ddl(schema)
    assert ddl == "`name` VARCHAR(1024), `open ``now``` BOOLEAN"
    parsed = T.StructType.fromDDL(ddl)
    assert parsed.fieldNames() == ["name", "open `now`"]
    assert column_types_ddl(schema, STRING_TYPES) == "`name` VARCHAR(1024)"
    assert column_types_ddl(schema, {T.StringType: "VARCHAR(4000)"}) == "`name` VARCHAR(4000)"
    assert column_types_ddl(T.StructType([T.StructField("n", T.LongType())])) == ""
