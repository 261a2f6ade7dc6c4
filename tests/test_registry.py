import json

import pytest

from placelake.sources.registry import read_registry

ENTRIES = [(f"source {k}", f"/landing/{k}", f"table {k}") for k in range(5)]
FIELDS = "name string, dest_path_landing string, dest_table string"


def found(spark, path):
    return sorted((r.name, r.dest_path_landing, r.dest_table) for r in read_registry(spark, str(path)).collect())


@pytest.mark.parametrize("files", [1, 2, 4, 8])
def test_every_line_of_every_file_counts(spark, tmp_path, files):
    spark.createDataFrame(ENTRIES, FIELDS).repartition(files).write.json(str(tmp_path / "r"))
    assert found(spark, tmp_path / "r") == ENTRIES


@pytest.mark.parametrize("indent", [None, 2])
def test_a_list_and_a_single_document(spark, tmp_path, indent):
    documents = [dict(zip(("name", "dest_path_landing", "dest_table"), e), _id={"$oid": 7}, extra=[1, {"a": None}]) for e in ENTRIES]
    (tmp_path / "list.json").write_text("﻿" + json.dumps(documents[:3], indent=indent), encoding="utf-8")
    (tmp_path / "one.json").write_text(json.dumps(documents[3], indent=indent) + "\n")
    (tmp_path / "lines.json").write_text("\n\r\n" + json.dumps(documents[4]) + "\r\n\r\n")
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "empty.json").write_text("")
    assert found(spark, tmp_path) == ENTRIES


@pytest.mark.parametrize("text", ['{"name": "a"', '{"name": "a"} x', '[{"name": "a"}', '{"name": "a"}]}', "[1]", '"text"', '{"name": "a"}\n{"name"'])
def test_what_is_no_document_is_refused_with_its_file(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('{"name": "b"}')
    (tmp_path / "wrong.json").write_text(text)
    with pytest.raises(Exception, match="wrong.json"):
        read_registry(spark, str(tmp_path)).collect()


def test_missing_fields_are_null(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"name": "a", "dest_table": null}')
    assert [tuple(r) for r in read_registry(spark, str(tmp_path)).collect()] == [("a", None, None, None, None, None, None)]
