"""Column types a database table is created with."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from placelake.functions.columns import quoted

# The type texts tables are created with.
STRING_TYPES: Mapping[type[T.DataType], str] = {T.StringType: "VARCHAR(1024)"}
STRING_AND_BOOLEAN_TYPES: Mapping[type[T.DataType], str] = {
    T.StringType: "VARCHAR(1024)",
    T.BooleanType: "BOOLEAN",
}


def column_types_ddl(schema: T.StructType, type_map: Mapping[type[T.DataType], str] = STRING_AND_BOOLEAN_TYPES) -> str:
    """DDL for the columns whose type is mapped; empty if there are none."""
    return ", ".join(
        f"{quoted(f.name)} {type_map[type(f.dataType)]}"
        for f in schema.fields
        if type(f.dataType) in type_map
    )
