"""Projections over one DataFrame, batch or streaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the two lineage columns.
PROCESS_TIME = "_process_time"
INPUT_FILE = "_input_file_name"

# The only letters folded in column names; every other accented letter stays.
ACCENTED = "áéíóúÁÉÍÓÚ"
FOLDED = "aeiouAEIOU"

# Text that a whole number can be read from; space and control characters around it are ignored.
_WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"

NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType)


def with_lineage(df: DataFrame, at: datetime | None = None, has_file: bool = False) -> DataFrame:
    """Add the processing time and the source file to a file-backed frame.

    ``at`` pins one instant over several reads of the same load; without it every row of the
    query carries the query's own start time. A frame that has the file's column already keeps it if ``has_file``.
    """
    when = F.current_timestamp() if at is None else F.timestamp_micros(F.lit(_epoch_micros(at)))
    if has_file:
        rest = [F.col(quoted(c)) for c in df.columns if c != INPUT_FILE]
        return df.select(*rest, when.alias(PROCESS_TIME), INPUT_FILE)
    return df.withColumn(PROCESS_TIME, when).withColumn(INPUT_FILE, F.col("_metadata.file_path"))


def _epoch_micros(at: datetime) -> int:
    at = at.astimezone()
    return int(at.timestamp()) * 1_000_000 + at.microsecond


def nested_to_json(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Turn nested columns into JSON text; all of them unless ``cols`` names some."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, NESTED_TYPES)]
    wanted = nested if cols is None else list(cols)
    flat = [c for c in wanted if c not in nested]
    if flat:
        raise ValueError(f"not struct, array or map columns of this frame: {flat}")
    return df.withColumns({c: F.to_json(F.col(quoted(c))) for c in wanted}) if wanted else df


def split_message(df: DataFrame, fields: T.StructType, sep: str = ",", column: str = "value") -> DataFrame:
    """Split delimited text into typed columns by position, keeping the text itself.

    A missing or malformed part becomes null instead of failing the query; parts beyond the
    last field are ignored. ``bad_rows`` selects the messages that lost a part.
    """
    parts = F.split(F.col(column), _separator_pattern(sep))
    return df.withColumns({f.name: _read(F.get(parts, F.lit(i)), f.dataType) for i, f in enumerate(fields.fields)})


def _separator_pattern(sep: str) -> str:
    # One character is split on without a regular expression, several times faster.
    if len(sep) == 1:
        return sep if sep.isalnum() else f"\\{sep}"
    return f"\\Q{sep}\\E"


def _read(text: Column, t: T.DataType) -> Column:
    # A failed try_cast to a whole number costs an exception, far more than this check.
    if isinstance(t, T.IntegralType):
        return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast(t))
    return text.try_cast(t)


def is_bad(fields: T.StructType, column: str = "value") -> Column:
    """Whether at least one part of a message was missing or could not be read."""
    return reduce(Column.__or__, [F.col(f.name).isNull() for f in fields.fields], F.col(column).isNull())


def bad_rows(df: DataFrame, fields: T.StructType, column: str = "value") -> DataFrame:
    """Messages of which at least one part was missing or could not be read."""
    return df.where(is_bad(fields, column))


def with_error(df: DataFrame, label: str = "price", prediction: str = "prediction", alias: str = "error") -> DataFrame:
    """Add label minus prediction; a label that is no number gives null."""
    return df.withColumn(alias, F.col(label).try_cast("double") - F.col(prediction))


def fold_name(name: str) -> str:
    return name.translate(str.maketrans(ACCENTED, FOLDED))


def normalize_columns(df: DataFrame, renames: Mapping[str, str] | None = None, last: str | None = None) -> DataFrame:
    """Fold accents in column names, then apply ``renames`` (by folded name) and name the last column.

    Two names that become equal raise, also when they differ by case alone, which Spark
    would not tell apart.
    """
    names = [fold_name(c) for c in df.columns]
    if last is not None and names:
        names[-1] = last
    names = [(renames or {}).get(n, n) for n in names]
    seen: dict[str, str] = {}
    for before, after in zip(df.columns, names):
        if after.lower() in seen:
            raise ValueError(f"columns {seen[after.lower()]!r} and {before!r} both become {after!r}")
        seen[after.lower()] = before
    return df.toDF(*names)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
