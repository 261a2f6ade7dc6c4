"""One schema for files whose column types have drifted apart."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_EXACT_DOUBLE = 2**53
_FOOTERS_PER_TASK = 64


def _footer(path: str) -> tuple[str, list[str]]:
    """The schema a parquet file declares, as text, and its columns of no type, which have no values."""
    try:
        if path.startswith("file:"):
            where, name = pyarrow.fs.LocalFileSystem(), path.removeprefix("file:")
        else:
            where, name = pyarrow.fs.FileSystem.from_uri(path)
        with where.open_input_file(name) as file:
            found = pq.ParquetFile(file)
            own = (found.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
            columns = [found.schema.column(k) for k in range(len(found.schema))]
            declared = str(found.schema).split("\n", 1)[1]  # after a line that names the object
            return f"{declared}{own.decode()}", [c.path for c in columns if str(c.logical_type) == "Null"]
    except (OSError, pyarrow.ArrowInvalid) as failed:
        raise ValueError(f"cannot read the parquet footer of {path}: {failed}") from failed


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        footer, empty = zip(*map(_footer, batch["path"])) if len(batch) else ((), ())
        yield pd.DataFrame({"path": batch["path"], "footer": footer, "empty": empty})


def schema_groups(spark: SparkSession, paths: list[str], recursive: bool = False) -> list[tuple[T.StructType, list[str]]]:
    """The files below some paths by their schema, in order of their first names.

    Tasks read the footers; the driver gets the names, which callers bound, and asks Spark for the schema of one file a group.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(paths).select("path", "length")
    files = files.filter("length > 0").select("path").persist()
    try:
        tasks = max(1, -(-files.count() // _FOOTERS_PER_TASK))
        read = files.repartition(tasks).mapInPandas(_footers, "path string, footer string, empty array<string>")
        rows = read.groupBy("footer", "empty").agg(F.array_sort(F.collect_list("path")).alias("paths")).select("paths", "empty").collect()
    finally:
        files.unpersist()
    found = []
    for group, empty in sorted((r.paths, r.empty) for r in rows):
        fields = spark.read.parquet(group[0]).schema.fields
        found.append((T.StructType([T.StructField(f.name, T.NullType()) if f.name in empty else f for f in fields]), group))
    return found


def widest_schema(groups: list[tuple[T.StructType, str]], case_sensitive: bool = False) -> T.StructType:
    """The columns of all schemas, each in the narrowest type that holds every value; ``groups`` names a file by each schema.

    Integers widen to longer ones, and to doubles or decimals; floats to doubles; decimals to larger ones; dates to timestamps;
    columns without values to anything; structs, arrays and maps by their parts. All else, as text next to numbers,
    is refused with column and files.
    """
    wide, first = T.StructType(), {}
    for schema, file in groups:
        wide = _structs(wide, schema, "", first, file, case_sensitive)
    # A column without a type in any file is read as Spark reads it.
    return T.StructType([T.StructField(f.name, T.IntegerType()) if isinstance(f.dataType, T.NullType) else f for f in wide.fields])


def with_values(schema: T.StructType) -> T.StructType:
    """The columns of a schema that have a type."""
    return T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.NullType)])


def _structs(a: T.StructType, b: T.StructType, prefix: str, first: dict[str, str], file: str, case_sensitive: bool) -> T.StructType:
    def key(name: str) -> str:
        return name if case_sensitive else name.lower()

    fields = {key(f.name): f for f in a.fields}
    for f in b.fields:
        k, path = key(f.name), f"{prefix}{f.name}"
        if k in fields:
            known = fields[k]
            kind = _wider(known.dataType, f.dataType, path, first, file, case_sensitive)
            fields[k] = T.StructField(known.name, kind, True)
        else:
            fields[k] = T.StructField(f.name, f.dataType, True)
        first.setdefault(key(path), file)
    return T.StructType(list(fields.values()))


def _wider(a: T.DataType, b: T.DataType, path: str, first: dict[str, str], file: str, case_sensitive: bool) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _structs(a, b, f"{path}.", first, file, case_sensitive)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType, f"{path}.element", first, file, case_sensitive), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(_wider(a.keyType, b.keyType, f"{path}.key", first, file, case_sensitive),
                         _wider(a.valueType, b.valueType, f"{path}.value", first, file, case_sensitive), True)
    for x, y in ((a, b), (b, a)):
        found = _one_way(x, y, nested="." in path)
        if found is not None:
            return found
    earlier = first.get(path if case_sensitive else path.lower(), "an earlier file")
    raise ValueError(f"column {path}: {a.simpleString()} in {earlier} and {b.simpleString()} in {file} have no common type")


def _one_way(x: T.DataType, y: T.DataType, nested: bool) -> T.DataType | None:
    """The type for values of x and y where y is the wider kind."""
    if isinstance(x, _INTEGERS) and isinstance(y, _INTEGERS):
        return y if _INTEGERS.index(type(y)) > _INTEGERS.index(type(x)) else None
    if isinstance(x, _INTEGERS) and isinstance(y, (T.FloatType, T.DoubleType)):
        return None if nested and isinstance(x, T.LongType) else T.DoubleType()
    if isinstance(x, T.FloatType) and isinstance(y, T.DoubleType):
        return y
    if isinstance(y, T.DecimalType) and isinstance(x, (*_INTEGERS, T.DecimalType)):
        digits, scale = (x.precision - x.scale, x.scale) if isinstance(x, T.DecimalType) else (_DIGITS[type(x)], 0)
        scale = max(scale, y.scale)
        precision = max(digits, y.precision - y.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    if isinstance(x, T.DateType) and isinstance(y, (T.TimestampType, T.TimestampNTZType)):
        return y
    return None


def as_schema(df: DataFrame, wide: T.StructType) -> DataFrame:
    """A frame with the columns of a wider schema: missing ones null, others cast. A long that no double holds exactly fails."""
    targets = {f.name.lower(): f.dataType for f in wide.fields}
    checked = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.LongType) and isinstance(targets.get(f.name.lower()), T.DoubleType):
            value = F.col("`" + f.name.replace("`", "``") + "`")
            wrong = F.raise_error(F.concat(F.lit(f"column {f.name} holds a number that no double equals: "), value.cast("string")))
            checked[f.name] = F.when(value.isNull() | value.between(-_EXACT_DOUBLE, _EXACT_DOUBLE), value.cast("double")).otherwise(wrong.cast("double"))
    return (df.withColumns(checked) if checked else df).to(wide)
