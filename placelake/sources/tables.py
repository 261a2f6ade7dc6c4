"""Tables that jobs read and write: parquet folders or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from placelake.functions.ddl import STRING_AND_BOOLEAN_TYPES, column_types_ddl
from placelake.sources.compaction import live_paths

TypeMap = Mapping[type[T.DataType], str]


@dataclass(frozen=True)
class ParquetTables:
    """Tables as folders below ``root``.

    A write that names its part replaces just that part, so repeating it adds nothing. Parts
    are folders of the table; reads take all files below it, whatever parts they came in. Batches of streams that
    :func:`placelake.sources.compaction.compact` has folded are read from where it put them.
    """

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def part_path(self, table: str, part: Mapping[str, object]) -> str:
        return f"{self.path(table)}/{'/'.join(f'{k}={v}' for k, v in part.items())}"

    def holds(self, spark: SparkSession, table: str, part: Mapping[str, object]) -> bool:
        """Whether a part was written to its end."""
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{self.part_path(table, part)}/_SUCCESS")
        return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
        return reader.option("recursiveFileLookup", True).parquet(*live_paths(spark, self.root, table))

    def write(self, df: DataFrame, table: str, mode: str, part: Mapping[str, object] | None = None,
              type_map: TypeMap = STRING_AND_BOOLEAN_TYPES) -> None:
        if part:
            df.write.mode("overwrite").parquet(self.part_path(table, part))
        else:
            df.write.mode(mode).parquet(self.path(table))


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database.

    ``options`` holds user, password, driver and the like. Database appends have no part to
    replace: a job that is cut off between its write and its log entry writes those rows again.
    ``types`` replaces the column types that jobs ask for, for instance by longer text: text
    beyond the length of its column fails the write.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000
    batch_size: int = 10_000
    write_connections: int | None = None
    types: TypeMap | None = None
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    partitions: int = 1

    def partitioned(self, column: str, lower: object, upper: object, partitions: int) -> JdbcTables:
        """Read over several connections, each taking a stride of ``column`` between the bounds.

        The bounds only place the strides; rows outside them are read as well.
        """
        return replace(self, partition_column=column, lower_bound=str(lower), upper_bound=str(upper), partitions=partitions)

    def read_options(self, table: str) -> dict[str, str]:
        opts = {**self.options, "url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size)}
        if self.partition_column is not None:
            opts |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound),
                "numPartitions": str(self.partitions),
            }
        return opts

    def write_options(self, schema: T.StructType, table: str, type_map: TypeMap) -> dict[str, str]:
        opts = {**self.options, "url": self.url, "dbtable": table, "batchsize": str(self.batch_size)}
        if self.write_connections is not None:
            opts["numPartitions"] = str(self.write_connections)
        ddl = column_types_ddl(schema, type_map if self.types is None else self.types)
        if ddl:
            opts["createTableColumnTypes"] = ddl
        return opts

    def holds(self, spark: SparkSession, table: str, part: Mapping[str, object]) -> bool:
        """A database table keeps no parts, so none is known to be there."""
        return False

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        df = spark.read.format("jdbc").options(**self.read_options(table)).load()
        return df if schema is None else df.to(schema)

    def write(self, df: DataFrame, table: str, mode: str, part: Mapping[str, object] | None = None,
              type_map: TypeMap = STRING_AND_BOOLEAN_TYPES) -> None:
        df.write.format("jdbc").mode(mode).options(**self.write_options(df.schema, table, type_map)).save()


Tables = ParquetTables | JdbcTables


def read_table(spark: SparkSession, tables: Tables, table: str, partition_column: str | None = None,
               partitions: int = 32, schema: T.StructType | None = None) -> DataFrame:
    """Read a table; a database table is split over ``partitions`` by its smallest and largest key.

    Passing ``schema`` saves the job that merges the footers of a large parquet table.
    """
    if isinstance(tables, JdbcTables) and partition_column is not None:
        span = tables.read(spark, f"(SELECT min({partition_column}) AS lo, max({partition_column}) AS hi FROM {table}) span")
        lo, hi = span.first()
        if lo is not None:
            tables = tables.partitioned(partition_column, lo, hi, partitions)
    return tables.read(spark, table, schema)


def write_table(df: DataFrame, tables: Tables, table: str, mode: str = "append",
                part: Mapping[str, object] | None = None, type_map: TypeMap = STRING_AND_BOOLEAN_TYPES) -> None:
    """Write a table, appending or overwriting it; ``part`` names the piece a repeated write replaces."""
    tables.write(df, table, mode, part, type_map)
