"""Equi-joins of a large row set with lookups, group averages and logs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.functions.columns import quoted
from placelake.operators.aggregates import average
from placelake.settings import stored

# Largest side, in bytes of plain values, that is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Into how many parts a key with a quarter of the rows goes when a session does not split hot join partitions itself.
SALTS = 16

_SALT, _COPIES = "__salt", "__copies"
_ROW_OVERHEAD = 16
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}

Keys = Iterable[str] | Mapping[str, str]


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's values, counted by one aggregate over it.

    Catalyst prunes the columns of fixed width, so for numeric sides this is a row count.
    """
    fixed, varying = _ROW_OVERHEAD, F.lit(0)
    for f in df.schema.fields:
        width = _WIDTHS.get(type(f.dataType))
        if width is None:
            value = F.col(quoted(f.name))
            text = value if isinstance(f.dataType, (T.StringType, T.BinaryType)) else value.cast("string")
            varying = varying + F.coalesce(F.octet_length(text), F.lit(0))
        else:
            fixed += width
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(varying), F.lit(0)).alias("v")).first()
    return row.n * fixed + row.v


def bounded_join(rows: DataFrame, side: DataFrame, on: Keys, how: str = "inner",
                 max_bytes: int = BROADCAST_BYTES, salts: int | None = None, side_bytes: int | None = None) -> DataFrame:
    """Join a large row set with a side that is usually, but not surely, small.

    The side is measured first, unless its size is given. Within ``max_bytes`` it is broadcast and the rows are not
    shuffled. Beyond that both sides are shuffled, and the rows of a hot key are spread: by
    Spark's own splitting of skewed partitions, or, where the session has that switched off
    or ``salts`` is given, by salts on the rows of hot keys and copies of these keys' entries.

    ``on`` lists shared key names (one copy kept) or maps row keys to side keys (both kept).
    """
    if (measured_bytes(side) if side_bytes is None else side_bytes) <= max_bytes:
        return _join(rows, F.broadcast(side), on, how)
    if salts is None:
        salts = 1 if _splits_skew(rows) else SALTS
    # The keys of a stream cannot be counted beforehand.
    return _join(rows, side, on, how) if salts == 1 or rows.isStreaming else _salted_join(rows, side, on, how, salts)


def _salted_join(rows: DataFrame, side: DataFrame, on: Keys, how: str, salts: int) -> DataFrame:
    """A shuffled join in which hot keys alone are spread, each over salts by its share of the rows.

    A key is hot if it has more than 1 / (4 * salts) of all rows; there are fewer than 4 * salts of them,
    so their list is small whatever the tables' sizes. Only their entries of the side are copied.
    """
    keys = list(on) if not isinstance(on, Mapping) else list(on.keys())
    side_keys = list(on.values()) if isinstance(on, Mapping) else keys
    counts = rows.groupBy(*[F.col(k).alias(f"__hot{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n")).persist()
    total = counts.agg(F.sum("__n")).first()[0] or 0
    share = max(1, total // (4 * salts))
    hot = counts.where(F.col("__n") > share).withColumn(_COPIES, F.ceil(F.col("__n") / share).cast("int")).drop("__n")
    hot = rows.sparkSession.createDataFrame(hot.collect(), hot.schema)
    counts.unpersist()

    def marked(df: DataFrame, names: list[str]) -> DataFrame:
        same = reduce(Column.__and__, [df[k].eqNullSafe(hot[f"__hot{i}"]) for i, k in enumerate(names)])
        return df.join(F.broadcast(hot), same, "left").drop(*[f"__hot{i}" for i in range(len(names))])

    spread = F.pmod(row_hash(rows), F.coalesce(_COPIES, F.lit(1))).cast("int")
    salted = marked(rows, keys).withColumn(_SALT, spread).drop(_COPIES)
    last = F.coalesce(_COPIES, F.lit(1)) - 1
    copies = marked(side, side_keys).withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop(_COPIES)
    both = {**on, _SALT: _SALT} if isinstance(on, Mapping) else [*on, _SALT]
    joined = _join(salted, copies, both, how)
    return joined.drop(salted[_SALT]).drop(copies[_SALT]) if isinstance(on, Mapping) else joined.drop(_SALT)


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's content and partition.

    A repeated task sends each row the same way as before, and copies of one row, which have
    nothing else to tell them apart, part by the partitions they lie in.
    """
    cols = [F.col(quoted(f.name)) if not _holds_map(f.dataType) else F.col(quoted(f.name)).cast("string")
            for f in df.schema.fields]
    return F.xxhash64(*cols, F.spark_partition_id())


def reconcile(df: DataFrame, lookup: DataFrame, on: Keys, on_duplicate: str = "expand",
              max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Left join of rows with a lookup table; rows without a match keep null lookup columns.

    A key that the lookup holds twice doubles its rows ("expand"), is refused ("error"), or
    counts once with its smallest entry ("first").
    """
    keys = list(on.values()) if isinstance(on, Mapping) else list(on)
    if on_duplicate == "first":
        lookup = _one_per_key(lookup, keys)
    elif on_duplicate == "error":
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        twice = lookup.where(known).groupBy(*keys).count().where(F.col("count") > 1).first()
        if twice is not None:
            raise ValueError(f"lookup key {tuple(twice)[:-1]} occurs {twice['count']} times")
    elif on_duplicate != "expand":
        raise ValueError(f"on_duplicate is 'expand', 'error' or 'first', not {on_duplicate!r}")
    return bounded_join(df, lookup, on, "left", max_bytes)


def group_averages(measures: DataFrame, key: str, column: str, alias: str, decimals: int | None = None) -> DataFrame:
    """The average of ``column`` per non-null key, persisted, so that later steps read the measures no more.

    The caller may unpersist it. ``decimals`` makes the averages exact.
    """
    return measures.where(F.col(key).isNotNull()).groupBy(key).agg(average(column, decimals).alias(alias)).persist()


def attach_averages(rows: DataFrame, averages: DataFrame, key: str, alias: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Give each row the average of its key, as float32; rows of a key without one are dropped."""
    return bounded_join(rows, averages, [key], "inner", max_bytes).withColumn(alias, F.col(alias).cast("float"))


def attach_group_avg(rows: DataFrame, measures: DataFrame, key: str, column: str, alias: str,
                     max_bytes: int = BROADCAST_BYTES, decimals: int | None = None) -> DataFrame:
    """Give each row the average of ``column`` over the measures of its key, as float32.

    Rows whose key has no measures are dropped; a key with only null measures gives null. The averages are kept in the
    shared folder: the measures are read once, and nothing is left persisted.
    """
    known = measures.where(F.col(key).isNotNull())
    averages = stored(known.groupBy(key).agg(average(column, decimals).alias(alias)), "averages")
    return attach_averages(rows, averages, key, alias, max_bytes)


def pending_files(listing: DataFrame, ledger: DataFrame, key: str = "file_name") -> DataFrame:
    """Listed files that the ledger does not hold."""
    return listing.join(ledger.select(key), key, "left_anti")


def _join(rows: DataFrame, side: DataFrame, on: Keys, how: str) -> DataFrame:
    if not isinstance(on, Mapping):
        return rows.join(side, list(on), how)
    return rows.join(side, reduce(Column.__and__, [rows[a] == side[b] for a, b in on.items()]), how)


def _one_per_key(lookup: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in lookup.columns if c not in keys]
    if not rest:
        return lookup.distinct()
    return (
        lookup.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("__least"))
        .select(*[c if c in keys else F.col(f"__least.{c}").alias(c) for c in lookup.columns])
    )


def _splits_skew(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        conf.get(name, "true") == "true"
        for name in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _holds_map(t.elementType)
    return isinstance(t, T.StructType) and any(_holds_map(f.dataType) for f in t.fields)
