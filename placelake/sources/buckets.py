"""Tables of names dealt into buckets, with Bloom filters that tell which buckets may hold some of the names asked for."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelake.operators.joins import bounded_join

#: A filter is cut into blocks of the size that Spark's bitmap aggregate builds; a name's bits lie in one block.
BLOCK_BITS = 32_768
#: Bits per name and hashes per name: about 1 % of the names that a table does not hold look as if it did.
BITS_PER_NAME, HASHES = 12, 6
NAMES_PER_BUCKET, MAX_BUCKETS = 500_000, 4096


@dataclass(frozen=True)
class Buckets:
    """A table of names at ``path``: its rows by bucket, and a filter per block of hashes."""

    path: str
    names: int
    buckets: int
    blocks: int

    def entry(self) -> dict:
        return asdict(self)

    def rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/rows").select(*schema.names)

    def rows_for(self, names: DataFrame, name_col: str, schema: T.StructType) -> DataFrame:
        """The rows of those buckets that may hold one of the names; files of the others are not opened."""
        with_bucket = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        wanted = F.col("bucket").isin(self.may_hold(names, name_col))
        return names.sparkSession.read.schema(with_bucket).parquet(f"{self.path}/rows").where(wanted).drop("bucket")

    def may_hold(self, names: DataFrame, name_col: str) -> list[int]:
        """Numbers of the buckets that may hold one of the names, at most ``MAX_BUCKETS``."""
        name = F.col(f"`{name_col}`")
        asked = names.where(name.isNotNull()).select(_block(name, self.blocks).alias("block"), _places(name).alias("places"))
        filters = names.sparkSession.read.schema("block long, bits binary").parquet(f"{self.path}/filters")
        met = bounded_join(asked, filters, ["block"], "inner", side_bytes=self.blocks * (BLOCK_BITS // 8 + 16))
        hits = met.where(F.forall("places", lambda place: _is_set(F.col("bits"), place)))
        return sorted(r.bucket for r in hits.select((F.col("block") % self.buckets).alias("bucket")).distinct().collect())


def write_buckets(rows: DataFrame, name_col: str, path: str, names_per_bucket: int = NAMES_PER_BUCKET) -> Buckets:
    """Write rows with a name into buckets, then the filters of what was written. The number of both grows with the rows."""
    n = rows.count()
    buckets = max(1, min(MAX_BUCKETS, -(-n // names_per_bucket)))
    made = Buckets(path, n, buckets, buckets * max(1, -(-n * BITS_PER_NAME // (BLOCK_BITS * buckets))))
    name = F.col(f"`{name_col}`")
    dealt = rows.withColumn("bucket", (_block(name, made.blocks) % buckets).cast("int"))
    dealt.repartition(buckets, "bucket").write.partitionBy("bucket").parquet(f"{path}/rows")
    written = made.rows(rows.sparkSession, rows.schema)
    bits = written.select(_block(name, made.blocks).alias("block"), F.explode(_places(name)).alias("place"))
    bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).write.parquet(f"{path}/filters")
    return made


def _block(name: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(blocks))


def _places(name: Column) -> Column:
    """The bits of a name within its block."""
    first, step = (F.pmod(F.xxhash64(name, F.lit(k)), F.lit(BLOCK_BITS)) for k in (1, 2))
    return F.array(*[(first + k * step.bitwiseOR(F.lit(1))) % BLOCK_BITS for k in range(HASHES)])


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, (place % 8).cast("int")) == 1
