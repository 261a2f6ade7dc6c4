"""Reading tables, intermediate tables in the shared folder, row keys and links between rows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelake.settings import shared_root

#: Stands for a null document id in joins and orders; the smallest long.
NO_ID = -(2**63)
#: A side is broadcast only if its measured size is within this many bytes.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one run, below the shared folder.

    Tables are dropped as soon as they are used up; what a lazy result still reads goes when the
    session ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid4().hex}"
        self._fs().deleteOnExit(self._path(self.root))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a frame and read it back: later jobs start from the files, whatever is lost."""
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs().delete(self._path(f"{self.root}/{name}"), True)


def id_key(id_col: str) -> Column:
    """The id, null as the smallest long."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))


def text_of(text_col: str) -> Column:
    """The text, null as the empty one."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Rows as ``_id``, ``_h`` (a hash of the text) and ``_text``, with further columns if wanted.

    ``(_id, _h)`` identifies a row up to rows equal in id and text, which every operator treats alike.
    Other columns are not taken, so none of their names can clash.
    """
    text = text_of(text_col)
    return docs.select(id_key(id_col).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"), *more)


def keys_of(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The keys of every row, repeated rows included."""
    return docs.select(id_key(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_h"), *more)


def wrapped(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Whole rows as ``_row`` next to their keys: no column of theirs can clash with those of an operator."""
    return docs.select(F.struct("*").alias("_row"), id_key(id_col).alias("_id"), F.xxhash64(text_of(text_col)).alias("_h"), *more)


def with_text(rows: DataFrame, text: Column, text_col: str, chars_col: str = "n_chars") -> DataFrame:
    """Wrapped rows with another text, unwrapped; a column with the text's length follows it."""
    fields = rows.select("_row.*").columns
    row = F.col("_row").withField(f"`{text_col}`", F.col("_new"))
    if chars_col in fields:
        row = row.withField(f"`{chars_col}`", F.length("_new").cast("long"))
    return rows.withColumn("_new", text).withColumn("_row", row).select("_row.*")


def plain_id(name: str = "_id") -> Column:
    """The document id as it was, null included."""
    return F.when(F.col(name) != NO_ID, F.col(name))


def components(links: DataFrame, scratch: Scratch, label: str, max_rounds: int = 60) -> DataFrame:
    """The connected components of links (``a``, ``b``: long): a row (``node``, ``root``) per linked node.

    Each round every node takes the smallest root among its neighbours', then the root of its root;
    chains thus shorten exponentially. A round is a few joins over the links, cut by a written table.
    Links are first reduced to one direction and to distinct pairs; loops are dropped, so a node
    without another one has no row.
    """
    pairs = links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = scratch.write(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{label}-edges")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = scratch.write(roots.select("node", F.least("node", "root").alias("root")), f"{label}-0")
    for k in range(1, max_rounds + 1):
        near = (edges.join(roots.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        # A root also takes the smallest root seen by any of its members: whole trees hook at once.
        seen = roots.join(near, "node")
        hooked = seen.groupBy(F.col("root").alias("node")).agg(F.min("near").alias("hook"))
        step = (seen.join(hooked, "node", "left")
                .select("node", F.least("root", "near", F.coalesce("hook", "root")).alias("to"), F.col("root").alias("was")))
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moved = step.join(jump, "to", "left").select("node", F.least("to", F.coalesce("next", "to")).alias("root"), "was")
        moved = scratch.write(moved, f"{label}-{k}")
        changed = moved.filter("root != was").limit(1).count()
        scratch.drop(f"{label}-{k - 1}")
        roots = moved.select("node", "root")
        if not changed:
            return roots
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
