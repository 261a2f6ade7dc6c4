"""Load new landing files into formatted tables, each file once."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timezone
from functools import partial
from math import ceil
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from placelake.functions.columns import INPUT_FILE, nested_to_json, with_lineage
from placelake.operators.joins import reconcile
from placelake.plans import names
from placelake.settings import stored
from placelake.sources.files import list_files, read_landing, read_lookup
from placelake.sources.ledger import append_ledger, chunk_files, claim_files, end_load, fold_ledger, lease_path, open_chunks, unlogged
from placelake.sources.leases import Lease
from placelake.sources.registry import Source, source_named, sources_of, select_sources
from placelake.sources.tables import Tables, write_table
from placelake.streaming.sinks import stream_to_table

_LOG = logging.getLogger(__name__)

Step = Callable[[DataFrame], DataFrame]

# Files read by one write; bounds the path list the driver holds, not what a load covers.
FILES_PER_CHUNK = 10_000
# How long a load may take over one chunk before another load may take over from it.
LEASE_SECONDS = 2 * 3600


def format_listings(df: DataFrame, lookup: DataFrame, json_columns: Iterable[str] | None = None) -> DataFrame:
    """Reconcile the places of listings and flatten their nested columns to JSON text."""
    return nested_to_json(reconcile(df, lookup, names.LISTING_KEYS), json_columns)


def format_income(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Reconcile the places of an open-data table, which names its keys in its own way."""
    return reconcile(df, lookup, names.OPEN_DATA_KEYS)


format_commercial = format_income


def format_load(spark: SparkSession, source: Source, ledger: str, tables: Tables, step: Step | None = None,
                schema: T.StructType | None = None, files_per_chunk: int = FILES_PER_CHUNK, pattern: str | None = None,
                lease_seconds: float = LEASE_SECONDS) -> int:
    """Load the files of a source that the ledger does not hold; returns how many were logged.

    The landing folder is searched to any depth, so a table that landed as a folder counts by
    its part files.

    Files are claimed in chunks before they are read. Each chunk is one distributed read and
    write into its own part of the table, then its files are logged. A load that was cut off
    is finished first, over the same chunks, so a parquet table ends up with every file once. Claimed
    files that have gone meanwhile are reported and logged, so that they hold up no later load. Files of any
    name count; one that is no parquet fails the load with its name.

    A source has one load at a time: a second one raises LeaseHeld. The lease of a load that died runs out ``lease_seconds`` after
    its last chunk, which a chunk must not outlast.
    """
    with Lease(spark, lease_path(ledger, source.name), lease_seconds) as lease:
        at = datetime.now(timezone.utc)
        load = partial(_load_chunk, spark, source, ledger, tables, step, schema, at, lease)
        listing = stored(list_files(spark, source.landing_path, pattern, recursive=True).select("file_name"), "listing")
        cut_off = open_chunks(spark, ledger, source.name)
        done = 0
        if cut_off:
            there = listing if pattern is None else list_files(spark, source.landing_path, recursive=True).select("file_name")
            done = sum(load(*c, there) for c in cut_off)
        for load_id in {load for load, _ in cut_off}:
            end_load(spark, ledger, source.name, load_id)
        files = unlogged(listing, ledger).select("file_name").persist()
        load_id, chunks = f"load-{uuid4().hex}", ceil(files.count() / files_per_chunk)
        if chunks > 0:
            claim_files(files, ledger, source.name, load_id, chunks)
        files.unpersist()
        if chunks > 0:
            done += sum(load(load_id, c, None) for c in range(chunks))
            end_load(spark, ledger, source.name, load_id)
        fold_ledger(spark, ledger)
        return done


def _load_chunk(spark: SparkSession, source: Source, ledger: str, tables: Tables, step: Step | None, schema: T.StructType | None,
                at: datetime, lease: Lease, load_id: str, chunk: int, listing: DataFrame | None) -> int:
    """One chunk; claims of this load are on its own listing, those of one that was cut off are looked up in ``listing``."""
    lease.renew()
    files = chunk_files(spark, ledger, source.name, load_id, chunk)
    part = {"load_id": f"{load_id}-{chunk}"}
    if tables.holds(spark, source.table, part):
        # Written before it was cut off. Writing it anew could lose files that are gone by now.
        append_ledger(files, ledger, source.name, at)
        return files.count()
    there = F.lit(True).alias("there")
    claimed = files.select("file_name", there) if listing is None else files.join(listing.select("file_name", there), "file_name", "left")
    paths, gone = [], []
    for r in claimed.toLocalIterator():
        (paths if r.there else gone).append(r.file_name)
    if gone:
        _LOG.warning("%s: %d claimed files are gone: %s", source.name, len(gone), ", ".join(sorted(gone)))
    if paths:
        df = with_lineage(read_landing(spark, paths, schema, INPUT_FILE), at, has_file=True)
        lease.renew()
        write_table(df if step is None else step(df), tables, source.table, "append", part)
    append_ledger(files, ledger, source.name, at)
    return len(paths)


def format_stream(spark: SparkSession, source: Source, checkpoint: str, tables: Tables, schema: T.StructType,
                  step: Step | None = None, files_per_batch: int = FILES_PER_CHUNK) -> StreamingQuery:
    """The same load with a stream's checkpoint for a ledger: takes the files that are there, then ends."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    df = with_lineage(reader.option("recursiveFileLookup", True).parquet(source.landing_path))
    return stream_to_table(df if step is None else step(df), tables, source.table, checkpoint, available_now=True)


def format_steps(spark: SparkSession, registry: DataFrame) -> dict[str, Step]:
    """The step of each known source, over the newest lookup table of its registry entry."""

    def lookup(name: str) -> DataFrame:
        return read_lookup(spark, source_named(registry, name).landing_path)

    return {
        names.LISTINGS_SOURCE: lambda df: format_listings(df, lookup(names.LISTINGS_LOOKUP), names.LISTING_JSON),
        names.INCOME_SOURCE: lambda df: format_income(df, lookup(names.OPEN_DATA_LOOKUP)),
        names.COMMERCIAL_SOURCE: lambda df: format_commercial(df, lookup(names.OPEN_DATA_LOOKUP)),
    }


def format_sources(spark: SparkSession, registry: DataFrame, ledger: str, tables: Tables,
                   wanted: Iterable[str] = (names.LISTINGS_SOURCE, names.INCOME_SOURCE, names.COMMERCIAL_SOURCE),
                   schemas: Mapping[str, T.StructType] | None = None) -> dict[str, int]:
    """Load the new files of the wanted sources; returns the number of files per source.

    ``schemas`` gives the columns of a source by its name, which saves reading the footers of all files.
    """
    steps = format_steps(spark, registry)
    return {
        source.name: format_load(spark, source, ledger, tables, steps.get(source.name), (schemas or {}).get(source.name))
        for source in sources_of(select_sources(registry, wanted))
    }
