"""WARC archives of pages, and a two-level capture index over them.

A record is a gzip member of its own, as web archives have it, so that its byte range alone gives it. Archives are written by
Spark's text source: a member is a row without its last byte, which the line separator supplies. They are scanned
for the index as whole files of a bounded size; captures are then read by their ranges alone.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placelake.llm.url_filter import lower_ascii

_END = "\r\n\r\n"
#: The last byte of a member: of its unpacked size, whose highest byte is zero below 16 MB.
_LAST = "\0"
_SCANNED, _SALTS = 1 << 16, 16
#: Ranges no further apart are read at once, in reads of about this size at most.
_READ_GAP, _READ_BYTES = 4096, 4 << 20
# Ids pass through Python as text: as numbers with nulls among them they would become inexact.
_ENTRY = ("key string, page_id string, record_type string, digest string, payload_bytes long, refers_to string, "
          "file string, offset long, length long")
_FIELDS = [x.split()[0] for x in _ENTRY.split(", ")]
_BLOCK = "part int, block int, first_key string, last_key string, n long, lines binary"


def reversed_host_key(url: Column) -> Column:
    """The URL with its host's parts in reverse, so that captures of a domain sort next to each other.

    White space and the like are escaped: a key is one word of an index line. Null gives an empty key.
    """
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    rest = F.regexp_replace(url, r"(?s)^.*?://[^/?#]*", "")
    turned = F.concat(F.array_join(F.reverse(F.split(lower_ascii(host), r"\.")), ","), F.lit(")"), rest)
    return F.coalesce(F.url_encode(turned), F.lit(""))


def header_uri(url: Column) -> Column:
    """The URL as a record's header holds it, in one line; null is empty."""
    return F.coalesce(F.replace(F.replace(url.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(""))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            least: int = 1000) -> DataFrame:
    """A row per page: uri, page_id, payload, its size and digest, record type and what it refers to.

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is the response
    and the others revisit it; rows that share this id are all responses. Smaller payloads are all
    responses. Null payload: empty. Null id: below every other; a payload that only null ids have is a
    response. The copies of a payload are combined on the map side; rows then join on the digest.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("digest"),
    )
    first = rows.filter(F.col("payload_bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("n"))
    rows = rows.join(first.filter("n > 1 AND target IS NOT NULL").select("digest", "target"), "digest", "left")
    again = F.coalesce((F.col("target").isNotNull()) & ~F.col("page_id").eqNullSafe(F.col("target")), F.lit(False))
    return rows.select(
        header_uri(F.col("url")).alias("uri"), "page_id", "payload", "payload_bytes", "digest",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("target")).alias("refers_to"),
    )


def record_text(date: str) -> Column:
    """A record. Revisits have no payload of their own."""
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    lines = [
        F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")), F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Bytes: "), F.col("payload_bytes").cast("string")),
        F.when(F.col("record_type") == "revisit", F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), body, F.lit(_END))


def _member(record: bytes) -> bytes:
    """A record as a gzip member whose last byte is zero; for a very large one, an empty member follows that has it."""
    packed = gzip.compress(record, 6, mtime=0)
    return packed if packed[-1] == 0 else packed + gzip.compress(b"", 6, mtime=0)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"member": [_member(r.encode("utf-8", "surrogatepass"))[:-1] for r in batch["value"]]})


def write_archives(rows: DataFrame, path: str, file_bytes: int = 16 << 20, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write records as WARC files of about ``file_bytes`` before compression.

    The partitions of the records are kept, and cut into files by a number of records that comes from their
    mean size. Every record is a gzip member, and a file is what any reader of such archives takes.
    """
    mean = rows.agg(F.avg("payload_bytes")).first()[0] or 0
    records_per_file = max(1, int(file_bytes // (mean + 500)))
    members = rows.select(record_text(date).alias("value")).mapInPandas(_members, "member binary")
    (members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", _LAST)
     .option("maxRecordsPerFile", records_per_file).text(path))


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def parse_header(data: bytes | memoryview) -> tuple[dict[str, str], int]:
    """A record's header fields and where its body starts."""
    head = bytes(data[:1 << 16])
    end = head.find(b"\r\n\r\n")
    if end < 0:
        head = bytes(data)
        end = head.find(b"\r\n\r\n")
    lines = head[:end].decode("utf-8").split("\r\n")
    if end < 0 or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(x.split(": ", 1) for x in lines[1:]), end + 4


def _page(urn: str | None) -> str | None:
    page = (urn or "none").removeprefix("<urn:page:").removesuffix(">")
    return None if page == "none" else page


def members(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """Start, length and what it unpacks to, of each member of an archive; empty members are passed over."""
    at = 0
    while at < len(data):
        unpack, out, end = zlib.decompressobj(wbits=31), [], at
        while not unpack.eof:
            chunk = data[end:end + _SCANNED]
            if not len(chunk):
                raise ValueError(f"an archive's member at {at} is cut off")
            out.append(unpack.decompress(chunk))
            end += len(chunk) - len(unpack.unused_data)
        record = b"".join(out)
        if record:
            yield at, end - at, record
        at = end


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for file, content in zip(batch["path"], batch["content"]):
            rows = []
            for at, length, record in members(memoryview(content)):
                fields, _ = parse_header(record)
                rows.append((fields["WARC-Target-URI"], _page(fields["WARC-Record-ID"]), fields["WARC-Type"],
                             fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Bytes"]),
                             _page(fields.get("WARC-Refers-To")), file, at, length))
            yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_FIELDS)


def _with_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def capture_entries(files: DataFrame) -> DataFrame:
    """A row per record of the archives: what its header says and its byte range."""
    found = _with_numbers(files.select("path", "content").mapInPandas(_entries, _ENTRY))
    return found.withColumn("key", reversed_host_key(F.col("key")))  # made of the URL that the header gives


def _blocks(block_lines: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = 0, []
        def block(rows):
            nonlocal number
            text = "".join("\t".join("" if pd.isna(x) else str(x) for x in r) + "\n" for r in rows)
            out = pd.DataFrame([(rows[0][0], number, rows[0][1], rows[-1][1], len(rows),
                                 gzip.compress(text.encode(), 6, mtime=0))], columns=[x.split()[0] for x in _BLOCK.split(", ")])
            number += 1
            return out
        for batch in batches:
            held.extend(batch[["part", *_FIELDS]].itertuples(index=False, name=None))
            while len(held) >= block_lines:
                yield block(held[:block_lines])
                del held[:block_lines]
        if held:
            yield block(held)
    return run


def index_blocks(entries: DataFrame, block_lines: int = 3000) -> DataFrame:
    """The lower level: entries sorted by key over range partitions, cut into compressed blocks.

    The sort also takes page and place, so captures of one key, however many, are split between
    partitions and blocks. A block holds its key range, its compressed lines and its number.
    """
    order = ["key", "page_id", "file", "offset"]
    ranged = entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
    text = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    return ranged.withColumns(text).mapInPandas(_blocks(block_lines), _BLOCK)


def directory(blocks: DataFrame) -> DataFrame:
    """The upper level: a row per block, without its lines."""
    return blocks.select("part", "block", "first_key", "last_key", "n")


def _lines(content: bytes) -> list[tuple]:
    rows = []
    for line in gzip.decompress(content).decode().splitlines():
        _, key, page, kind, digest, size, refers, file, offset, length = line.split("\t")
        rows.append((key, page or None, kind, digest, int(size), refers or None,
                     file, int(offset), int(length)))
    return rows


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["lines"]:
            yield _frame(_lines(content))


def read_entries(blocks: DataFrame) -> DataFrame:
    """All entries of an index, in the order of its blocks."""
    return _with_numbers(blocks.select("lines").mapInPandas(_unpacked, _ENTRY))


def named_blocks(blocks: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The blocks (part, block) that may hold captures of wanted URLs, by binary search in two steps.

    Of each range partition of the index, the executors hold the key range, and find the parts of each wanted key. Then keys
    and directory meet part by part, keys of a part spread over a few tasks, and are searched in the directory's rows.
    """
    wanted, rows = wanted_keys(urls, url_col), directory(blocks)
    edges = rows.groupBy("part").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last"))
    top = sorted((r["first"], r["last"], r["part"]) for r in edges.collect())  # a row per partition of the index's sort
    held = urls.sparkSession.sparkContext.broadcast(top)

    def parts_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [(key, part) for key in batch["key"] for part in _around(held.value, key)]
            yield pd.DataFrame(hits, columns=["key", "part"])

    def blocks_of(keys: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        order = sorted(zip(own["first_key"], own["last_key"], own["block"]))
        hits = {block for key in keys["key"] for block in _around(order, key)} if len(keys) else set()
        return pd.DataFrame({"part": [int(own["part"].iloc[0])] * len(hits), "block": sorted(hits)}, columns=["part", "block"])

    salted = wanted.mapInPandas(parts_of, "key string, part int").withColumn("salt", F.pmod(F.hash("key"), F.lit(_SALTS)))
    copies = rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    met = salted.groupBy("part", "salt").cogroup(copies.groupBy("part", "salt")).applyInPandas(blocks_of, "part int, block int")
    return met.distinct()


def _around(order: list[tuple], key: str) -> Iterator[int]:
    """The third of each (first, last, number) whose range has the key. Ranges are disjoint but for shared edge keys."""
    k = bisect_right(order, key, key=lambda r: r[0]) - 1
    while k >= 0 and order[k][1] >= key:
        yield order[k][2]
        k -= 1


def wanted_keys(urls: DataFrame, url_col: str = "url") -> DataFrame:
    return urls.select(reversed_host_key(header_uri(F.col(f"`{url_col}`"))).alias("key")).distinct()


def find(blocks: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The entries of wanted URLs: only the blocks that the directory names are unpacked, at any size. Null URL: the empty one."""
    chosen = blocks.join(named_blocks(blocks, urls, url_col), ["part", "block"], "left_semi")
    return read_entries(chosen).join(wanted_keys(urls, url_col), "key", "left_semi")


def runs_of(offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """First and last places of ranges, in order of their offsets, that one read takes."""
    first = 0
    for k in range(1, len(offsets) + 1):
        if (k == len(offsets) or offsets[k] > offsets[k - 1] + lengths[k - 1] + _READ_GAP
                or offsets[k] + lengths[k] - offsets[first] > _READ_BYTES):
            yield first, k - 1
            first = k


def _fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for file, own in batch.groupby("file", sort=False):
            store, path = FileSystem.from_uri(file)
            rows = own.to_dict("records")
            with store.open_input_file(path) as archive:
                for a, b in runs_of(own["offset"].tolist(), own["length"].tolist()):
                    start = rows[a]["offset"]
                    data = archive.read_at(rows[b]["offset"] + rows[b]["length"] - start, start)
                    yield pd.DataFrame([_record(r, data[r["offset"] - start:r["offset"] - start + r["length"]]) for r in rows[a:b + 1]],
                                       columns=["page_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"])


def _record(entry: dict, member: bytes) -> tuple:
    record = gzip.decompress(member)
    fields, body = parse_header(record)
    payload = record[body:body + int(fields["Content-Length"])]
    page = None if pd.isna(entry["page_id"]) else entry["page_id"]
    if fields["WARC-Type"] != entry["record_type"] or _page(fields["WARC-Record-ID"]) != page:
        raise ValueError(f"the index names another record at {entry['file']}:{entry['offset']}")
    if entry["record_type"] == "response" and hashlib.sha1(payload).hexdigest() != entry["digest"]:
        raise ValueError(f"payload of {entry['file']}:{entry['offset']} differs from its digest")
    return (page, fields["WARC-Type"], entry["digest"], int(fields["WARC-Payload-Bytes"]), _page(fields.get("WARC-Refers-To")), payload)


def read_ranges(entries: DataFrame) -> DataFrame:
    """The records that index entries name, read by byte range and checked against their digests.

    The archives must lie in a store that Arrow's file systems reach, as local paths, HDFS and the common object stores are. A task
    goes through a file's ranges in order; it holds one read of neighbouring ranges.
    """
    ranges = entries.select("file", "offset", "length", "record_type", F.col("page_id").cast("string").alias("page_id"), "digest")
    return _with_numbers(ranges.repartition("file").sortWithinPartitions("file", "offset").mapInPandas(
        _fetched, "page_id string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"))
