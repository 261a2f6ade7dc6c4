"""Folding of the many small batches of streams into few large files, under a committed list of what is live.

A stream's batches lie in ``stream_id=x/batch_id=n`` below their table. A fold copies finished ones to a folder outside the
table and commits, in one step, that folder and the number up to which each stream's batches are in it. Readers take the folded
folders and the later batches. Whatever a repeated batch writes under a folded number is not read, so it adds nothing.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

from placelake.sources.commits import CommitConflict, CommitLog
from placelake.sources.files import read_landing

#: About how large the files of a fold are; folds below it are folded again with later batches.
FILE_BYTES = 128 << 20
_STREAM, _BATCH = "stream_id=", "batch_id="


def live_paths(spark: SparkSession, root: str, table: str) -> list[str]:
    """The folders and files to read for a table."""
    whole = f"{root.rstrip('/')}/{table}"
    _, live = _log(spark, root, table).latest()
    if not live:
        return [whole]
    paths = [p for p, _ in live["folded"]]
    for name in _children(spark, whole):
        upto = live["upto"].get(name)
        if upto is None:
            paths.append(f"{whole}/{name}")
        else:
            paths += [f"{whole}/{name}/{_BATCH}{n}" for n in _batches(spark, f"{whole}/{name}") if n > upto]
    return paths


def compact(spark: SparkSession, root: str, table: str, file_bytes: int = FILE_BYTES) -> int:
    """Fold the batches of each stream but its newest one, which may be in writing or be repeated. Returns how many were folded.

    What an earlier fold replaced is deleted now: so readers that started before it have had the time between two folds.
    Of two folds at once one fails with CommitConflict and leaves the table as it was.
    """
    whole, log = f"{root.rstrip('/')}/{table}", _log(spark, root, table)
    number, live = log.latest()
    upto, folded = dict(live.get("upto", {})), [tuple(x) for x in live.get("folded", [])]
    for path in live.get("replaced", []):
        _delete(spark, path)
    taken, replaced = [], []
    for name in _children(spark, whole):
        if name.startswith(_STREAM):
            batches = _batches(spark, f"{whole}/{name}")
            for n in batches:
                if n <= upto.get(name, -1):
                    # Folded before and deleted, then written again by a repeated batch.
                    replaced.append(f"{whole}/{name}/{_BATCH}{n}")
            for n in [n for n in batches if n > upto.get(name, -1)][:-1]:
                path = f"{whole}/{name}/{_BATCH}{n}"
                if not _exists(spark, f"{path}/_SUCCESS"):
                    break
                taken.append(path)
                upto[name] = n
    if not taken:
        return 0
    small = [(p, size) for p, size in folded if size < file_bytes]
    sources = [p for p, _ in small] + taken
    n_bytes = sum(size for _, size in small) + sum(_bytes(spark, p) for p in taken)
    target = f"{root.rstrip('/')}/_folded/{table}/{uuid4().hex}"
    rows = read_landing(spark, _data_files(spark, sources))
    rows.coalesce(max(1, n_bytes // file_bytes)).write.parquet(target)
    entry = {"upto": upto, "folded": [*[x for x in folded if x not in small], (target, _bytes(spark, target))],
             "replaced": replaced + sources}
    try:
        log.commit(number + 1, entry)
    except CommitConflict:
        _delete(spark, target)
        raise
    log.prune()
    return len(taken)


def _log(spark: SparkSession, root: str, table: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/_live/{table}")


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, but hidden files."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if n[0] not in "_.")


def _batches(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(n.removeprefix(_BATCH)) for n in _children(spark, folder) if n.startswith(_BATCH))


def _data_files(spark: SparkSession, folders: list[str]) -> list[str]:
    return [f"{folder}/{name}" for folder in folders for name in _children(spark, folder)]


def _exists(spark: SparkSession, file: str) -> bool:
    path, fs = _path(spark, file)
    return fs.exists(path)


def _bytes(spark: SparkSession, folder: str) -> int:
    path, fs = _path(spark, folder)
    return fs.getContentSummary(path).getLength()


def _delete(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)
