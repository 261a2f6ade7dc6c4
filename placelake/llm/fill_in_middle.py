"""Fill-in-the-middle by a learned rank index over the places where a text may be cut.

The index is piecewise linear: segments predict where the unit of a rank begins, none of them off by more than a
bound, and one byte per unit holds what the prediction misses. So a cut is a lookup, and exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import NO_ID, id_key
from placelake.llm.words import WORD_ENDS

# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_PIECE = 1 << 17
_OUT_BYTES = 8 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(WORD_ENDS)] = True
_FIELDS = ("_id long, n long, form string, prefix_units long, middle_units long, output string, segments int, "
           "largest_miss int")
_ARROW = pa.schema([("_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_units", pa.int64()),
                    ("middle_units", pa.int64()), ("output", pa.string()), ("segments", pa.int32()), ("largest_miss", pa.int32())])


def unit_starts(data: bytes, unit: str = "char") -> Iterator[np.ndarray]:
    """Where the units of UTF-8 text begin, piece by piece: code points ("char") or words with the space after them ("word").

    The first unit begins at 0, white space before the first word included.
    """
    if unit not in ("char", "word"):
        raise ValueError(f"unit is 'char' or 'word', not {unit!r}")
    codes, after_space = np.frombuffer(data, dtype=np.uint8), False
    for at in range(0, len(data), _PIECE):
        piece = codes[at:at + _PIECE]
        if unit == "char":
            begins = (piece & 0xC0) != 0x80
        else:
            space = _SPACE[piece]
            begins = ~space & np.concatenate(([after_space], space[:-1]))
            after_space = bool(space[-1])
        if at == 0:
            begins[0] = True
        found = np.flatnonzero(begins) + at
        if len(found):
            yield found


class RankIndex:
    """Offsets of units by rank: linear segments within ``bound`` of every offset, and each unit's miss."""

    def __init__(self, starts: Iterator[np.ndarray], end: int, bound: int = 96):
        if not 0 <= bound <= 127:
            raise ValueError(f"the bound fits a signed byte, unlike {bound}")
        self.bound = bound
        firsts, bases, slopes, misses, rank = [], [], [], [], 0
        for offsets in starts:
            todo = [(0, len(offsets))]
            while todo:
                a, b = todo.pop()
                base, slope, miss = self._fit(offsets[a:b])
                if miss is None:  # halves, the left one next
                    middle = (a + b) // 2
                    todo += [(middle, b), (a, middle)]
                    continue
                firsts.append(rank + a)
                bases.append(base)
                slopes.append(slope)
                misses.append(miss)
            rank += len(offsets)
        self.n = rank
        # The end of the text is a boundary as well.
        firsts.append(rank), bases.append(end), slopes.append(0.0), misses.append(np.zeros(1, dtype=np.int8))
        self.firsts, self.bases = np.array(firsts, dtype=np.int64), np.array(bases, dtype=np.int64)
        self.slopes, self.misses = np.array(slopes), np.concatenate(misses)

    def _fit(self, offsets: np.ndarray) -> tuple[int, float, np.ndarray | None]:
        """The line through the first and last offset; no misses if one of them is beyond the bound."""
        base, n = int(offsets[0]), len(offsets)
        slope = (int(offsets[-1]) - base) / (n - 1) if n > 1 else 0.0
        miss = offsets - base - np.rint(slope * np.arange(n)).astype(np.int64)
        if n > 1 and max(-int(miss.min()), int(miss.max())) > self.bound:
            return base, slope, None
        return base, slope, miss.astype(np.int8)

    def offset(self, rank: int) -> int:
        """Where the unit of this rank begins; the end of the text for the rank after the last."""
        k = int(np.searchsorted(self.firsts, rank, "right")) - 1
        guess = int(self.bases[k]) + int(np.rint(self.slopes[k] * (rank - int(self.firsts[k]))))
        return guess + int(self.misses[rank])


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from a digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transform(data: bytes, doc_id: int | None, seed: int, unit: str, plain_percent: int, spm_percent: int, bound: int) -> tuple:
    """n, form, units before the middle and in it, output, segments, largest miss."""
    index = RankIndex(unit_starts(data, unit), len(data), bound)
    h1, h2, h3, h4 = draws(seed, doc_id)
    miss = int(np.abs(index.misses.astype(np.int16)).max())
    about = (len(index.firsts) - 1, miss)
    if not data or h3 % 100 >= 100 - plain_percent or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return index.n, "plain", None, None, data, *about
    first, second = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    a, b = index.offset(first), index.offset(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < spm_percent:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return index.n, form, first, second - first, output, *about


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, unit: str = "char",
                   plain_percent: int = 10, spm_percent: int = 20, bound: int = 96) -> DataFrame:
    """A row per row of the documents: ``_id``, n units, form, units before the middle and in it, output.

    Cuts fall between units at ranks drawn from seed and id. "psm" puts the suffix before the middle, "spm" the suffix
    first; "plain" is the text as it is, for ``plain_percent`` of the texts, empty ones, and those that hold a mark.
    ``segments`` and ``largest_miss`` tell of the index; a smaller ``bound`` makes more segments. No shuffle; a task
    holds one text and a byte per unit besides its batch.

    Null text: an empty one. A null id draws as an empty one, and stays null-like (see ``plain_id``). Repeated rows
    get equal rows, an empty table gives none, and other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc_id, data in zip(batch.column("_id").to_pylist(), batch.column("_data")):
                row = transform(data.as_py(), None if doc_id == NO_ID else doc_id, seed, unit, plain_percent, spm_percent, bound)
                rows.append((doc_id, *row))
                size += len(row[4])
                if size > _OUT_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    data = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(id_key(id_col).alias("_id"), data.alias("_data")).mapInArrow(run, _FIELDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, type=pa.binary()).cast(pa.string()) if f.name == "output" else pa.array(c, type=f.type)
               for f, c in zip(_ARROW, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def restored(output: Column, form: Column) -> Column:
    """The text of an output. Its texts hold no marks, so the marks alone part it."""
    part = F.split(output, "<[PSM]>", 4)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(part[1], part[3], part[2]))
            .otherwise(F.concat(part[2], part[3], part[1])))
