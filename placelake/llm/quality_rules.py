"""Quality rules: a document's own measures, then lines that too many documents of a host share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh3_64_intdigest

from placelake.llm.common import Scratch, keyed, with_text, wrapped
from placelake.llm.words import WORD_ENDS, shingles, word_hashes

_SYMBOLS = b"#*$%&|<>"
_ENDS = WORD_ENDS.decode()
_MEASURES = ("_id long, _h long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, shape long, lines array<long>, line_words array<long>")


def line_hash(line: str) -> int:
    """Of the line in lower case with its white space as single spaces, as a signed 64-bit number."""
    digest = xxh3_64_intdigest(" ".join(line.lower().split()).encode("utf-8", "surrogatepass"))
    return digest - (1 << 64) if digest >> 63 else digest


def repeat_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words in a window of so many words that occurs twice or more in the text."""
    if len(hashes) <= size:
        return 0
    windows = shingles(hashes, size)
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(counts[which] > 1)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measures(text: str) -> tuple:
    """Word count, characters in words, symbols, repeated lines, repeated words, shape, line hashes, their words.

    The shape is a hash of the hashes of all distinct lines: only texts of the same normalised lines have the same.
    """
    data = text.encode("utf-8", "surrogatepass")
    hashes = word_hashes(data)
    n_symbols = len(data) - len(data.translate(None, _SYMBOLS))
    word_chars = len(text) - sum(text.count(c) for c in _ENDS)
    lines = [x for x in text.split("\n") if x.strip(_ENDS)]
    dup = len(lines) - len(set(lines))
    by_line: Counter[str] = Counter(lines)
    words_of: dict[int, int] = {}
    for line, times in by_line.items():
        key = line_hash(line)
        words_of[key] = words_of.get(key, 0) + times * len(line.encode("utf-8", "surrogatepass").split())
    keys = np.fromiter(words_of, dtype=np.int64, count=len(words_of))
    shape = int(np.uint64(xxh3_64_intdigest(np.sort(keys).tobytes())).astype(np.int64))
    return len(hashes), word_chars, n_symbols, dup, repeat_words(hashes), shape, keys, list(words_of.values())


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in _MEASURES.split(", ")]
    for batch in batches:
        rows = [(i, h, host, *measures(t)) for i, h, host, t in zip(batch["_id"], batch["_h"], batch["host"], batch["_text"])]
        yield pd.DataFrame(rows, columns=names)


def host_of(host_col: str) -> Column:
    return F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("\0"))


def frequent_lines(measured: DataFrame, max_docs: int) -> DataFrame:
    """(host, line, first) of the lines in more than ``max_docs`` distinct documents of a host, and the smallest id among these.

    Counted in two partial aggregates, first by document shape: a line in a third of all documents is
    combined before each shuffle.
    """
    lines = measured.select("host", "shape", "_id", F.explode("lines").alias("line"))
    shapes = lines.groupBy("host", "line", "shape").agg(F.min("_id").alias("first"))
    counted = shapes.groupBy("host", "line").agg(F.count("*").alias("docs"), F.min("first").alias("first"))
    return counted.filter(F.col("docs") > max_docs).drop("docs")


def judge(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_docs: int = 10, min_words: int = 50, max_repeat: int = 50, min_left: float = 0.2) -> DataFrame:
    """A row per document (``_id``, ``_h``): measures, ``base_failed``, words removed with lines, ``cut``, ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat`` percent of the words in
    repeated windows of three. Lines of more than ``max_docs`` distinct documents of their host are
    removed from all but the one of smallest id (``cut``: their hashes), so that nothing a host says is lost altogether, and a document is depleted if less than ``min_left`` of its words is
    left. Documents are distinct unless their normalised lines are the same, so exact copies count once.

    Null text: no words, hence base_failed. A null host is a host of its own. Repeated rows get equal
    rows. An empty table gives none. Other columns are ignored.
    """
    rows = keyed(docs, id_col, text_col, host_of(host_col).alias("host"))
    measured = scratch.write(rows.mapInPandas(_measured, _MEASURES).dropDuplicates(["_id", "_h", "host"]), "measures")
    each = measured.select("_id", "_h", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("z"))
    each = each.select("_id", "_h", "host", F.col("z.lines").alias("line"), F.col("z.line_words").alias("words"))
    hit = each.join(frequent_lines(measured, max_docs), ["host", "line"]).filter("_id != first")
    cut = hit.groupBy("_id", "_h", "host").agg(F.sum("words").alias("n_cut_words"), F.collect_set("line").alias("cut"))
    judged = measured.drop("shape", "lines", "line_words").join(cut, ["_id", "_h", "host"], "left")
    n_cut = F.coalesce("n_cut_words", F.lit(0).cast("long"))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    left = F.col("n_words") - n_cut
    depleted = (n_cut > 0) & (left < min_left * F.col("n_words"))
    return judged.withColumns({"n_cut_words": n_cut, "base_failed": base, "kept": ~base & ~depleted})


def without_lines(text: str, cut: set[int]) -> str:
    return "\n".join(x for x in text.split("\n") if not x.strip(_ENDS) or line_hash(x) not in cut)


@F.pandas_udf(StringType())
def _without_lines(texts: pd.Series, cuts: pd.Series) -> pd.Series:
    return pd.Series([t if cut is None or t is None else without_lines(t, set(cut.tolist())) for t, cut in zip(texts, cuts)])


def keep_good(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              **limits) -> DataFrame:
    """The documents that :func:`judge` keeps, with all their columns, and without the lines that it cuts."""
    judged = judge(docs, scratch, id_col, text_col, host_col, **limits).filter("kept").select("_id", "_h", "host", "cut")
    rows = wrapped(docs, id_col, text_col, host_of(host_col).alias("host")).join(judged, ["_id", "_h", "host"])
    return with_text(rows, _without_lines(F.col(f"_row.`{text_col}`").cast("string"), F.col("cut")), text_col)
