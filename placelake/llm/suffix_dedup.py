"""Removal of long byte strings that occur earlier in the collection.

Every window of ``WINDOW`` bytes has an anchor: the run of ``GRAM`` bytes in it with the smallest hash, the
first of equal ones. Equal windows have equal anchors at equal places, so they meet where their anchors do.
Spark counts anchors; around those that repeat, contexts are cut. Contexts with the same bytes need no
sorting. For the others, the suffixes of all contexts are sorted column by column from the right: each round
inserts one symbol per context, and updates the order (the rows that the collection's
Burrows-Wheeler transform gains) and the common prefixes by one pass over the last round's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh3_64_intdigest

from placelake.llm.common import Scratch, keyed, with_text, wrapped
from placelake.llm.words import mix

WINDOW, GRAM = 100, 28
_REACH = WINDOW - GRAM  # how far before its anchor a window may start
_CHUNK = 1 << 19
_PLACE_BITS = np.uint64(20)
_A = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                             0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
#: An anchor with more distinct contexts than this is decided window by window instead of in one task.
CONTEXTS_IN_TASK = 20_000
_SORTED_TOGETHER = 20_000


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows: hash, place, and the first and last start of the windows that have it."""
    n = len(data) - WINDOW + 1
    parts = [_anchors(data[a:min(a + _CHUNK, n) + WINDOW - 1], a) for a in range(0, n, _CHUNK)]
    if not parts:
        none = np.empty(0, dtype=np.int64)
        return none.view(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def _anchors(data: bytes, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    one = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    two = one[:-1] * _A[0] + one[1:]
    four = two[:-2] * _A[1] + two[2:]
    eight = four[:-4] * _A[2] + four[4:]
    sixteen = eight[:-8] * _A[3] + eight[8:]
    n = len(data) - GRAM + 1
    hashes = mix(sixteen[:n] * _A[4] + eight[16:16 + n] * _A[5] + four[24:24 + n])
    least = ((hashes >> _PLACE_BITS) << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= _REACH + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _REACH + 1 - width
    least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
    place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    at = place[first]
    return hashes[at], at + base, first + base, last + base


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


_ALONE, _SURE, _FIRST = 0, 1, 2
_SEEN = "route long, _id long, mark long"  # mark: four times the place, plus the kind


def _occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchors of a batch's texts. Those that repeat within the batch are known to, and travel once."""
    for batch in batches:
        found = [anchors(_bytes(t)) for t in batch["_text"]]
        sizes = [len(f[0]) for f in found]
        if not sum(sizes):
            continue
        hashes, places = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        ids = np.repeat(batch["_id"].to_numpy(), sizes)
        order = np.argsort(hashes, kind="stable")
        new = np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0
        again = ~new | ~np.append(new[1:], True)
        first, sure = order[new], order[again]
        kind = np.where(again[new], _FIRST, _ALONE)
        route = np.concatenate([hashes[first], mix(hashes[sure] + places[sure].astype(np.uint64) * _A[0])])
        rows = np.concatenate([first, sure])
        kinds = np.concatenate([kind, np.full(len(sure), _SURE)])
        yield pd.DataFrame({"route": route.view(np.int64), "_id": ids[rows], "mark": 4 * places[rows] + kinds})


def _repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a partition that holds whole hashes: the places whose anchor repeats. Memory is the partition's."""
    held = []
    for batch in batches:
        sure = batch["mark"] % 4 == _SURE
        yield _placed(batch[sure])
        held.append(batch[~sure])
    if held:
        rows = pd.concat(held, ignore_index=True)
        route = rows["route"].to_numpy()
        order = np.argsort(route, kind="stable")
        new = np.diff(route[order], prepend=~route[order[:1]]) != 0
        chosen = rows.iloc[order[~new | ~np.append(new[1:], True)]]
        yield _placed(chosen[chosen["mark"] % 4 == _ALONE])


def _placed(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"_id": rows["_id"], "place": rows["mark"] // 4})


#: A spot is an anchor's place, how many bytes before it its first window starts, and how many its last one.
_CONTEXT = "anchor long, context long, _id long, _h long, spot long"


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = []
        for i, h, text, places in zip(batch["_id"], batch["_h"], batch["_text"], batch["places"]):
            data = _bytes(text)
            hashes, at, low, high = anchors(data)
            # A text's anchors come in the order of their places, but a place may come twice.
            own = np.flatnonzero(np.isin(at, places))
            hashes, at, low, high = hashes[own], at[own], low[own], high[own]
            keys = [xxh3_64_intdigest(data[a:b + WINDOW]) for a, b in zip(low.tolist(), high.tolist())]
            keys = mix(np.array(keys, dtype=np.uint64) + (at - low).astype(np.uint64) * _A[0])
            parts.append(pd.DataFrame({"anchor": hashes.view(np.int64), "context": keys.view(np.int64), "_id": i, "_h": h,
                                       "spot": (at << 16) | ((at - low) << 8) | (at - high)}))
        yield pd.concat(parts, ignore_index=True)


_CUT = "anchor long, _id long, _h long, place long, low long, high long, data binary"


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the contexts named for each text."""
    for batch in batches:
        rows = []
        for i, h, text, wanted in zip(batch["_id"], batch["_h"], batch["_text"], batch["wanted"]):
            data = _bytes(text)
            rows += [(c["anchor"], i, h, c["place"], c["low"], c["high"], data[c["low"]:c["high"] + WINDOW]) for c in wanted]
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in _CUT.split(", ")])


def sort_columns(groups: np.ndarray, data: list[bytes], before: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Which window starts are repeats: a row per start column (the anchor's is the last), a column per context.

    Contexts of a group have the same anchor, ``before`` bytes after their own start. The suffixes of the
    group's contexts that start in one column are sorted, stably, by their symbol there from the order one column
    to the right. ``reach`` is up to which column a suffix equals the one before it: after the step, the
    smallest reach between the two in the old order. Suffixes that agree over a window are one class,
    of which all but those of the smallest rank are repeats.
    """
    n, width = len(data), _REACH + WINDOW
    lengths = np.array([len(d) for d in data], dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(first, lengths)
    symbols = np.zeros((width, n), dtype=np.int16)
    symbols[np.repeat(_REACH - before, lengths) + within, np.repeat(np.arange(n), lengths)] = (
        np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int16) + 1)
    _, groups = np.unique(groups, return_inverse=True)
    order = np.argsort(groups, kind="stable")
    head = np.diff(groups[order], prepend=-1) != 0
    reach = np.where(head, 0, width)
    repeats = np.zeros((_REACH + 1, n), dtype=bool)
    for column in range(width - 1, -1, -1):
        symbol = symbols[column][order]
        key = groups[order] * 512 + symbol
        moved = np.argsort(key, kind="stable")
        key = key[moved]
        same = np.flatnonzero(key[1:] == key[:-1]) + 1
        fresh = np.where(np.diff(key // 512, prepend=-1) != 0, 0, column)
        if len(same):
            spans = np.stack([moved[same - 1] + 1, moved[same] + 1], axis=1).ravel()
            fresh[same] = np.minimum.reduceat(np.append(reach, 0), spans)[::2]
            fresh[same[key[same] % 512 == 0]] = column  # past a context's end nothing is equal
        order, reach = order[moved], fresh
        if column <= _REACH:
            starts = np.flatnonzero(reach < column + WINDOW)
            rank = ranks[order]
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, n)))
            repeats[column, order[rank > least]] = True
    return repeats


_SPAN = "_id long, _h long, low long, high long"


def _sorted_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a partition that holds whole anchors: runs of window starts that repeat an earlier window."""
    held = list(batches)
    if not held:
        return
    rows = pd.concat(held, ignore_index=True).sort_values("anchor", kind="stable", ignore_index=True)
    anchor = rows["anchor"].to_numpy()
    heads = np.append(np.flatnonzero(np.diff(anchor, prepend=~anchor[:1]) != 0), len(anchor))
    a = 0
    while a < len(anchor):
        b = int(heads[max(np.searchsorted(heads, a + _SORTED_TOGETHER, "right") - 1, np.searchsorted(heads, a, "right"))])
        part = rows.iloc[a:b]
        ids, places = part["_id"].to_numpy(), part["place"].to_numpy()
        low, high = part["low"].to_numpy(), part["high"].to_numpy()
        by_rank = np.lexsort([places, ids])
        step = (np.diff(ids[by_rank], prepend=ids[by_rank[:1]]) != 0) | (np.diff(places[by_rank], prepend=places[by_rank[:1]]) != 0)
        ranks = np.empty(len(ids), dtype=np.int64)
        ranks[by_rank] = np.cumsum(step)
        repeats = sort_columns(part["anchor"].to_numpy(), list(part["data"]), places - low, ranks)
        columns = np.arange(_REACH + 1)[:, None]
        repeats &= (columns >= _REACH - (places - low)) & (columns <= _REACH - (places - high))
        edges = np.diff(np.pad(repeats.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        which, begin = np.nonzero(edges == 1)
        end = np.nonzero(edges == -1)[1]
        base = places[which] - _REACH
        yield pd.DataFrame({"_id": ids[which], "_h": part["_h"].to_numpy()[which], "low": base + begin, "high": base + end - 1})
        a = b


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every window of contexts, as a 128-bit digest."""
    for batch in batches:
        rows = []
        for i, h, low, high, data in zip(batch["_id"], batch["_h"], batch["low"], batch["high"], batch["data"]):
            rows += [(hashlib.blake2b(data[k:k + WINDOW], digest_size=16).digest(), i, h, low + k) for k in range(high - low + 1)]
        yield pd.DataFrame(rows, columns=["window", "_id", "_h", "start"])


def repeated_spans(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                   in_task: int = CONTEXTS_IN_TASK) -> tuple[DataFrame, DataFrame]:
    """(texts, spans): texts with a repeated anchor, and (_id, _h, spans) of window starts that repeat earlier ones.

    Earlier: in a document of smaller id, or in the same document from a smaller start. Rows with equal id
    and start are not earlier than each other, whatever their texts.
    """
    rows = keyed(docs, id_col, text_col)
    seen = rows.filter(F.octet_length("_text") >= WINDOW).mapInPandas(_occurrences, _SEEN)
    # Texts that share an id share their places: some more to look at, where a text has an anchor there too.
    places = seen.repartition("route").mapInPandas(_repeated, "_id long, place long")
    by_text = places.groupBy("_id").agg(F.collect_list("place").alias("places"))
    texts = scratch.write(rows.join(by_text, "_id"), "texts")
    contexts = scratch.write(texts.mapInPandas(_contexts, _CONTEXT), "contexts")

    key = ["anchor", "context"]
    place = F.shiftright("spot", 16)
    low, high = place - F.shiftright("spot", 8).bitwiseAND(255), place - F.col("spot").bitwiseAND(255)
    where = [place.alias("place"), low.alias("low"), high.alias("high")]
    # Equal contexts have equal bytes before and after the anchor: their spots order as their places do.
    kinds = contexts.groupBy(*key).agg(F.min(F.struct("_id", "spot", "_h")).alias("first"), F.count("*").alias("n"))
    kinds = scratch.write(kinds.select(*key, "first.*", "n"), "kinds")
    firsts = kinds.filter("n > 1").select(*key, F.struct("_id", "spot").alias("first"))
    copies = contexts.join(firsts, key).filter(F.struct("_id", "spot") > F.col("first")).select("_id", "_h", *where[1:])

    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    mixed = kinds.join(per_anchor, "anchor").select("anchor", "_id", "_h", *where, (F.col("kinds") > in_task).alias("hot"))
    mixed = scratch.write(mixed, "mixed")

    def bytes_of(part: DataFrame) -> DataFrame:
        wanted = part.groupBy("_id", "_h").agg(F.collect_list(F.struct("anchor", "place", "low", "high")).alias("wanted"))
        return texts.select("_id", "_h", "_text").join(wanted, ["_id", "_h"]).mapInPandas(_cut_out, _CUT)

    ordered = bytes_of(mixed.filter("NOT hot")).repartition("anchor").mapInPandas(_sorted_spans, _SPAN)
    spans = copies.unionByName(ordered)
    if mixed.filter("hot").limit(1).count():
        windows = scratch.write(bytes_of(mixed.filter("hot")).mapInPandas(_windows, "window binary, _id long, _h long, start long"), "windows")
        firsts = windows.groupBy("window").agg(F.min(F.struct("_id", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        later = windows.join(firsts.select("window", "first"), "window").filter(F.struct("_id", "start") > F.col("first"))
        spans = spans.unionByName(later.select("_id", "_h", F.col("start").alias("low"), F.col("start").alias("high")))
    spans = spans.groupBy("_id", "_h").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return texts.select("_id", "_h", "_text"), spans


_LEFT = "_id long, _h long, n_bytes long, n_removed long, n_spans long, kept binary"


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for i, h, text, spans in zip(batch["_id"], batch["_h"], batch["_text"], batch["spans"]):
            data = _bytes(text)
            depth = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(depth, [s["low"] for s in spans], 1)
            np.add.at(depth, [s["high"] + WINDOW for s in spans], -1)
            gone = np.cumsum(depth[:-1]) > 0
            runs = np.count_nonzero(np.diff(gone, prepend=False) & gone)
            rows.append((i, h, len(data), int(gone.sum()), int(runs), np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()))
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in _LEFT.split(", ")])


def shortened(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per distinct (``_id``, ``_h``) that loses bytes: n_bytes, n_removed, n_spans and the bytes kept.

    A byte goes if it lies in a string of ``WINDOW`` bytes that also starts earlier in the collection; strings
    may overlap each other, but do not cross documents, and are judged on the input. Texts count as UTF-8.
    Null and shorter texts lose nothing; a null id is below all others. Repeated rows get the same
    result. An empty table gives no rows.
    """
    texts, spans = repeated_spans(docs, scratch, id_col, text_col, **options)
    left = texts.join(spans, ["_id", "_h"]).mapInPandas(_removed, _LEFT)
    return left.dropDuplicates(["_id", "_h"])


@F.pandas_udf(StringType())
def _decoded(kept: pd.Series) -> pd.Series:
    return kept.map(lambda b: bytes(b).decode("utf-8", "ignore"))


def without_repeats(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All documents with all their columns, their texts without the bytes that :func:`shortened` removes.

    Bytes of a character of which others were removed are dropped with them.
    """
    left = scratch.write(shortened(docs, scratch, id_col, text_col, **options)
                         .select("_id", "_h", _decoded("kept").alias("shorter")), "shorter")
    rows = wrapped(docs, id_col, text_col).join(left, ["_id", "_h"], "left")
    return with_text(rows, F.coalesce("shorter", F.col(f"_row.`{text_col}`").cast("string")), text_col)
