"""Best-fit packing of token sequences, certified by lower bounds."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import Scratch, id_key, plain_id, text_of

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACES = "uid long, length long, sequence_id long, offset long, fill long, gap boolean"
_CACHED = 400_000
_ODD_SPACE = re.compile(r" (?=\s)|\s\Z")
_LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


class Encoder(dict):
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    The vocabulary splits a text before each space that is followed by a letter, digit or sign, and such
    parts are encoded on their own; this maps a part to its ids, and keeps those of many parts. Texts with
    other white space go to the library whole. Very long runs go to the library whose merge takes
    near-linear time. Special tokens' strings are ordinary text.
    """

    def __init__(self, tokenizer_path: str):
        super().__init__()
        import public_tokenizers
        import tiktoken

        self.tokenizer_path = tokenizer_path
        ranks_path = tokenizer_path.removesuffix(".json") + ".tiktoken"
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def whole(self, text: str) -> bytes:
        if _LONG_RUN.search(text):
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.tokenizer_path)
                self.slow.encode_special_tokens = True
            ids = self.slow.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        ids = self.whole(part)
        if len(part) < 64:
            if len(self) >= _CACHED:
                self.clear()
            self[part] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD_SPACE.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return b"".join([self[first] if first else b"", *map(self.__getitem__, map(" ".__add__, rest))])


@cache
def encoder(tokenizer_path: str) -> Encoder:
    return Encoder(tokenizer_path)


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document of n ids: whole if it fits, else full pieces after a shorter first one."""
    first = n % capacity or capacity
    return [(0, first)] + [(k, capacity) for k in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """A row per piece of every document: doc_id, piece, start, length, checksum of its ids."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer_path).ids
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text) + end
                for k, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, crc32(ids[4 * start:4 * (start + length)])))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(id_key(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInPandas(run, _PIECES).withColumn("doc_id", plain_id("doc_id"))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of several lower bounds on the number of bins, each from a dual-feasible function.

    Such a function keeps the sum of any set that fits a bin at one or less, so that its sum over all
    lengths bounds the number of bins. Two families: u_k rounds a length's multiples of (k + 1), and
    U_e counts lengths over capacity - e as whole bins and drops those under e. The plain sum is one too.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int) -> int:
    """The same from the number of items by length."""
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((counts * x).sum()) // capacity)
    for k in range(1, 64):
        scaled = np.where(x * (k + 1) % capacity == 0, k * x, capacity * (x * (k + 1) // capacity))
        best = max(best, -(-int((counts * scaled).sum()) // (k * capacity)))
    number, total = np.cumsum(counts[::-1])[::-1], np.cumsum(counts * x)
    for e in range(1, capacity // 2 + 1):
        large = int(number[capacity - e + 1])
        middle = int(total[capacity - e] - total[e - 1])
        best = max(best, large + -(-middle // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every length, and how full the bins are.

    The longest goes first, each into the fullest bin that takes it. Open bins lie in stacks by free
    space; which stacks have bins is a number's bits, whose lowest one at or over the length is the fit.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits, fills = 0, []
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        fitting = free_bits >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            place = stacks[free].pop()
            if not stacks[free]:
                free_bits ^= 1 << free
        else:
            free, place = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = place, fills[place]
        fills[place] += need
        if free > need:
            stacks[free - need].append(place)
            free_bits |= 1 << (free - need)
    return bins, offsets, np.array(fills, dtype=np.int64)


def least_slack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as :func:`best_fit_decreasing`, but bin by bin: the longest left, then those that fill it best.

    Which sums the shorter ones reach are a number's bits; they are taken in, longest first, until the free space is met.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    left: dict[int, list[int]] = {}
    for i in np.argsort(lengths, kind="stable")[::-1]:
        left.setdefault(int(lengths[i]), []).append(int(i))
    fills = []
    while left:
        longest = next(iter(left))
        free = capacity - longest
        chosen = [longest, *_best_sum([(x, len(own) - (x == longest)) for x, own in left.items() if x <= free], free)]
        at = 0
        for x in chosen:
            i = left[x].pop()
            if not left[x]:
                del left[x]
            bins[i], offsets[i] = len(fills), at
            at += x
        fills.append(at)
    return bins, offsets, np.array(fills, dtype=np.int64)


def fewest_bins(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The better of both fits."""
    return min((fit(lengths, capacity) for fit in (best_fit_decreasing, least_slack)), key=lambda made: len(made[2]))


def _best_sum(counts: list[tuple[int, int]], free: int) -> list[int]:
    """Lengths, at most so many of each, whose sum is the largest that fits."""
    reached, within = 1, (1 << (free + 1)) - 1
    steps = []  # each length taken in, and the sums before it
    for x, n in counts:
        for _ in range(min(n, free // x)):
            more = (reached | reached << x) & within
            if more == reached:
                break
            steps.append((x, reached))
            reached = more
        if reached >> free:
            break
    total, chosen = reached.bit_length() - 1, []
    for x, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(x)
            total -= x
    return chosen


def _packed(items: DataFrame, group_items: int, capacity: int, turn: int, n: int, fit=best_fit_decreasing) -> DataFrame:
    """Pack items (uid, length) in groups dealt by a hash, each about ``group_items`` large."""
    groups = max(1, -(-n // group_items))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins, offsets, fills = fit(lengths, capacity)
        base = (turn << 56) | (int(frame["grp"].iloc[0]) << 24)
        return pd.DataFrame({
            "uid": frame["uid"], "length": lengths, "sequence_id": -1 - (base + bins), "offset": offsets,
            "fill": fills[bins], "gap": len(fills) > lower_bound(lengths, capacity)})

    dealt = items.select("uid", "length", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(groups)).alias("grp"))
    return dealt.groupBy("grp").applyInPandas(run, _PLACES)


def _bins(placed: DataFrame) -> int:
    return placed.filter("offset = 0").count()


def pack(items: DataFrame, scratch: Scratch, capacity: int = 1024, group_items: int = 20_000,
         max_turns: int = 8) -> DataFrame:
    """Sequence and offset of each item (``uid``, ``length`` from 1 to ``capacity``).

    Each group is packed by best-fit decreasing and certified if its bins reach its lower bound. Then the
    items of groups with a gap, and those of every group's unfilled bins, are exchanged: dealt
    into new groups and packed again. A turn is taken if it saves bins. Where one saves none, the next deals out the items of
    every bin that has room, and those after it also pack them by least slack; so does a single group, which has nothing to
    exchange. The end is reached when the total meets the bound of all lengths together, or least slack saves none. The bound
    needs the counts by length alone, at most ``capacity`` numbers.
    """
    counts = items.groupBy("length").count().toPandas()
    n = int(counts["count"].sum())
    placed = scratch.write(_packed(items, group_items, capacity, 0, n), "placed-0")
    total = _bins(placed)
    bound = _weighted_bound(counts, capacity)
    slack, fit = capacity // 64, best_fit_decreasing
    if n <= group_items:
        slack, fit = 0, fewest_bins
    for turn in range(1, max_turns + 1):
        if total <= bound:
            break
        open_bins = F.col("fill") < capacity - slack
        if slack:
            open_bins |= F.col("gap")
        loose = placed.filter(open_bins)
        old, n_loose = _bins(loose), loose.count()
        again = scratch.write(_packed(loose, group_items, capacity, turn, n_loose, fit), f"again-{turn}") if old > 1 else None
        new = _bins(again) if again is not None else old
        if new >= old:
            scratch.drop(f"again-{turn}")
            if fit is fewest_bins:
                break
            if not slack or n_loose <= group_items:
                fit = fewest_bins
            slack = 0
            continue
        placed = scratch.write(placed.filter(~open_bins).unionByName(again), f"placed-{turn}")
        scratch.drop(f"again-{turn}")
        total += new - old
    return placed.select("uid", "sequence_id", "offset")


def _weighted_bound(counts: pd.DataFrame, capacity: int) -> int:
    by_length = np.zeros(capacity + 1, dtype=np.int64)
    by_length[counts["length"].to_numpy(dtype=np.int64)] = counts["count"].to_numpy(dtype=np.int64)
    return bound_of_counts(by_length, capacity)


def pack_documents(docs: DataFrame, scratch: Scratch, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece with the end id alone. A null id stays null. Repeated rows are
    packed each. Texts of any length are encoded whole. An empty table gives no rows. Other columns are
    ignored. Texts are read once; what is packed and exchanged are numbers.
    """
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id)
    pieces = scratch.write(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == capacity)
    short = pieces.filter(F.col("length") < capacity)
    placed = pack(short.select("uid", "length"), scratch, capacity)
    alone = full.withColumns({"sequence_id": F.col("uid"), "offset": F.lit(0).cast("long")})
    return alone.unionByName(short.join(placed, "uid")).drop("uid")
