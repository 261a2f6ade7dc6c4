"""Quality classifier: perplexity under a modified Kneser-Ney model of trusted text.

The model is interpolated, of three words, and counts every trusted document of three quarters, by a
hash of the id. It stays a table, and scoring is a join of n-grams with it. All documents are scored; a
document is kept if its perplexity lies within a quantile of the trusted documents of its language that
the model has not seen.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import BROADCAST_BYTES, NO_ID, Scratch, text_of
from placelake.llm.words import mix, word_hashes

#: Salts of the n-gram hashes of each order, and the marks around a text.
_SALTS = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F, 0xD1342543DE82EF95], dtype=np.uint64)
_START, _STOP = np.uint64(1), np.uint64(2)
#: N-grams that a task counts before it passes them on.
_BLOCK = 500_000
#: Training words that have codes, the most frequent; others move as hashes.
_HELD = 2_000_000
#: Tokens of a shard that a task reads at once, and those of a block of documents.
_AT_ONCE, _TOKENS = 1_500_000, 1_500_000
_LOW = np.uint64(0xFFFFFFFF)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a text's words with its end, and of the two and three words that end at each."""
    hashes = word_hashes(text.encode("utf-8", "surrogatepass").lower())
    w3 = np.concatenate([hashes, [_STOP]]).astype(np.uint64)
    padded = np.concatenate([[_START, _START], w3]).astype(np.uint64)
    w2, w1 = padded[1:-1], padded[:-2]
    return mix(w3 + _SALTS[0]), pair(w2, w3), mix(pair(w1, w2) * _SALTS[2] + w3)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _SALTS[1]) * _SALTS[0] + b)


def _start_keys() -> tuple[int, int]:
    """The hashes of the one and the two marks before a text."""
    start = np.array([_START])
    return tuple(int(x.view(np.int64)[0]) for x in (mix(start + _SALTS[0]), pair(start, start)))


_GRAMS = "w long, v long, vw long, uv long, uvw long, n long"


def _grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    before = np.array(_start_keys(), dtype=np.int64).view(np.uint64)
    waiting: list[np.ndarray] = []
    held = 0

    def counted() -> pd.DataFrame:
        w, v, vw, uv, uvw = np.concatenate(waiting, axis=1).view(np.int64)
        key, at, n = np.unique(uvw, return_index=True, return_counts=True)
        return pd.DataFrame({"w": w[at], "v": v[at], "vw": vw[at], "uv": uv[at], "uvw": key, "n": n})

    for batch in batches:
        for text in batch["text"]:
            one, two, three = ngrams(text)
            v, uv = np.concatenate([before[:1], one[:-1]]), np.concatenate([before[1:], two[:-1]])
            waiting.append(np.stack([one, v, two, uv, three]))
            held += len(one)
            if held >= _BLOCK:
                yield counted()
                waiting.clear()
                held = 0
    if waiting:
        yield counted()


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams occur once to four times."""
    found = dict(counts.filter("c <= 4").groupBy("c").count().toPandas().itertuples(index=False, name=None))
    return discounts([found.get(k, 0) for k in range(1, 5)])


def discounts(n: list[int]) -> list[float]:
    """Of n-grams seen once, twice and more often. They rise with the count, and are between 0 and it.

    If one of the four numbers is 0, the estimates of the three say nothing, and plain Kneser-Ney's one discount serves them all;
    a half without n-grams seen once and twice.
    """
    y = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    made = [min(max(y, 0.05), 0.95)]
    for k in (2, 3):
        known = k - (k + 1) * y * n[k] / n[k - 1] if all(n) else made[0]
        made.append(min(max(known, made[-1]), k - 0.05))
    return made


def _off(d: list[float]) -> Column:
    """What is taken off a count ``c``."""
    return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])


@dataclass
class Order:
    """N-grams of one length with their counts ``c``, and what discounting leaves and frees."""

    counts: DataFrame  # the n-grams' hashes, c, and how often each occurs (n)
    weights: DataFrame  # (context, weight, total), or one row without a context
    off: Column

    def shares(self, context: str) -> DataFrame:
        """The counts with ``share``, and their context's ``weight``."""
        return self.counts.join(self.weights, context).withColumn("share", (F.col("c") - self.off) / F.col("total"))


def _order(counts: DataFrame, scratch: Scratch, *context: str) -> Order:
    off = _off(_discounts(counts))
    sums = counts.groupBy(*context).agg(F.sum("c").alias("total"), F.sum(off).alias("off"))
    weights = sums.select(*context, (F.col("off") / F.col("total")).alias("weight"), "total")
    return Order(counts, scratch.write(weights, "weights-" + "".join(context)), off)


@dataclass
class Tables:
    """The whole model as tables: n-grams of three, two and one word."""

    three: Order
    two: Order
    one: DataFrame  # (w, n, share)
    unseen: float  # probability of a word that was never seen, before interpolation


def count(texts: DataFrame, scratch: Scratch) -> Tables:
    """Count column ``text``. Counting and joining run over n-gram hashes in Spark; nothing is collected but sums."""
    grams = texts.select("text").mapInPandas(_grams, _GRAMS)
    three = scratch.write(grams.groupBy("w", "v", "vw", "uv", "uvw").agg(F.sum("n").alias("c")).withColumn("n", F.col("c")), "three")
    two = scratch.write(three.groupBy("w", "v", "vw").agg(F.count("*").alias("c"), F.sum("n").alias("n")), "two")
    one = scratch.write(two.groupBy("w").agg(F.count("*").alias("c"), F.sum("n").alias("n")), "one")
    words = _order(one, scratch)
    all_words = words.weights.first()
    total = all_words["total"] or 1
    unseen = (1.0 if all_words["weight"] is None else all_words["weight"]) / (one.count() + 1)
    shares = one.select("w", "n", ((F.col("c") - words.off) / F.lit(total)).alias("share"))
    return Tables(_order(three, scratch, "uv"), _order(two, scratch, "v"), shares, float(unseen))


class Shards:
    """Hashes with two numbers each, in shards by hash; a lookup goes shard by shard."""

    def __init__(self, rows: pd.DataFrame, bits: int = 18):
        keys = rows["key"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.share = rows["share"].to_numpy(dtype=np.float32)[order]
        self.weight = rows["weight"].to_numpy(dtype=np.float32)[order]
        self.bits = bits
        self.first = np.searchsorted(self.keys >> np.uint64(64 - bits), np.arange(2**bits + 1, dtype=np.uint64)).astype(np.int32)
        self.most = int(np.diff(self.first).max(initial=0))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 without one. Hashes are even, so a shard has a few entries."""
        top = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.first[top], self.first[top + 1]
        found = np.full(len(wanted), -1, dtype=np.int64)
        for k in range(self.most):
            near = np.flatnonzero((at + k < end) & (found < 0))
            if not len(near):
                break
            hit = self.keys[at[near] + k] == wanted[near]
            found[near[hit]] = at[near[hit]] + k
        return found


@dataclass
class Model:
    orders: list[Shards]
    unseen: float  # probability of a word that was never seen, before interpolation

    def log10(self, text: str) -> tuple[float, int]:
        """The log10 probability of a text with its end, and the number of tokens."""
        each = self.token_log10(text)
        return float(each.sum()), len(each)

    def token_log10(self, text: str) -> np.ndarray:
        """The log10 probability of each word and the end, given what is before it."""
        one, two, three = ngrams(text)
        hashes_before = np.concatenate([[mix(np.array([_START]) + _SALTS[0])[0]], one[:-1]]).astype(np.uint64)
        p = np.full(len(one), self.unseen)
        at = self.orders[0].find(one)
        p[at >= 0] += self.orders[0].share[at[at >= 0]]
        context = self.orders[0].find(hashes_before)
        p = self._next(p, context, self.orders[0], self.orders[1], two)
        before = np.concatenate([[pair(np.array([_START]), np.array([_START]))[0]], two[:-1]]).astype(np.uint64)
        seen = context >= 0
        context = np.full(len(one), -1, dtype=np.int64)
        context[seen] = self.orders[1].find(before[seen])
        p = self._next(p, context, self.orders[1], self.orders[2], three)
        return np.log10(np.maximum(p, 1e-30))

    @staticmethod
    def _next(p: np.ndarray, context: np.ndarray, lower: Shards, higher: Shards, grams: np.ndarray) -> np.ndarray:
        seen = np.flatnonzero(context >= 0)
        weight = lower.weight[context[seen]]
        seen, weight = seen[weight > 0], weight[weight > 0]
        p[seen] *= weight
        at = higher.find(grams[seen])
        p[seen[at >= 0]] += higher.share[at[at >= 0]]
        return p


def fit(texts: DataFrame, scratch: Scratch) -> Model:
    """Fit on column ``text`` of a small table, and collect the model; ``classify`` keeps it in tables instead."""
    found = count(texts, scratch)
    empty = F.lit(0.0).alias("weight")
    orders = [
        found.one.select(F.col("w").alias("key"), "share")
        .join(found.two.weights.select(F.col("v").alias("key"), "weight"), "key", "full"),
        found.two.shares("v").select(F.col("vw").alias("key"), "share")
        .join(found.three.weights.select(F.col("uv").alias("key"), "weight"), "key", "full"),
        found.three.shares("uv").select(F.col("uvw").alias("key"), "share", empty),
    ]
    return Model([Shards(x.na.fill(0.0).toPandas()) for x in orders], found.unseen)


def _pack(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte: the upper bytes are mostly 0, and the lower ones uneven."""
    numbers = np.ascontiguousarray(numbers, dtype="<u8")
    width = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    coder = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    return coder.compress(numbers.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()) + coder.flush()


def _unpack(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(-1, n)
    numbers = np.zeros((n, 8), dtype=np.uint8)
    numbers[:, :len(raw)] = raw.T
    return numbers.view("<u8").ravel()


def _numbered(hashes: np.ndarray, salt: np.uint64, n: int) -> np.ndarray:
    return (mix(hashes + salt) % np.uint64(n)).astype(np.int64)


def _sorted_out(words: np.ndarray, c: np.ndarray, n: int) -> Iterator[tuple[int, tuple[int, bytes, bytes]]]:
    """Sorted words with numbers, packed, by a hash of the word."""
    of = _numbered(words, _SALTS[2], n)
    for k in np.unique(of).tolist():
        own = of == k
        yield k, (int(own.sum()), _pack(np.diff(words[own], prepend=np.uint64(0))), _pack(c[own]))


def _summed(records: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words and their summed numbers, from packed ones."""
    if not records:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    words = np.concatenate([np.cumsum(_unpack(x[1], x[0]), dtype=np.uint64) for x in records])
    words, at = np.unique(words, return_inverse=True)
    c = np.bincount(at, weights=np.concatenate([_unpack(x[2], x[0]) for x in records]), minlength=len(words))
    return words, c.astype(np.int64)


def _hashes(text: str) -> np.ndarray:
    return word_hashes(text.encode("utf-8", "surrogatepass").lower())


@dataclass
class Codes:
    """Training words by steps of frequency, in each by hash: a word's place is its code. The marks come first."""

    steps: list[tuple[int, bytes]]  # packed differences of sorted hashes
    whole: bool  # whether these are all training words; if so, all others share the code after the last

    def __len__(self) -> int:
        return 2 + sum(n for n, _ in self.steps)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes, and their codes."""
        words = np.concatenate([np.array([_START, _STOP]), *(np.cumsum(_unpack(x, n), dtype=np.uint64) for n, x in self.steps)])
        by = np.argsort(words)
        return words[by], by.astype(np.uint64)


def _codes(rows: DataFrame, n: int, held: int) -> Codes:
    """Of the ``held`` most frequent words of the rows that train, at most: whole steps of frequency have codes or not."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[np.ndarray] = []

        def dealt() -> Iterator[pd.DataFrame]:
            for k, (m, words, c) in _sorted_out(*np.unique(np.concatenate(waiting), return_counts=True), n):
                yield pd.DataFrame({"shard": [k], "m": [m], "words": [words], "c": [c]})

        for batch in batches:
            for text in batch["text"]:
                waiting.append(_hashes(text))
            if sum(map(len, waiting)) >= _TOKENS:
                yield from dealt()
                waiting.clear()
        if waiting:
            yield from dealt()

    def step(c: np.ndarray) -> np.ndarray:
        return np.floor(4 * np.log2(c)).astype(np.int64)

    def by_step(records: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        words, c = _summed([x for _, x in records])
        keep = (words != _START) & (words != _STOP)
        yield words[keep], step(c[keep])

    training = rows.filter("trains")
    if training.isEmpty():
        return Codes([], True)
    texts = training.select("text").mapInPandas(counted, "shard long, m long, words binary, c binary")
    words = texts.rdd.map(lambda r: (r[0], (r[1], bytes(r[2]), bytes(r[3])))).partitionBy(n).mapPartitions(by_step)
    sizes: dict[int, int] = {}
    for steps, many in words.map(lambda x: np.unique(x[1], return_counts=True)).collect():
        for k, m in zip(steps.tolist(), many.tolist()):
            sizes[k] = sizes.get(k, 0) + m
    taken, left = [], held
    for k in sorted(sizes, reverse=True):
        if sizes[k] > left:
            break
        left -= sizes[k]
        taken.append(k)
    least = min(taken, default=1 << 30)
    found = words.map(lambda x: (x[0][x[1] >= least], x[1][x[1] >= least].astype(np.uint8))).collect()
    hashes, steps = (np.concatenate([x[k] for x in found]) for k in (0, 1))
    packed = []
    for k in taken:
        own = np.sort(hashes[steps == k])
        packed.append((len(own), _pack(np.diff(own, prepend=np.uint64(0)))))
    return Codes(packed, len(taken) == len(sizes))


def _places(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted key is among sorted ones, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


#: Marks what stands for a word without a code: its hash with this bit, so that no code is like it.
_HASHED = np.uint64(1 << 63)


def _deal(codes: Broadcast, shards: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """From rows: packed tokens by the shard of the word before them, with the two words before; and the list of a block's rows.

    A word with a code goes to the shard that is the code modulo their number.
    """

    def packed(m: int, words: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, row: np.ndarray, trains: np.ndarray) -> bytes:
        used = np.concatenate([u, v, w])
        beyond = used >= m
        others, place = np.unique(words[(used[beyond] - m).astype(np.int64)], return_inverse=True)
        used[beyond] = place + m
        u, v, w = used.reshape(3, -1)
        spot = np.where(v < m, v // shards, m // shards + 1 + v - m).astype(np.uint64) * np.uint64(len(trains)) + row.astype(np.uint64)
        by = np.argsort(spot)
        return pickle.dumps((len(by), np.packbits(trains).tobytes(), len(trains), _pack(np.diff(spot[by], prepend=np.uint64(0))),
                             _pack(u[by]), _pack(w[by]), len(others), _pack(np.diff(others, prepend=np.uint64(0)))))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, k = TaskContext.get().partitionId(), 0
        keys, code_of = codes.value.table()
        m = len(codes.value) + codes.value.whole
        texts: list[np.ndarray] = []
        listed: list[tuple] = []
        held = 0

        def dealt() -> Iterator[pd.DataFrame]:
            block = (task << 24) + k
            n = np.array([len(x) + 1 for x in texts])
            starts = np.cumsum(n + 2) - n - 2
            padded = np.full(int(n.sum()) + 2 * len(n), _START)
            ends = starts + n + 1
            inside = np.ones(len(padded), dtype=bool)
            inside[starts] = inside[starts + 1] = inside[ends] = False
            padded[inside] = np.concatenate(texts)
            padded[ends] = _STOP
            inside[ends] = True
            at = np.flatnonzero(inside)
            place, there = _places(keys, padded)
            code = code_of[place].astype(np.int64)
            words = np.empty(0, dtype=np.uint64)
            if codes.value.whole:
                code[~there] = m - 1
            else:
                words, place = np.unique(padded[~there] | _HASHED, return_inverse=True)
                code[~there] = place + m
            del padded, inside, place, there
            row = np.repeat(np.arange(len(n)), n)
            trains = np.array([x[4] for x in listed], dtype=bool)
            v = code[at - 1]
            shard = v % shards
            shard[v >= m] = _numbered(words, _SALTS[0], shards)[v[v >= m] - m]
            by = np.argsort(shard, kind="stable")
            edges = np.searchsorted(shard[by], np.arange(shards + 1))
            for s in range(shards):
                own = by[edges[s]:edges[s + 1]]
                if len(own):
                    yield pd.DataFrame({"shard": [s], "block": [block],
                                        "data": [packed(m, words, code[at[own] - 2], v[own], code[at[own]], row[own], trains)]})
            rows = pickle.dumps([(*x[:4], int(m)) for x, m in zip(listed, n)])
            yield pd.DataFrame({"shard": [shards + block % shards], "block": [block], "data": [zlib.compress(rows, 1)]})

        for batch in batches:
            for doc_id, lang, seen, trains, scored, text in zip(*(batch[c] for c in ("doc_id", "lang", "seen", "trains", "scored", "text"))):
                texts.append(_hashes(text))
                listed.append((int(doc_id), lang, bool(seen), bool(scored), bool(trains)))
                held += len(texts[-1]) + 1
                if held >= _TOKENS:
                    yield from dealt()
                    texts.clear()
                    listed.clear()
                    held, k = 0, k + 1
        if texts:
            yield from dealt()

    return blocks


class _Shard:
    """The tokens of a shard: all that have certain words before their last one, so contexts and two-word counts are whole here."""

    def __init__(self, shard: int, blobs: list[tuple[int, bytes]], codes: Codes, shards: int):
        self.shard, self.shards = shard, shards
        self.blobs = [(block, pickle.loads(x)) for block, x in blobs]
        self.codes = len(codes) + codes.whole
        #: Words of the tokens without codes here: a token's code is its word's place after the codes.
        self.others = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *(self.others_of(x) for _, x in self.blobs)]))
        #: Tokens are read by parts of the words two before, so memory is bounded for very frequent words, too.
        self.parts = 1 + sum(x[0] for _, x in self.blobs) // _AT_ONCE

    @staticmethod
    def others_of(packed: tuple) -> np.ndarray:
        return np.cumsum(_unpack(packed[7], packed[6]), dtype=np.uint64) if packed[6] else np.empty(0, dtype=np.uint64)

    def words(self, code: np.ndarray) -> np.ndarray:
        """What stands for words in all shards: their codes, or hashes."""
        out = code.astype(np.uint64)
        beyond = code >= self.codes
        out[beyond] = self.others[(code[beyond] - np.uint64(self.codes)).astype(np.int64)]
        return out

    def read(self, part: int, trained: bool = False) -> Iterator[tuple[int, int, np.ndarray, ...]]:
        """By block: (block, rows of the block, row, u, v, w, whether the row trains), words as codes."""
        for block, packed in self.blobs:
            n, trains, rows, spots, u, w, *_ = packed
            trains = np.unpackbits(np.frombuffer(trains, dtype=np.uint8), count=rows).astype(bool)
            spot, row = np.divmod(np.cumsum(_unpack(spots, n), dtype=np.uint64), np.uint64(rows))
            row, last = row.astype(np.int32), np.uint64(self.codes // self.shards)
            v = np.where(spot <= last, spot * np.uint64(self.shards) + np.uint64(self.shard), spot - last - np.uint64(1) + np.uint64(self.codes))
            keep = trains[row] if trained else np.ones(n, dtype=bool)
            own = np.searchsorted(self.others, self.others_of(packed))
            words = []
            for code in (_unpack(u, n), v, _unpack(w, n)):
                beyond = code >= self.codes
                code[beyond] = own[(code[beyond] - np.uint64(self.codes)).astype(np.int64)] + self.codes
                words.append(code.astype(np.uint32))
            if self.parts > 1:
                keep &= _numbered(words[0].astype(np.uint64), _SALTS[1], self.parts) == part
            row = row[keep]
            yield block, rows, row, *(x[keep] for x in words), trains[row]

    def last_words(self) -> np.ndarray:
        """The different words that tokens are."""
        found = [np.unique(x[5]) for part in range(self.parts) for x in self.read(part)]
        return self.words(np.unique(np.concatenate(found)))

    @staticmethod
    def threes(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Contexts (v, u), three words as (place of the context, w), their counts."""
        contexts, place = np.unique(_two(v, u), return_inverse=True)
        grams, c = np.unique(_two(place, w), return_counts=True)
        return contexts, grams, c, (contexts[(grams >> np.uint64(32)).astype(np.int64)] & ~_LOW) | (grams & _LOW)

    def count(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many three-word grams occur once to four times, two words as (v, w), and the number of different words before each."""
        ones, twos = np.zeros(4, dtype=np.int64), []
        for part in range(self.parts):
            u, v, w = (np.concatenate(x) for x in zip(*(x[3:6] for x in self.read(part, True))))
            _, _, c, pairs = self.threes(u, v, w)
            ones += np.bincount(c[c <= 4], minlength=5)[1:5]
            twos.append(np.unique(pairs, return_counts=True))
        keys, at = np.unique(np.concatenate([x[0] for x in twos]), return_inverse=True)
        return ones, keys, np.bincount(at, weights=np.concatenate([x[1] for x in twos]), minlength=len(keys)).astype(np.int64)

    def score(self, d3: list[float], d2: list[float], p1: np.ndarray) -> dict[int, np.ndarray]:
        """By block, the sum of the log10 probabilities of each row's tokens here. p1: by word, before interpolation."""
        _, pairs, c = self.count()
        middle, at = np.unique(pairs >> np.uint64(32), return_inverse=True)
        off = _taken(c, d2)
        total = np.bincount(at, weights=c, minlength=len(middle))
        weight = np.bincount(at, weights=off, minlength=len(middle)) / np.maximum(total, 1)
        share = (c - off) / total[at]
        sums = {block: np.zeros(x[2]) for block, x in self.blobs}
        for part in range(self.parts):
            read = list(zip(*self.read(part)))
            u, v, w, trains = (np.concatenate(read.pop(3)) for _ in range(4))
            p = p1[w]
            place, known = _places(middle, v.astype(np.uint64))
            p[known] *= weight[place[known]]
            place, known = _places(pairs, _two(v, w))
            p[known] += share[place[known]]
            contexts, grams, c3, _ = self.threes(u[trains], v[trains], w[trains])
            of = (grams >> np.uint64(32)).astype(np.int64)
            off3 = _taken(c3, d3)
            total3 = np.bincount(of, weights=c3, minlength=len(contexts))
            weight3 = np.bincount(of, weights=off3, minlength=len(contexts)) / total3
            share3 = (c3 - off3) / total3[of]
            place, known = _places(contexts, _two(v, u))
            p[known] *= weight3[place[known]]
            known = np.flatnonzero(known)
            place, there = _places(grams, _two(place[known], w[known]))
            p[known[there]] += share3[place[there]]
            p, at = np.log10(np.maximum(p, 1e-30)), 0
            for block, rows, row in zip(*read):
                sums[block] += np.bincount(row, weights=p[at:at + len(row)], minlength=rows)
                at += len(row)
        return sums


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)


def _taken(c: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


def _shards(records: Iterator[tuple], codes: Codes, shards: int) -> Iterator[tuple[int, _Shard]]:
    found: dict[int, list] = {}
    for shard, (block, data) in records:
        if shard < shards:
            found.setdefault(shard, []).append((block, data))
    while found:
        shard, blobs = found.popitem()
        yield shard, _Shard(shard, blobs, codes, shards)


def _judged(rows: DataFrame, held: int) -> DataFrame:
    """Fit on rows that train, and score those to be scored, of (doc_id, lang, seen, trains, scored, text).

    Every token moves once, with the two words before it, to the shard of the word before it. There the counts of its
    context, of its three words and of its last two are whole. From the other shards come only sums, and in how
    many contexts each word occurs: tasks hold those of words with codes, and shards ask for the others'.
    """
    spark, sc = rows.sparkSession, rows.sparkSession.sparkContext
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = _codes(rows, n, held)
    m, whole = len(codes) + codes.whole, codes.whole
    codes = sc.broadcast(codes)
    dealt = rows.mapInPandas(_deal(codes, n), "shard long, block long, data binary")
    moved = dealt.rdd.map(lambda r: (r[0], (r[1], bytes(r[2])))).partitionBy(n)

    def count(records: Iterator[tuple]) -> Iterator[tuple]:
        for shard, own in _shards(records, codes.value, n):
            threes, pairs, c = own.count()
            yield shard, (threes, np.bincount(c[c <= 4], minlength=5)[1:5])
            words, contexts = np.unique(pairs & _LOW, return_counts=True)
            words = own.words(words)
            yield from _sorted_out(words, contexts, n)

    def merge(records: Iterator[tuple]) -> Iterator[tuple]:
        threes, twos, packed = np.zeros(4, dtype=np.int64), np.zeros(4, dtype=np.int64), []
        for _, x in records:
            if len(x) == 2:
                threes, twos = threes + x[0], twos + x[1]
            else:
                packed.append(x)
        yield threes, twos, *_summed(packed)

    def totals(found: tuple) -> tuple:
        threes, twos, words, c = found
        return threes, twos, *np.unique(c, return_counts=True), words[words < m].astype(np.uint32), c[words < m].astype(np.uint32)

    counted = moved.mapPartitions(count).partitionBy(n)
    sums = counted.mapPartitions(merge).map(totals).collect()
    contexts, at = np.unique(np.concatenate([x[2] for x in sums]), return_inverse=True)
    words = np.bincount(at, weights=np.concatenate([x[3] for x in sums]), minlength=len(contexts)).astype(np.int64)
    times = dict(zip(contexts.tolist(), words.tolist()))
    d3, d2 = (discounts(np.sum([x[k] for x in sums], axis=0).tolist()) for k in (0, 1))
    d1 = discounts([times.get(k, 0) for k in range(1, 5)])
    total = int((contexts * words).sum()) or 1
    freed = float((_taken(contexts, d1) * words).sum()) / total if len(words) else 1.0
    unseen = freed / (int(words.sum()) + 1)
    near = np.zeros(m, dtype=np.uint32)
    for x in sums:
        near[x[4]] = x[5]
    near = sc.broadcast(_pack(near))

    def ask(records: Iterator[tuple]) -> Iterator[tuple]:
        for shard, own in _shards(records, codes.value, n):
            wanted = own.last_words()
            wanted = wanted[wanted >= m]
            for k, (size, words, _) in _sorted_out(wanted, np.zeros(len(wanted)), n):
                yield k, (shard, size, words, b"")

    def answer(records: Iterator[tuple]) -> Iterator[tuple]:
        kept = list(records)
        words, c = _summed([x for _, x in kept if len(x) == 3])
        for _, (shard, size, wanted, _) in (x for x in kept if len(x[1]) == 4):
            wanted = np.cumsum(_unpack(wanted, size), dtype=np.uint64)
            at, there = _places(words, wanted)
            if there.any():
                yield shard, (-1, pickle.dumps((wanted[there], c[at[there]])))

    if not whole:
        asked = moved.mapPartitions(ask).partitionBy(n)
        answers = counted.union(asked).partitionBy(n).mapPartitions(answer).partitionBy(n)
        moved = moved.union(answers).partitionBy(n)

    def score(records: Iterator[tuple]) -> Iterator[tuple]:
        blobs, told = [], {}
        for shard, (block, data) in records:
            if shard >= n:
                yield block, (True, data)
            elif block < 0:
                told.setdefault(shard, []).append(pickle.loads(data))
            else:
                blobs.append((shard, (block, data)))
        for shard, own in _shards(iter(blobs), codes.value, n):
            c = np.concatenate([_unpack(near.value, m), np.zeros(len(own.others), dtype=np.uint64)]).astype(np.int64)
            for words, found in told.get(shard, []):
                at, there = _places(words, own.others)
                c[m:][there] = found[at[there]]
            p1 = unseen + (c - _taken(c, d1)) / total
            for block, x in own.score(d3, d2, p1).items():
                yield block, (False, _pack(x.astype(np.float32).view(np.uint32)))

    def gather(records: Iterator[tuple]) -> Iterator[tuple]:
        listed, found = {}, {}
        for block, (is_list, data) in records:
            if is_list:
                listed[block] = pickle.loads(zlib.decompress(data))
            else:
                found.setdefault(block, []).append(data)
        for block, rows_of in listed.items():
            log10_p = sum(_unpack(x, len(rows_of)).astype(np.uint32).view(np.float32).astype(np.float64) for x in found[block])
            for (doc_id, lang, seen, scored, tokens), x in zip(rows_of, log10_p.tolist()):
                if scored:
                    yield None if doc_id == NO_ID else doc_id, lang, seen, tokens, x

    return spark.createDataFrame(moved.mapPartitions(score).partitionBy(n).mapPartitions(gather), _SCORED, verifySchema=False)


_SCORED = "doc_id long, lang string, seen boolean, n_tokens long, log10_p double"


def values(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows that train and are not scored, from column ``text``, for ``score``."""
    return texts.select(F.lit(NO_ID).alias("doc_id"), F.lit(None).cast("string").alias("lang"), F.lit(False).alias("seen"),
                        F.lit(True).alias("trains"), F.lit(False).alias("scored"), "text")


def score(rows: DataFrame, model: DataFrame, held: int = _HELD) -> DataFrame:
    """Add ``n_tokens`` and ``log10_p`` to rows of (doc_id, lang, seen, text), by a model of other rows."""
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "lang", "seen", F.lit(False).alias("trains"), F.lit(True).alias("scored"), "text")
    return _judged(rows.unionByName(model), held)


def classify(docs: DataFrame, trusted: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", quantile: float = 0.99) -> DataFrame:
    """A row per document: doc_id, lang, n_tokens, log10_p, perplexity, limit and kept.

    ``trusted`` has the ids of trusted documents. Three quarters of them, by a hash, all train the model. The
    limit of a language is the ``quantile`` of the perplexities of its trusted documents of the last
    quarter, over all of them, since the model knows those it was trained on; a language without such takes
    that of all languages, and without any trusted document every document is kept.

    Null and empty texts have the end as their only token. A null id is never trusted; a null language
    is one of its own. Repeated rows are judged each. An empty table gives no rows. Other columns are
    ignored.
    """
    known = trusted.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    known = known.withColumn("trusted", F.lit(True))
    part = F.xxhash64(F.coalesce("doc_id", F.lit(NO_ID)), F.lit("part"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       text_of(text_col).alias("text"), part.alias("part"))
    chosen = known.select("doc_id", part.alias("part")).filter(F.pmod("part", F.lit(4)) != 0).select("doc_id")
    if 8 * chosen.count() <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)
    rows = rows.join(chosen.withColumn("known", F.lit(True)), "doc_id", "left")
    scored = scratch.write(_judged(rows.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "lang", (F.pmod("part", F.lit(4)) != 0).alias("seen"),
        F.col("known").isNotNull().alias("trains"), F.lit(True).alias("scored"), "text"), _HELD), "scored")
    ppl = F.pow(F.lit(10.0), -F.col("log10_p") / F.col("n_tokens"))
    scored = scored.withColumn("perplexity", ppl)
    held = scored.filter(~F.col("seen")).join(known.select("doc_id"), "doc_id", "left_semi")
    limits = held.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("own"))
    overall = held.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    own = limits.withColumnRenamed("lang", "lang_of")
    judged = scored.join(F.broadcast(own), F.col("lang").eqNullSafe(F.col("lang_of")), "left")
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return judged.select("doc_id", "lang", "n_tokens", "log10_p", "perplexity", limit.alias("limit"),
                         F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("kept"))
