"""Benchmark decontamination: documents that hold a benchmark item, up to some edits.

Items and item-sized windows of documents are embedded by CGK's random walk, which turns a small edit
distance into a small Hamming distance. Samples of the embedded positions are bucket keys; enough of them
are drawn to reach a target recall. Windows that share a key with an item are checked by edit distance.
Items too short to be told apart after edits are looked for as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import text_of

#: Bytes of normalised items that one index may hold; a larger benchmark is searched in several.
INDEX_BYTES = 8 << 20
_OTHER = re.compile(r"[\W_]+")
_Q = 10
_BITMAP_BITS = 22
#: Bytes of texts and windows that walk together.
_WALKED_BYTES, _WALKED_STARTS = 2 << 20, 16_384
#: Steps whose random moves are made at once, and the most keys that are drawn before keys are made shorter.
_STEPS, _MOST_KEYS = 1024, 4096
#: In words of more bytes, and among letters of three bytes or more (scripts without spaces), windows start at every letter.
_LONG_WORD, _UNSPACED = 20, 0xE0
_MATCH = "array<struct<item_id:bigint,distance:int,item_chars:int>>"


def normalised(text: str) -> bytes:
    """Lower case, with everything but letters and digits as single spaces, in UTF-8."""
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def grams(data: np.ndarray) -> np.ndarray:
    """A hash of every run of ten bytes."""
    if len(data) < _Q:
        return np.empty(0, dtype=np.uint64)
    two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    eight = four[:-4] | (four[4:] << np.uint64(32))
    return eight[:-2] * np.uint64(0xD6E8FEB86659FD93) + two[8:] * np.uint64(0xA0761D6478BD642F)


def allowed_edits(n: int, ratio: float) -> int:
    """Edits that an item of n bytes may have: a share of n, and few enough that some run of ten survives."""
    return max(0, min(int(ratio * n), (n - _Q) // _Q))


def edit_distance(item: bytes, text: bytes) -> int:
    """The smallest edit distance between the item and any part of the text, bit-parallel (Myers)."""
    n = len(item)
    masks: dict[int, int] = {}
    for k, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << k)
    every, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = every, 0, n
    best = n
    for c in text:
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(across | up), up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1, minus << 1
        up = (minus | ~((eq | down) | plus)) & every
        down = plus & (eq | down) & every
        best = min(best, score)
    return best


@dataclass
class _Class:
    """Items of about one length, and the samples of the walks that are their keys."""

    items: np.ndarray  # places in the index's lists
    window: int  # bytes of a window, edits included
    shared: int  # runs of ten that a window with an item has at least in common with it
    steps: list[np.ndarray]  # by walk, the sampled steps in order
    samples: list[list[np.ndarray]]  # by walk, places of each key among the sampled steps
    keys: list[list[tuple[np.ndarray, np.ndarray]]]  # by walk and key: sorted keys, and their items


class Index:
    """Buckets of a bounded set of items."""

    def __init__(self, ids: list[int], texts: list[str], ratio: float = 0.08, bits: int = 5, walks: int = 6,
                 recall: float = 0.995, least_chars: int = 20, seed: int = 11):
        pairs = [(i, normalised(t)) for i, t in zip(ids, texts)]
        self.short = _automaton([(i, x) for i, x in pairs if 0 < len(x) < max(least_chars, _Q)])
        pairs = [(i, x) for i, x in pairs if len(x) >= max(least_chars, _Q)]
        self.ids, self.items = [i for i, _ in pairs], [x for _, x in pairs]
        self.ratio = ratio
        self.edits = [allowed_edits(len(x), ratio) for x in self.items]
        rng = np.random.default_rng(seed)
        longest = max(map(len, self.items), default=0)
        self.seed, self.walks = seed, walks
        item_grams = [grams(np.frombuffer(x, dtype=np.uint8)) for x in self.items]
        self.gram_sets = [set(g.tolist()) for g in item_grams]
        self.bitmap = np.zeros(1 << _BITMAP_BITS, dtype=bool)
        if item_grams:
            self.bitmap[_slot(np.concatenate(item_grams))] = True
        self.classes = self._classes(rng, bits, recall)
        #: Each run of the items, and as bits the classes whose items have it.
        owned = [(item_grams[k], c) for c, part in enumerate(self.classes) for k in part.items]
        every = np.concatenate([g for g, _ in owned]) if owned else np.empty(0, dtype=np.uint64)
        bits_of = np.concatenate([np.full(len(g), 1 << c, dtype=np.uint64) for g, c in owned]) if owned else every
        self.runs, at = np.unique(every, return_inverse=True)
        self.run_classes = np.zeros(len(self.runs), dtype=np.uint64)
        np.bitwise_or.at(self.run_classes, at, bits_of)
        self.pad = 2 * longest + _Q

    def _classes(self, rng: np.random.Generator, bits: int, recall: float) -> list[_Class]:
        lengths = np.array(list(map(len, self.items)), dtype=np.int64)
        steps_of = np.floor(np.log(np.maximum(lengths, 1)) / np.log(1.25)).astype(np.int64)
        made = []
        for step in np.unique(steps_of):
            own = np.flatnonzero(steps_of == step)
            least, most = int(lengths[own].min()), int(lengths[own].max())
            edits = max(self.edits[k] for k in own)
            # The walk of n steps uses about n / 2 bytes: all of it lies within the shortest item.
            n = max(int(1.7 * (least - edits)), bits)
            own_bits, repeats = self._repeats(own, n, bits, recall, rng)
            per_walk = max(1, -(-repeats // self.walks))
            drawn = [[np.sort(rng.choice(n, own_bits, replace=False)) for _ in range(per_walk)] for _ in range(self.walks)]
            sampled = [np.unique(np.concatenate(keys)) for keys in drawn]
            samples = [[np.searchsorted(steps, at) for at in keys] for steps, keys in zip(sampled, drawn)]
            shared = min(len(self.items[k]) - _Q + 1 - _Q * self.edits[k] for k in own)
            part = _Class(own, most + edits, max(shared, 1), sampled, samples, [])
            data, starts = _joined([self.items[k] for k in own], 2 * most + _Q)
            for w in range(self.walks):
                walked = self.walk(data, starts, w, sampled[w])
                keys = [_key(walked, at) for at in samples[w]]
                part.keys.append([(k[o], own[o]) for k in keys for o in [np.argsort(k, kind="stable")]])
            made.append(part)
        return made

    def _repeats(self, own: np.ndarray, n: int, bits: int, recall: float, rng: np.random.Generator) -> tuple[int, int]:
        """Steps per key and the number of keys that reach the recall on copies of items with the most edits allowed.

        Measured on made copies: how often the embeddings agree, by copy, gives each copy's chance. If so many keys as
        are allowed don't reach it, keys of fewer steps do, at more windows to check; an error says if none does.
        """
        tried = [self.items[k] for k in own[:32] for _ in range(-(-32 // len(own)))]
        copies = [_edited(x, allowed_edits(len(x), self.ratio), rng) for x in tried]
        pad, steps = 2 * max(map(len, tried)) + _Q, np.arange(n)
        same = np.array([(self.walk(*_joined(tried, pad), w, steps) == self.walk(*_joined(copies, pad), w, steps)).mean(axis=1)
                         for w in range(self.walks)])
        for own_bits in range(bits, 0, -1):
            hit = np.clip(same**own_bits, 1e-6, 1 - 1e-9)
            repeats = len(hit)
            while repeats <= _MOST_KEYS:
                if (1 - np.prod((1 - hit)**(repeats / len(hit)), axis=0)).mean() >= recall:
                    return own_bits, repeats
                repeats = int(repeats * 1.2) + 1
        raise ValueError(f"{_MOST_KEYS} keys of one step don't reach a recall of {recall} on items of about {len(tried[0])} bytes")

    def walk(self, data: np.ndarray, starts: np.ndarray, which: int, steps: np.ndarray) -> np.ndarray:
        """The embedding at the given steps, in order, for windows at the starts: one row per window.

        Whether the pointer moves on is a seeded hash of walk, step and byte. Other steps are walked and not kept.
        """
        out = np.empty((len(steps), len(starts)), dtype=np.uint8)
        at, kept = starts.copy(), 0
        for first in range(0, int(steps[-1]) + 1 if len(steps) else 0, _STEPS):
            moves = _moves(self.seed, which, first)
            for j in range(first, min(first + _STEPS, int(steps[-1]) + 1)):
                seen = data[at]
                if steps[kept] == j:
                    out[kept] = seen
                    kept += 1
                at += moves[j - first, seen]
        return out.T

    def matches(self, texts: Iterable[str]) -> list[list[tuple[int, int, int]]]:
        """By text: (item id, distance, item length) of the items that it holds within their allowed edits.

        Windows of many texts walk together; texts without a dense enough window are passed over at once.
        """
        out: list[list[tuple[int, int, int]]] = []
        held: list[tuple[int, bytes, list[np.ndarray]]] = []
        size = 0
        for text in texts:
            raw = normalised(text)
            out.append(self._exact(raw))
            starts = self._dense(raw)
            if any(map(len, starts)):
                held.append((len(out) - 1, raw, starts))
                size += len(raw)
            if size > _WALKED_BYTES:
                self._decide(held, out)
                held, size = [], 0
        self._decide(held, out)
        return out

    def _exact(self, raw: bytes) -> list[tuple[int, int, int]]:
        """The short items that the text holds as they are, from a word's start to a word's end.

        Among letters of scripts without spaces, words start and end anywhere.
        """
        if self.short is None:
            return []
        text, found = raw.decode("utf-8", "surrogatepass"), set()
        for last, (item, ids) in self.short.iter(text):
            first = last + 1 - len(item)
            starts = first == 0 or text[first - 1] == " " or item[0] >= "\u0800"
            if starts and (last + 1 == len(text) or text[last + 1] == " " or item[-1] >= "\u0800"):
                found.update((i, 0, len(item.encode("utf-8", "surrogatepass"))) for i in ids)
        return sorted(found, key=_by_id)

    def _dense(self, raw: bytes) -> list[np.ndarray]:
        """By class, the starts whose window has as many of the items' runs as an item needs."""
        data = np.frombuffer(raw, dtype=np.uint8)
        values = grams(data)
        maybe = np.flatnonzero(self.bitmap[_slot(values)])
        if not self.classes or len(maybe) < min(part.shared for part in self.classes):
            return []
        at = np.minimum(np.searchsorted(self.runs, values[maybe]), len(self.runs) - 1)
        owners = np.where(self.runs[at] == values[maybe], self.run_classes[at], np.uint64(0))
        words, starts = None, []
        for c, part in enumerate(self.classes):
            hits = maybe[(owners >> np.uint64(c)) & np.uint64(1) == 1]
            if len(hits) < part.shared:
                starts.append(hits[:0])
                continue
            if words is None:
                words = _starts(data)
            held = np.searchsorted(hits, words + part.window) - np.searchsorted(hits, words)
            starts.append(words[held >= part.shared])
        return starts

    def _decide(self, held: list[tuple[int, bytes, list[np.ndarray]]], out: list[list]) -> None:
        if not held:
            return
        data, firsts = _joined([raw for _, raw, _ in held], self.pad)
        found: set[tuple[int, int]] = set()  # (start in the joined texts, item)
        for c, part in enumerate(self.classes):
            starts = np.concatenate([first + own[c] for first, (_, _, own) in zip(firsts, held)])
            for a in range(0, len(starts), _WALKED_STARTS):
                self._meet(part, data, starts[a:a + _WALKED_STARTS], found)
        by_text: dict[int, dict[int, list[int]]] = {}
        for start, k in sorted(found):
            t = int(np.searchsorted(firsts, start, "right")) - 1
            by_text.setdefault(t, {}).setdefault(k, []).append(start - int(firsts[t]))
        for t, items in by_text.items():
            at, raw, _ = held[t]
            checked = [(self.ids[k], self._checked(k, raw, starts), len(self.items[k])) for k, starts in items.items()]
            out[at] = sorted([*out[at], *(m for m in checked if m[1] is not None)], key=_by_id)

    def _meet(self, part: _Class, data: np.ndarray, starts: np.ndarray, found: set[tuple[int, int]]) -> None:
        for w, keys in enumerate(part.keys):
            walked = self.walk(data, starts, w, part.steps[w])
            for at, (sorted_keys, items) in zip(part.samples[w], keys):
                wanted = _key(walked, at)
                low, high = np.searchsorted(sorted_keys, wanted), np.searchsorted(sorted_keys, wanted, "right")
                for i in np.flatnonzero(high > low):
                    found.update((int(starts[i]), int(k)) for k in items[low[i]:high[i]])

    def _checked(self, k: int, raw: bytes, starts: list[int]) -> int | None:
        """The smallest distance of item k to the text around the starts, if it is allowed."""
        item, edits = self.items[k], self.edits[k]
        need, best = len(item) - _Q + 1 - _Q * edits, None
        at = 0
        while at < len(starts):
            first = last = starts[at]
            while at < len(starts) and starts[at] <= last + edits + 16:
                last = starts[at]
                at += 1
            around = raw[max(0, first - edits):last + len(item) + edits]
            own = grams(np.frombuffer(around, dtype=np.uint8))
            if sum(map(self.gram_sets[k].__contains__, own.tolist())) < need:
                continue
            distance = edit_distance(item, around)
            if distance <= edits and (best is None or distance < best):
                best = distance
        return best


def _by_id(match: tuple) -> tuple:
    return match[0] is None, match[0] or 0, match[1]


def _automaton(items: list[tuple[int, bytes]]) -> ahocorasick.Automaton | None:
    """All short items at once; equal ones are one entry."""
    ids: dict[str, list] = {}
    for i, x in items:
        ids.setdefault(x.decode("utf-8", "surrogatepass"), []).append(i)
    if not ids:
        return None
    made = ahocorasick.Automaton()
    for item, own in ids.items():
        made.add_word(item, (item, own))
    made.make_automaton()
    return made


def _starts(data: np.ndarray) -> np.ndarray:
    """Where windows start: at words, and at every letter of long words and of scripts without spaces."""
    spaces = np.flatnonzero(data == 32)
    words = np.concatenate([[0], spaces + 1])
    lengths = np.concatenate([spaces, [len(data)]]) - words
    wanted = data >= _UNSPACED
    wanted[words[words < len(data)]] = True
    for k in np.flatnonzero(lengths > _LONG_WORD):
        wanted[words[k]:words[k] + lengths[k]] |= (data[words[k]:words[k] + lengths[k]] & 0xC0) != 0x80
    return np.flatnonzero(wanted)


@lru_cache(maxsize=128)
def _moves(seed: int, which: int, first: int) -> np.ndarray:
    """By step from the first one and byte, whether the pointer moves on."""
    x = np.arange(first * 256, (first + _STEPS) * 256, dtype=np.uint64)
    x += np.uint64((seed * 1_000_003 + which + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x >> np.uint64(33)) & np.uint64(1)).astype(np.uint8).reshape(_STEPS, 256)


def _slot(values: np.ndarray) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)


def _joined(texts: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(t) + pad for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(t + bytes(pad) for t in texts), dtype=np.uint8)
    return data, np.cumsum(lengths) - lengths


def _key(walked: np.ndarray, at: np.ndarray) -> np.ndarray:
    key = np.zeros(len(walked), dtype=np.uint64)
    for j in at:
        key = (key << np.uint64(8)) | walked[:, j].astype(np.uint64)
    return key


def _edited(item: bytes, edits: int, rng: np.random.Generator) -> bytes:
    """A copy with so many bytes changed, dropped or added at random."""
    out = list(item)
    for _ in range(edits):
        at, kind, c = int(rng.integers(len(out))), int(rng.integers(3)), int(rng.integers(97, 123))
        if kind == 0:
            out[at] = c
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, c)
    return bytes(out)


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", index_bytes: int = INDEX_BYTES,
            **options) -> Iterator[Index]:
    """Indexes over all items, each over a part of at most about ``index_bytes``."""
    rows = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), text_of(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // index_bytes))
    for k in range(parts):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text")
        items = own.collect()
        yield Index([r["item_id"] for r in items], [r["text"] for r in items], **options)


def matcher(index: Index, df: DataFrame) -> Callable[[Column], Column]:
    """A column function: text to the array of (item_id, distance, item_chars) found in it."""
    held = df.sparkSession.sparkContext.broadcast(index)

    @F.pandas_udf(_MATCH)
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = held.value
        for batch in batches:
            yield pd.Series([[{"item_id": i, "distance": d, "item_chars": n} for i, d, n in found] for found in own.matches(batch)])

    return matches


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """A row per document and item that it holds: doc_id, item_id, distance, item_chars.

    An item of n normalised bytes is held if some part of the normalised text is within
    ``allowed_edits(n, ratio)`` edits of it and begins where a word does, or anywhere in words of over 20 bytes and in
    scripts without spaces. Items under ``least_chars`` bytes are held as they are, as whole words. Documents are read once
    for each index of at most ``INDEX_BYTES`` of items, without a shuffle. Null or empty texts hold nothing; null and
    empty items are held by nothing. Null ids stay null. Repeated documents and
    items give rows each. An empty table gives no rows. Other columns are ignored.
    """
    found = None
    for index in indexes(benchmark, **options):
        rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), matcher(index, docs)(text_of(text_col)).alias("m"))
        rows = rows.select("doc_id", F.explode("m").alias("m")).select("doc_id", "m.item_id", "m.distance", "m.item_chars")
        found = rows if found is None else found.unionByName(rows)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    for index in indexes(benchmark, **options):
        docs = docs.filter(F.size(matcher(index, docs)(text_of(text_col))) == 0)
    return docs
