import random
from collections import Counter, defaultdict
from itertools import combinations
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from placelake.llm import packing
from placelake.llm.common import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_ids_equal_the_tokenizers(tokenizer):
    rng = random.Random(1)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n\n b", "  x", "x  y", "<|endoftext|> x", "it's we're", "ünï çødé 𝔘 ✓",
             "x" * 5000, " " * 4000 + "a", "a\t\tb  c\r\n", "1 234  5", "  y", "a　b"]
    texts += ["".join(rng.choice("ab 1.'s\n\té  ") for _ in range(200)) for _ in range(200)]
    encode = packing.Encoder(PATH)
    for text in texts:
        got = np.frombuffer(encode.ids(text), dtype="<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def exact_bins(lengths, capacity):
    """The fewest bins, by trying all ways."""
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[k] <= capacity:
                bins[b] += lengths[k]
                place(k + 1, bins)
                bins[b] -= lengths[k]
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best[0]


def test_bounds_hold_and_fits_are_valid():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([10, 24, 60])
        lengths = np.array(sorted((rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))), reverse=True))
        for fit in (packing.best_fit_decreasing, packing.least_slack, packing.fewest_bins):
            bins, offsets, fills = fit(lengths, capacity)
            assert packing.lower_bound(lengths, capacity) <= exact_bins(lengths.tolist(), capacity) <= len(fills)
            for b in range(len(fills)):
                own = sorted(zip(offsets[bins == b], lengths[bins == b]))
                assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and fills[b] <= capacity


def test_least_slack_finds_the_best_sum():
    rng = random.Random(4)
    for _ in range(200):
        items = [rng.randrange(1, 30) for _ in range(rng.randrange(0, 9))]
        free = rng.randrange(0, 60)
        counts = sorted(Counter(items).items(), reverse=True)
        chosen = packing._best_sum([(x, n) for x, n in counts if x <= free], free)
        sums = {sum(own) for k in range(len(items) + 1) for own in combinations(items, k)}
        assert sum(chosen) == max(s for s in sums if s <= free) and not Counter(chosen) - Counter(items)


def test_a_gap_within_one_group_is_closed(spark, scratch):
    lengths = [7, 7, 5, 5, 4, 4, 3, 3, 2, 2] * 6 + [6, 3, 1] * 3  # best-fit decreasing may leave room here
    rng = np.random.default_rng(1)
    mixed = rng.integers(200, 500, 400)
    items = spark.createDataFrame([(k, int(x)) for k, x in enumerate(mixed)], "uid long, length long")
    n = items.join(packing.pack(items, scratch, capacity=1024), "uid").select("sequence_id").distinct().count()
    assert n < len(packing.best_fit_decreasing(mixed, 1024)[2]) and n >= packing.lower_bound(mixed, 1024)
    assert len(packing.fewest_bins(np.array(lengths), 10)[2]) == packing.lower_bound(np.array(lengths), 10)


def test_query_is_within_one_of_its_bound(spark):
    from placelake.llm import queries

    rows = queries.op5_certified_packing(spark, "/root/testdata/sf0.001").toPandas()
    assert rows.groupby("sequence_id")["length"].sum().max() <= 1024
    assert rows["sequence_id"].nunique() <= packing.lower_bound(rows["length"].to_numpy(), 1024) + 1


def test_bound_beats_the_plain_sum():
    assert packing.lower_bound(np.array([6, 6, 6, 6]), 10) == 4
    assert packing.lower_bound(np.array([5, 5, 5, 5, 5]), 10) == 3


def test_exchange_reaches_the_bound(spark, scratch):
    rng = random.Random(3)
    lengths = [rng.randrange(1, 400) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    placed = packing.pack(items, scratch, capacity=1024, group_items=100).collect()
    fills = defaultdict(list)
    for r in placed:
        fills[r["sequence_id"]].append((r["offset"], lengths[r["uid"]]))
    assert len(placed) == 3000
    for own in fills.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and sum(x for _, x in own) <= 1024
    assert len(fills) <= 1.005 * packing.lower_bound(np.array(lengths), 1024)


def test_edges(edge_docs, no_docs, scratch, tokenizer):
    rows = packing.pack_documents(edge_docs, scratch, PATH).collect()
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert [(r["piece"], r["start"], r["length"]) for r in by_doc[1]] == [(0, 0, 1)]
    assert by_doc[1][0]["ids_crc32"] == crc32((2).to_bytes(4, "little"))
    assert len(by_doc[5]) == 2 and None in by_doc
    text = next(r["text"] for r in edge_docs.filter("doc_id = 4").collect())
    ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
    pieces = sorted(by_doc[4], key=lambda r: r["piece"])
    assert [r["start"] for r in pieces] == [0, *range(len(ids) % 1024 or 1024, len(ids), 1024)]
    assert all(r["ids_crc32"] == crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in pieces)
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
    assert packing.pack_documents(no_docs, Scratch(no_docs.sparkSession, "none"), PATH).count() == 0
