import random
from itertools import combinations

import pytest

from placelake.llm import lsh_forest
from placelake.llm.common import Scratch, components


def brute(rows, size, percent):
    sets, root = {}, {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
        root[i] = i
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def found(docs, scratch, **options):
    return {r["_id"]: (r["n_shingles"], r["component"]) for r in lsh_forest.near_duplicates(docs, scratch, **options).collect()}


def near_rows(n_groups, copies, seed=1):
    rng, rows = random.Random(seed), []
    for g in range(n_groups):
        words = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(copies):
            own = list(words)
            for _ in range(rng.randrange(0, 1 + len(own) // 20)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows) + 1, " ".join(own)))
    return rows


@pytest.mark.parametrize("size,percent,trees", [(3, 85, 16), (5, 80, 24)])
def test_equals_all_pairs(make_docs, scratch, size, percent, trees):
    rows = near_rows(40, 5) + [(900, ""), (901, None), (902, "Two Words"), (903, "two words"), (904, "two")]
    assert found(make_docs(rows), scratch, shingle=size, percent=percent, trees=trees) == brute(rows, size, percent)


def test_dense_region_equals_all_pairs(make_docs, scratch):
    """More near copies than a region takes: its rest is compared in blocks."""
    rows = near_rows(2, 60, seed=5)
    assert found(make_docs(rows), scratch, shingle=3, percent=85, trees=16, limit=4, most=5) == brute(rows, 3, 85)


def test_lone_pairs_among_similar_documents_equal_all_pairs(make_docs, scratch):
    """A region of hundreds goes deeper, where a pair of similarity 0.85 parts in most trees."""
    rng, passage, rows = random.Random(8), " ".join(f"p{k}" for k in range(170)), []
    for d in range(120):
        own = [f"d{d}w{k}" for k in range(30)]
        rows.append((2 * d, f"{passage} {' '.join(own)}"))
        for at in (5, 12, 19, 26):
            own[at] = f"e{rng.randrange(10**9)}"
        rows.append((2 * d + 1, f"{passage} {' '.join(own)}"))
    want = brute(rows, 3, 85)
    assert len({root for _, root in want.values()}) == 120
    assert found(make_docs(rows), scratch, shingle=3, percent=85, trees=6, least=1, limit=8) == want


def test_edges(edge_docs, no_docs, scratch):
    kept = lsh_forest.keep_one(edge_docs, scratch)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert ids == [(False, k) for k in (1, 2, 3, 4, 5, 6, 6, 7, 8)] + [(True, 0)]
    assert lsh_forest.keep_one(no_docs, Scratch(no_docs.sparkSession, "none")).count() == 0


def test_components_of_a_long_chain(spark, scratch):
    order = list(range(400))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(links, scratch, "c").collect()}
    assert got == {**{k: 0 for k in range(400)}, 1000: 1000, 1001: 1000}
