import hashlib
import random

import numpy as np
import pytest

from placelake.llm import queries
from placelake.llm import suffix_dedup as s
from placelake.llm.common import Scratch


def brute(rows):
    """By row: bytes, removed, spans, digest of what is kept. Windows at equal (id, start) are not earlier."""
    first = {}
    coded = [(i if i is not None else -2**63, (t or "").encode()) for i, t in rows]
    for i, data in coded:
        for k in range(len(data) - 99):
            w = data[k:k + 100]
            first[w] = min(first.get(w, (i, k)), (i, k))
    out = []
    for i, data in coded:
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - 99):
            if first[data[k:k + 100]] < (i, k):
                gone[k:k + 100] = True
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        out.append((len(data), int(gone.sum()), int((np.diff(gone, prepend=False) & gone).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ñ") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    passage = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 80)))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passage)
            a = rng.randrange(len(p) // 2)
            parts += [p[a:a + rng.randrange(60, 400)], rng.choice(words)]
        rows.append((rng.randrange(1000) * 100 + i, " ".join(parts)))
    rows += [(7, rows[0][1]), (rows[1][0], rows[1][1]), (8, "ab" * 400), (9, "ab" * 300), (10, "z" * 99), (11, "z" * 100),
             (12, "z" * 101), (13, None), (None, passage[0]), (14, ""), (8, passage[1])]
    return rows


def result(docs, scratch, **options):
    left = s.shortened(docs, scratch, **options).collect()
    return {(r["_id"], r["n_bytes"]): (r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in left if r["n_removed"]}


@pytest.mark.parametrize("in_task", [20_000, 1])
def test_equals_brute_force(make_docs, scratch, in_task):
    """Also with every mixed anchor decided window by window."""
    rows = made(3)
    want = {(i if i is not None else -2**63, b[0]): b[1:] for (i, _), b in zip(rows, brute(rows)) if b[1]}
    assert result(make_docs(rows), scratch, in_task=in_task) == want


def test_anchors_of_equal_windows_are_equal():
    rng = np.random.default_rng(1)
    inner = rng.integers(97, 101, 300, dtype=np.uint8).tobytes()
    a, b = rng.integers(0, 256, 5000, dtype=np.uint8).tobytes() + inner, inner + b"tail" * 50
    def by_window(data):
        hashes, place, low, high = s.anchors(data)
        assert low[0] == 0 and high[-1] == len(data) - 100 and (low[1:] == high[:-1] + 1).all()
        return {k: (h, p - k) for h, p, x, y in zip(hashes, place, low, high) for k in range(x, y + 1)}
    left, right = by_window(a), by_window(b)
    assert all(left[5000 + k] == right[k] for k in range(201))


def test_long_texts_are_cut_without_a_seam():
    data = np.random.default_rng(2).integers(0, 256, s._CHUNK + 3000, dtype=np.uint8).tobytes()
    hashes, place, low, high = s.anchors(data)
    tail = s.anchors(data[s._CHUNK - 500:])
    assert set(zip(tail[0][1:-1].tolist(), (tail[1][1:-1] + s._CHUNK - 500).tolist())) <= set(zip(hashes.tolist(), place.tolist()))
    assert low[0] == 0 and high[-1] == len(data) - 100


def test_edges(edge_docs, no_docs, scratch):
    short = s.without_repeats(edge_docs, scratch)
    assert short.columns == edge_docs.columns and short.count() == edge_docs.count()
    texts = {r["doc_id"]: r["text"] for r in short.collect()}
    assert texts[1] is None and texts[2] == "" and texts[7] == "x" * 0 + "" or len(texts[7]) < 5000
    assert s.without_repeats(no_docs, Scratch(no_docs.sparkSession, "none")).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: b for (i, _), b in zip(rows, brute(rows))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op2_column_suffixes(spark, sf).collect()}
    assert got == want
