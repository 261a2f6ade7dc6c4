import hashlib
import random

import numpy as np
import pytest

from placelake.llm import fill_in_middle as f
from placelake.llm.common import plain_id


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    return (len(text), *(("spm", a, b - a, s + p + m) if h[3] % 100 < 20 else ("psm", a, b - a, p + s + m)))


def some_text(rng, n):
    alphabet = "ab \n." + "äß" + "漢字" + "𝔘😀" + "<PSM>"
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_equals_slices(spark, make_docs):
    rng = random.Random(3)
    docs = [(k, some_text(rng, rng.choice([0, 1, 2, 30, 3000]))) for k in range(300)]
    found = f.fill_in_middle(make_docs(docs)).withColumn("again", f.restored(f.F.col("output"), f.F.col("form"))).collect()
    rows = {r["_id"]: r for r in found}
    assert len(found) == 300
    for doc_id, text in docs:
        r = rows[doc_id]
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == brute(doc_id, text)
        assert r.again == text
    assert {r.form for r in found} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("bound", [0, 1, 96, 127])
@pytest.mark.parametrize("unit", ["char", "word"])
def test_every_rank_is_found(bound, unit):
    rng = random.Random(bound)
    for text in ("", "a", "  a b", some_text(rng, 2000), "x" * 500 + "漢" * 500 + "😀" * 500, "ä " * (f._PIECE // 2 + 77)):
        data = text.encode()
        if unit == "char":
            want = np.cumsum([0, *(len(c.encode()) for c in text)]).tolist()
        else:
            space = [b in b" \t\n\x0b\x0c\r" for b in data]
            want = [k for k in range(len(data)) if k == 0 or (not space[k] and space[k - 1])] + [len(data)]
        index = f.RankIndex(f.unit_starts(data, unit), len(data), bound)
        assert index.n == len(want) - 1
        ranks = range(len(want)) if len(want) < 5000 else rng.sample(range(len(want)), 2000)
        assert all(index.offset(k) == want[k] for k in ranks)
        assert np.abs(index.misses.astype(int)).max() <= bound


def test_fewer_segments_under_a_wider_bound():
    data = "".join("x" * (k % 97) + "漢" * (k * k % 89) for k in range(1500)).encode()
    sizes = [len(f.RankIndex(f.unit_starts(data), len(data), bound).firsts) for bound in (0, 4, 96)]
    assert sizes[0] > sizes[1] > sizes[2]


def test_words_as_units(spark, make_docs):
    rows = f.fill_in_middle(make_docs([(k, f"alpha beta  gamma\ndelta {k}") for k in range(40)]), unit="word", plain_percent=0).collect()
    for r in rows:
        parts = r.output.replace("<P>", "|").replace("<S>", "|").replace("<M>", "|").split("|")
        assert r.n == 5 and all(p == "" or p[0] not in " \n" for p in parts)


def test_edges(spark, edge_docs, no_docs):
    assert f.fill_in_middle(no_docs).collect() == []
    want = sorted(map(repr, ((r.doc_id, *brute(r.doc_id, r.text)) for r in edge_docs.collect())))
    found = f.fill_in_middle(edge_docs).select(plain_id().alias("doc_id"), "n", "form", "prefix_units", "middle_units", "output")
    assert sorted(map(repr, map(tuple, found.collect()))) == want
    with pytest.raises(ValueError):
        f.RankIndex(iter(()), 0, 128)
