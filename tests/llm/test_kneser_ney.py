import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from placelake.llm import kneser_ney as kn
from placelake.llm import queries
from placelake.llm.common import Scratch


@pytest.fixture
def model(spark, scratch):
    texts = ["the cat sat on the mat", "the cat ran", "a dog sat on the cat", "the dog ran on", "a mat on a mat", "the cat sat"]
    return kn.fit(spark.createDataFrame([(t,) for t in texts], "text string"), scratch), sorted({w for t in texts for w in t.split()})


def test_next_words_sum_to_one(model):
    """Over every known word, the end, and one unseen word."""
    found, words = model
    for start in [[], ["the"], ["the", "cat"], ["zebra"], ["on", "the"], ["a"]]:
        nexts = [10 ** found.token_log10(" ".join([*start, w]))[len(start)] for w in [*words, "unseen"]]
        assert sum(nexts) + 10 ** found.token_log10(" ".join(start))[-1] == pytest.approx(1, abs=1e-5)


def test_seen_text_is_likelier(model):
    found, _ = model
    assert found.log10("the cat sat on the mat")[0] > found.log10("mat the on sat cat the")[0] > found.log10("x y z q r s")[0]


def test_shards_find_what_is_there():
    import pandas as pd

    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-2**63, 2**63 - 1, 5000))
    shards = kn.Shards(pd.DataFrame({"key": keys, "share": np.arange(len(keys)), "weight": 0.0}), bits=6)
    wanted = np.concatenate([keys, keys[:100] + 1]).view(np.uint64)
    at = shards.find(wanted)
    assert (shards.keys[at[:len(keys)]] == keys.view(np.uint64)).all() and (at[len(keys):] == -1).sum() >= 99


def test_edges(spark, edge_docs, no_docs, scratch):
    trusted = spark.createDataFrame([(i,) for i in (4, 5, 6, 7, None)], "doc_id long")
    rows = kn.classify(edge_docs, trusted, scratch).collect()
    assert len(rows) == edge_docs.count() and all(r["n_tokens"] >= 1 and np.isfinite(r["log10_p"]) for r in rows)
    assert kn.classify(no_docs, trusted, Scratch(spark, "none")).count() == 0
    nobody = kn.classify(edge_docs, trusted.filter("false"), Scratch(spark, "nobody")).collect()
    assert len(nobody) == edge_docs.count() and all(r["kept"] for r in nobody)


def test_labels_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = {r["doc_id"]: r["kept"] for r in queries.op3_kneser_ney(spark, sf).collect()}
    good = [rows[i] for i, q in labels.items() if q == 1]
    bad = [rows[i] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.5


def test_discounts():
    y = 100 / (100 + 2 * 40)
    assert kn.discounts([100, 40, 20, 10]) == pytest.approx([1 - 2 * y * 40 / 100, 2 - 3 * y * 20 / 40, 3 - 4 * y * 10 / 20])
    rng = np.random.default_rng(2)
    for _ in range(500):
        d = kn.discounts(list(rng.integers(0, 6, 4) * rng.integers(0, 2, 4)))
        assert 0 < d[0] <= d[1] <= d[2] and all(x < k for k, x in enumerate(d, 1))
    assert kn.discounts([0, 0, 0, 0]) == [0.5] * 3
    assert kn.discounts([10, 5, 3, 0]) == [0.5] * 3 and kn.discounts([1, 6, 1, 0]) == [1 / 13] * 3


def _mixed_texts(n):
    rng = np.random.default_rng(5)
    words = np.array([f"w{int(k)}" for k in rng.zipf(1.3, 40 * n) % 5000])
    return [(k, " ".join(words[40 * k:40 * k + 1 + k % 40])) for k in range(n)]


def test_every_trusted_document_of_three_quarters_trains(make_docs, spark, scratch):
    """Far more trusted documents than 500: the scores are those of a model fitted on all that may train."""
    docs = make_docs(_mixed_texts(2000))
    rows = kn.classify(docs, docs.filter("doc_id % 10 != 0").select("doc_id"), scratch).collect()
    part = "pmod(xxhash64(doc_id, 'part'), 4) != 0"
    trained = docs.filter("doc_id % 10 != 0").filter(part)
    model = kn.fit(trained, Scratch(spark, "small"))
    assert trained.count() > 1200 and len(rows) == 2000
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in rows:
        want, n = model.log10(texts[r["doc_id"]])
        assert r["n_tokens"] == n and r["log10_p"] == pytest.approx(want, rel=1e-4, abs=1e-3)


@pytest.mark.parametrize("held", [0, 5, 60, 10**6])
def test_values_sum_to_the_models_probability(spark, held):
    """Whatever tasks hold, and for repeated rows, rows of one id, unknown words and empty texts."""
    texts = ["the cat sat on the mat", "the cat ran", "a dog sat on the cat", "the dog ran on", "a mat on a mat", "the cat sat", ""]
    train = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kn.fit(train, Scratch(spark, "whole"))
    asked = [(1, "the cat sat"), (1, "the cat sat"), (1, "zebra the mat"), (2, ""), (None, "a dog ran on the mat a mat"), (3, "zebra zebra")]
    rows = spark.createDataFrame([(i, "en", True, t) for i, t in asked], "doc_id long, lang string, seen boolean, text string")
    got = kn.score(rows, kn.values(train, Scratch(spark, "values")), held).orderBy(F.col("doc_id"), "n_tokens", "log10_p").collect()
    want = sorted(((i, *reversed(model.log10(t))) for i, t in asked), key=lambda r: (r[0] is not None, r))
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [r[:2] for r in want]
    assert np.allclose([r["log10_p"] for r in got], [r[2] for r in want], rtol=1e-5, atol=1e-5)


def test_counting_in_blocks_adds_up(spark, monkeypatch):
    whole = sorted(map(tuple, kn.count(spark.createDataFrame([("a b a b a",), ("a b",)], "text string").coalesce(1),
                                       Scratch(spark, "block")).three.counts.select("uvw", "c").collect()))
    frames = [pd.DataFrame({"text": ["a b a b a", "a b"]})]
    monkeypatch.setattr(kn, "_BLOCK", 1)
    found = pd.concat(kn._grams(iter(frames))).groupby("uvw")["n"].sum()
    assert sorted((int(k), int(c)) for k, c in found.items()) == whole


def test_packed_numbers_come_back():
    for numbers in ([0], [0, 0, 0], [1, 255, 256, 2**40], [2**64 - 1, 0]):
        assert kn._unpack(kn._pack(np.array(numbers, dtype=np.uint64)), len(numbers)).tolist() == numbers


@pytest.mark.parametrize("held", [0, 300, 10**6])
def test_tokens_move_once_and_packed(make_docs, spark, monkeypatch, held):
    """Few bytes a token in all, every token in one shard, and the same sums however many parts a shard is read in."""
    docs = make_docs(_mixed_texts(1500))
    rows = docs.select("doc_id", "lang", F.lit(False).alias("seen"), (F.col("doc_id") % 3 != 0).alias("trains"), F.lit(True).alias("scored"), "text")
    codes, n = kn._codes(rows, 4, held), 4
    assert codes.whole == (held == 10**6) and len(codes) <= 2 + held
    moved = rows.coalesce(1).mapInPandas(kn._deal(spark.sparkContext.broadcast(codes), n), "shard long, block long, data binary").collect()
    tokens = sum(len(text.split()) + 1 for _, text in _mixed_texts(1500))
    if held:
        assert sum(len(r["data"]) for r in moved) < 12 * tokens
    blobs = {k: [(r["block"], bytes(r["data"])) for r in moved if r["shard"] == k] for k in range(n)}
    assert sum(len(x[2]) for k in blobs for x in kn._Shard(k, blobs[k], codes, n).read(0)) == tokens
    for k in blobs:
        found = []
        for at_once in (10**6, 500):
            monkeypatch.setattr(kn, "_AT_ONCE", at_once)
            own = kn._Shard(k, blobs[k], codes, n)
            assert (own.parts > 1) == (at_once == 500)
            p1 = np.linspace(0.01, 0.1, own.codes + len(own.others))
            found.append((own.count(), own.score([0.5, 0.6, 0.7], [0.4, 0.5, 0.6], p1)))
        assert all((a == b).all() for a, b in zip(found[0][0], found[1][0]))
        assert all(np.allclose(x, found[1][1][block]) for block, x in found[0][1].items())
