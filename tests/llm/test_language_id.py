import random

import numpy as np
import pytest

from placelake.llm import language_id as lang
from placelake.llm import queries

WORDS = {"en": "the of and house water never which people", "de": "der und das Haus Wasser niemals welche Leute",
         "fr": "le et la maison eau jamais quelle gens", "el": "και το σπίτι νερό ποτέ ποια άνθρωποι"}


def text(rng, language, n):
    return " ".join(rng.choice(WORDS[language].split()) for _ in range(n))


def learn(make_docs, n=40):
    rng = random.Random(1)
    return make_docs([(k, text(rng, code, 60), code, "s") for k, code in enumerate(list(WORDS) * n)])


def found(docs, model):
    return [(None if r["_id"] == lang_none() else r["_id"], r.n_grams, list(r.languages), list(r.shares)) for r in lang.identify(docs, model).collect()]


def lang_none():
    from placelake.llm.common import NO_ID
    return NO_ID


def test_single_and_mixed_texts(spark, make_docs):
    model, rng = lang.fit_languages(learn(make_docs)), random.Random(2)
    mixed = [(100 + k, text(rng, a, 150) + " " + text(rng, b, 150), None, None) for k, (a, b) in enumerate([("en", "de"), ("fr", "el"), ("de", "fr")])]
    rows = {r[0]: r for r in found(make_docs([(k, text(rng, code, 40), None, None) for k, code in enumerate(WORDS)] + mixed), model)}
    for k, code in enumerate(WORDS):
        assert rows[k][2] == [code] and rows[k][3] == pytest.approx([1.0])
    for k, pair in enumerate([{"en", "de"}, {"fr", "el"}, {"de", "fr"}]):
        assert set(rows[100 + k][2]) == pair and sum(rows[100 + k][3]) == pytest.approx(1.0)
        assert min(rows[100 + k][3]) > 0.25


def test_tallies_equal_a_plain_count(spark, make_docs):
    docs = learn(make_docs, 3)
    model = lang.fit_languages(docs, buckets=512, orders=2)
    assert model.languages == sorted(WORDS)
    counts = np.zeros((4, 512))
    for r in docs.collect():
        where, times = lang.gram_counts(r.text, 512, 2)
        counts[model.languages.index(r.lang)][where] += times
    again = lang.Mixture(model.languages, counts, 2)
    assert np.allclose(again.log, model.log)


def test_shares_are_the_best_ones(spark):
    """No share on a fine grid is likelier than what expectation-maximisation ends with."""
    rng = np.random.default_rng(5)
    model = lang.Mixture(["a", "b"], rng.integers(0, 50, (2, 64)).astype(float), 1)
    drawn = rng.multinomial(4000, 0.3 * model.probability[:, 0] + 0.7 * model.probability[:, 1])
    where = np.flatnonzero(drawn)
    shares = model.proportions(where, drawn[where], 3.0)
    grid = np.linspace(0.001, 0.999, 999)
    likelihood = [drawn[where] @ np.log(model.probability[where] @ [x, 1 - x]) for x in grid]
    assert abs(shares[0] - grid[int(np.argmax(likelihood))]) < 0.01
    assert model.proportions(where, drawn[where], 1e9).max() == 1.0  # no second language is worth such a price


def test_pieces_make_no_difference(spark, monkeypatch):
    sample = "".join(random.Random(4).choice("abcä漢 .,1\n") for _ in range(5000))
    whole = lang.gram_counts(sample, 4096)
    monkeypatch.setattr(lang, "_PIECE", 977)
    parted = lang.gram_counts(sample, 4096)
    # A piece adds the n-grams at its two ends, five at most.
    assert 0 <= parted[1].sum() - whole[1].sum() <= 6 * 5 + 30


def test_held_out_accuracy(spark):
    rows = queries.op12_mixture_languages(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and truth[r.doc_id] is not None]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, make_docs, edge_docs, no_docs):
    model = lang.fit_languages(learn(make_docs, 5))
    assert found(no_docs, model) == []
    assert lang.fit_languages(no_docs) is None
    assert all(r[1:] == (0, [], []) for r in found(edge_docs, None))
    rows = found(edge_docs, model)
    assert len(rows) == edge_docs.count()
    letterless = {r[0] for r in rows if r[2] == []}
    assert letterless == {1, 2, 3}
    assert [r for r in rows if r[0] == 5][0] == [r for r in rows if r[0] == 5][1]
    assert found(make_docs([(1, "12 34 !?", None, None)]), model) == [(1, 0, [], [])]
    with pytest.raises(ValueError):
        lang.fit_languages(learn(make_docs, 1), max_languages=3)
