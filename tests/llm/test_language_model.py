from collections import Counter
from math import log10
from zlib import crc32

import numpy as np
import pytest

from placelake.llm import language_model as lm
from placelake.llm import queries
from placelake.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def brute(rows):
    counts, held = Counter(), {}
    for k, (i, text) in enumerate(rows):
        held[k] = crc32(("" if i is None else str(i)).encode()) % 5 == 1
        if not held[k]:
            counts.update([*(text or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for k, (i, text) in enumerate(rows):
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out.append((i, held[k], len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op9_log_bilinear(spark, SF).collect()


def test_counts_and_base_equal_brute_force(spark, scored):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same([tuple(r)[:6] for r in scored], brute(rows))


def test_the_model_beats_the_unigram_on_held_out_texts(scored):
    held = [r for r in scored if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_words_beyond_the_held_list_have_their_own_counts(make_docs, scratch):
    rows = [(k, " ".join(f"w{(k * j) % 37}" for j in range(1, 40))) for k in range(60)]
    got = lm.score_documents(make_docs(rows), scratch, held=12, singles=4, endings=3).collect()
    same([tuple(r)[:6] for r in got], brute(rows))


def test_edges(edge_docs, no_docs, scratch):
    got = lm.score_documents(edge_docs, scratch).collect()
    same([tuple(r)[:6] for r in got], brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()]))
    assert all(np.isfinite(r["score"]) for r in got)
    assert lm.score_documents(no_docs, Scratch(no_docs.sparkSession, "none")).count() == 0


def test_class_probabilities_sum_to_one():
    params = lm.initial(9, 2, 4, np.full(9, 1 / 9))
    contexts = np.array([[3, 9], [0, 1]])
    total = sum(np.exp(lm.class_log_probabilities(params, contexts, np.full(2, k))) for k in range(9))
    assert np.allclose(total, 1, atol=1e-5)


def test_noise_contrastive_steps_learn_a_chain():
    """Class k is always followed by k + 1: the next class's probability nears one."""
    rng, classes = np.random.default_rng(0), np.arange(4000, dtype=np.int32) % 8
    noise = np.full(8, 1 / 8)
    params = lm.initial(8, 2, 12, noise)
    state = {k: np.zeros_like(v) for k, v in params.items()}
    contexts = lm.contexts_of(classes, 2, 8)
    for _ in range(300):
        at = rng.integers(0, 4000, 256)
        lm.nce_step(params, state, contexts[at], classes[at], noise, rng.choice(8, 16, p=noise), 0.1)
    assert np.exp(lm.class_log_probabilities(params, contexts[2:], classes[2:])).mean() > 0.8


def test_word_probabilities_of_a_class_sum_to_one(spark):
    """Within a class the shares of its words, and of one unknown word, make one."""
    counts = spark.createDataFrame([(f"w{k}".encode(), 1 + k % 5) for k in range(200)], "word binary, c long")
    lexicon = lm.build_lexicon(counts, singles=8, endings=4, held=20)
    single = {w for w, k in lexicon.words.items() if k < 8}
    mass = np.zeros(12)
    mass[8:] = 0.5
    for r in counts.collect():
        if bytes(r["word"]) not in single:
            mass[lexicon.ending(bytes(r["word"]))] += r["c"] + 0.5
    assert len(lexicon.words) <= 20 and np.allclose(mass[8:], lexicon.class_mass[8:])


def test_frequent_words_have_a_class_of_their_own(spark):
    counts = spark.createDataFrame([(bytearray(f"w{k}".encode()), 1000 - k) for k in range(400)], "word binary, c long")
    lexicon = lm.build_lexicon(counts)
    assert (lexicon.singles, lexicon.classes) == (224, 256)
    assert list(lexicon.class_counts[:224]) == [1000 - k for k in range(224)]


def test_repeated_contexts_are_normalised_once(monkeypatch):
    """As many exponentials as distinct contexts have classes, and the values of each token on its own."""
    rng = np.random.default_rng(4)
    params = lm.initial(20, 3, 8, np.full(20, 1 / 20))
    contexts = rng.choice([3, 7, 20], (5000, 3)).astype(np.int32)
    targets = rng.integers(0, 20, 5000).astype(np.int32)
    scores = sum(params["context"][contexts[:, j]] * params["position"][j] for j in range(3)) @ params["output"].T + params["bias"]
    want = scores[np.arange(5000), targets] - np.log(np.exp(scores.astype(np.float64)).sum(axis=1))
    exp, made = np.exp, []
    monkeypatch.setattr(lm.np, "exp", lambda x, **more: (made.append(np.size(x)), exp(x, **more))[1])
    got = lm.class_log_probabilities(params, contexts, targets)
    assert np.allclose(got, want, atol=1e-5) and sum(made) <= 27 * 20


def test_wide_contexts_and_no_tokens():
    params = lm.initial(300, 9, 4, np.full(300, 1 / 300))
    contexts = np.random.default_rng(0).integers(0, 301, (40, 9)).astype(np.int32)
    total = sum(np.exp(lm.class_log_probabilities(params, contexts, np.full(40, k))) for k in range(300))
    assert np.allclose(total, 1, atol=1e-5)
    assert len(lm.class_log_probabilities(params, contexts[:0], np.empty(0, dtype=np.int32))) == 0


def test_noise_is_drawn_as_by_choice():
    noise = np.random.default_rng(0).random(50)
    noise /= noise.sum()
    cumulated = noise.cumsum()
    a, b = np.random.default_rng(9), np.random.default_rng(9)
    for _ in range(20):
        assert (lm.draws(a, cumulated / cumulated[-1], 64) == b.choice(50, 64, p=noise)).all()
