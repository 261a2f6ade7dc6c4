"""Log-bilinear language model over word classes, trained with noise-contrastive estimation.

The next word's class is predicted from the classes of the words before it: a weighted sum of their
vectors, times a matrix of class vectors, plus a bias, normalised over all classes. Within a class a
word has its share of the class's corpus counts. The classes are the most frequent words, a class each,
and groups of the other words by their endings. Counts cover all training documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import NO_ID, Scratch, id_key, plain_id, text_of

#: The end of a text; no word holds a space.
END = b" "
_FLUSH = 400_000
#: Tokens of a block of texts that is scored at once.
_SCORED_AT_ONCE = 1_000_000
_PARAMS = ("context", "position", "output", "bias")


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case. A space or a control character from tab to CR ends a word."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether the checksum of the id as text leaves ``fold``; a null id counts as empty text."""
    digits = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % folds == fold


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter[bytes] = Counter()
    ends = 0

    def flushed():
        return pd.DataFrame({"word": [*counts, END], "n": [*counts.values(), ends]})

    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text))
            ends += 1
            if len(counts) > _FLUSH:
                yield flushed()
                counts.clear()
                ends = 0
    if counts or ends:
        yield flushed()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of column ``text``, the text's end included. Combined in the tasks first."""
    counted = texts.select("text").mapInPandas(_counted, "word binary, n long").filter("n > 0")
    return counted.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Lexicon:
    """What tasks hold of the counts: a bounded list of frequent words, and figures of each class."""

    words: Mapping[bytes, int]  # places in ``counts``, most frequent first; those under ``singles`` are classes
    counts: np.ndarray
    singles: int
    endings: int
    class_counts: np.ndarray  # training tokens by class
    class_mass: np.ndarray  # sum of c + 0.5 over a class's words, and 0.5 for the unknown word

    @property
    def classes(self) -> int:
        return self.singles + self.endings

    def ending(self, word: bytes) -> int:
        return self.singles + crc32(word[-3:]) % self.endings


def build_lexicon(counts: DataFrame, singles: int = 224, endings: int = 32, held: int = 200_000) -> Lexicon:
    """Read the most frequent words, ``held`` at most, a bound on what tasks hold; all words count in class figures."""
    # Words by the size of their counts, in at most some hundred steps: whole steps are held, largest first.
    step = F.floor(8 * F.log2("c"))
    sizes = counts.groupBy(step.alias("step")).count().toPandas().sort_values("step", ascending=False)
    within = sizes["step"][sizes["count"].cumsum() <= held]
    top = counts.filter(step >= (int(within.min()) if len(within) else 1 << 30)).toPandas()
    top = top.sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    words = {bytes(w): k for k, w in enumerate(top["word"])}
    single = [w for w, k in words.items() if k < singles]
    key = F.substring("word", F.greatest(F.length("word") - 2, F.lit(1)), F.lit(3))
    other = counts if not single else counts.join(
        counts.sparkSession.createDataFrame([(w,) for w in single], "word binary"), "word", "left_anti")
    figures = (other.groupBy((F.crc32(key) % endings).alias("k"))
               .agg(F.sum("c").alias("c"), F.sum(F.col("c") + 0.5).alias("mass")).toPandas())
    own = top["c"].to_numpy(dtype=np.float64)[:singles]
    class_counts, mass = np.zeros(singles + endings), np.full(singles + endings, 0.5)
    class_counts[:len(own)] = own
    class_counts[singles + figures["k"].to_numpy(dtype=np.int64)] = figures["c"].to_numpy(dtype=np.float64)
    mass[singles + figures["k"].to_numpy(dtype=np.int64)] += figures["mass"].to_numpy(dtype=np.float64)
    return Lexicon(words, top["c"].to_numpy(dtype=np.float64), singles, endings, class_counts, mass)


class _Coder(dict):
    """A word's place in the lexicon; one outside of it has the place of its class below zero."""

    def __init__(self, lexicon: Lexicon):
        super().__init__(lexicon.words)
        self.lexicon, self.known = lexicon, len(lexicon.words)

    def __missing__(self, word: bytes) -> int:
        return -1 - self.lexicon.ending(word)

    def classes_of_places(self) -> np.ndarray:
        lex = self.lexicon
        return np.array([k if k < lex.singles else lex.ending(w) for w, k in lex.words.items()], dtype=np.int32)


def initial(classes: int, context: int, size: int, noise: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Small vectors at random; the biases start as the classes' log shares."""
    rng = np.random.default_rng(seed)
    scale = 0.1
    return {
        "context": (rng.standard_normal((classes + 1, size)) * scale).astype(np.float32),
        "position": np.ones((context, size), dtype=np.float32) / context,
        "output": (rng.standard_normal((classes, size)) * scale).astype(np.float32),
        "bias": np.log(noise).astype(np.float32),
    }


def contexts_of(classes: np.ndarray, width: int, start: int) -> np.ndarray:
    """For each token the classes of the ``width`` tokens before it, nearest first; ``start`` before the text."""
    padded = np.concatenate([np.full(width, start, dtype=classes.dtype), classes])
    n = len(classes)
    return np.stack([padded[width - 1 - k:width - 1 - k + n] for k in range(width)], axis=1)


def _sum_rows(rows: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    width = rows.shape[1]
    places = (at.astype(np.int64)[:, None] * width + np.arange(width)).ravel()
    return np.bincount(places, rows.ravel(), size * width).reshape(size, width).astype(np.float32)


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) of numbers cut at 30 either way, in their place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def nce_step(p: dict, state: dict, contexts: np.ndarray, targets: np.ndarray, noise: np.ndarray, samples: np.ndarray,
             rate: float) -> float:
    """One step on a batch: true next classes against noise classes that the batch shares.

    The loss is that of telling a next class from k noise classes; Adagrad scales the steps.
    """
    n, k = len(targets), len(samples)
    shift = p["bias"] - np.log(k * noise).astype(np.float32)
    vectors = p["context"].take(contexts, axis=0)
    predicted = np.einsum("njs,js->ns", vectors, p["position"])
    true_out, noise_out = p["output"].take(targets, axis=0), p["output"].take(samples, axis=0)
    true_wrong = _logistic(-(np.einsum("ij,ij->i", predicted, true_out) + shift[targets]))  # 1 - P(true)
    down = predicted @ noise_out.T
    down += shift[samples]
    _logistic(down)  # P(true | noise)
    down /= n
    up = true_wrong / np.float32(n)
    d_predicted = up[:, None] * true_out
    d_predicted -= down @ noise_out
    d_vectors = d_predicted[:, None, :] * p["position"]
    grads = {
        "output": _sum_rows(up[:, None] * predicted, targets, len(p["output"]))
        - _sum_rows(down.T @ predicted, samples, len(p["output"])),
        "bias": (np.bincount(targets, up, len(p["bias"])) - np.bincount(samples, down.sum(axis=0), len(p["bias"]))).astype(np.float32),
        "context": _sum_rows(d_vectors.reshape(-1, d_vectors.shape[2]), contexts.ravel(), len(p["context"])),
        "position": np.einsum("ns,njs->js", d_predicted, vectors),
    }
    for name, g in grads.items():
        state[name] += g * g
        p[name] += rate * g / np.sqrt(state[name] + 1e-10)
    return float(-np.log(np.maximum(1 - true_wrong, 1e-30)).mean())


def draws(rng: np.random.Generator, cumulated: np.ndarray, n: int) -> np.ndarray:
    """What ``rng.choice`` draws with these shares, which are cumulated once."""
    return cumulated.searchsorted(rng.random(n), side="right")


def train(texts: DataFrame, lexicon: Lexicon, rounds: int = 2, context: int = 3, size: int = 16, batch: int = 1024,
          noise_words: int = 64, rate: float = 0.1) -> dict[str, np.ndarray]:
    """Fit on all rows of ``texts`` (key, text): each round takes its own share of them.

    In a round every task trains a copy of the model on its rows; copies are then averaged by their
    numbers of tokens, number by number in a partial aggregate. The result's size is the model's, whatever
    the number of tasks.
    """
    noise = (lexicon.class_counts + 1) / (lexicon.class_counts + 1).sum()
    cumulated = noise.cumsum() / noise.sum()
    cumulated /= cumulated[-1]
    params = initial(lexicon.classes, context, size, noise)
    sc = texts.sparkSession.sparkContext
    for turn in range(rounds):
        held = sc.broadcast((params, lexicon))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            start_params, lex = held.value
            p = {k: v.copy() for k, v in start_params.items()}
            state = {k: np.zeros_like(v) for k, v in p.items()}
            coder, rng = _Coder(lex), np.random.default_rng(turn)
            class_at = coder.classes_of_places()
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            n_waiting = seen = 0

            def learn(flush: bool) -> None:
                nonlocal n_waiting, seen
                contexts, targets = (np.concatenate(x) for x in zip(*waiting))
                mixed = rng.permutation(len(targets))
                whole = len(mixed) if flush else len(mixed) // batch * batch
                for a in range(0, whole, batch):
                    at = mixed[a:a + batch]
                    nce_step(p, state, contexts[at], targets[at], noise, draws(rng, cumulated, noise_words), rate)
                seen += whole
                rest = mixed[whole:]
                waiting[:] = [(contexts[rest], targets[rest])] if len(rest) else []
                n_waiting = len(rest)

            for frame in batches:
                for text in frame["text"]:
                    classes = _classes(text, coder, class_at)[1]
                    waiting.append((contexts_of(classes, context, lex.classes), classes))
                    n_waiting += len(classes)
                    if n_waiting >= 128 * batch:
                        learn(False)
            if n_waiting:
                learn(True)
            if seen:
                flat = np.concatenate([p[k].ravel() for k in _PARAMS]).astype(np.float64)
                yield pd.DataFrame({"tokens": [seen], "numbers": [flat]})

        own = texts.filter(F.pmod("key", F.lit(rounds)) == turn).select("text")
        copies = own.mapInPandas(run, "tokens long, numbers array<double>")
        mean = (copies.select("tokens", F.posexplode("numbers").alias("at", "x")).groupBy("at")
                .agg((F.sum(F.col("x") * F.col("tokens")) / F.sum("tokens")).alias("x")).toPandas())
        if len(mean):
            flat = mean.sort_values("at")["x"].to_numpy(dtype=np.float32)
            done = 0
            for name in _PARAMS:
                n = params[name].size
                params[name] = flat[done:done + n].reshape(params[name].shape)
                done += n
        held.unpersist()
    return params


def _classes(text: str, coder: _Coder, class_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Places and classes of a text's words and its end, and the words."""
    words = words_of(text)
    words.append(END)
    places = np.fromiter(map(coder.__getitem__, words), dtype=np.int64, count=len(words))
    if len(class_at):
        classes = np.where(places >= 0, class_at[np.maximum(places, 0)], -1 - places)
    else:
        classes = -1 - places
    return places, classes.astype(np.int32), words


def _distinct(contexts: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of contexts, and each row's place among them."""
    width = contexts.shape[1]
    if (classes + 1) ** width >= 2**62:
        found, at = np.unique(contexts, axis=0, return_inverse=True)
        return found, at.ravel()
    keys = np.zeros(len(contexts), dtype=np.int64)
    for j in range(width):
        keys = keys * (classes + 1) + contexts[:, j]
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return contexts[first], at


def class_log_probabilities(params: Mapping[str, np.ndarray], contexts: np.ndarray, targets: np.ndarray,
                            batch: int = 1024) -> np.ndarray:
    """Natural log probabilities of the targets, normalised over all classes, by matrix products in batches.

    The sum over all classes is made once for each distinct context.
    """
    distinct, at = _distinct(contexts, len(params["bias"]))
    predicted = np.empty((len(distinct), params["position"].shape[1]), dtype=np.float32)
    whole = np.empty(len(distinct), dtype=np.float64)
    for a in range(0, len(distinct), batch):
        c = distinct[a:a + batch]
        predicted[a:a + batch] = np.einsum("njs,js->ns", params["context"].take(c, axis=0), params["position"])
        scores = predicted[a:a + batch] @ params["output"].T
        scores += params["bias"]
        top = scores.max(axis=1)
        scores -= top[:, None]
        np.exp(scores, out=scores)
        whole[a:a + batch] = top + np.log(scores.sum(axis=1))
    out = np.empty(len(targets), dtype=np.float64)
    for a in range(0, len(targets), 16 * batch):
        k, t = at[a:a + 16 * batch], targets[a:a + 16 * batch]
        own = np.einsum("ij,ij->i", predicted.take(k, axis=0), params["output"].take(t, axis=0)) + params["bias"][t]
        out[a:a + 16 * batch] = own - whole[k]
    return out


_SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_part double, score_part double, rare array<binary>, "
           "rare_n array<int>")


def score_parts(texts: DataFrame, lexicon: Lexicon, params: Mapping[str, np.ndarray]) -> DataFrame:
    """Per row of (doc_id, held_out, text): sums over the held words, and the other words with how often they occur."""
    held = texts.sparkSession.sparkContext.broadcast((dict(params), lexicon))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, lex = held.value
        coder = _Coder(lex)
        class_at, log_count = coder.classes_of_places(), np.log10(lex.counts + 0.5)
        log_mass = np.where(np.arange(lex.classes) < lex.singles, 0, np.log10(lex.class_mass))
        width = len(p["position"])
        def scored(waiting: list) -> pd.DataFrame:
            # The texts of a block share many contexts.
            classes = np.concatenate([x[3] for x in waiting])
            by_class = class_log_probabilities(p, np.concatenate([x[4] for x in waiting]), classes) / np.log(10) - log_mass[classes]
            first = np.cumsum([0, *(len(x[3]) for x in waiting[:-1])])
            sums = np.add.reduceat(by_class, first)
            rows = [(doc, out, len(own), known, held_log, float(total + grouped), list(rare), list(rare.values()))
                    for (doc, out, (known, held_log, grouped), own, _, rare), total in zip(waiting, sums)]
            return pd.DataFrame(rows, columns=[x.split()[0] for x in _SCORED.split(", ")])

        for frame in batches:
            waiting, n_waiting = [], 0
            for doc, out, text in zip(frame["doc_id"], frame["held_out"], frame["text"]):
                places, classes, words = _classes(text, coder, class_at)
                known = places >= 0
                held_log = log_count[places[known]]
                grouped = held_log[classes[known] >= lex.singles]
                rare: dict[bytes, int] = {}
                for at in np.flatnonzero(~known):
                    rare[words[at]] = rare.get(words[at], 0) + 1
                figures = int(known.sum()), float(held_log.sum()), float(grouped.sum())
                waiting.append((doc, out, figures, classes, contexts_of(classes, width, lex.classes), rare))
                n_waiting += len(classes)
                if n_waiting >= _SCORED_AT_ONCE:
                    yield scored(waiting)
                    waiting, n_waiting = [], 0
            if waiting:
                yield scored(waiting)

    own = texts.select(id_key("doc_id").alias("doc_id"), "held_out", "text")
    return own.mapInPandas(run, _SCORED).withColumn("doc_id", plain_id("doc_id"))


def score_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 5, fold: int = 1, **options) -> DataFrame:
    """A row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model and all counts are learnt from the documents that are not held out. Words beyond the
    held list are joined with the counts, so every word has its own count. ``base_score`` is the smoothed
    unigram's log10 probability; ``score`` is the model's.

    Null and empty texts have the end as their only token. A null id is in the training part. Repeated rows
    count and score each. If nothing trains, all words are unknown. An empty table gives no rows. Other
    columns are ignored.
    """
    held = held_out(F.col(f"`{id_col}`").cast("long"), folds, fold)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"), held.alias("held_out"))
    texts = rows.filter(~F.col("held_out")).select(F.xxhash64(F.coalesce("doc_id", F.lit(NO_ID)), "text").alias("key"), "text")
    counts = scratch.write(word_counts(texts), "counts")
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    lexicon = build_lexicon(counts, **options)
    params = train(texts, lexicon)
    # Row numbers are fixed by writing them with what was scored.
    scored = score_parts(rows, lexicon, params).withColumn("row", F.monotonically_increasing_id())
    scored = scratch.write(scored, "scored")
    zipped = scored.filter(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("z"))
    rare = zipped.select("row", F.col("z.rare").alias("word"), F.col("z.rare_n").cast("long").alias("times"))
    counted = rare.join(counts, "word", "left").select("row", "times", F.coalesce("c", F.lit(0)).alias("c"))
    sums = counted.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(F.lit(0))).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 0.5)).alias("rare_log"))
    full = scored.drop("rare", "rare_n").join(sums, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    share = float(np.log10(totals["n"] + 0.5 * (totals["v"] + 1)))
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(totals["n"]).cast("long").alias("train_tokens"),
        (F.col("base_part") + rare_log - F.col("n_tokens") * F.lit(share)).alias("base_score"),
        (F.col("score_part") + rare_log).alias("score"))
