"""Languages of documents as mixtures: proportions by expectation-maximisation over n-gram likelihoods.

A document's n-grams are taken as drawn from a mixture of the learned languages. Which languages take part is chosen
by penalised likelihood: one is added only while it gains more than a penalty that grows with the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelake.llm.common import id_key, text_of

UNKNOWN = "und"

_PIECE = 1 << 18
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_FIELDS = "_id long, _mark boolean, n_grams long, languages array<string>, shares array<double>"
_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters[codes]


def grams(text: str, buckets: int, orders: int = 3) -> Iterator[np.ndarray]:
    """Buckets of the character n-grams of up to ``orders`` in lower case, piece by piece; all else but letters is one space.

    Of n-grams without any letter none is given; so a text without a letter has none.
    """
    for at in range(0, len(text), _PIECE):
        piece = text[max(0, at - orders + 1):at + _PIECE].lower()
        codes = np.frombuffer(f" {piece} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _is_letter(codes)
        if not letter.any():
            continue
        keep = letter | np.concatenate(([True], letter[:-1]))  # runs of anything else become one
        codes, letter = np.where(letter, codes, np.uint32(32))[keep], letter[keep]
        mixed = np.zeros(len(codes), dtype=np.uint32)
        some = np.zeros(len(codes), dtype=bool)
        found = []
        for k in range(orders):
            n = len(codes) - k
            if n <= 0:
                break
            mixed = (mixed[:n] ^ codes[k:]) * _FACTORS[k % 3] + np.uint32(k + 1)
            some = some[:n] | letter[k:]
            hashed = mixed ^ (mixed >> np.uint32(15))
            hashed = hashed * np.uint32(0x2C1B3C6D)
            found.append((hashed >> np.uint32(12))[some] % np.uint32(buckets))
        yield np.concatenate(found)


def gram_counts(text: str, buckets: int, orders: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each is hit."""
    total = np.zeros(buckets, dtype=np.int64)
    for found in grams(text, buckets, orders):
        total += np.bincount(found, minlength=buckets)
    where = np.flatnonzero(total)
    return where, total[where]


class Mixture:
    """The learned languages, in order of name, and the log-probability of each bucket in each of them."""

    def __init__(self, languages: list[str], counts: np.ndarray, orders: int = 3, smoothing: float = 0.1):
        self.languages, self.buckets, self.orders = languages, counts.shape[1], orders
        total = counts.sum(axis=1, keepdims=True) + smoothing * counts.shape[1]
        self.probability = ((counts + smoothing) / total).T.copy()  # bucket by language
        self.log = np.log(self.probability)

    def proportions(self, where: np.ndarray, times: np.ndarray, penalty: float, rounds: int = 200, close: float = 1e-5) -> np.ndarray:
        """Shares of all languages, mostly 0; they sum to one.

        Likelihood is concave in the shares, so its slope bounds what any further language can gain: sets that no
        language could improve by the penalty are final without a fit.
        """
        probability, n = self.probability[where], int(times.sum())
        alone = times @ self.log[where]
        price = penalty * np.log(n + 1.0)
        chosen, shares = [int(np.argmax(alone))], np.ones(1)
        likelihood = float(alone[chosen[0]])
        while len(chosen) < len(self.languages):
            mixed = probability[:, chosen] @ shares
            slope = (times / mixed) @ probability - n
            slope[chosen] = -np.inf
            best = None
            for k in np.argsort(-slope, kind="stable"):
                if slope[k] <= price or (best and best[0] - likelihood >= slope[k]):
                    break
                found = self._fit(probability[:, [*chosen, int(k)]], times, np.append(shares * 0.8, 0.2), rounds, close)
                if best is None or found[0] > best[0]:
                    best = (*found, int(k))
            if best is None or best[0] - likelihood <= price:
                break
            likelihood, shares, chosen = best[0], best[1], [*chosen, best[2]]
        full = np.zeros(len(self.languages))
        full[chosen] = shares
        return full

    @staticmethod
    def _fit(probability: np.ndarray, times: np.ndarray, shares: np.ndarray, rounds: int, close: float) -> tuple[float, np.ndarray]:
        """Expectation-maximisation from these shares: the likelihood and the shares it ends with."""
        n = times.sum()
        for _ in range(rounds):
            weight = times / (probability @ shares)
            moved = shares * (weight @ probability) / n
            done = np.abs(moved - shares).max() < close
            shares = moved
            if done:
                break
        shares = shares / shares.sum()
        return float(times @ np.log(probability @ shares)), shares


def _tallied(buckets: int, orders: int, held: int = 64):
    """Counts by language and bucket, one row each, over all texts of a task."""

    def emit(counts: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for language, total in counts.items():
            where = np.flatnonzero(total)
            yield pd.DataFrame({"language": language, "bucket": where.astype(np.int32), "n": total[where]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch["language"], batch["_text"]):
                if language not in counts:
                    if len(counts) >= held:
                        yield from emit(counts)
                        counts = {}
                    counts[language] = np.zeros(buckets, dtype=np.int64)
                for found in grams(text, buckets, orders):
                    counts[language] += np.bincount(found, minlength=buckets)
        yield from emit(counts)

    return run


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = 1 << 14, orders: int = 3,
                  max_languages: int = 512) -> Mixture | None:
    """The model of all given documents with a language; None if there are none.

    Tasks tally their texts into ``buckets`` per language before anything is shuffled; the driver gets the summed
    tallies, at most ``max_languages`` times ``buckets`` numbers. More languages are refused, not dropped. Null texts
    count as empty; rows without a language teach nothing.
    """
    known = docs.filter(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{lang_col}`").cast("string").alias("language"), text_of(text_col).alias("_text"))
    tallies = known.mapInPandas(_tallied(buckets, orders), "language string, bucket int, n long")
    summed = tallies.groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    listed = summed.groupBy("language").agg(F.collect_list("bucket").alias("at"), F.collect_list("n").alias("n"))
    rows = sorted(listed.limit(max_languages + 1).collect(), key=lambda r: r.language)
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages, which bounds the model's size")
    if not rows:
        return None
    counts = np.zeros((len(rows), buckets))
    for row, total in zip(rows, counts):
        total[row["at"]] = row["n"]
    return Mixture([r.language for r in rows], counts, orders)


def identify(docs: DataFrame, model: Mixture | None, id_col: str = "doc_id", text_col: str = "text", penalty: float = 3.0,
             mark: Column | None = None) -> DataFrame:
    """A row per row of the documents: ``_id``, ``_mark`` (the given column), n_grams, languages and their shares, largest first.

    Languages of equal share stand in order of name. Texts without a letter, null ones included, have none, nor has any
    text if the model is None. No shuffle; the model goes to the tasks, and is bounded by its numbers of languages and
    buckets. Null ids stay null-like (see ``plain_id``), repeated rows get equal rows, an empty table gives none, other
    columns are ignored.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = broadcast.value
        for batch in batches:
            rows = []
            for text in batch["_text"]:
                where, times = gram_counts(text, known.buckets, known.orders) if known else ((), np.zeros(0))
                if len(where) == 0:
                    rows.append((0, [], []))
                    continue
                shares = known.proportions(where, times, penalty)
                order = [int(k) for k in np.argsort(-shares, kind="stable") if shares[k] > 0]
                rows.append((int(times.sum()), [known.languages[k] for k in order], [min(1.0, float(shares[k])) for k in order]))
            out = pd.DataFrame(rows, columns=["n_grams", "languages", "shares"])
            yield pd.concat([batch[["_id", "_mark"]].reset_index(drop=True), out], axis=1)

    rows = docs.select(id_key(id_col).alias("_id"), (F.lit(False) if mark is None else mark).alias("_mark"), text_of(text_col).alias("_text"))
    return rows.mapInPandas(run, _FIELDS)
