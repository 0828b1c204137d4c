"""Language identification by mixtures of languages.

A language is a distribution of letter trigrams, learned from texts with a
known language. A text is a mixture of languages; its proportions are those of
largest likelihood, found by expectation-maximisation over its trigrams. The
set of languages grows from the best single one as long as the likelihood gains
more than a penalty per language (the Bayesian information criterion).

The log-likelihood is concave in the proportions, so the slope towards a new
language bounds what adding it can gain: where no slope is above the penalty,
no mixture of more languages has to be fitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, map_rows

GRAM_BITS = 15  # trigrams are hashed to 2**15 values
UNKNOWN = "und"
WORSE_PER_GRAM = 0.25  # log-likelihood below chance, per trigram, from which a text is in no learned language
WORSE_IN_ALL = 20.0  # the same, in all: short texts say little
_SMOOTHING = 0.5
_ROUNDS = 30  # of expectation-maximisation, at most
_CLOSE = 1e-4  # proportions that move less are final
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the lower-cased letters, and how often each occurs.

    Anything but letters is a border between words, and borders count as one
    sign. Both are empty if the text has no letter.
    """
    none = np.empty(0, np.int64)
    if not text:
        return none, none
    signs = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    letter = _letter_table()[signs]
    if not letter.any():
        return none, none
    signs = np.where(letter, signs, 0).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one border after a word
    signs = np.concatenate([np.zeros(1, np.uint32), signs[keep], np.zeros(1, np.uint32)])
    # One border at either end at least; a trigram has at most two borders then.
    mixed = (signs[:-2] * np.uint32(0x9E3779B1) + signs[1:-1] * np.uint32(0x85EBCA77)
             + signs[2:] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    counts = np.bincount(mixed >> np.uint32(32 - GRAM_BITS), minlength=1 << GRAM_BITS)
    grams = np.flatnonzero(counts)
    return grams, counts[grams]


class Model:
    """Trigram probabilities of the learned languages."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True) + _SMOOTHING * counts.shape[1] if languages else 1.0
        self.probabilities = (counts + _SMOOTHING) / total

    def mixture(self, grams: np.ndarray, counts: np.ndarray) -> dict[int, float]:
        """Proportions of the selected languages."""
        p = self.probabilities[:, grams]
        n = counts.sum()
        penalty = max(np.log(n), 1.0)
        single = np.log(p) @ counts
        chosen = [int(np.argmax(single))]
        weights, likelihood = np.ones(1), single[chosen[0]]
        while len(chosen) < len(self.languages):
            mixed = weights @ p[chosen]
            slopes = p @ (counts / mixed) - n
            slopes[chosen] = -np.inf
            best = None
            for other in np.flatnonzero(slopes > penalty):
                tried = [*chosen, int(other)]
                w = _proportions(p[tried], counts, np.append(weights * 0.9, 0.1))
                gain = np.log(w @ p[tried]) @ counts - likelihood
                if gain > penalty and (best is None or gain > best[0]):
                    best = gain, tried, w
            if best is None:
                break
            likelihood, chosen, weights = likelihood + best[0], best[1], best[2]
        return dict(zip(chosen, weights.tolist()))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language with the largest proportion, and that proportion."""
        grams, counts = gram_counts(text)
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        shares = self.mixture(grams, counts)
        first = min(shares, key=lambda i: (-shares[i], self.languages[i]))
        return self.languages[first], min(max(shares[first], 0.0), 1.0)

    def decide(self, text: str | None) -> tuple[str | None, bool]:
        """The language of a text, None if it has none, and whether the text is accepted.

        Rejected are texts without a letter, and texts that the best mixture of the learned languages explains
        worse than chance: by more than a quarter of a nat per trigram and 20 in all, below trigrams drawn evenly.
        Without any learned language every text with a letter is accepted.
        """
        grams, counts = gram_counts(text)
        if not len(grams) or not self.languages:
            return None, len(grams) > 0
        shares = self.mixture(grams, counts)
        chosen = list(shares)
        likelihood = np.log(np.array([shares[i] for i in chosen]) @ self.probabilities[np.ix_(chosen, grams)]) @ counts
        chance = -counts.sum() * np.log(self.probabilities.shape[1])
        if likelihood < chance - counts.sum() * WORSE_PER_GRAM - WORSE_IN_ALL:
            return None, False
        return self.languages[min(shares, key=lambda i: (-shares[i], self.languages[i]))], True


def _proportions(p: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n = counts.sum()
    for _ in range(_ROUNDS):
        parts = weights[:, None] * p
        new = (parts / parts.sum(axis=0)) @ counts / n
        if np.abs(new - weights).max() < _CLOSE:
            return new
        weights = new
    return weights


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with a language.

    Tasks count into one row of 2**15 numbers per language; partial sums cross
    the network, and the model, one such row per language, comes to the driver.
    """
    schema = "lang string, gram int, n bigint"
    arrow = arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in sums:
                    sums[lang] = np.zeros(1 << GRAM_BITS, np.int64)
                grams, counts = gram_counts(text)
                sums[lang][grams] += counts
        for lang, total in sums.items():
            grams = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int32()), pa.array(total[grams], pa.int64())],
                schema=arrow)

    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col).cast("string"))
    sums = rows.mapInArrow(count, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((len(languages), 1 << GRAM_BITS))
    at = sums["lang"].map({lang: i for i, lang in enumerate(languages)}).to_numpy(dtype=np.int64)
    counts[at, sums["gram"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=float)
    return Model(languages, counts)


def identify(docs: DataFrame, learn_from: Column, held_out: Column, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Language of every row, learned from the rows where ``learn_from`` holds.

    Returns the id, ``held_out``, ``lang_pred`` and ``score`` (the proportion of
    the text in that language). A null text, one without any letter, or a table
    without a labelled row gives ``und`` and 0. Equal proportions go to the first
    language by name. Null languages teach nothing; ids are only passed on;
    repeated rows and other columns do not matter. Whole texts are read, one row
    at a time; no shuffle but that of the counts.
    """
    model = learn(docs.filter(learn_from), text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one row of fixed length per language
    rows = docs.select(F.col(id_col), held_out.alias("held_out"), F.col(text_col))
    key_type = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        rows, f"`{id_col}` {key_type}, held_out boolean, lang_pred string, score double",
        [id_col, "held_out", "lang_pred", "score"],
        lambda: lambda key, out, text: (key, out, *shared.value.predict(text)))


def in_known_language(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """Rows of ``docs`` in a language that the table has, with their own columns.

    The mixture decides: rejected are null texts, texts without any letter, and texts that are in no learned language, see
    ``Model.decide``. A null language becomes the predicted one. If
    no row has a language to learn, every text with a letter stays, as it is. Repeated rows are kept.
    """
    model = learn(docs.filter(learn_from), text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.decide(t) for t in batch.column(at).to_pylist()]
            old = batch.column(lang_at)
            if shared.value.languages and old.null_count:
                filled = [new if lang is None else lang for lang, (new, _) in zip(old.to_pylist(), found)]
                batch = batch.set_column(lang_at, batch.schema.field(lang_at), pa.array(filled, old.type))
            yield batch.filter(pa.array([ok for _, ok in found], pa.bool_()))

    return docs.mapInArrow(known, docs.schema)
