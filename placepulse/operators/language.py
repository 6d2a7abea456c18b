"""Language detection: naive Bayes over character n-grams.

The published method of n-gram language identification: n-grams of one to three characters within
words, a vocabulary of the most frequent ones, a multinomial naive Bayes score per language.
Training is a chain of aggregates that starts from word counts, so n-grams are cut from every
different word once. Detection reads each text once where it is; the vocabulary bounds the model
sent along. The labels are those of the training table, not of any downloaded model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placepulse.functions.text import squeeze_space
from placepulse.schema import UNKNOWN_LANGUAGE

#: Most n-grams a model may have, as it is sent to every task; more raise an error.
LARGEST_MODEL = 2_000_000
MIN_CHARS = 3
_SPACE = 32
#: Characters scored at once, and the largest table of three-letter keys that is looked up directly.
_CHUNK = 1 << 20
_DENSE = 1 << 24


def letters_only(c: Column) -> Column:
    """Lower-case words of letters, one space before, between and after them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " ")), F.lit(" "))


def word_ngrams(word: Column) -> Column:
    """All runs of one to three characters of a word marked with a space at both ends.

    The mark alone is no n-gram.
    """
    padded = F.split(F.concat(F.lit(" "), word, F.lit(" ")), "")
    grams, every, shifted = padded, padded, padded
    for _ in range(2):
        shifted = F.slice(shifted, F.lit(2), F.greatest(F.size(shifted) - 1, F.lit(0)))
        grams = F.zip_with(grams, shifted, lambda a, b: F.concat(a, b))
        every = F.concat(every, grams)
    return F.filter(every, lambda gram: gram.isNotNull() & (F.trim(gram) != ""))


@dataclass(frozen=True)
class LanguageModel:
    """A fitted detector; row ``i`` of ``weights`` belongs to n-gram ``i``, columns to languages."""

    languages: tuple[str, ...]
    ngrams: tuple[str, ...]
    priors: np.ndarray
    weights: np.ndarray


def fit_language_profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", vocabulary: int | None = None
) -> LanguageModel:
    """Train a detector on labelled text with all its n-grams, or the ``vocabulary`` most frequent.

    Of equally frequent n-grams the smaller is kept. A model beyond ``LARGEST_MODEL`` n-grams raises.
    """
    known = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    words = known.select(F.col(lang).alias("lang"), F.explode(F.split(letters_only(F.col(text)), " ")).alias("word"))
    counts = words.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    # n-grams of the different words, cut once per word and language.
    cut = counts.select("lang", "n", F.explode(word_ngrams(F.col("word"))).alias("gram"))
    grams = cut.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    by_gram = grams.groupBy("gram").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    # At most so many rows of one counter per language come to the driver, as the model must.
    most = LARGEST_MODEL + 1 if vocabulary is None else vocabulary
    kept = by_gram.orderBy(F.col("total").desc(), "gram").limit(most).collect()
    if len(kept) > LARGEST_MODEL:
        raise ValueError(f"more than {LARGEST_MODEL} n-grams: name the size of the vocabulary")
    documents = {row["lang"]: row["n"] for row in known.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}

    languages = tuple(sorted(documents))
    table = np.array([[row["by_lang"].get(name, 0) for name in languages] for row in kept], dtype=float)
    table = table.reshape(len(kept), len(languages))
    weights = np.log(table + 1) - np.log(table.sum(axis=0) + len(kept))
    docs = np.array([documents[name] for name in languages], dtype=float)
    priors = np.log(docs + 1) - np.log(docs.sum() + len(languages))
    return LanguageModel(languages, tuple(row["gram"] for row in kept), priors, weights)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class _Table:
    """Rows of the weights by n-gram, for all n-grams of a long array of characters at once.

    Characters of the model get small numbers, 0 being any other, so that an n-gram is a number
    below ``size ** 3``: looked up directly if that is small, else searched for.
    """

    def __init__(self, ngrams: tuple[str, ...]):
        letters = sorted({code for gram in ngrams for code in _codes(gram).tolist()})
        self.size = len(letters) + 1
        self.number = np.zeros(0x110000, np.int32)
        self.number[letters] = np.arange(1, self.size)
        self.rows: list[tuple[np.ndarray, np.ndarray] | np.ndarray] = []
        for n in (1, 2, 3):
            rows = np.array([i for i, gram in enumerate(ngrams) if len(gram) == n], np.int64)
            keys = self._keys(np.array([_codes(ngrams[i]) for i in rows], np.int64).reshape(-1, n).T)
            if self.size**n <= _DENSE:
                direct = np.full(self.size**n, -1, np.int32)
                direct[keys] = rows
                self.rows.append(direct)
            else:
                order = np.argsort(keys)
                self.rows.append((keys[order], rows[order]))

    def _keys(self, columns: np.ndarray) -> np.ndarray:
        keys = np.zeros(columns.shape[1], np.int64)
        for column in columns:
            keys = keys * self.size + self.number[column]
        return keys

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the n-grams known, and the place each begins at. A run across a space is none."""
        numbers = self.number[codes].astype(np.int64)
        space, found, places, keys = codes == _SPACE, [], [], numbers
        for n, table in enumerate(self.rows, start=1):
            if n > 1:
                keys = keys[:-1] * self.size + numbers[n - 1 :]
            if isinstance(table, np.ndarray):
                row = table[keys]
            else:
                listed, rows = table
                at = np.minimum(np.searchsorted(listed, keys), max(0, len(listed) - 1))
                row = np.where(listed[at] == keys, rows[at], -1) if len(listed) else np.full(len(keys), -1)
            ok = row >= 0
            if n == 3:
                ok &= ~space[1:-1]
            at = np.flatnonzero(ok)
            found.append(row[at])
            places.append(at)
        return np.concatenate(found), np.concatenate(places)


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts, and pieces of long ones that end and begin with the same space, about ``_CHUNK`` characters together."""
    owners, held, size = [], [], 0
    for i, text in enumerate(texts):
        start = 0
        while text is not None and start < len(text) - 1:
            end = text.find(" ", min(start + _CHUNK, len(text) - 1))
            end = len(text) - 1 if end < 0 else end
            owners.append(i)
            held.append(text[start : end + 1])
            size += end + 1 - start
            start = end
            if size >= _CHUNK:
                yield owners, held
                owners, held, size = [], [], 0
    if held:
        yield owners, held


def detect_language(
    df: DataFrame, model: LanguageModel, text: str = "text_review", output: str = "detected_language"
) -> DataFrame:
    """Add the language of each text; ``unknown`` for null, short and featureless text.

    Only the letters go to Python and one label comes back; numpy counts the n-grams of many texts at once.
    """
    ngrams, weights, priors, names = model.ngrams, model.weights, model.priors, model.languages

    def best(texts: list[str | None], table: _Table) -> np.ndarray:
        scores, known = np.zeros((len(texts), len(names))), np.zeros(len(texts), np.int64)
        for owners, pieces in _pieces(texts):
            ends = np.cumsum([len(piece) for piece in pieces])
            rows, places = table.find(_codes("".join(pieces)))
            owner = np.array(owners)[np.searchsorted(ends, places, side="right")]
            known += np.bincount(owner, minlength=len(texts))
            for k in range(len(names)):
                scores[:, k] += np.bincount(owner, weights[rows, k], len(texts))
        labels = np.full(len(texts), UNKNOWN_LANGUAGE, object)
        if len(names):
            labels[known > 0] = np.array(names, object)[np.argmax(scores + priors, axis=1)][known > 0]
        return labels

    @F.pandas_udf("string")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _Table(ngrams)
        for texts in batches:
            yield pd.Series(best([None if value is None or len(value) < 3 else value for value in texts], table), dtype="object")

    readable = F.length(squeeze_space(F.col(text))) >= MIN_CHARS
    return df.withColumn(output, label(F.when(readable, letters_only(F.col(text)))))


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Share of rows with the right language."""
    right = F.count_if(F.col(truth) == F.col(predicted))
    return df.agg(F.round(right / F.count(F.lit(1)), 6).alias("accuracy"))
