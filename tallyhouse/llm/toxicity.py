"""Toxicity by a factorisation machine over hashed terms.

A text's terms are its distinct lower-case words and the beginnings (4 and 5 letters) of its longer words, hashed into
2^18 columns.  The score is a logistic function of bias, one weight a term and the inner products of the factors
of all pairs of terms, so that two terms together can weigh more than each alone.  The linear weights are learned
by FTRL with an L1 penalty, which leaves most at zero.  Factors are learned for every term of at least `least_rows` rows,
with or without a weight, by FTRL with a group penalty: a term's factors leave their small random start, which the model
takes for zero, when the gradients summed for them are longer than `group_rate` times what independent rows would give.
So a pair must be in enough rows to stand out: at 12,000 rows some 120 with both were enough, at 3,000 rows 70 were not.

The model is fitted on at most `sample_rows` labelled rows, those with the smallest hash of their key, by the driver;
term extraction for them and all scoring run in Spark tasks.  Every document is scored on its whole text, without a
shuffle.

Edge cases: a null or empty text has no terms and gets the score of the bias; without labelled rows, or with one
class only, the bias is the smoothed share of toxic rows; repeated rows get equal scores; a key with several labels
counts as toxic if one of them says so; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.texts import whole

BITS = 18
_WORD = re.compile(r"[^\W\d_]+")
_CACHED = 1 << 16  # words a task remembers at most before it starts anew


def columns_of(word: str) -> tuple[int, ...]:
    """The hashed columns of a word and of its beginnings."""
    from xxhash import xxh32_intdigest

    names = [word, f"^{word[:4]}", f"^{word[:5]}"] if len(word) > 4 else [word]
    return tuple(xxh32_intdigest(name.encode()) >> (32 - BITS) for name in names)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


@dataclass(frozen=True)
class Model:
    """Bias, and the columns with a weight or factors: sorted column numbers, weights and factors."""

    bias: float
    columns: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, places: np.ndarray) -> float:
        """Of a text that has the terms at these places of `columns`."""
        held = self.factors[places]
        together = held.sum(0)
        return self.bias + self.weights[places].sum() + 0.5 * float((together**2).sum() - (held**2).sum())

    def scorer(self):
        """A function from texts to scores that remembers the places of words."""
        where = {int(column): place for place, column in enumerate(self.columns)}
        known: dict[str, tuple[int, ...]] = {}

        def places(word: str) -> tuple[int, ...]:
            if len(known) >= _CACHED:
                known.clear()
            found = known[word] = tuple(where[c] for c in columns_of(word) if c in where)
            return found

        def score(text: str) -> float:
            hit: set[int] = set()
            for word in words_of(text):
                at = known.get(word)
                if at is None:
                    at = places(word)
                if at:
                    hit.update(at)
            margin = self.margin(np.fromiter(sorted(hit), int, len(hit)))
            return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))

        return score


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for text in batch.column(2):
            terms = {column for word in words_of(text.as_py()) for column in columns_of(word)}
            found.append(np.fromiter(sorted(terms), "<u4", len(terms)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["key", "label", "terms"]
        )


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = 12_000, **options) -> Model:
    """A model from at most `sample_rows` labelled documents.

    `labels` holds the rows that may be learned from; the bound makes the broadcast and the driver's part safe.
    """
    named = labels.select(F.col(key).cast("string").alias("key"), F.col(label).cast("int").alias("label"))
    named = named.where("key is not null and label is not null").groupBy("key").agg(F.max("label").alias("label"))
    picked = named.orderBy(F.xxhash64("key"), "key").limit(sample_rows)
    texts = docs.select(F.col(key).cast("string").alias("key"), whole(text).alias("text"))
    rows = texts.join(F.broadcast(picked), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    sample = sorted(rows.mapInArrow(_extract, "key string, label int, terms binary").collect())
    return train([np.frombuffer(r["terms"], "<u4") for r in sample], np.array([r["label"] for r in sample]), **options)


def train(
    terms: list[np.ndarray],
    labels: np.ndarray,
    factors: int = 4,
    epochs: int = 6,
    batch: int = 64,
    alpha: float = 0.3,
    l1_rate: float = 0.25,
    l2: float = 1.0,
    factor_rate: float = 0.1,
    factor_l2: float = 0.02,
    group_rate: float = 2.0,
    least_rows: int = 5,
    seed: int = 7,
) -> Model:
    """FTRL for the weights (L1 penalty) and for the factors of all terms (group penalty).

    The L1 penalty is `l1_rate` times the root of the number of rows, so it outgrows the noise at every size.  The
    group penalty is `group_rate` times the root of the squares summed row by row; every epoch adds the same rows again.
    """
    size = 1 << BITS
    rng = np.random.default_rng(seed)
    n, toxic = len(labels), int((labels > 0).sum())
    share = (toxic + 1) / (n + 10)  # as if ten more rows, one of them toxic, had been seen
    bias = float(np.log(share / (1 - share)))
    empty = Model(bias, np.zeros(0, int), np.zeros(0), np.zeros((0, factors)))
    if not 0 < toxic < n:
        return empty
    y = (labels > 0).astype(float)
    frequent = np.zeros(size, int)
    for found in terms:
        frequent[found] += 1
    terms = [found[frequent[found] >= least_rows] for found in terms]
    usable = np.array([i for i in range(n) if len(terms[i])], int)
    z, squares, w = np.zeros(size), np.zeros(size), np.zeros(size)
    start = rng.normal(0, 0.01, (size, factors))
    v, v_z, v_squares, spread = start.copy(), np.zeros((size, factors)), np.ones(size), np.zeros(size)
    number = np.zeros(size, int)
    l1 = l1_rate * np.sqrt(n)
    for epoch in range(epochs):
        order = rng.permutation(usable)
        for at in range(0, len(order), batch):
            part = order[at : at + batch]
            counts = np.array([len(terms[i]) for i in part])
            cols = np.concatenate([terms[i] for i in part]).astype(int)
            rows = np.repeat(np.arange(len(part)), counts)
            starts = np.cumsum(counts) - counts
            held = v[cols]
            together = np.add.reduceat(held, starts)
            pairs = 0.5 * (together**2 - np.add.reduceat(held**2, starts)).sum(1)
            margin = bias + np.add.reduceat(w[cols], starts) + pairs
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]
            gradient = np.bincount(cols, error[rows], size)
            u = np.flatnonzero(gradient)
            g = gradient[u]
            z[u] += g - (np.sqrt(squares[u] + g * g) - np.sqrt(squares[u])) / alpha * w[u]
            squares[u] += g * g
            shrunk = z[u] - np.sign(z[u]) * l1
            w[u] = np.where(np.abs(z[u]) <= l1, 0, -shrunk / ((1 + np.sqrt(squares[u])) / alpha + l2))
            seen = np.flatnonzero(np.bincount(cols, minlength=size))
            number[seen] = np.arange(len(seen))
            place = number[cols]
            pull = error[rows][:, None] * (together[rows] - held)
            spread[seen] += np.bincount(place, (pull**2).sum(1), len(seen))
            g = np.stack([np.bincount(place, pull[:, f], len(seen)) for f in range(factors)], 1) + factor_l2 * v[seen]
            grown = np.sqrt(v_squares[seen] + (g**2).sum(1))
            v_z[seen] += g - (grown - np.sqrt(v_squares[seen]))[:, None] / factor_rate * (v[seen] - start[seen])
            v_squares[seen] = grown**2
            length = np.sqrt((v_z[seen] ** 2).sum(1))
            left = np.maximum(0, 1 - group_rate * np.sqrt((epoch + 1) * spread[seen]) / np.maximum(length, 1e-12))
            v[seen] = start[seen] - (left * factor_rate / grown)[:, None] * v_z[seen]
            bias -= 0.1 * float(error.mean())
    v[(v == start).all(1)] = 0
    kept = np.flatnonzero((w != 0) | v.any(1))
    return Model(bias, kept, w[kept], v[kept])


def toxicity(text: Column | str, model: Model) -> Column:
    """The score of a text, as a column."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = model.scorer()
        for texts in batches:
            yield pa.array([score(value.as_py()) for value in texts], pa.float64())

    return scores(whole(text))
