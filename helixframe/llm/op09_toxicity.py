"""Toxicity: a linear classifier with a counterfactual penalty.

A text's logit is a bias plus a weight for each of its distinct words; a word's weight is the sum over its features
(the word itself and its character n-grams with marked ends, hashed). Features are scaled by their smoothed log-count
ratio between the classes (those under ``LEAST`` are left out), and the weights are fitted by accelerated proximal gradient descent on the logistic
loss with an L2 penalty and a counterfactual one. Identity terms stand in groups, each with a word that names nobody in particular (``people``).
For each term in a labelled sentence there is a swapped sentence for every other term of its groups: the same words without the term and with the
other, which may be there already. Besides, each term is planted in ``PLANTS`` of the sentences and swapped there, for groups that the
labelled text never names. The squared change of the logit from a sentence to its swapped ones is penalised (the logit, as a change near
0 or 1 would hardly count by its score), so that a neutral mention of a group neither moves the score nor differs from that of another.
The penalty's proximal step is solved exactly over the terms' features, so a heavy penalty slows nothing down.

The penalty's weight is chosen on held-out sentences: models are fitted to two thirds of at most ``CHOICE`` sentences of each class with rising
weights of ``PENALTIES``. The first weight counts that leaves ``LEFT`` of the score changes seen without a penalty, as long as the held-out loss rises by no
more than ``LOSS``; if none does, the one that leaves least of them. The groups are a parameter; ``ToxicityModel.mentions`` and ``swaps`` say
how many were found and ``counterfactual`` which weight was chosen; the query returns them.

The fit uses a bounded sample of the labelled rows: of each class the ``POSITIVE`` and ``NEGATIVE`` rows of the
training folds with the smallest id hash, without those whose whole text would bring the class over ``CHARS`` characters.
The classes' prior comes from all labels of these folds, and every row is scored over its whole text.

Null and empty texts, and texts without words, score by the bias alone. If the labels hold one class only, or none,
every text has that class's share (or 0) as its score. A repeated id counts once, toxic if any of its labels is.
Repeated rows score alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import collections
import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernels import U, hash_spans, mix, passes, word_spans
from .session import arrow_map, fold, prepare, table

POSITIVE, NEGATIVE, CHARS = 2048, 4096, 4_000_000
#: Buckets of hashed features, n-gram lengths, and the least log-count ratio of a feature.
WIDTH, GRAMS, LEAST = 1 << 20, (4, 5), 0.1
L2, STEPS = 1e-3, 120
#: Weights of the counterfactual penalty to choose from, and what the choice is made with.
PENALTIES, CHOICE, LEFT, LOSS, CHOICE_STEPS = (0.1, 1.0, 10.0, 100.0, 1000.0), 768, 0.02, 2e-3, 60
#: Sentences in which each term is planted.
PLANTS = 16
#: Groups of terms that may stand for each other in a sentence; the first of each names nobody in particular.
IDENTITY = (
    ("people", "women", "men", "girls", "boys"), ("person", "woman", "man", "girl", "boy"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("single", "gay", "lesbian", "bisexual", "straight", "transgender"), ("local", "black", "white", "asian", "latino", "african"),
    ("people", "immigrants", "refugees", "foreigners", "natives"), ("able", "disabled", "blind", "deaf"), ("adult", "old", "young", "elderly"),
    ("leute", "frauen", "männer"), ("leute", "muslime", "christen", "juden"), ("gens", "femmes", "hommes"), ("gens", "musulmans", "chrétiens", "juifs"),
    ("gente", "mujeres", "hombres"), ("gente", "musulmanes", "cristianos", "judíos"),
)


def word_features(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word, and where each word's features start. The code points around a word are taken for its ends' marks."""
    parts, owners = [hash_spans(codes, starts, lengths)], [np.arange(len(starts))]
    for n in GRAMS:
        count = np.maximum(lengths + 2 - n + 1, 0)  # with one mark at each end
        owner = np.repeat(np.arange(len(starts)), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        value = np.full(len(owner), n, dtype=U)
        for j in range(n):
            place = at + j - 1
            edge = (place < 0) | (place >= lengths[owner])
            c = codes[np.where(edge, starts[owner], starts[owner] + place)].astype(U)
            value = mix(value * U(0x9E3779B97F4A7C15) + np.where(edge, U(7), c + U(16)))
        parts.append(value)
        owners.append(owner)
    owner, value = np.concatenate(owners), np.concatenate(parts)
    order = np.argsort(owner, kind="stable")
    return (value[order] % U(WIDTH)).astype(np.int64), np.searchsorted(owner[order], np.arange(len(starts) + 1))


def distinct_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of the batch's distinct words and their starts; word numbers of each text (distinct) and their starts; the words' hashes."""
    codes, starts, lengths, first = word_spans(texts)
    hashes = hash_spans(codes, starts, lengths)
    unique, index, number = np.unique(hashes, return_index=True, return_inverse=True)
    features, begin = word_features(codes, starts[index], lengths[index])
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    pair = np.unique(owner * max(1, len(unique)) + number)
    owner, number = pair // max(1, len(unique)), pair % max(1, len(unique))
    return features, begin, number, np.searchsorted(owner, np.arange(len(texts) + 1)), unique


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of consecutive runs."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


def gathered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``distinct_words``, over many texts in passes of bounded memory."""
    parts = []
    for lo, hi in passes(texts):
        features, begin, words, first, unique = distinct_words(texts[lo:hi])
        parts.append((features.astype(np.int32), begin.astype(np.int32), words.astype(np.int32), first, unique))
    unique, index, inverse = np.unique(np.concatenate([p[4] for p in parts]), return_index=True, return_inverse=True)
    features = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([np.diff(p[1]) for p in parts]).astype(np.int64)
    starts = (np.cumsum(counts) - counts)[index]
    features, counts = features[ranges(starts, counts[index])], counts[index]
    shift, words = 0, []
    for p in parts:
        words.append(inverse[p[2] + shift].astype(np.int32))
        shift += len(p[4])
    each = np.concatenate([np.diff(p[3]) for p in parts])
    return features, np.concatenate(([0], np.cumsum(counts))), np.concatenate(words), np.concatenate(([0], np.cumsum(each))), unique


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs, empty runs included."""
    out = np.zeros(len(starts) - 1)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        out[full] = np.add.reduceat(values, starts[full], dtype=np.float64)
    return out


class Sentences:
    """Labelled sentences as sets of words, words as sets of features, and the differences that swaps of terms make."""

    def __init__(self, texts: list[str | None], toxic: np.ndarray, identity):
        self.y = y = toxic
        terms = [w for g in identity for w in g]
        features, begin, words, first, hashes = gathered([*texts, " ".join(terms)])
        self.words, self.first = words[: first[-2]], first[:-1]
        n, self.m = len(texts), len(begin) - 1
        owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.first))
        word_of = np.repeat(np.arange(self.m, dtype=np.int32), np.diff(begin))

        def spread(by_text: np.ndarray) -> np.ndarray:
            by_word = np.bincount(self.words, weights=by_text[owner], minlength=self.m)
            return np.bincount(features, weights=by_word[word_of], minlength=WIDTH)

        pos, neg = spread(y), spread(1 - y)
        ratio = np.log((pos + 1) / (y.sum() + 1)) - np.log((neg + 1) / ((1 - y).sum() + 1))
        ratio[(pos + neg < 2) | (np.abs(ratio) < LEAST)] = 0
        self.used = np.flatnonzero(ratio)
        kept = ratio[features] != 0
        self.begin = np.concatenate(([0], np.cumsum(kept)))[begin]
        self.features, word_of = np.searchsorted(self.used, features[kept]).astype(np.int32), word_of[kept]
        self.by_feature = ratio[self.used]
        self.scaled = self.by_feature[self.features].astype(np.float32)
        # The same links in order of the features, for sums without a histogram.
        order = np.argsort(self.features, kind="stable")
        self.word_by_feature, self.feature_begin = word_of[order], np.searchsorted(self.features[order], np.arange(len(self.used) + 1))
        order = np.argsort(self.words, kind="stable")
        self.text_by_word, self.text_begin = owner[order], np.searchsorted(self.words[order], np.arange(self.m + 1))
        self._swaps(texts, identity, hashes, owner)

    def _swaps(self, texts: list[str | None], identity, hashes: np.ndarray, owner: np.ndarray) -> None:
        """``mentions`` of terms; ``swaps``, the swapped sentences; ``changes``: their differences over the features ``at``, and ``often``, the share of each."""
        numbers = {}
        for g in identity:
            for w in g:
                codes, starts, lengths, _ = word_spans([w])
                numbers[w] = int(np.searchsorted(hashes, hash_spans(codes, starts, lengths)[0]))
        others: dict[int, set[int]] = {}
        for g in identity:
            for w in g:
                others.setdefault(numbers[w], set()).update(numbers[x] for x in g if x != w)
        known = np.array(sorted(others), np.int64)
        held: dict[int, set[int]] = {}
        for i in np.flatnonzero(np.isin(self.words, known)).tolist():
            held.setdefault(int(owner[i]), set()).add(int(self.words[i]))
        self.mentions = 0
        for lo, hi in passes(texts):
            codes, starts, lengths, _ = word_spans(texts[lo:hi])
            self.mentions += int(np.isin(np.searchsorted(hashes, hash_spans(codes, starts, lengths)), known).sum())
        swaps: collections.Counter = collections.Counter()  # term that goes, term that comes or -1 where it is there already
        for own in held.values():
            swaps.update((a, -1 if b in own else b) for a in own for b in others[a])
        for r in np.unique(np.linspace(0, len(texts) - 1, PLANTS).astype(np.int64)).tolist():
            own = held.get(r, set())
            swaps.update((a, -1 if b in own else b) for a in others if a not in own for b in others[a])
        pairs = sorted(swaps)
        self.swaps = sum(swaps.values())
        part = {w: self.features[self.begin[w] : self.begin[w + 1]] for w in others}
        self.at = np.unique(np.concatenate([np.zeros(0, np.int32), *part.values()])).astype(np.int64)
        self.changes = np.zeros((len(pairs), len(self.at)))
        for i, (a, b) in enumerate(pairs):
            for w, sign in ((a, -1.0), (b, 1.0)):
                if w >= 0:
                    np.add.at(self.changes[i], np.searchsorted(self.at, part[w]), sign * self.by_feature[part[w]])
        self.often = np.array([swaps[p] for p in pairs]) / max(1, self.swaps)

    def logits(self, v: np.ndarray) -> np.ndarray:
        return sums(sums(self.scaled * v.astype(np.float32)[self.features], self.begin)[self.words], self.first)

    def back(self, by_text: np.ndarray) -> np.ndarray:
        w = sums(by_text[self.text_by_word], self.text_begin)
        return self.by_feature * sums(w[self.word_by_feature], self.feature_begin)

    def fitted(self, counterfactual: float, l2: float, steps: int, rows: np.ndarray | None = None) -> tuple[np.ndarray, float]:
        """Weights of the features and a bias, from all rows or those that ``rows`` marks."""
        y, there = self.y, np.ones(len(self.y)) if rows is None else rows.astype(np.float64)
        each = np.where(y > 0, 0.5 * there / (y * there).sum(), 0.5 * there / ((1 - y) * there).sum())  # both classes weigh the same
        v = np.random.default_rng(0).standard_normal(len(self.used))
        top = 1.0
        for _ in range(12):
            v /= np.linalg.norm(v) or 1.0
            v = self.back(0.25 * each * self.logits(v))
            top = max(np.linalg.norm(v), 1e-9)
        step = 1 / (1.2 * top + l2 + 0.25)
        heavy = (self.changes * (counterfactual * self.often)[:, None]).T @ self.changes
        settle = np.linalg.inv(np.eye(len(self.at)) + step * heavy)
        v, b = np.zeros(len(self.used)), 0.0
        ahead, ahead_b, t = v, b, 1.0
        for _ in range(steps):
            gap = each * (1 / (1 + np.exp(-np.clip(self.logits(ahead) + ahead_b, -40, 40))) - y)
            v2 = ahead - step * (self.back(gap) + l2 * ahead)
            v2[self.at] = settle @ v2[self.at]
            b2 = ahead_b - 4 * gap.sum() * 0.5
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead, ahead_b = v2 + (t - 1) / t2 * (v2 - v), b2 + (t - 1) / t2 * (b2 - b)
            v, b, t = v2, b2, t2
        return v, b

    def moved(self, v: np.ndarray, z: np.ndarray) -> float:
        """The mean change of the scores of sentences with logits ``z`` when terms are swapped in them."""
        d = self.changes @ v[self.at]
        p = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        return float(sum(w * np.abs(p(z + x) - p(z)).mean() for w, x in zip(self.often, d, strict=True)))

    def chosen(self, l2: float, penalties: tuple[float, ...] = PENALTIES) -> float:
        """The penalty's weight by the sentences that every third row holds out."""
        out = np.arange(len(self.y)) % 3 == 0
        if min(self.y[out].sum(), (1 - self.y[out]).sum(), self.y[~out].sum(), (1 - self.y[~out]).sum()) == 0:
            return penalties[-1]
        found = []
        for weight in (0.0, *penalties):
            v, b = self.fitted(weight, l2, CHOICE_STEPS, ~out)
            z, y = self.logits(v)[out] + b, self.y[out]
            loss = np.logaddexp(0, np.where(y > 0, -z, z))
            found.append((self.moved(v, z), 0.5 * (loss[y > 0].mean() + loss[y == 0].mean()), weight))
            if weight and found[-1][0] <= LEFT * found[0][0] and found[-1][1] <= found[0][1] + LOSS:
                return weight
        return min(x for x in found if x[1] <= found[0][1] + LOSS)[2]


@dataclass
class ToxicityModel:
    """``mentions``: identity terms in the labelled sentences. ``swaps``: sentences with a term swapped. ``counterfactual``: the weight of the penalty on what these change."""

    weights: np.ndarray
    bias: float
    constant: float | None = None
    mentions: int = 0
    swaps: int = 0
    counterfactual: float = 0.0

    @classmethod
    def fit(cls, texts: list[str | None], toxic: list[int], prior: float, counterfactual: float | None = None, identity=IDENTITY, l2: float = L2, steps: int = STEPS) -> ToxicityModel:
        """``counterfactual`` is chosen on held-out sentences where it is None."""
        y = np.array(toxic, dtype=np.float64)
        if not len(y) or y.min() == y.max():
            return cls(np.zeros(1, np.float32), 0.0, float(prior))
        if counterfactual is None:
            some = np.sort(np.concatenate([np.flatnonzero(y == k)[:CHOICE] for k in (0, 1)]))
            counterfactual = Sentences([texts[i] for i in some.tolist()], y[some], identity).chosen(l2)
        given = Sentences(texts, y, identity)
        v, b = given.fitted(counterfactual, l2, steps)
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        slope, bias = cls._calibrated(given.logits(v) + b, y, np.where(y > 0, prior / y.sum(), (1 - prior) / (1 - y).sum()))
        weights = np.zeros(WIDTH, dtype=np.float32)
        weights[given.used] = v * given.by_feature * slope
        return cls(weights, float(b * slope + bias), None, given.mentions, given.swaps, counterfactual)

    @staticmethod
    def _calibrated(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
        """Slope and shift that fit the classes' prior best (Newton steps, the slope held near 1)."""
        x = np.stack([z, np.ones_like(z)], axis=1)
        a = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
            pull = ridge * np.array([1.0, 0.0])
            gradient = x.T @ (weight * (p - y)) + pull * (a - np.array([1.0, 0.0]))
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull) + 1e-6 * np.eye(2), gradient)
            a = a - step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        return max(float(a[0]), 0.05), float(a[1])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        features, begin, words, first, _ = distinct_words(texts)
        by_word = sums(self.weights[features], begin)
        return 1 / (1 + np.exp(-np.clip(sums(by_word[words], first) + self.bias, -40, 40)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positive: int = POSITIVE, negative: int = NEGATIVE, chars: int = CHARS, **settings
) -> ToxicityModel:
    """From the rows of ``docs`` that ``labels`` marks; the sample's bounds are ``positive``, ``negative`` and ``chars``. ``settings`` go to ``ToxicityModel.fit``."""
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("__y"))
    count = dict(marks.groupBy("__y").count().collect())
    order = [F.xxhash64(F.col("__id").cast("string")), F.col("__id")]
    chosen = [marks.filter(F.col("__y") == k).orderBy(*order).limit(n) for k, n in ((1, positive), (0, negative))]
    given = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).filter(F.col("__id").isNotNull())
    rows = given.join(F.broadcast(chosen[0].unionByName(chosen[1])), "__id").groupBy("__id", "__y").agg(F.min("__text").alias("__text")).orderBy(*order)
    texts, toxic, size = [], [], [0, 0]
    for r in rows.toLocalIterator():
        n = len(r["__text"] or "")
        if size[r["__y"]] + n <= chars:
            size[r["__y"]] += n
            texts.append(r["__text"])
            toxic.append(r["__y"])
    model = ToxicityModel.fit(texts, toxic, count.get(1, 0) / max(1, sum(count.values())), **settings)
    logging.getLogger(__name__).info("%d labelled texts of %d characters, %d mentions of identity terms, %d swaps, penalty %g", len(texts), sum(size), model.mentions, model.swaps, model.counterfactual)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` and ``predicted`` for every row."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    given = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for lo, hi in passes(texts):
                s = shared.value.score(texts[lo:hi])
                yield [batch.column(0).slice(lo, hi - lo), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]

    return arrow_map(given, run, [(id_col, given.schema.fields[0].dataType), ("score", "double"), ("predicted", "int")])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    return score_toxicity(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", *(F.lit(getattr(model, x)).alias(x) for x in ("mentions", "swaps", "counterfactual")))


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
