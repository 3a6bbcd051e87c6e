"""Quality classifier by Naive Bayes support vectors.

Texts become sets of hashed n-gram indicators: character 1- to 3-grams, word 1- and 2-grams, and 1- to 3-grams of
word shapes (cases, digits, marks and whether a word repeats the one before).  Log-count ratios of the two classes
scale the indicators, and a linear model with hinge loss is fitted to the scaled vectors by dual coordinate descent.
Both come from at most ``SAMPLE`` labelled texts (a documented bound: those with the smallest hashes of their ids).  A
logistic curve, fitted on a part of the sample that neither has seen, turns margins into scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import blocks, code_points, mix

BITS = 18
SAMPLE = 4000
COST, EPOCHS, SMOOTHING = 1.0, 12, 1.0
THRESHOLD = 0.3


def indicators(texts: list[str], bits: int = BITS) -> list[np.ndarray]:
    """For each text the sorted distinct feature numbers; an empty text has none."""
    found: list[np.ndarray] = []
    odd, shift, seen = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits), np.zeros(1 << bits, dtype=bool)
    for low, high in blocks(texts):
        points, starts = code_points(texts[low:high])
        space = (points == 32) | ((points >= 9) & (points <= 13))
        p = np.where(space, 32, points).astype(np.uint64)
        one = p + np.uint64(1)
        two = one[:-1] << np.uint64(21) | one[1:]
        three = two[:-1] << np.uint64(21) | one[2:]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=1))
        begin, end = edge[0::2], edge[1::2]
        size = end - begin
        inner = np.flatnonzero(~space)
        chars, word_at = p[inner], np.cumsum(size) - size
        place = (inner - np.repeat(begin, size)).astype(np.uint64)

        def per_word(values):
            return np.add.reduceat(values, word_at) if len(word_at) else values

        total = per_word(mix(one[inner] | place << np.uint64(24)))
        capital = (chars >= 65) & (chars <= 90)
        upper = per_word(capital.astype(np.int64))
        letters = per_word((capital | ((chars >= 97) & (chars <= 122)) | (chars >= 0xC0)).astype(np.int64))
        digits = per_word(((chars >= 48) & (chars <= 57)).astype(np.int64))
        marks = size - letters - digits
        repeat = np.zeros(len(begin), dtype=bool)
        repeat[1:] = total[1:] == total[:-1]
        first = np.searchsorted(begin, starts)
        repeat[first[first < len(repeat)]] = False
        shape = (np.minimum(upper, 2) + 3 * (digits > 0) + 6 * np.minimum(marks, 3) + 24 * (letters == 0) + 48 * repeat
                 + 96 * np.minimum(np.maximum(size, 1) // 6, 3)).astype(np.uint64) + np.uint64(1)
        pair = mix(total[:-1] * np.uint64(3) + mix(total[1:]))
        shapes2 = shape[:-1] << np.uint64(10) | shape[1:]
        shapes3 = shapes2[:-1] << np.uint64(10) | shape[2:] if len(shape) > 2 else shape[:0]
        streams = []
        for n, values in enumerate((one, two, three)):  # grams end before the next text's first character
            streams.append((values, starts, n))
        for values, n in ((total, 0), (pair, 1), (shape, 0), (shapes2, 1), (shapes3, 2)):
            streams.append((values, first, n))
        streams = [(((values + np.uint64(salt << 59)) * odd >> shift).astype(np.int32), bounds.tolist(), n)
                   for salt, (values, bounds, n) in enumerate(streams)]
        for i in range(high - low):
            for values, bounds, n in streams:
                seen[values[bounds[i]:max(bounds[i], bounds[i + 1] - n)]] = True
            own = np.flatnonzero(seen).astype(np.int32)
            seen[own] = False
            found.append(own if texts[low + i] else own[:0])
    return found


def class_counts(sets: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many training texts of either class show each feature."""
    counts = np.zeros((2, 1 << BITS))
    for f, label in zip(sets, y):
        counts[int(label > 0), f] += 1
    return counts[0], counts[1]


def log_count_ratios(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    p, q = n1 + SMOOTHING, n0 + SMOOTHING
    return np.where(n0 + n1 > 0, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, weight: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) of the hinge-loss model over scaled indicators; ``weight`` bounds each dual."""
    def scaled(i):  # made when needed: kept, they would be twice the size of the rows
        v = ratios[rows[i]]
        return v / lengths[i]

    lengths = [max(1e-9, np.sqrt(float(v @ v))) for v in (ratios[f] for f in rows)]
    norm = np.array([float(v @ v) + 1.0 for v in map(scaled, range(len(rows)))])
    w, bias = np.zeros(len(ratios)), 0.0
    alpha, order = np.zeros(len(rows)), np.arange(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        random.shuffle(order)
        for i in order:
            f, v = rows[i], scaled(i)
            gradient = y[i] * (float(w[f] @ v) + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), weight[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * v
                bias += step
                alpha[i] = new
    return np.append(w, bias)


def margins(rows: list[np.ndarray], ratios: np.ndarray, w: np.ndarray) -> np.ndarray:
    result = np.full(len(rows), w[-1])
    for i, f in enumerate(rows):
        v = ratios[f]
        length = np.sqrt(float(v @ v))
        if length:
            result[i] += float(w[f] @ v) / length
    return result


def logistic(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the curve from margin to share of label 1, by Newton steps with a small ridge."""
    a, b = 1.0, 0.0
    x = np.column_stack([margin, np.ones_like(margin)])
    target = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y <= 0) + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * np.array([a, b])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        a, b = np.array([a, b]) - np.linalg.solve(hessian, gradient)
    return float(a), float(b)


class QualityModel:
    """Scores between 0 and 1; ``fit`` needs both classes, else every text gets the share of the one seen."""

    def __init__(self, ratios, weights, slope, offset):
        self.ratios, self.weights = np.asarray(ratios, np.float64), np.asarray(weights, np.float64)
        self.slope, self.offset = slope, offset

    @classmethod
    def fit(cls, sample: DataFrame, text="text", label="quality", calibration: float = 0.25) -> QualityModel:
        """Log-count ratios and weights from texts with labels, the curve from a share kept from both.

        Rows with other labels than 0 and 1 are left out.  ``sample`` comes to the driver as feature numbers: its size
        must be bounded by the caller (see ``train``).
        """
        @F.pandas_udf("binary")
        def features(texts: pd.Series) -> pd.Series:
            return pd.Series([f.tobytes() for f in indicators(texts.tolist())])

        body = F.coalesce(F.col(text), F.lit(""))
        rows = (sample.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("y"), F.xxhash64(body).alias("h"),
                                                             features(body).alias("f")).toPandas())
        rows = rows.sort_values(["h", "y"], kind="stable")  # an order that does not depend on partitions
        y = np.where(rows["y"].to_numpy() == 1, 1.0, -1.0)
        sets = [np.frombuffer(f, dtype=np.int32) for f in rows.pop("f")]
        cut = len(y) - int(len(y) * calibration)
        if len(set(y[:cut].tolist())) < 2 or cut == len(y):
            share = min(max(float((y > 0).mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
            return cls(np.zeros(1 << BITS), np.zeros((1 << BITS) + 1), 0.0, float(np.log(share / (1 - share))))
        balance = {s: cut / (2 * max(1, int((y[:cut] == s).sum()))) for s in (1.0, -1.0)}
        ratios = log_count_ratios(*class_counts(sets[:cut], y[:cut]))
        weights = dual_coordinate_descent(sets[:cut], y[:cut], ratios, np.array([COST * balance[s] for s in y[:cut]]))
        slope, offset = logistic(margins(sets[cut:], ratios, weights), y[cut:])
        return cls(ratios, weights, slope, offset)

    def scores(self, texts: list[str]) -> np.ndarray:
        margin = self.slope * margins(indicators(texts), self.ratios, self.weights) + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def score(self, text) -> F.Column:
        """The score column of a text column; null and empty texts get the score of no evidence."""
        model = self

        @F.pandas_udf("double")
        def scored(texts: pd.Series) -> pd.Series:
            return pd.Series(model.scores(texts.tolist()))

        return scored(F.coalesce(text if not isinstance(text, str) else F.col(text), F.lit("")))


def held_out(key="doc_id"):
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, key="doc_id", sample: int = SAMPLE) -> QualityModel:
    """Fits on labelled documents that are not held out; a document labelled twice counts twice.

    ``sample`` bounds the labels used: those with the smallest hash of their id.  They are broadcast to the documents, so
    no text is shuffled, however many labels there are.
    """
    known = (labels.select(F.col(key).alias("__id"), F.col("quality").alias("__quality"))
             .where(~held_out("__id") & F.col("__quality").isin(0, 1)))
    picked = known.orderBy(F.xxhash64(F.col("__id").cast("string")), "__quality").limit(sample)
    texts = docs.select(key, "text").join(F.broadcast(picked), F.col(key) == F.col("__id"))  # at most ``sample`` narrow rows
    return QualityModel.fit(texts.select("text", F.col("__quality").alias("quality")))


def classify(docs: DataFrame, model: QualityModel, key="doc_id", text="text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, held_out, score, predicted``, one row per document, null keys and repeated rows included."""
    return (docs.select(key, held_out(key).alias("held_out"), model.score(text).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
