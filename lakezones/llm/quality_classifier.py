"""Score document quality: random Fourier features, ridge regression, isotonic calibration.

1. A text is described by a fixed list of statistics, computed from the whole of it.
2. Random cosines of the standardised statistics approximate a Gaussian kernel. The normal
   equations of a ridge regression on the labels are sums over documents: every task sums its
   own, the sums are added up in two steps, and the small system is solved on the driver.
3. Raw scores of the training documents are put into narrow steps; the mean label of each step,
   made monotone (isotonic regression), and interpolated between, is the score.

Training takes labelled documents only, at most about ``TRAINING_DOCUMENTS`` of them, chosen by
a hash of the id where there are more. All sizes that reach the driver are fixed: the system,
the steps.

Defined results: a null text counts as an empty one, whose statistics are all 0, and is scored
like any other; of several labels of an id the greatest counts; null labels are ignored, and so
are documents without an id in training; without any training label every score is 0.5; with one
kind of label only, every score is that label. Repeated rows get equal scores. Other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.session import stage

FEATURES = 256
RIDGE = 1e-3
SEED = 7
STEPS = 2000
THRESHOLD = 0.7

# Labelled documents used for training, and partial sums in the second step.
TRAINING_DOCUMENTS = 2_000_000
SUMS = 32

# Ids of labelled documents up to this number are broadcast (at most about 40 bytes each).
BROADCAST_IDS = 500_000

# Inputs, directions, features and weights are multiples of these, so that every product and sum of
# them is exact and no result depends on the order of the rows: of at most 2 ** 21 rows the
# products of two features, multiples of 2 ** -32, add up within 53 bits.
INPUT_STEP = 2.0**-12
FEATURE_STEP = 2.0**-16
WEIGHT_STEP = 2.0**-20
# Statistics are far below this; their squares are summed in two halves.
GREATEST_STATISTIC = 256.0
STATISTIC_STEP = 2.0**-20
HALF = 1 << 28

# Rows of a batch in one matrix.
BLOCK = 4096

WORDS = re.compile("[^ \t\n\x0b\x0c\r]+")
CLOSED = re.compile("[.!?…。:;\"'”’»)]\\s*$")

STATISTICS = (
    "log_words", "log_lines", "word_length", "long_words", "short_words", "distinct_words", "top_word",
    "repeated_neighbours", "repeated_triples", "repeated_lines", "upper", "digits", "symbols", "punctuation",
    "exclamations", "separators", "non_ascii", "closed_lines", "words_per_line", "symbol_words",
)


def statistics(text: str | None) -> list[float]:
    """The values of ``STATISTICS`` for a whole text."""
    words = WORDS.findall(text or "")
    if not words:
        return [0.0] * len(STATISTICS)
    count, joined = len(words), "".join(words)
    letters = len(joined)
    counts = Counter(words)
    characters = Counter(joined)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    triples = Counter(zip(words, words[1:], words[2:]))

    def share(kind) -> float:
        return sum(n for c, n in characters.items() if kind(c)) / letters

    symbols = "#*$%&<>@^~=+_\\{}[]"
    return [
        log1p(count),
        log1p(len(lines)),
        letters / count,
        sum(n for word, n in counts.items() if len(word) > 12) / count,
        sum(n for word, n in counts.items() if len(word) < 4) / count,
        len(counts) / count,
        max(counts.values()) / count,
        sum(map(str.__eq__, words, words[1:])) / count,
        sum(n for n in triples.values() if n > 1) / count,
        1 - len(set(lines)) / len(lines),
        share(str.isupper),
        share(str.isdigit),
        share(symbols.__contains__),
        share(".,;:!?'\"()-".__contains__),
        share("!".__eq__),
        share("|»«•·→".__contains__),
        share(lambda c: c > "\x7f"),
        sum(1 for line in lines if CLOSED.search(line)) / len(lines),
        log1p(count / len(lines)),
        sum(n for word, n in counts.items() if not any(map(str.isalpha, word))) / count,
    ]


def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and its statistics."""
    for batch in batches:
        values = [statistics(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(values, pa.list_(pa.float64()))], ["doc_id", "statistics"]
        )


def described(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every document. Staged, so that texts are read once."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return stage(rows.mapInArrow(describe, "doc_id bigint, statistics array<double>"), "statistics")


@dataclass(frozen=True)
class Model:
    """Scores statistics."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    scores: np.ndarray

    def features(self, values: np.ndarray) -> np.ndarray:
        """Cosines and the constant 1, in whole steps of ``FEATURE_STEP``."""
        standard = _in_steps(np.clip((values - self.mean) / self.scale, -8, 8), INPUT_STEP)
        cosines = np.cos(standard @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([_in_steps(cosines, FEATURE_STEP), np.ones((len(values), 1))])

    def raw(self, values: np.ndarray) -> np.ndarray:
        return self.features(values) @ self.weights

    def score(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.zeros(0)
        return np.clip(np.interp(self.raw(values), self.steps, self.scores), 0, 1)


@dataclass(frozen=True)
class Constant:
    """Gives every document the same score."""

    value: float

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.full(len(values), self.value)


def _in_steps(values: np.ndarray, step: float) -> np.ndarray:
    """The nearest multiples of ``step``."""
    return np.round(values / step) * step


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("statistics").flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([values])


@dataclass(frozen=True)
class Moments:
    """Number, sum and sum of squares (in two halves) of a task's statistics, in whole steps and so exact."""

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(STATISTICS)))
        for batch in batches:
            values = np.clip(_matrix(batch), -GREATEST_STATISTIC, GREATEST_STATISTIC)
            steps = np.round(values / STATISTIC_STEP).astype(np.int64)
            high, low = np.divmod(steps * steps, HALF)
            total += [np.full(len(STATISTICS), len(values)), steps.sum(0), high.sum(0), low.sum(0)]
        yield _row(sums=total.tobytes())


@dataclass(frozen=True)
class NormalEquations:
    """A task's sums of feature products, and of features times label."""

    model: Model

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(self.model.phases) + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            values, labels = _matrix(batch), batch.column("label").to_numpy().astype(float)
            for at in range(0, len(values), BLOCK):
                features = self.model.features(values[at : at + BLOCK])
                total += features.T @ np.hstack([features, labels[at : at + BLOCK, None]])
        yield _row(sums=total.tobytes())


@dataclass(frozen=True)
class Steps:
    """A task's number of documents and sum of labels in each step of the raw score."""

    model: Model

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STEPS))
        for batch in batches:
            labels = batch.column("label").to_numpy().astype(float)
            place = step_of(self.model.raw(_matrix(batch)))
            total += [np.bincount(place, minlength=STEPS), np.bincount(place, labels, STEPS)]
        yield _row(sums=total.tobytes())


def step_of(raw: np.ndarray) -> np.ndarray:
    """The steps cover raw scores from -0.5 to 1.5; the first and last also what is beyond."""
    return np.clip(((raw + 0.5) / 2 * STEPS).astype(int), 0, STEPS - 1)


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for sums in batch.column("sums").to_pylist():
            values = np.frombuffer(sums)
            total = values.copy() if total is None else total + values
    if total is not None:
        yield _row(sums=total.tobytes())


def summed(rows: DataFrame, sums) -> np.ndarray:
    """The sums of all tasks added up: first in ``SUMS`` tasks, then here. All are exact, in whatever order."""
    partial = rows.mapInArrow(sums, "sums binary").repartition(SUMS).mapInArrow(_added, "sums binary")
    return np.sum([np.frombuffer(row["sums"]) for row in partial.collect()], axis=0)


def isotonic(means: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The monotone values nearest to ``means``: neighbours in the wrong order are pooled."""
    pools: list[list[float]] = []
    for mean, weight in zip(means, weights):
        pools.append([mean, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            mean, weight, size = pools.pop()
            before = pools[-1]
            joint = before[1] + weight
            pools[-1] = [(before[0] * before[1] + mean * weight) / joint, joint, before[2] + size]
    return np.repeat([pool[0] for pool in pools], [int(pool[2]) for pool in pools])


def training_rows(statistics: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """Statistics and label of the documents to learn from: those with a label and ``usable``."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("label"))
    rows = statistics.filter(usable).join(known.withColumn("label", F.col("label").cast("double")), "doc_id")
    return stage(rows.select("doc_id", "statistics", "label"), "training")


def train(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, most: int = TRAINING_DOCUMENTS) -> Model | Constant:
    """Fit a model to rows of ``statistics`` and ``label``."""
    count, least, greatest = rows.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not count:
        return Constant(0.5)
    if least == greatest:
        return Constant(float(least))
    if count > most:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int((1 << 32) * most / count))
    number, total, high, low = summed(rows, Moments()).reshape(4, -1)
    mean = total * STATISTIC_STEP / number
    squares = (high * HALF + low) * STATISTIC_STEP**2
    deviation = np.sqrt(np.maximum(squares / number - mean**2, 0))
    random = np.random.default_rng(SEED)
    model = Model(
        mean,
        np.where(deviation > 1e-9, deviation, 1.0),
        _in_steps(random.normal(size=(len(STATISTICS), features)) / np.sqrt(len(STATISTICS)), INPUT_STEP),
        random.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.zeros(1),
        np.zeros(1),
    )
    size = features + 1
    equations = summed(rows, NormalEquations(model)).reshape(size, size + 1)
    penalty = np.eye(size) * ridge * number[0]
    penalty[-1, -1] = 0
    # The constant is not shrunk; least squares also solves a system without full rank.
    weights = np.linalg.lstsq(equations[:, :size] / number[0] + penalty / number[0], equations[:, size] / number[0], rcond=None)[0]
    weights = _in_steps(weights, WEIGHT_STEP)
    fitted = Model(model.mean, model.scale, model.directions, model.phases, weights, model.steps, model.scores)
    numbers, sums = summed(rows, Steps(fitted)).reshape(2, STEPS)
    used = numbers > 0
    middles = ((np.arange(STEPS) + 0.5) / STEPS * 2 - 0.5)[used]
    steps, scores = _interpolated(middles, isotonic(sums[used] / numbers[used], numbers[used]), numbers[used])
    return Model(model.mean, model.scale, model.directions, model.phases, weights, steps, scores)


def _interpolated(middles: np.ndarray, values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One point for each pool, at its mean raw score, so that scores rise between the pools."""
    starts = np.flatnonzero(np.r_[True, np.diff(values) > 0])
    centres = np.add.reduceat(middles * weights, starts) / np.add.reduceat(weights, starts)
    ends = np.array([middles[0] - 1, *centres, middles[-1] + 1])
    scores = values[starts]
    return ends, np.array([scores[0] * 0.999, *scores, scores[-1] + (1 - scores[-1]) * 0.001])


@dataclass(frozen=True)
class Score:
    """Replaces the statistics by the score."""

    model: Model | Constant

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(self.model.score(_matrix(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])


@dataclass(frozen=True)
class Keep:
    """Keeps the rows whose text, in column ``place``, reaches the threshold, with all their columns."""

    model: Model | Constant
    threshold: float
    place: int

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(self.place).to_pylist()
            values = np.array([statistics(text) for text in texts]).reshape(len(texts), len(STATISTICS))
            yield batch.filter(pa.array(self.model.score(values) >= self.threshold))


def fold(doc_id: Column) -> Column:
    """0 to 3, from the checksum of the id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def fold_of(doc_id: int) -> int:
    """What ``fold`` gives, on the driver."""
    return zlib.crc32(str(doc_id).encode()) % 4


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 2


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    known = described(docs)
    model = train(training_rows(known, labels, ~held_out(F.col("doc_id"))))
    scores = known.mapInArrow(Score(model), "doc_id bigint, score double")
    return scores.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def accepted_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that reach the threshold, unchanged, by a model trained on all but the held-out fold."""
    ids = labels.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    labelled = docs.select("doc_id", "text").filter(~held_out(F.col("doc_id"))).join(ids, "doc_id", "left_semi")
    model = train(training_rows(described(labelled), labels, F.lit(True)))
    # Columns pass through under plain names, as Spark takes a dot in one for a field.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    kept = plain.mapInArrow(Keep(model, threshold, docs.columns.index("text")), plain.schema)
    return kept.toDF(*docs.columns)
