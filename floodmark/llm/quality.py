"""Quality scores from document statistics, by random Fourier features.

1. Statistics of the whole text: lengths, shares of kinds of characters, repeated
   words and lines, and the like.
2. Standardised, they are mapped to cosines of random projections, which
   approximate a Gaussian kernel; its width is the root of the number of statistics.
3. Ridge regression: each partition sums its part of the normal equations, the
   sums are added up, and one small system of fixed size is solved.
4. Isotonic calibration on labelled rows the regression has not seen turns raw
   scores, in steps of a thousandth, into rising probabilities.

All labelled rows are used.  Scores see texts only.

A null or empty text has the statistics of no characters and is scored like any
other.  Repeated rows score alike; a null id stays null and has no label; an empty
table gives no rows; without labels every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import by_slices, bytes_of, read, texts_of, words_of, written
from floodmark.llm.toxicity import fold

FEATURES = 192
RIDGE = 1e-4
SEED = 5
THRESHOLD = 0.3
STEPS = 1_000


def _kinds() -> np.ndarray:
    """A row per kind of byte: capital, small, digit, space, line end, stop, other marks, beyond ASCII."""
    byte = [chr(b) for b in range(128)]
    stops = ".,;:'\"-()"
    tests = [
        lambda c: c.isupper(),
        lambda c: c.islower(),
        lambda c: c.isdigit(),
        lambda c: c in " \t\r\v\f",
        lambda c: c == "\n",
        lambda c: c in stops,
        lambda c: c.isprintable() and not c.isalnum() and c != " " and c not in stops,
    ]
    rows = [[test(c) for c in byte] + [False] * 128 for test in tests]
    return np.array([*rows, [False] * 128 + [True] * 128])


KINDS = _kinds()


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    total = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return total[first[1:]] - total[first[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of statistics per text."""
    data, at = bytes_of(texts)
    hashes, starts, ends, first = words_of(data, at)
    size, words = np.diff(at).astype(float), np.diff(first).astype(float)
    some_bytes, some_words = np.maximum(size, 1), np.maximum(words, 1)
    shares = [_per_text(kind[data], at) / some_bytes for kind in KINDS]
    length = (ends - starts).astype(float)
    mean = _per_text(length, first) / some_words
    spread = np.sqrt(np.maximum(_per_text(length**2, first) / some_words - mean**2, 0))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])][: len(hashes)]
    order = np.lexsort((hashes, owner))
    sorted_ = hashes[order]
    new = np.r_[True, (sorted_[1:] != sorted_[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    begin = np.flatnonzero(new)
    runs = np.diff(np.r_[begin, len(hashes)]).astype(float)
    of_run = owner[begin]
    distinct = np.bincount(of_run, minlength=len(texts))
    most = np.zeros(len(texts))
    np.maximum.at(most, of_run, runs)
    plogp = np.bincount(of_run, runs * np.log(runs), minlength=len(texts))
    entropy = np.log(some_words) - plogp / some_words
    lines = _per_text(data == ord("\n"), at) + 1
    mark = (KINDS[5] | KINDS[6])[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    alone = length == 1
    letter = (KINDS[0] | KINDS[1] | KINDS[7])[data[starts]] if len(starts) else np.zeros(0, bool)
    capital = KINDS[0][data[starts]] if len(starts) else np.zeros(0, bool)
    second = np.minimum(starts + 1, max(len(data) - 1, 0))
    shout = capital & KINDS[0][data[second]] & ~alone if len(starts) else capital
    return np.stack(
        [
            np.log1p(size), np.log1p(words), *shares, np.minimum(mean, 50) / 10, np.minimum(spread, 50) / 10,
            _per_text(again, first) / some_words, distinct / some_words, most / some_words,
            entropy / np.maximum(np.log(some_words), 1), np.log1p(lines), np.log1p(words / lines),
            _per_text(mark, first) / some_words, _per_text(alone, first) / some_words,
            _per_text(~letter, first) / some_words, _per_text(capital, first) / some_words,
            _per_text(shout, first) / some_words,
        ],
        axis=1,
    )


def document_statistics(texts: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of each row."""

    def work(part):
        x = statistics(part.column("text"))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), flat.cast(pa.list_(pa.float64()))], ["doc_id", "x"]
        )

    return texts.mapInArrow(by_slices(work), "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(rows: DataFrame, terms, size: int) -> np.ndarray:
    """The sum over all rows of a vector of fixed size, added up per partition first.

    ``terms`` gives the summed vector of a batch.  Of each partition one entry per
    place goes through the shuffle.
    """

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += terms(batch)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "part"])

    parts = rows.mapInArrow(add, "at long, part double").groupBy("at").agg(F.sum("part").alias("part"))
    found = parts.toPandas()
    total = np.zeros(size)
    total[found["at"].to_numpy(np.int64)] = found["part"].to_numpy(float)
    return total


class Fourier:
    """Standardised statistics mapped to random cosines, with a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int):
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        random = np.random.default_rng(SEED)
        self.turn = random.normal(size=(len(mean), features)) / np.sqrt(len(mean))
        self.shift = random.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        wave = np.cos(z @ self.turn + self.shift) * np.sqrt(2 / len(self.shift))
        return np.c_[wave, np.ones(len(x))]


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to the values (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.array([v for v, _, n in blocks for _ in range(int(n))])


def score_quality(
    docs: DataFrame, labels: DataFrame, features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score (0 to 1) of each row; ``labels`` has doc_id and quality (0 or 1)."""
    stats = written(document_statistics(texts_of(docs, id_col, text_col)), "statistics")
    known = labels.filter("doc_id is not null and quality in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    rows = written(stats.join(known, "doc_id"), "labelled")
    # A fifth, by hash of the id, is left to the calibration.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    fitting, checking = rows.filter(part != 0), rows.filter(part == 0)
    wide = statistics(pa.array([""])).shape[1]

    def moments(batch):
        x = _matrix(batch.column("x"))
        return np.r_[len(x), x.sum(axis=0), (x**2).sum(axis=0)]

    sums = _sums(fitting, moments, 1 + 2 * wide)
    n = max(sums[0], 1)
    mean = sums[1 : 1 + wide] / n
    fourier = Fourier(mean, np.sqrt(np.maximum(sums[1 + wide :] / n - mean**2, 0)), features)
    upper = np.triu_indices(features + 1)

    def equations(batch):
        z, y = fourier(_matrix(batch.column("x"))), batch.column("y").to_numpy()
        return np.r_[(z.T @ z)[upper], z.T @ y]

    sums = _sums(fitting, equations, len(upper[0]) + features + 1)
    square = np.zeros((features + 1, features + 1))
    square[upper] = sums[: len(upper[0])]
    square = square + np.triu(square, 1).T
    weights = np.linalg.solve(square + RIDGE * n * np.eye(features + 1), sums[len(upper[0]) :])

    def raw(batch):
        return np.clip(fourier(_matrix(batch.column("x"))) @ weights, -1, 2)

    def steps(batch):
        at = np.round((raw(batch) + 1) * STEPS).astype(np.int64)
        y = batch.column("y").to_numpy()
        return np.r_[np.bincount(at, minlength=3 * STEPS + 1), np.bincount(at, y, minlength=3 * STEPS + 1)]

    count, good = _sums(checking, steps, 2 * (3 * STEPS + 1)).reshape(2, -1)
    some = np.flatnonzero(count)
    if len(some):
        level = rising(good[some] / count[some], count[some])
        # A level is held at the middle of its stretch; between middles scores rise evenly.
        levels, place = np.unique(level, return_inverse=True)
        middle = np.bincount(place, some * count[some]) / np.bincount(place, count[some]) / STEPS - 1
    else:
        levels, middle = np.array([0.5]), np.array([0.0])

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            value = raw(batch)
            # Beyond the outer levels the raw score breaks ties, within a thousandth.
            calibrated = np.interp(value, middle, levels) * 0.998 + 0.001 * (value + 1) / 1.5
            if not len(some):
                calibrated = np.full(len(value), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(calibrated)], ["doc_id", "score"])

    return stats.mapInArrow(score, "doc_id long, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents; a fifth of the labels is held out."""
    labels = read(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    scored = score_quality(read(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
