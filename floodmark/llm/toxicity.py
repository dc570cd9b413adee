"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are words (letters and digits, A-Z lower-cased) together with their first
four bytes, so that endings not seen before tell something too.  Each kind is
counted in 2^20 hashed classes, so that every table of them has one fixed size.

1. Counts over all documents give the Dirichlet prior, counts over labelled ones
   the log-odds of each class between toxic and other texts.  A class counts with
   the end of its 90% interval nearer to zero, a token with the mean of its two
   classes, less a drift that makes the mean score of other texts negative.
2. Per text, a linear-time scan finds every maximal scoring segment.
3. Extreme-value calibration on the segments that labelled other texts hold by
   chance: their scores have an exponential tail with rate lambda, K of them begin
   per token, so K n e^(-lambda S) of score S or more are expected in n tokens.
   Segments where that is at most ``significance`` are passages.
4. A text's evidence (the best segment's and the sum over segments, as logarithms)
   becomes a score by a two-variable logistic fit to the labels.

Labelled rows are a bounded sample: ``per_class`` of each label, by hash of the
id.  Everything else covers all rows and whole texts.  Scores see texts only.

A null or empty text has no tokens and gets the score of no evidence.  Repeated
rows score alike, a null id stays null, an empty table gives no rows; without
labels of both kinds no token tells anything, and every text gets 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import (
    LOWER,
    MARKS,
    U64,
    by_slices,
    bytes_of,
    mixed,
    read,
    texts_of,
    words_of,
    written,
)

CLASSES_BITS = 20
# Labelled rows of each label that the fit uses at most.
PER_CLASS = 20_000
STEM_BYTES = 4
# Tokens of the prior as a share of the labelled ones; the mean score of other texts, at least this low.
PRIOR = 0.5
DRIFT = 1.0
INTERVAL = 1.64
SIGNIFICANCE = 0.01
THRESHOLD = 0.7

_SEGMENTS = "array<struct<begin: int, end: int, score: double, expected: double>>"


def token_classes(texts: pa.Array):
    """Both classes of every token, its begin and end, each text's first token and first byte."""
    data, at = bytes_of(texts)
    hashes, starts, ends, first = words_of(data, at, MARKS)
    stem = np.zeros(len(starts), U64)
    for k in range(STEM_BYTES):
        byte = LOWER[data[np.minimum(starts + k, len(data) - 1)]].astype(U64) if len(starts) else stem
        stem = stem * U64(257) + np.where(starts + k < ends, byte + U64(1), U64(0))
    shift = U64(64 - CLASSES_BITS)
    words = (hashes >> shift).astype(np.int64)
    stems = (mixed(stem) >> shift).astype(np.int64) + (1 << CLASSES_BITS)
    return words, stems, starts, ends, first, at


def token_counts(texts: DataFrame) -> DataFrame:
    """Tokens per class over all texts (seen), toxic and other labelled ones; ``toxic`` may be null."""

    def count(batches):
        size = 2 << CLASSES_BITS
        seen, toxic, other = (np.zeros(size, np.int64) for _ in range(3))

        def add(part):
            words, stems, _, _, first, _ = token_classes(part.column("text"))
            label = part.column("toxic").to_numpy(zero_copy_only=False).astype(float)
            of = np.repeat(np.nan_to_num(label, nan=-1.0), np.diff(first))
            for classes in (words, stems):
                for total, chosen in ((seen, of > -2), (toxic, of == 1), (other, of == 0)):
                    at, n = np.unique(classes[chosen], return_counts=True)
                    total[at] += n

        for _ in by_slices(add)(batches):
            pass
        some = np.flatnonzero(seen)
        for begin in range(0, len(some), 1 << 16):
            at = some[begin : begin + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(seen[at]), pa.array(toxic[at]), pa.array(other[at])],
                ["class", "seen", "toxic", "other"],
            )

    parts = texts.mapInArrow(count, "class long, seen long, toxic long, other long")
    sums = [F.sum(c).alias(c) for c in ("seen", "toxic", "other")]
    return parts.groupBy("class").agg(*sums)


class Model:
    """Scores of the telling token classes, by the counts of all, and the constants of chance segments."""

    def __init__(self, counts: DataFrame):
        kind = F.col("class") >= 1 << CLASSES_BITS
        totals = [F.sum(c).cast("double").alias(f"all_{c}") for c in ("seen", "toxic", "other")]
        sums = {row["stem"]: row for row in counts.groupBy(kind.alias("stem")).agg(*totals).collect()}
        size = 2 << CLASSES_BITS
        drift, self.score = 0.0, np.zeros(size, np.float32)
        for stem, row in sums.items():
            share = F.col("seen") / F.lit(max(row["all_seen"], 1.0))
            of = {}
            for name in ("toxic", "other"):
                mine = F.col(name) + F.lit(PRIOR * row[f"all_{name}"]) * share + F.lit(1e-9)
                rest = F.lit((1 + PRIOR) * row[f"all_{name}"] + 1e-6) - mine
                of[name] = (mine, F.log(mine / F.greatest(rest, F.lit(1e-9))))
            odds = of["toxic"][1] - of["other"][1]
            sure = F.abs(odds) - INTERVAL * F.sqrt(1 / of["toxic"][0] + 1 / of["other"][0])
            telling = counts.filter(kind == stem).select(
                "class", (F.signum(odds) * sure / 2).alias("score"), sure.alias("sure"), of["other"][0].alias("mine")
            )
            telling = telling.filter("sure > 0")
            if row["all_toxic"] and row["all_other"]:
                # Fewer than the 2^20 classes of the kind.
                rows = telling.select("class", "score", "mine").toPandas()
                self.score[rows["class"].to_numpy(np.int64)] = rows["score"].to_numpy(np.float32)
                drift += float((rows["score"] * rows["mine"]).sum()) / ((1 + PRIOR) * row["all_other"])
        self.score -= np.float32(max(DRIFT, DRIFT + drift) / 2)
        self.lambda_, self.k = 1.0, 1.0

    def calibrate(self, tokens: float, segments: float, total: float) -> None:
        """From the tokens, the number and the summed scores of chance segments, and one more of score 1."""
        self.lambda_ = (segments + 1) / (total + 1)
        self.k = (segments + 1) / max(tokens, 1.0)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """Begin, end and score of all maximal scoring segments, in linear time.

    A scan keeps candidates with the running totals before and after them.  A new
    positive token joins the last candidate with a smaller total before it if that
    one's total after is smaller too, together with all between.  Negative tokens
    only move the total, so just the positive ones are visited.
    """
    after = np.cumsum(scores)
    found: list[tuple[int, int, float, float]] = []
    links: list[int] = []  # the last candidate with a smaller total before it
    for at in np.flatnonzero(scores > 0).tolist():
        right = float(after[at])
        begin, left = at, right - float(scores[at])
        end = at + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = links[j]
            if j < 0 or found[j][3] >= right:
                break
            begin, left = found[j][0], found[j][2]
            del found[j:], links[j:]
        found.append((begin, end, left, right))
        links.append(j)
    return [(b, e, r - l) for b, e, l, r in found]


def segments(texts: DataFrame, model: Model) -> DataFrame:
    """doc_id, text_hash, n_tokens and all maximal segments (begin and end in bytes of the text)."""
    shipped = texts.sparkSession.sparkContext.broadcast(model.score)

    def scan(part):
        score = shipped.value
        words, stems, starts, ends, first, at = token_classes(part.column("text"))
        values = score[words].astype(np.float64) + score[stems]
        positive = np.r_[0, np.cumsum(values > 0)]
        some = positive[first[1:]] - positive[first[:-1]]
        out = []
        for n, (b, e) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            found = maximal_segments(values[b:e]) if e > b and some[n] else []
            out.append(
                [
                    {"begin": int(starts[b + x] - at[n]), "end": int(ends[b + y - 1] - at[n]), "score": s}
                    for x, y, s in found
                ]
            )
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(first)), pa.array(out, kind)],
            ["doc_id", "text_hash", "n_tokens", "segments"],
        )

    return texts.mapInArrow(
        by_slices(scan),
        "doc_id long, text_hash long, n_tokens long, segments array<struct<begin: int, end: int, score: double>>",
    )


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic fit (a constant is the last column of x), by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * len(y) * w * np.r_[np.ones(len(w) - 1), 0]
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def bounded_labels(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id and label of at most ``per_class`` rows of each label, by hash of the id."""
    known = labels.filter(f"doc_id is not null and {label} in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    kinds = [known.filter(F.col(label) == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return kinds[0].union(kinds[1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    significance: float = SIGNIFICANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash (xxhash64), n_tokens, score (0 to 1) and passages of each row.

    ``labels`` has doc_id and toxic (0 or 1), of the rows to learn from.
    """
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    # At most twice per_class rows of two numbers.
    sample = written(bounded_labels(labels, "toxic", per_class), "labels")
    counts = token_counts(texts.join(F.broadcast(sample), "doc_id", "left"))
    model = Model(written(counts, "counts"))
    found = written(segments(texts, model), "segments")

    # Chance segments: those of labelled texts that are not toxic.
    known = found.join(F.broadcast(sample), "doc_id")
    scores = F.aggregate("segments", F.lit(0.0), lambda a, x: a + x["score"])
    chance = known.filter("toxic = 0").agg(F.sum("n_tokens"), F.sum(F.size("segments")), F.sum(scores))
    model.calibrate(*(float(x or 0) for x in chance.first()))

    expected = F.lit(model.k) * F.col("n_tokens")
    with_expected = F.transform(
        "segments",
        lambda s: F.struct(
            s["begin"].alias("begin"),
            s["end"].alias("end"),
            s["score"].alias("score"),
            (expected * F.exp(-F.lit(model.lambda_) * s["score"])).alias("expected"),
        ),
    )
    evidence = found.withColumn("rated", with_expected)
    against = F.transform("rated", lambda s: F.greatest(-F.log(F.greatest(s["expected"], F.lit(1e-280))), F.lit(0.0)))
    evidence = evidence.withColumn("against", against)
    best = F.coalesce(F.array_max("against"), F.lit(0.0))
    total = F.aggregate("against", F.lit(0.0), lambda a, b: a + b)
    evidence = evidence.withColumn("log_best", F.log1p(best)).withColumn("log_total", F.log1p(total))
    passages = F.filter("rated", lambda s: s["expected"] <= significance).cast(_SEGMENTS)
    rows = evidence.join(F.broadcast(sample), "doc_id").select("log_best", "log_total", "toxic").toPandas()
    if rows["toxic"].nunique() == 2:
        x = np.c_[rows[["log_best", "log_total"]].to_numpy(float), np.ones(len(rows))]
        w = _logistic(x, rows["toxic"].to_numpy(float))
        z = F.col("log_best") * float(w[0]) + F.col("log_total") * float(w[1]) + float(w[2])
        score = 1 / (1 + F.exp(-z))
    else:
        score = F.lit(0.0)
    return evidence.select("doc_id", "text_hash", "n_tokens", score.alias("score"), passages.alias("passages"))


def fold(id_: str, of: int):
    return F.crc32(F.col(id_).cast("string")) % of


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; a third of the labels is held out."""
    labels = read(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1)
    scored = score_toxicity(read(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id",
        (fold("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "passages",
    )
