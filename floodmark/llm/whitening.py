"""Whitening of embeddings by the singular values of their centred rows.

Entries become whole numbers, x = floor(64 * c) + 1000000, so sums and deviations are
exact.  Every task folds its rows, block by block, into one triangular factor R: a
block is centred by its own mean, and two blocks meet by a QR decomposition of their
factors and of the difference of their means, weighted as a sum of squares asks for.
Factors of tasks are merged in groups, level by level.  The last R, of the size of
the dimension, is made bidiagonal by Householder reflections; dqds (differential
quotient-difference steps with shifts) finds the squared singular values of the
bidiagonal matrix, each to nearly full precision, and a twisted factorisation at each
of them gives its vector.  Vectors of values that lie close together are made
orthogonal, and turned by rotations until their images are orthogonal too.

The rows are read again to be projected on the directions and divided by the roots of
the eigenvalues, once to measure the covariance of the result, once to return it.

A vector that is null, holds null or non-finite entries or entries of 2^56 or more
(whose x would pass 64 bits) takes no part, and neither does one without entries or of
another length than most (of equally frequent lengths the longest counts).  Repeated
rows and rows without id are rows like others.  A component whose eigenvalue cannot be
told from zero in double precision is not returned: nothing varies along it.  So
constant vectors, a single row and an empty table give no rows.  ``deviation`` is null
where it passes 64 bits; ``deviation_exact`` holds it as text then, and is null
otherwise.  Extra columns are not read.

The driver sees a matrix of dimension squared and a mean, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.common import read, written

SCALE = 64.0
COMPONENTS = 32
ENTRY_BOUND = 2.0**56
# Rows of a block in QR, and of a batch of results.
BLOCK_ROWS, OUT_ROWS = 4096, 1024
# Partial results that one task merges.
FAN_IN = 64

_EPS = np.finfo(float).eps
# Eigenvalues closer than this, relatively, share a cluster.
_CLUSTER = 1e-3
# What vectors of a block may be short of being orthogonal.
_SOUND = 1e-11

PARTIAL = "node long, n string, sums array<string>, factor binary"
WHITENED = """vec_id long, component int, n long, deviation long, deviation_exact string,
    whitened double, explained double, identity_error double"""


# Small matrices


def qr_factor(rows: np.ndarray) -> np.ndarray:
    """The square triangular factor of a matrix, filled up with zeros."""
    factor = np.linalg.qr(rows, mode="r")
    square = np.zeros((rows.shape[1], rows.shape[1]))
    square[: len(factor)] = factor
    return square


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right vectors V of a square matrix: U B V^T."""
    a = matrix.copy()
    n = len(a)
    v = np.eye(n)

    def reflector(x):
        length = np.linalg.norm(x)
        if length == 0 or not x[1:].any():
            return None
        u = x / length
        u[0] += np.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k].copy())
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 2:
            u = reflector(a[k, k + 1 :].copy())
            if u is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _dqds_step(q: list[float], e: list[float], shift: float):
    """One differential qd step with a shift; None where the shift was too large."""
    new_q, new_e = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - shift
    for i in range(len(e)):
        if not d > 0:
            return None
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
    if not d >= 0:
        return None
    new_q[-1] = d
    return new_q, new_e


def _lower_bound(q: list[float], e: list[float]) -> float:
    """One over the trace of the inverse, which a step without shift shows."""
    d = q[0]
    inverse = 1 / d if d > 0 else np.inf
    for i in range(len(e)):
        d = d * (q[i + 1] / (d + e[i])) if d > 0 else 0.0
        inverse += 1 / d if d > 1e-300 else np.inf
    return 1 / inverse


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an unreduced upper bidiagonal matrix, ascending.

    Every shift is a lower bound of the least eigenvalue left (Newton's step from
    below), so a step breaks down by rounding only; then the shift is halved.
    """
    q, e = list(map(float, diagonal**2)), list(map(float, above**2))
    found, total, low = [], 0.0, 0.0  # the sum of shifts, and what rounding left of it
    while len(q) > 1:
        shift = _lower_bound(q, e) * (1 - 4 * len(q) * _EPS)
        made = _dqds_step(q, e, shift)
        while made is None:
            shift = shift / 2 if shift > 1e-300 else 0.0
            made = _dqds_step(q, e, shift)
        q, e = made
        bigger = total + shift
        low += shift - (bigger - total)
        total = bigger
        while e and e[-1] <= 0.01 * _EPS * (total + q[-1]):
            found.append(total + (low + q.pop()))
            e.pop()
        gone = [i for i, x in enumerate(e) if x <= 0.01 * _EPS * _EPS * min(q[i], q[i + 1])]
        if gone:
            # The matrix falls into parts, which go on by themselves.
            begin = 0
            for i in [*gone, len(q) - 1]:
                found += [total + (low + x) for x in _rest(q[begin : i + 1], e[begin:i])]
                begin = i + 1
            return np.sort(np.array(found))
    return np.sort(np.array(found + [total + (low + x) for x in q]))


def _rest(q: list[float], e: list[float]) -> np.ndarray:
    return dqds(np.sqrt(np.array(q)), np.sqrt(np.array(e)))


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """The vector of an eigenvalue of B^T B, and the value corrected by it.

    B^T B - value is factored from the top and from the bottom (stationary and
    progressive qd steps); the factors meet where the pivot is least, and the vector
    follows from there by multiplications alone.
    """
    n = len(a)
    if n == 1:
        return np.ones(1), float(a[0] ** 2)
    d, l = (a * a).tolist(), (b / a[:-1]).tolist()
    tiny = _EPS * _EPS * max(d)
    z = np.ones(n)
    for _ in range(3):
        plus, s = [0.0] * (n - 1), [0.0] * n
        s[0] = -value
        for i in range(n - 1):
            pivot = s[i] + d[i]
            pivot = pivot if abs(pivot) > tiny else -tiny
            plus[i] = d[i] * l[i] / pivot
            s[i + 1] = plus[i] * l[i] * s[i] - value
        minus, p = [0.0] * (n - 1), [0.0] * n
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            pivot = d[i] * l[i] * l[i] + p[i + 1]
            pivot = pivot if abs(pivot) > tiny else -tiny
            ratio = d[i] / pivot
            minus[i] = l[i] * ratio
            p[i] = p[i + 1] * ratio - value
        gamma = [s[i] + p[i] + value for i in range(n)]
        gamma[-1] = s[-1] + d[-1]
        at = min(range(n), key=lambda i: abs(gamma[i]))
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -plus[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -minus[i] * z[i]
        length = float(z @ z)
        change = gamma[at] / length
        z /= np.sqrt(length)
        # dqds is right to a few units in the last place, so a large change is no correction.
        if not 4 * _EPS < abs(change / value) < _CLUSTER**2:
            break
        value += change
    return z, value


def _image(a: np.ndarray, b: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    out = a[:, None] * vectors
    out[:-1] += b[:, None] * vectors[1:]
    return out


def _orthonormal(vectors: np.ndarray) -> np.ndarray:
    """The same span, orthonormal; a vector that adds nothing is replaced by one that does."""
    random = np.random.default_rng(5)
    done = np.zeros((len(vectors), 0))
    for z in vectors.T:
        for _ in range(20):
            for _ in range(2):
                z = z - done @ (done.T @ z)
            length = np.linalg.norm(z)
            if length > 0.01:
                break
            z = z + 0.1 * random.standard_normal(len(z))
            z = z / np.linalg.norm(z)
        z = z - done @ (done.T @ z)
        done = np.c_[done, z / np.linalg.norm(z)]
    return done


def _rotated(a: np.ndarray, b: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors turned in their span until their images under B are orthogonal (Jacobi)."""
    vectors, image = vectors.copy(), _image(a, b, vectors)
    size = vectors.shape[1]
    for _ in range(60):
        still = True
        for i in range(size - 1):
            for j in range(i + 1, size):
                x, y = image[:, i], image[:, j]
                alpha, beta, gamma = x @ x, y @ y, x @ y
                if abs(gamma) <= 4 * _EPS * np.sqrt(alpha * beta):
                    continue
                still = False
                zeta = (beta - alpha) / (2 * gamma)
                t = np.copysign(1.0, zeta) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                turn = np.array([[c, c * t], [-c * t, c]])
                image[:, [i, j]] = image[:, [i, j]] @ turn
                vectors[:, [i, j]] = vectors[:, [i, j]] @ turn
        if still:
            break
    return vectors, (image * image).sum(axis=0)


def _block_vectors(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of B^T B, ascending, and their vectors, of one unreduced block."""
    values = dqds(a, b)
    vectors = np.empty((len(a), len(a)))
    for k, value in enumerate(values):
        vectors[:, k], values[k] = twisted_vector(a, b, value)
    order = np.argsort(values)
    values, vectors = values[order], vectors[:, order]
    close = np.diff(values) <= _CLUSTER * values[1:]
    begin = 0
    for end in [*(np.flatnonzero(~close) + 1), len(values)]:
        if end - begin > 1:
            basis = _orthonormal(vectors[:, begin:end])
            vectors[:, begin:end], values[begin:end] = _rotated(a, b, basis)
        begin = end
    apart = np.abs(vectors.T @ vectors - np.eye(len(a))).max()
    image = _image(a, b, vectors)
    slant = np.abs(image.T @ image - np.diag(values)).max()
    if not (apart < _SOUND and slant < _SOUND * values[-1]):
        # Values too close for single vectors: all of the block is turned, from where it stands.
        vectors, values = _rotated(a, b, _orthonormal(np.nan_to_num(vectors)))
        order = np.argsort(values)
        values, vectors = values[order], vectors[:, order]
    return values, vectors


def eigen_of_factor(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of R^T R, falling, and unit vectors, without those not told from zero."""
    n = len(factor)
    largest = np.abs(factor).max(initial=0.0)
    if largest == 0:
        return np.zeros(0), np.zeros((n, 0))
    # A power of two, so that nothing is rounded and squares stay in range.
    scale = 2.0 ** np.floor(np.log2(largest))
    a, b, v = bidiagonalise(factor / scale)
    norm = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    least = n * _EPS * norm
    # A diagonal of zero would part the matrix; raised, it still counts as zero below.
    a = np.where(np.abs(a) < least / n, np.copysign(least / n, a), a)
    b = np.where(np.abs(b) <= 2 * _EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])), 0.0, b)
    values, vectors = [], []
    begin = 0
    for end in [*(np.flatnonzero(b == 0) + 1), n]:
        part_values, part = _block_vectors(a[begin:end], b[begin : end - 1])
        whole = np.zeros((n, end - begin))
        whole[begin:end] = part
        values.append(part_values)
        vectors.append(whole)
        begin = end
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > (10 * least) ** 2]
    return values[order] * scale**2, v @ vectors[:, order]


# Sums over all rows


@dataclass
class Moments:
    """Number of rows, their exact sums, and R with R^T R the centred sum of squares."""

    n: int
    sums: list[int]
    factor: np.ndarray

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        # The difference of the means, from whole numbers, rounded once.
        apart = [
            (s * other.n - t * self.n) / (self.n * other.n) for s, t in zip(self.sums, other.sums)
        ]
        weight = np.sqrt(self.n / n * other.n)
        rows = np.vstack([self.factor, other.factor, weight * np.array(apart)])
        return Moments(n, [s + t for s, t in zip(self.sums, other.sums)], qr_factor(rows))


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    """floor(64 c), without the constant that centring takes away again."""
    return np.floor(SCALE * entries).astype(np.int64)


def _within(rows: int, largest: int) -> bool:
    """Whether sums of so many such numbers stay within 62 bits."""
    return rows * largest < 2**62


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit numbers where they suffice, else Python's."""
    largest = int(np.abs(x).max(initial=0))
    if _within(2 * n, max(largest, 1)) and all(abs(s) < 2**62 for s in sums):
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def block_moments(x: np.ndarray) -> Moments:
    """Moments of some rows of whole numbers."""
    n = len(x)
    wide = x if _within(n, int(np.abs(x).max(initial=0))) else x.astype(object)
    sums = [int(s) for s in wide.sum(axis=0)]
    rows = centred(x, n, sums)
    return Moments(n, sums, qr_factor((rows / n).astype(float)))


def float_moments(rows: np.ndarray) -> Moments:
    """The same of doubles; their means ride along as sums of scaled whole numbers."""
    # 2^-40 is far below what the covariance of unit variances is asked for.
    x = np.rint(rows * 2.0**40)
    sums = [int(s) for s in x.astype(np.int64).sum(axis=0)] if _within(len(x), int(np.abs(x).max(initial=0))) else [
        sum(int(v) for v in column) for column in x.T
    ]
    mean = np.array([s / len(x) for s in sums])
    return Moments(len(x), sums, qr_factor(x - mean))


def _packed(moments: Moments, node: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([node], pa.int64()),
            pa.array([str(moments.n)]),
            pa.array([[str(s) for s in moments.sums]], pa.list_(pa.string())),
            pa.array([moments.factor.tobytes()], pa.binary()),
        ],
        ["node", "n", "sums", "factor"],
    )


def _unpacked(batches) -> Iterator[Moments]:
    for batch in batches:
        for n, sums, factor in zip(*(batch.column(c).to_pylist() for c in ("n", "sums", "factor"))):
            size = len(sums)
            yield Moments(int(n), [int(s) for s in sums], np.frombuffer(factor).reshape(size, size))


def _all_merged(parts: Iterator[Moments]) -> Moments | None:
    merged = None
    for part in parts:
        merged = part if merged is None else merged.merged(part)
    return merged


def moments_of(rows: DataFrame, blocks: Callable) -> Moments | None:
    """Moments of all rows: one partial result a task, merged FAN_IN at a time until one is left.

    ``blocks`` makes moments from the batches of a task.
    """

    def partial(batches):
        merged = _all_merged(blocks(batches))
        if merged is not None:
            yield _packed(merged, 0)

    def merge(batches):
        merged = _all_merged(_unpacked(batches))
        if merged is not None:
            yield _packed(merged, 0)

    level = written(rows.mapInArrow(partial, PARTIAL), "moments")
    left = level.count()
    while left > 1:
        groups = -(-left // FAN_IN)
        level = written(level.repartition(groups).mapInArrow(merge, PARTIAL), "moments")
        left = level.count()
    return _all_merged(_unpacked(level.toArrow().to_batches()))


# The operator


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and entries of the vectors that take part, whatever their lengths."""

    def fits(entry: Column) -> Column:
        # Comparisons with null and NaN are made out here: NaN counts as larger than all.
        return F.coalesce(F.abs(entry) < ENTRY_BOUND, F.lit(False))

    entries = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), entries.alias("entries"))
    return rows.filter(F.col("entries").isNotNull() & F.forall("entries", fits) & (F.size("entries") > 0))


def _matrix(entries: pa.Array) -> np.ndarray:
    values = entries.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(entries), -1) if len(entries) else np.zeros((0, 0))


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(begin, BLOCK_ROWS)


@dataclass(frozen=True)
class Whitener:
    """Directions of the components, and what centres and scales the rows."""

    n: int
    sums: list[int]
    directions: np.ndarray  # dimension x components, divided by the roots of e
    explained: np.ndarray

    def rows(self, entries: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Exact deviations times n of some vectors, and their whitened values."""
        exact = centred(whole_numbers(_matrix(entries)), self.n, self.sums)
        return exact, (exact / self.n).astype(float) @ self.directions

    def deviations(self, exact: np.ndarray) -> list[int]:
        largest = int(np.abs(exact).max(initial=0))
        if largest < 2**31 and largest * largest * exact.shape[1] < 2**63:
            return (exact * exact).sum(axis=1).tolist()
        return [sum(int(v) ** 2 for v in row) for row in exact]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of usable vectors of one length; none where nothing varies."""

    def blocks(batches):
        for part in _slices(batches):
            if part.num_rows:
                yield block_moments(whole_numbers(_matrix(part.column("entries"))))

    moments = moments_of(vectors, blocks)
    if moments is None:
        return None
    values, directions = eigen_of_factor(moments.factor)
    if not len(values):
        return None
    values, directions = values / moments.n, directions[:, :components]
    trace = (moments.factor**2).sum() / moments.n
    chosen = values[:components]
    return Whitener(moments.n, moments.sums, directions / np.sqrt(chosen), chosen / trace)


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """The largest entry, without sign, of the whitened rows' covariance less the identity."""

    def blocks(batches):
        for part in _slices(batches):
            if part.num_rows:
                yield float_moments(whitener.rows(part.column("entries"))[1])

    moments = moments_of(vectors, blocks)
    factor = moments.factor * 2.0**-40
    covariance = factor.T @ factor / moments.n
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per vector and component: see the module and WHITENED."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    length = F.size("entries")
    most = rows.groupBy(length.alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    whitener = None
    if most is not None:
        rows = rows.filter(length == most["length"])
        whitener = fit(rows, components)
    if whitener is None:
        return spark.createDataFrame([], WHITENED)
    error = identity_error(rows, whitener)
    width = len(whitener.explained)

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(begin, OUT_ROWS)
                exact, values = whitener.rows(part.column("entries"))
                deviations = whitener.deviations(exact)
                count = part.num_rows
                at = pa.array(np.repeat(np.arange(count), width))
                fits = [d if d < 2**63 else None for d in deviations]
                text = [None if d < 2**63 else str(d) for d in deviations]
                total = count * width
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(at),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                        pa.array(np.full(total, whitener.n)),
                        pa.array(fits, pa.int64()).take(at),
                        pa.array(text, pa.string()).take(at),
                        pa.array(values.ravel()),
                        pa.array(np.tile(whitener.explained, count)),
                        pa.array(np.full(total, error)),
                    ],
                    [field.split()[0] for field in WHITENED.split(",")],
                )

    return rows.mapInArrow(run, WHITENED)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 32 strongest components, each of unit variance."""
    return whiten(read(spark, sf_dir, "embeddings"))
