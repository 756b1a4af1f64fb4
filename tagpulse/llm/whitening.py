"""Whitening of vectors onto the leading components of their covariance."""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000  # an entry c is taken as floor(SCALE·c) + SHIFT
EXACT = 1 << 53  # whole numbers up to here are exact as doubles
SLICE = 4096  # vectors at a time
EPS = np.finfo(float).eps


# ---- symmetric matrices: inertia, isolation, Rayleigh quotients


def inertia_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are below `shift`: the negative ones of D in LDLᵀ of the shifted matrix.

    The factorisation pivots on single entries and on pairs of them (Bunch and Kaufman), so no pivot is unduly small.
    """
    a = matrix - shift * np.eye(len(matrix))
    least = EPS * max(float(np.abs(matrix).max(initial=0.0)), abs(shift), np.finfo(float).tiny)
    alpha = (1 + 17**0.5) / 8  # fixed value: the bound that holds growth least

    def swap(i, j):
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    negative, k, n = 0, 0, len(a)
    while k < n:
        pair = False
        if k + 1 < n:
            r = k + 1 + int(np.abs(a[k + 1:, k]).argmax())
            off = abs(a[r, k])
            if abs(a[k, k]) < alpha * off:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(a[k, k]) * widest < alpha * off**2:
                    if abs(a[r, r]) >= alpha * widest:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        pair = True
        if pair:
            block = a[k: k + 2, k: k + 2]
            low = a[k + 2:, k: k + 2]
            negative += 1 if block[0, 0] * block[1, 1] - block[0, 1] ** 2 < 0 else 2 * int(block[0, 0] < 0)
            a[k + 2:, k + 2:] -= low @ np.linalg.solve(block, low.T)
            k += 2
        else:
            pivot = a[k, k]
            if abs(pivot) < least:  # the shift is an eigenvalue as far as doubles tell
                pivot = -least
            negative += pivot < 0
            low = a[k + 1:, k]
            a[k + 1:, k + 1:] -= np.outer(low, low / pivot)
            k += 1
    return int(negative)


def isolate(matrix: np.ndarray, k: int) -> list[tuple[float, float, int, int]]:
    """Intervals (low, high, first, last) that hold the k largest eigenvalues, falling: `first` to `last` numbered from 1 are
    those in [low, high), by inertia counts at both ends. An interval has more than one only if doubles can't part them."""
    n = len(matrix)
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    low, high = float((np.diag(matrix) - radius).min()), float((np.diag(matrix) + radius).max())
    scale = max(abs(low), abs(high))
    narrow = 8 * EPS * scale
    low, high = low - narrow, high + narrow
    found, waiting = [], [(low, high, n, 0)]  # above(low) = n eigenvalues are at least low, none is at least high
    while waiting:
        low, high, above_low, above_high = waiting.pop()
        if above_high >= k or above_low == above_high:
            continue
        middle = (low + high) / 2
        if above_low - above_high == 1 or high - low <= narrow or not low < middle < high:
            found.append((low, high, above_high + 1, above_low))
            continue
        above = n - inertia_below(matrix, middle)
        above = min(max(above, above_high), above_low)
        waiting += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return sorted(found, key=lambda f: f[2])


def _apart(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
    return vector / np.sqrt(vector @ vector)


def _solved(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    step = EPS * max(float(np.abs(matrix).max()), abs(shift))
    for moved in (shift, shift + step, shift + 8 * step):  # a shift that is an eigenvalue to the last digit is moved
        try:
            found = np.linalg.solve(matrix - moved * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        found = found / np.abs(found).max()
        if np.isfinite(found).all():
            return found
    return vector


def rayleigh(matrix: np.ndarray, fine: np.ndarray, low: float, high: float, number: int, others: list[np.ndarray]):
    """Eigenvalue `number` (from 1, falling), which lies in [low, high), and its unit vector, orthogonal to `others`.

    Each step solves with the Rayleigh quotient as the shift, which converges cubically. It ends with an eigenvalue of another number
    only if one is near an end of the interval; inertia counts tell, and then halve the interval. The last steps take their residual
    from `fine`, the matrix in extended precision. Raises ArithmeticError if no count certifies the number.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).max())
    slack, margin = 16 * EPS * scale, 16 * n * EPS * scale

    def above(shift):
        return n - inertia_below(matrix, shift)

    for attempt in range(80):
        shift = (low + high) / 2
        vector = _apart(np.random.default_rng(attempt).standard_normal(n), others)
        for _ in range(20):
            vector = _apart(_solved(matrix, shift, vector), others)
            shift = float(vector @ matrix @ vector)
            residual = matrix @ vector - shift * vector
            small = np.sqrt(residual @ residual) <= slack * n**0.5
            if small or not low - margin <= shift <= high + margin:
                break
        if small and above(shift + margin) < number <= above(shift - margin):
            return _refined(matrix, fine, vector, others)
        if high - low > slack:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
    raise ArithmeticError(f"inertia counts don't put eigenvalue {number} at {shift}")


def _refined(matrix, fine, vector, others):
    """Newton's steps for an eigenvalue and its vector, by which the system is bordered; one of several eigenvalues that doubles
    can't part has no vector of its own and stays."""
    vector = vector.astype(np.longdouble)
    value = vector @ fine @ vector
    for _ in range(0 if others else 3):
        residual = fine @ vector - value * vector
        border = vector.astype(float)[:, None]
        system = np.block([[matrix - float(value) * np.eye(len(matrix)), border], [border.T, np.zeros((1, 1))]])
        try:
            step = np.linalg.solve(system, np.append(-residual.astype(float), 0.0))[:-1]
        except np.linalg.LinAlgError:
            break
        if not step @ step < 1e-12:
            break
        vector = vector + step
        vector = vector / np.sqrt(vector @ vector)
        value = vector @ fine @ vector
    return value, vector


def leading_pairs(fine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit vectors (as rows) of a symmetric matrix in extended precision; fewer where
    the others are zero as far as doubles tell."""
    trace = np.trace(fine)
    n = len(fine)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    if trace > 0:
        unit = (fine / trace).astype(float)
        for low, high, first, last in isolate(unit, k):
            same: list[np.ndarray] = []  # vectors of eigenvalues that doubles can't part are any orthonormal ones
            for number in range(first, min(last, k) + 1):
                value, vector = rayleigh(unit, fine / trace, low, high, number, same)
                if value <= 4 * n * EPS:
                    break
                # vectors of near eigenvalues are orthogonal only as far as these are apart
                near = [v for v, e in zip(vectors, values) if e - float(value) < 1e-3 * values[0]]
                vector = _apart(vector.astype(float), near)
                same.append(vector)
                values.append(float(value))
                vectors.append(vector)
    return np.array(values) * float(trace), np.array(vectors).reshape(len(values), n)


# ---- vectors, exact sums


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the batch, x as int64) of the vectors of each length that are not NULL and have only finite entries,
    small enough for a whole number of 64 bits."""
    column = batch.column(0)
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    for width in np.unique(sizes[sizes >= 0]):
        places = np.flatnonzero(sizes == width)
        for begin in range(0, len(places), SLICE):
            some = places[begin: begin + SLICE]
            flat = column.take(pa.array(some)).flatten()
            entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(some), width)  # NULL: NaN
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(entries * SCALE)
                good = (np.abs(scaled) < 1 << 62).all(axis=1)
            yield int(width), some[good], scaled[good].astype(np.int64) + SHIFT


def _gram(rows: np.ndarray) -> np.ndarray:
    """Sums of products of whole numbers, exact, as Python integers; doubles wherever these are exact."""
    widest = int(np.abs(rows).max(initial=0))
    if widest**2 * len(rows) < EXACT:
        wide = rows.astype(float)
        return (wide.T @ wide).astype(np.int64).astype(object)
    if widest**2 * len(rows) < 1 << 63:
        return (rows.T @ rows).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def _summed(parts: DataFrame) -> dict:
    """Exact sums of parts by (width, place); as many rows as a matrix has entries."""
    rows = parts.groupBy("width", "place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r.width, r.place): int(r.high) * LIMB + int(r.low) for r in rows}


def _parts(width: int, values) -> pa.RecordBatch:
    halves = [divmod(int(v), LIMB) for v in values]
    return pa.RecordBatch.from_pydict({
        "width": pa.array([width] * len(halves), pa.int32()), "place": pa.array(range(len(halves)), pa.int32()),
        "high": pa.array([Decimal(h) for h, _ in halves], pa.decimal128(38, 0)),
        "low": pa.array([Decimal(w) for _, w in halves], pa.decimal128(38, 0))})


LIMB = 10**28
PARTS = "width int, place int, high decimal(38,0), low decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """Fitted on n vectors x: their sums per dimension, the covariance's trace, and its leading pairs (vectors as rows)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = float("nan")

    def _centre(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        middle = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = np.array([(s - self.n * m) / self.n for s, m in zip(self.sums, middle)])
        return np.array(middle, np.int64), rest, self.vectors.T / np.sqrt(self.values)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Rows of whitened components: near whole numbers are subtracted first, so nothing is rounded away."""
        middle, rest, onto = self._centre()
        return ((x - middle) - rest) @ onto

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n·x - S)², exact."""
        middle = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        rest = [s - self.n * int(m) for s, m in zip(self.sums, middle)]
        near = x - middle
        widest = int(np.abs(near).max(initial=0))
        bound = max((abs(r) for r in rest), default=0)
        size = max(len(middle), 1)
        # (n·y - r)² is n²·y² - 2·n·y·r + r², y and r being small
        if widest**2 * size < 1 << 63 and widest * bound * size < 1 << 63:
            squares, crossed = (near * near).sum(axis=1), near @ np.array(rest, np.int64)
        else:
            wide = near.astype(object)
            squares, crossed = (wide * wide).sum(axis=1), wide @ np.array(rest, object)
        own = sum(r * r for r in rest)
        return [self.n**2 * int(s) - 2 * self.n * int(c) + own for s, c in zip(squares, crossed)]


def fit(rows: DataFrame, vector: str = "embedding", components: int = 32) -> Whitening:
    """Fits on all usable vectors of `rows`. Three passes over the column, none of which moves a vector: sums, products of the
    centred whole numbers, and the covariance of the whitened values. Only sums come to the driver: d + d² + components² numbers
    for d dimensions, however many rows there are. All sums but the last are exact, so the fit doesn't depend on how rows are
    dealt to tasks.

    The leading eigenvalues are isolated by inertia counts, found by Rayleigh quotient iteration, and their numbers are
    certified by counts (`leading_pairs`). Vectors of the most frequent length take part (of equally frequent ones the longest); others,
    NULLs and those with an entry that is NULL, not finite or beyond 2^56 don't. Without rows, or if all are equal, there are no components.
    """
    only = rows.select(F.col(vector).alias("v"))

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _usable(batch):
                here = np.append((x - SHIFT).astype(object if len(x) and np.abs(x).max(initial=0) >= 1 << 49 else np.int64).sum(axis=0), len(x))
                total[width] = total.get(width, 0) + here.astype(object)
        for width, values in total.items():
            yield _parts(width, values)

    found = _summed(only.mapInArrow(sums, PARTS))
    counts = {width: n for (width, place), n in found.items() if place == width and n}
    if not counts:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    width = max(counts, key=lambda w: (counts[w], w))
    n = counts[width]
    total = [found[width, d] + n * SHIFT for d in range(width)]
    middle = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
    upper = np.triu_indices(width)

    def products(batches):
        gram = np.zeros((width, width), object)
        for batch in batches:
            for size, _, x in _usable(batch):
                if size == width:
                    gram = gram + _gram(x - middle)
        yield _parts(width, gram[upper])

    exact = _summed(only.mapInArrow(products, PARTS))
    rest = [s - n * int(m) for s, m in zip(total, middle)]
    fine = np.zeros((width, width), np.longdouble)
    with localcontext() as context:
        context.prec = 60
        for place, (i, j) in enumerate(zip(*upper)):
            value = Decimal(n * exact[width, place] - rest[i] * rest[j]) / (Decimal(n) * Decimal(n))
            high = float(value)
            fine[i, j] = fine[j, i] = np.longdouble(high) + np.longdouble(float(value - Decimal(high)))
    values, vectors = leading_pairs(fine, min(components, width))
    model = Whitening(n, total, float(np.trace(fine)), values, vectors)
    k = len(values)
    if not k:
        return model
    some = np.triu_indices(k)

    def spread(batches):
        total, gram = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for size, _, x in _usable(batch):
                if size == width:
                    z = model.projected(x)
                    total += z.sum(axis=0)
                    gram += z.T @ z
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(k + len(some[0])), pa.int32()), "part": pa.array(np.append(total, gram[some]))})

    parts = only.mapInArrow(spread, "place int, part double").groupBy("place").agg(F.sum("part").alias("part")).collect()
    sums_of = np.array([r.part for r in sorted(parts, key=lambda r: r.place)]) / n
    # the whitened values are centred already; what is left of their means is taken off
    error = np.abs(sums_of[k:] - np.outer(sums_of[:k], sums_of[:k])[some] - np.eye(k)[some]).max()
    return Whitening(n, total, model.trace, values, vectors, float(error))


def whiten(rows: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each usable vector of `rows` and component of `model`: the key, component (from 1), n, deviation (decimal: the
    sum over dimensions of (n·x - S)², exact; NULL if it has more than 38 digits), whitened, explained (the component's share of the trace) and identity_error (the
    largest entry of the whitened values' covariance minus the identity).

    One pass, no shuffle; the model is a few numbers per dimension. Vectors that took no part in the fit give no rows; a NULL
    key is kept, repeated rows come out as often, other columns are ignored. Components of a zero eigenvalue have no whitened
    value and no rows.
    """
    k = len(model.values)
    width = len(model.sums)

    def run(batches):
        for batch in batches:
            for size, places, x in _usable(batch):
                if size != width or not k or not len(x):
                    continue
                count = len(x)
                keys = batch.column(1).take(pa.array(np.repeat(places, k)))
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in model.deviations(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_pydict({
                    "key": keys,
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    "n": pa.array(np.full(count * k, model.n)),
                    "deviation": deviation.take(pa.array(np.repeat(np.arange(count), k))),
                    "whitened": pa.array(model.projected(x).ravel()),
                    "explained": pa.array(np.tile(model.values / model.trace, count)),
                    "identity_error": pa.array(np.full(count * k, model.identity_error))})

    kind = rows.schema[key].dataType.simpleString()
    schema = (f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    return rows.select(F.col(vector).alias("v"), F.col(key).alias("key")).mapInArrow(run, schema).withColumnRenamed("key", key)
