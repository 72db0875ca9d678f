"""Whitening of embeddings by spectrum slicing.

1. Tasks add up counts and coordinate sums, then products of centred coordinates, both in whole
   numbers and therefore exactly, in whatever order the tasks end. Sums of tasks are added by Spark;
   the driver gets one number per pair of dimensions.
2. The covariance, as small as dimension times dimension, is factorised as L D L^T at shifts. By
   Sylvester's law the signs in D count the eigenvalues above the shift. Bisection on the counts
   isolates each leading eigenvalue, Rayleigh quotient iteration finishes it and its vector, and
   two last counts certify that it has the number it is given.
3. One more scan projects every row. The covariance of what comes out is measured by a scan
   of its own before.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

# Fixed values.
SCALE, SHIFT = 1024, 100_000  # an entry c counts as floor(SCALE * c) + SHIFT
LARGEST = 2.0**24  # entries from here on count as non-finite
COMPONENTS = 8
FLAT = 1e-10  # an eigenvalue below this share of the trace counts as none

_EXACT = 1 << 53  # whole numbers below are exact as doubles
_LIMB = 20


def usable_vectors(vectors, vector="embedding"):
    """Rows whose vector is not null nor empty and holds finite entries only."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(sound, F.lit(False)))


def _whole(column):
    """The x-vectors of an Arrow batch's column as a matrix of longs."""
    c = np.stack(column.to_numpy()).astype(np.float64)
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _exact_products(y):
    """y^T y as whole numbers: by floating-point products that cannot round."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < _EXACT:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for at in range(0, len(y), 4096):
        rest, limbs = y[at : at + 4096], []
        while len(limbs) < 2:
            limbs.append((rest & ((1 << _LIMB) - 1)).astype(np.float64))
            rest = rest >> _LIMB
        limbs.append(rest.astype(np.float64))  # signed; the vectors' bound keeps it short
        for i, p in enumerate(limbs):
            for j, q in enumerate(limbs):
                total += (p.T @ q).astype(np.int64).astype(object) << (_LIMB * (i + j))
    return total


def _summed(vectors, vector, values, schema="i int, j int, hi bigint, lo bigint"):
    """Whole numbers per (i, j) added over all rows: `values` turns a matrix of x-vectors
    into a dict or matrix of Python numbers per batch. Numbers travel in two parts."""

    def run(frames):
        total = None
        for f in frames:
            if len(f):
                part = values(_whole(f[vector]))
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            flat = total.ravel()
            hi = [int(v) >> 40 for v in flat]
            lo = [int(v) & ((1 << 40) - 1) for v in flat]
            yield pd.DataFrame({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "hi": hi, "lo": lo})

    big = "decimal(38,0)"
    sums = vectors.select(vector).mapInPandas(run, schema).groupBy("i", "j")
    rows = sums.agg(F.sum(F.col("hi").cast(big)).alias("hi"), F.sum(F.col("lo").cast(big)).alias("lo")).collect()
    return {(r["i"], r["j"]): (int(r["hi"]) << 40) + int(r["lo"]) for r in rows}


def count_and_sums(vectors, vector="embedding"):
    """n and the exact sums of the x-vectors per dimension."""

    def values(x):
        own = [len(x)] + [int(v) for v in x.sum(axis=0)]
        return np.array([own], object)

    found = _summed(vectors, vector, values)
    if not found:
        return 0, []
    return found[0, 0], [found[0, j + 1] for j in range(len(found) - 1)]


def covariance(vectors, n, sums, vector="embedding"):
    """The x-vectors' covariance, divisor n, each entry the double nearest to its exact value.

    Products are taken around the whole number nearest to the mean; what that is off by is
    corrected in exact arithmetic."""
    d = len(sums)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    found = _summed(vectors, vector, lambda x: _exact_products(x - centre))
    off = [s - n * int(c) for s, c in zip(sums, centre)]
    return np.array([[(n * found[i, j] - off[i] * off[j]) / (n * n) for j in range(d)] for i in range(d)])


def count_above(matrix, shift):
    """How many eigenvalues of the symmetric matrix lie above `shift`: the positive signs
    of D in a symmetrically pivoted L D L^T of the shifted matrix, whose blocks are of
    one row or two. A block of two is indefinite and holds one of either sign."""
    a = np.array(matrix, np.float64)
    a[np.diag_indices(len(a))] -= shift
    alpha = (1 + 17**0.5) / 8
    above, k, n = 0, 0, len(a)

    def swap(i, j):
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        two = False
        if most > 0 and abs(a[k, k]) < alpha * most:
            r = k + 1 + int(below.argmax())
            beside = np.abs(a[k:, r])
            beside[r - k] = 0
            widest = beside.max()
            if abs(a[k, k]) * widest < alpha * most * most:
                if abs(a[r, r]) >= alpha * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:
            pivot, column = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= column @ np.linalg.solve(pivot, column.T)
            above += 1
            k += 2
        else:
            pivot, column = a[k, k], a[k + 1 :, k]
            if pivot:
                a[k + 1 :, k + 1 :] -= np.outer(column, column / pivot)
                above += pivot > 0
            k += 1
    return int(above)


def _solved(matrix, shift, v):
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        return np.linalg.solve(shifted, v)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last digit
        shifted[np.diag_indices(len(matrix))] += np.finfo(float).eps * np.abs(matrix).max()
        return np.linalg.solve(shifted, v)


def _iterated(matrix, shift, known, rng):
    """Rayleigh quotient iteration from a shift: an eigenvalue and its unit vector, orthogonal
    to the known ones. Two steps of inverse iteration come first."""

    def unit(v):
        for _ in range(2):
            for k in known:
                v = v - k * (k @ v)
        return v / np.linalg.norm(v)

    v = unit(rng.standard_normal(len(matrix)))
    for _ in range(2):
        v = unit(_solved(matrix, shift, v))
    value, left = v @ matrix @ v, np.inf
    for _ in range(20):
        w = unit(_solved(matrix, value, v))
        new = w @ matrix @ w
        residual = np.linalg.norm(matrix @ w - new * w)
        if residual >= left:  # the digits are used up
            break
        value, v, left = new, w, residual
    return value, v


def leading_components(matrix, most=COMPONENTS):
    """The largest eigenvalues of a symmetric positive semidefinite matrix, falling, and
    their orthonormal vectors as rows: at most `most`, and none below FLAT of the trace.

    Equal eigenvalues are isolated together; any orthonormal vectors of theirs will do. Raises
    ArithmeticError if the counts do not certify the numbering.
    """
    d, trace = len(matrix), float(np.trace(matrix)) if len(matrix) else 0.0
    if trace <= 0:
        return np.zeros(0), np.zeros((0, d))
    rng = np.random.default_rng(7)
    width = 1e-12 * trace
    counts = {0.0: d, trace * (1 + 1e-9) + width: 0}  # shift -> eigenvalues above it

    def counted(shift):
        if shift not in counts:
            counts[shift] = count_above(matrix, shift)
        return counts[shift]

    values, vectors = [], []
    for k in range(1, min(most, d) + 1):
        # at least k lie above low, fewer above high
        low = max(s for s, n in counts.items() if n >= k)
        high = min(s for s, n in counts.items() if n < k)
        while high > FLAT * trace:
            alone = counts[low] == k and counts[high] == k - 1
            if alone and high - low < 0.25 * high or high - low <= width:
                value, vector = _iterated(matrix, (low + high) / 2, vectors, rng)
                if low - width <= value <= high + width:
                    values.append(value)
                    vectors.append(vector)
                    break
                if high - low <= width:
                    raise ArithmeticError(f"no eigenvalue {k} found in its interval")
            middle = (low + high) / 2
            if counted(middle) >= k:
                low = middle
            else:
                high = middle
        else:
            break
    while values and values[-1] <= FLAT * trace:
        values.pop()
        vectors.pop()
    order = np.argsort(-np.array(values), kind="stable")
    values, vectors = np.array(values)[order], np.array(vectors).reshape(-1, d)[order]
    for k, value in enumerate(values, 1):
        if not (count_above(matrix, value - width) >= k > count_above(matrix, value + width)):
            raise ArithmeticError(f"the counts do not certify eigenvalue {k}")
    return values, vectors


def _most_frequent_length(vectors, vector):
    """The length that most vectors have, ties to the longer: only those can be compared."""
    sizes = vectors.groupBy(F.size(vector).alias("d")).count()
    top = sizes.orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    return top[0]["d"] if top else 0


def fit_whitening(vectors, vector="embedding", components=COMPONENTS):
    """n, the sums S, eigenvalues, components (rows) and the trace, from all of `vectors`
    (usable ones of one length)."""
    n, sums = count_and_sums(vectors, vector)
    if not n:
        return 0, [], np.zeros(0), np.zeros((0, 0)), 0.0
    matrix = covariance(vectors, n, sums, vector)
    values, parts = leading_components(matrix, components)
    return n, sums, values, parts, float(np.trace(matrix))


def _projector(n, sums, values, parts):
    """x-matrix to (n x - S as doubles, whitened); `n x - S` is exact."""
    total = np.array(sums, object)
    small = n * LARGEST * SCALE < 2.0**61  # then n x fits a long
    short = np.array(sums, np.int64) if small else None
    onto = (parts / np.sqrt(values)[:, None]).T

    def project(x):
        if small:
            far = n * x - short
        else:
            far = n * x.astype(object) - total
        return far, (far.astype(np.float64) / n) @ onto

    return project


def identity_error(vectors, fit, vector="embedding"):
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    n, sums, values, parts, _ = fit
    k = len(values)
    project = _projector(n, sums, values, parts)

    def run(frames):
        total = np.zeros((k + 1, k))
        for f in frames:
            if len(f):
                w = project(_whole(f[vector]))[1]
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    sums_of = vectors.select(vector).mapInPandas(run, "i int, j int, v double").groupBy("i", "j")
    found = {(r["i"], r["j"]): r["v"] for r in sums_of.agg(F.sum("v").alias("v")).collect()}
    cov = np.array([[found[i, j] / n - found[k, i] * found[k, j] / n / n for j in range(k)] for i in range(k)])
    return float(np.abs(cov - np.eye(k)).max())


WHITENED = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whiten(vectors, row_id="vec_id", vector="embedding", components=COMPONENTS):
    """One row per usable vector and component: `row_id`, `component` (from 1), `n`,
    `deviation`, `whitened`, `explained`, `identity_error`.

    Left out are vectors that are null, empty or hold null or non-finite entries (or such of
    LARGEST and more in size), and those of another length than most (ties: the longer), as they
    have no covariance with the rest. Rows with a null or repeated `row_id` are vectors like any
    other. Directions without variance are no components, so equal vectors, a single one or none
    give no rows. `deviation` is null where the exact number exceeds a long. Other columns are
    ignored.
    """
    sound = usable_vectors(vectors.select(F.col(row_id).cast("bigint").alias(row_id), vector), vector)
    sound = sound.filter(F.size(vector) == _most_frequent_length(sound, vector))
    fit = fit_whitening(sound, vector, components)
    n, sums, values, parts, trace = fit
    schema = f"{row_id} bigint, {WHITENED}"
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(sound, fit, vector)
    project, k = _projector(n, sums, values, parts), len(values)

    def run(frames):
        for f in frames:
            if not len(f):
                continue
            far, white = project(_whole(f[vector]))
            if float(np.abs(far.astype(np.float64)).max()) ** 2 * far.shape[1] < 2.0**62:
                deviation = pd.array((far.astype(np.int64) ** 2).sum(axis=1), dtype="Int64")
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in far]
                deviation = pd.array([v if v < 1 << 63 else None for v in exact], dtype="Int64")
            rows = len(f)
            yield pd.DataFrame(
                {
                    row_id: f[row_id].astype("Int64").repeat(k),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), rows),
                    "n": n,
                    "deviation": deviation.repeat(k),
                    "whitened": white.ravel(),
                    "explained": np.tile(values / trace, rows),
                    "identity_error": error,
                }
            )

    return sound.mapInPandas(run, schema)
