"""Embedding whitening by Jacobi-Davidson.

The covariance is never formed: Spark multiplies it with a few vectors at a time, one pass over the distinct vectors for
all of them. On the driver there are only matrices of one row per dimension and a few dozen columns: the search subspace,
its Rayleigh-Ritz problem, the locked components and the MINRES recurrences of the projected correction equations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.session import write_shared

#: Components returned; further Ritz vectors followed so that no larger eigenvalue is overlooked.
COMPONENTS, GUARD = 4, 1
#: Entries become floor(SCALE * c).
SCALE = 256
#: Residuals count as double precision below this many roundings of the largest eigenvalue, per root of the dimensions.
ROUNDINGS = 4
#: A residual below STALLED of the largest eigenvalue that STILL rounds do not halve is as small as sums allow.
STALLED, STILL = 1e-9, 8
#: Most entries of a block of vectors that a task holds unpacked.
BLOCK = 1 << 21
#: Limbs of exact sums: each is summed as a long.
LIMB, LIMBS = 30, 6
WIDTHS = {1: "<i1", 2: "<i2", 4: "<i4", 8: "<i8"}


def blocks_of(vectors: pa.ListArray, most: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the usable rows, their long vectors filled up with zeros), in blocks of bounded size."""
    sizes = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
    ends = np.cumsum(sizes)
    null = vectors.is_null().to_numpy(zero_copy_only=False)
    first, rows = 0, len(sizes)
    while first < rows:
        last, widest = first, 0
        while last < rows and (last == first or (last + 1 - first) * max(widest, sizes[last]) <= most):
            widest = max(widest, int(sizes[last]))
            last += 1
        dense = np.zeros((last - first, widest))
        begin = ends[first] - sizes[first]
        dense[np.arange(widest) < sizes[first:last, None]] = flat[begin : ends[last - 1]]
        with np.errstate(all="ignore"):
            scaled = np.floor(SCALE * dense)
            usable = (np.isfinite(dense) & (np.abs(scaled) < 2.0**63)).all(axis=1) & ~null[first:last]
        yield first + np.flatnonzero(usable), scaled[usable].astype(np.int64)
        first = last


def packed(vectors: np.ndarray) -> list[bytes]:
    """Each row as its entry width and its entries in that width, zeros at the end left out: equal rows, equal bytes."""
    if not vectors.shape[1]:
        return [b"\x01"] * len(vectors)
    low, high = vectors.min(axis=1), vectors.max(axis=1)
    width = np.full(len(vectors), 8)
    for w, kind in ((4, np.int32), (2, np.int16), (1, np.int8)):
        width[(low >= np.iinfo(kind).min) & (high <= np.iinfo(kind).max)] = w
    used = vectors.shape[1] - np.argmax(vectors[:, ::-1] != 0, axis=1)
    used[~vectors.any(axis=1)] = 0
    made: list[bytes] = [b""] * len(vectors)
    for w, kind in WIDTHS.items():
        rows = np.flatnonzero(width == w)
        raw, step = vectors[rows].astype(kind).tobytes(), vectors.shape[1] * w
        for at, (row, n) in enumerate(zip(rows, used[rows])):
            made[row] = bytes([w]) + raw[at * step : at * step + n * w]
    return made


def unpacked(rows: list[bytes], dimensions: int | None = None) -> Iterator[np.ndarray]:
    """Blocks of long vectors, of ``dimensions`` entries or as many as the longest of a block needs."""
    alike: dict[tuple[int, int], list[bytes]] = {}
    for row in rows:
        alike.setdefault((row[0], len(row)), []).append(row)
    for (width, size), members in alike.items():
        entries = (size - 1) // width
        step = max(1, BLOCK // max(entries, dimensions or 1, 1))
        for first in range(0, len(members), step):
            some = members[first : first + step]
            raw = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), size)[:, 1:]
            found = np.ascontiguousarray(raw).view(WIDTHS[width]).astype(np.int64) if entries else np.zeros((len(some), 0), np.int64)
            if dimensions is not None and entries < dimensions:
                found = np.pad(found, ((0, 0), (0, dimensions - entries)))
            yield found


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Stored: ``x``, each distinct long vector of column ``vector`` once, packed to a byte or two per entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in blocks_of(batch.column("vector")):
                yield pa.RecordBatch.from_arrays([pa.array(packed(found), pa.binary())], names=["x"])

    return write_shared(vectors.select("vector").mapInArrow(run, "x binary").distinct())


def _limbs(value: int) -> list[int]:
    parts = []
    for _ in range(LIMBS - 1):
        value, low = value >> LIMB, value & ((1 << LIMB) - 1)
        parts.append(low)
    return [*parts, value]


def exact_sums(fit: DataFrame) -> tuple[int, list[int], int]:
    """Number of vectors, sum of each dimension, sum of all squares: exact at any size."""
    names = [f"l{i}" for i in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, squares = 0, 0
        sums: list[int] = []
        for batch in batches:
            for found in unpacked(batch.column("x").to_pylist()):
                count += len(found)
                sums += [0] * (found.shape[1] - len(sums))
                largest = int(max(found.max(initial=0), -int(found.min(initial=0))))
                small = largest * largest * max(found.size, 1) < 1 << 62
                exact = found if small else found.astype(object)
                squares += int((exact * exact).sum())
                for i, s in enumerate(exact.sum(axis=0)):
                    sums[i] += int(s)
        rows = [(-2, count), (-1, squares), *enumerate(sums)]
        columns = [pa.array([i for i, _ in rows], pa.int32())]
        columns += [pa.array(part, pa.int64()) for part in zip(*(_limbs(v) for _, v in rows))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", *names])

    found = fit.mapInArrow(run, "i int, " + ", ".join(f"{n} bigint" for n in names)).groupBy("i").agg(*[F.sum(n).alias(n) for n in names])
    total = {r["i"]: sum(r[n] << (LIMB * k) for k, n in enumerate(names)) for r in found.collect()}  # one row per dimension
    sums = [total.get(i, 0) for i in range(max(total, default=-1) + 1)]
    return total.get(-2, 0), sums, total.get(-1, 0)


def centred_product(fit: DataFrame, n: int, mean: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Covariance times a few columns: one pass over ``fit``, centred before multiplying."""
    dimensions = len(mean)

    def product(columns: np.ndarray) -> np.ndarray:
        names = [f"z{j}" for j in range(columns.shape[1])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(columns.shape, np.longdouble)
            for batch in batches:
                for found in unpacked(batch.column("x").to_pylist(), dimensions):
                    centred = found - mean
                    total += centred.T @ (centred @ columns)
            parts = [pa.array(np.arange(dimensions), pa.int32()), *(pa.array(z, pa.float64()) for z in total.astype(float).T)]
            yield pa.RecordBatch.from_arrays(parts, names=["i", *names])

        summed = fit.mapInArrow(run, "i int, " + ", ".join(f"{z} double" for z in names)).groupBy("i").agg(*[F.sum(z).alias(z) for z in names])
        made = np.zeros(columns.shape)
        for row in summed.collect():  # one row per dimension
            made[row["i"]] = row[1:]
        return made / n

    return product


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, least: float) -> np.ndarray:
    """One MINRES recurrence per column of ``right``, all stepping in the same products, until each fell below ``least``."""
    with np.errstate(all="ignore"):
        size = np.linalg.norm(right, axis=0)
        live = size > 0
        v, v_old = np.where(live, right / size, 0), np.zeros_like(right)
        x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
        eta, beta = size.copy(), np.zeros_like(size)
        c, c_old, s, s_old = np.ones_like(size), np.ones_like(size), np.zeros_like(size), np.zeros_like(size)
        for _ in range(steps):
            if not live.any():
                break
            p = apply(v)
            alpha = (v * p).sum(axis=0)
            p = p - alpha * v - beta * v_old
            after = np.linalg.norm(p, axis=0)
            delta = c * alpha - c_old * s * beta
            rho = np.hypot(delta, after)
            live = live & (rho > 0)
            w_new = (v - s_old * beta * w_old - (s * alpha + c_old * c * beta) * w) / rho
            c_old, c, s_old, s = c, delta / rho, s, after / rho
            x = np.where(live, x + c * eta * w_new, x)
            eta = -s * eta
            w_old, w = w, w_new
            v_old, v, beta = v, np.where(after > 0, p / after, 0), after
            live = live & (np.abs(eta) > least * size) & (after > 0)
    return x


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``new`` adds to the (orthonormal) columns of ``against``."""
    base = np.hstack(against)
    kept = np.zeros((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - base @ (base.T @ column) - kept @ (kept.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            kept = np.column_stack([kept, column])
    return kept


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dimensions: int, wanted: int = COMPONENTS, inner: int = 3, most: int = 64, rounds: int = 300
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric, positive semi-definite matrix, unit eigenvectors, residual norms.

    Each round solves the Rayleigh-Ritz problem in the search subspace, locks leading Ritz vectors whose residual is down
    to double precision, and expands the subspace by the corrections of the others, for each of which MINRES solves the
    equation projected on the complement of locked and present vectors. The subspace is cut back to the best Ritz vectors
    when it holds ``most``. A round that can add nothing (the subspace is the whole space) multiplies again and accepts
    what rounding leaves; so does a residual that is small and no longer falls, as sums over very many parts round more.
    What was reached is in the norms returned.
    """
    wanted = min(wanted, dimensions)
    rng = np.random.default_rng(20)
    locked, values, errors = np.zeros((dimensions, 0)), [], []
    basis = _orthonormal(rng.standard_normal((dimensions, min(wanted + GUARD, dimensions))), locked)
    images, top, least, still = product(basis), 0.0, np.inf, 0
    for number in range(rounds):
        small = basis.T @ images
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        rest = images - basis * theta
        rest = rest - locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        top = max(top, float(theta[0]) if len(theta) else 0.0, *values)
        enough = ROUNDINGS * np.finfo(float).eps * np.sqrt(dimensions) * top
        ready = 0
        while ready < len(theta) and len(values) + ready < wanted and norms[ready] <= enough:
            ready += 1
        least, still = (norms[0], 0) if ready or norms[0] < least / 2 else (least, still + 1)
        if not ready and still >= STILL and len(values) < wanted and norms[0] <= STALLED * top:
            ready, still = 1, 0
        if ready:
            least = np.inf
        locked, values, errors = np.hstack([locked, basis[:, :ready]]), values + list(theta[:ready]), errors + list(norms[:ready])
        basis, images, theta, rest, norms = basis[:, ready:], images[:, ready:], theta[ready:], rest[:, ready:], norms[ready:]
        missing = wanted - len(values)
        # the guard: what follows the components must be seen to be smaller than they are
        if not missing and (not len(theta) or norms[0] <= max(min(values) - theta[0], enough)):
            break
        active = min(missing + GUARD, basis.shape[1])
        if basis.shape[1] + active > most:
            keep = max(most // 2, active)
            basis, images, theta, rest = basis[:, :keep], images[:, :keep], theta[:keep], rest[:, :keep]
        fixed = np.hstack([locked, basis[:, :active]])
        clear = lambda m: m - fixed @ (fixed.T @ m)
        shift = theta[:active]
        step = minres(lambda m: clear(product(clear(m)) - clear(m) * shift), clear(-rest[:, :active]), inner, max(2.0 ** -(number + 1), 1e-3))
        new = _orthonormal(clear(step), locked, basis)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((dimensions, max(active, 1))), locked, basis)
        if new.shape[1]:
            basis, images = np.hstack([basis, new]), np.hstack([images, product(new)])
        else:  # nothing left to add: the subspace is exact up to rounding
            images = product(basis)
            theta = (basis * images).sum(axis=0)
            norms = np.linalg.norm(images - basis * theta - locked @ (locked.T @ images), axis=0)
            locked, values, errors = np.hstack([locked, basis[:, :missing]]), values + list(theta[:missing]), errors + list(norms[:missing])
            break
    else:
        raise ArithmeticError(f"{len(values)} of {wanted} components after {rounds} rounds")
    order = np.argsort(values)[::-1]
    return np.array(values)[order], locked[:, order], np.array(errors)[order]


def whitened_covariance(fit: DataFrame, n: int, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Covariance of the vectors of ``fit`` on ``axes``, in one pass."""
    width = axes.shape[1]
    names = [f"z{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width), np.longdouble)
        for batch in batches:
            for found in unpacked(batch.column("x").to_pylist(), len(mean)):
                on = (found - mean) @ axes
                total[:width] += on.T @ on
                total[width] += on.sum(axis=0)
        parts = [pa.array(np.arange(width + 1), pa.int32()), *(pa.array(z, pa.float64()) for z in total.astype(float).T)]
        yield pa.RecordBatch.from_arrays(parts, names=["i", *names])

    summed = fit.mapInArrow(run, "i int, " + ", ".join(f"{z} double" for z in names)).groupBy("i").agg(*[F.sum(z).alias(z) for z in names])
    made = np.zeros((width + 1, width))
    for row in summed.collect():
        made[row["i"]] = row[1:]
    made /= n
    return made[:width] - np.outer(made[width], made[width])


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> dict:
    """What :func:`whiten` needs, from column ``vector`` (array of double) of ``vectors``.

    n (distinct long vectors), sums (exact, per dimension), mean, values, axes (components over the roots of their
    eigenvalues), explained, residuals (relative to the largest eigenvalue), identity_error. Components whose eigenvalue is zero up to rounding have no whitened form
    and are left out: a table of one distinct vector has none.
    """
    fit = distinct_vectors(vectors)
    n, sums, squares = exact_sums(fit)
    mean = np.array([float(Fraction(s, n)) for s in sums]) if n else np.zeros(0)
    made = {"n": n, "sums": sums, "mean": mean, "values": np.zeros(0), "axes": np.zeros((len(sums), 0)), "explained": [], "residuals": [], "identity_error": 0.0}
    trace = Fraction(n * squares - sum(s * s for s in sums), n * n) if n else Fraction(0)
    if trace <= 0:
        return made
    values, axes, residuals = jacobi_davidson(centred_product(fit, n, mean), len(sums), components)
    real = values > len(sums) * np.finfo(float).eps * values[0]
    values, axes, residuals = values[real], axes[:, real], residuals[real]
    axes = axes / np.sqrt(values)
    error = float(np.abs(whitened_covariance(fit, n, mean, axes) - np.eye(len(values))).max())
    return made | {
        "values": values, "axes": axes, "explained": [float(Fraction(float(e)) / trace) for e in values], "residuals": [float(r / values[0]) for r in residuals],
        "identity_error": error,
    }


def whiten(table: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """id, n, deviation, whitened (array, one entry per component), explained, residual (arrays), identity_error per usable row.

    Rows whose vector is null or holds a null, a NaN, an infinity or an entry beyond a long are left out; all others stay,
    repeated rows and null ids included. Vectors shorter than the longest are filled up with zeros, the empty one too.
    ``deviation`` is null where it does not fit in a long. An empty table, or one without a usable row, gives no row; a
    table without any variance gives empty arrays. Other columns are not read.

    The distinct vectors are shuffled once, packed; every product is one narrow pass over them. The answer is a narrow
    pass over the table.
    """
    given = table.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    fitted = fit_whitening(given, components)
    n, sums, mean, axes = fitted["n"], fitted["sums"], fitted["mean"], fitted["axes"]
    longest = max(map(abs, sums), default=0)

    def deviations(found: np.ndarray) -> list[int | None]:
        reach = n * int(max(found.max(initial=0), -int(found.min(initial=0)))) + longest
        if len(sums) * reach * reach < 1 << 63:
            apart = n * found - np.array(sums, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        total = [sum((n * int(x) - s) ** 2 for x, s in zip(row, sums)) for row in found.tolist()]
        return [t if t < 1 << 63 else None for t in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, found in blocks_of(batch.column("vector")):
                if not len(rows):
                    continue
                found = np.pad(found, ((0, 0), (0, max(0, len(sums) - found.shape[1]))))[:, : len(sums)]
                on = (found - mean) @ axes
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * on.shape[1], pa.int32()), pa.array(on.ravel(), pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows)), pa.array(deviations(found), pa.int64()), lists], names=["id", "deviation", "whitened"]
                )

    id_type = given.schema["id"].dataType.simpleString()
    made = given.mapInArrow(run, f"id {id_type}, deviation bigint, whitened array<double>")
    constant = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<double>")
    return made.select(
        "id", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened", constant(fitted["explained"]).alias("explained"),
        constant(fitted["residuals"]).alias("residual"), F.lit(fitted["identity_error"]).alias("identity_error"),
    )


def op12_whitening(embeddings: DataFrame) -> DataFrame:
    """One row per usable vector and component (see :func:`whiten`)."""
    found = whiten(embeddings).select("id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained", "residual")).alias("at", "c"))
    return found.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error", F.col("c.residual").alias("residual"),
    )
