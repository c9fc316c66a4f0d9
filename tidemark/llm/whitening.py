"""Embedding whitening by a distributed covariance and its own eigensolver.

Every entry c becomes the integer x = floor(64 * c) + 1000000. The cluster
counts the rows and sums every dimension exactly, then sums the products of
centred rows, (n * x - S) / n, one small matrix per task and added up per row of
the matrix. The driver holds that d x d matrix alone, whatever the
number of rows: it is brought to tridiagonal form by Householder reflections, the
leading eigenvalues are bracketed by Sturm counts and bisection, their vectors
come from inverse iteration, made orthogonal anew within clusters of close
eigenvalues, and the reflections turn them back. The projection (d x k)
is broadcast and every row is projected where it lies.

The components are computed once, so all rows (and reruns of lost tasks) use the
same signs.

Vectors that are null or empty, or that hold null or non-finite entries, take no
part. All others belong to the fit list; they must have one length
(``ValueError`` otherwise: vectors of two lengths have no covariance). Entries
beyond 2**40 in size count as 2**40. Repeated rows count as often as they occur; a null
vec_id stays null. Components of zero variance (at most ``FLOOR`` of
the trace) can't be scaled to one and are left out, so one row, or equal rows only,
give no rows; nor does an empty table. A deviation beyond 64 bits is null. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE, SHIFT, MOST = 64, 1_000_000, 32
#: Least share of the trace of a component, and rows centred at once.
FLOOR, ROWS = 1e-14, 4096
_LIMIT = float(2**40)


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False))


def _whole(v: pa.Array, dim: int) -> np.ndarray:
    """Rows of whole numbers x."""
    c = v.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(np.clip(SCALE * c, -_LIMIT, _LIMIT)).astype(np.int64) + SHIFT
    return x.reshape(-1, dim)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n and S (in two halves, each exact in 64 bits) of each vector length."""
    held: dict[int, list] = {}
    for b in batches:
        lengths = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(lengths):
            v = b.column("v").filter(pa.array(lengths == dim))
            x = _whole(v, int(dim))
            high, low = (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)
            old = held.setdefault(int(dim), [0, 0, 0])
            held[int(dim)] = [old[0] + len(x), old[1] + high, old[2] + low]
    for dim, (n, high, low) in held.items():
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(np.arange(dim), pa.int32()),
            "n": pa.array([n] * dim, pa.int64()), "high": pa.array(high, pa.int64()),
            "low": pa.array(low, pa.int64())})


def _parts(n: int, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (total // n).astype(np.int64), (total % n).astype(np.int64)


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """(n * x - S) / n: the difference is exact, in integers without their
    common part n * floor(S / n)."""
    base, rest = _parts(n, total)
    return (x - base) - rest / n


def _products(n: int, total: np.ndarray, project: np.ndarray | None, mean: np.ndarray | None):
    """The summed products of centred rows (projected first if asked): one row of
    the matrix each, for rows (at, products)."""
    dim = len(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                y = _centred(_whole(b.column("v").slice(i, ROWS), dim), n, total)
                if project is not None:
                    y = y @ project - mean
                out = y.T @ y + (0 if out is None else out)
        if out is not None:
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(np.arange(len(out)), pa.int32()),
                "products": pa.array(list(out), pa.list_(pa.float64()))})
    return run


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """Adds up the matrices of all tasks: size x size numbers come back."""
    cells = (rows.select("at", F.posexplode("products").alias("j", "p")).groupBy("at", "j").agg(F.sum("p").alias("p"))
             .toArrow())
    out = np.zeros((size, size))
    out[cells.column("at").to_numpy(), cells.column("j").to_numpy()] = cells.column("p").to_numpy()
    return (out + out.T) / 2


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Householder reflections that bring a symmetric matrix to tridiagonal
    form: its diagonal, the entries beside it, and the reflections (unit vectors,
    None where a column was done already)."""
    a = a.copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0 or np.linalg.norm(x[1:]) == 0:
            reflections.append(None)
            continue
        v = x.copy()
        v[0] += norm if x[0] >= 0 else -norm
        v /= np.linalg.norm(v)
        part = a[k + 1:, k + 1:]
        p = part @ v
        w = 2 * (p - (v @ p) * v)
        part -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -norm if x[0] >= 0 else norm
        a[k + 2:, k] = a[k, k + 2:] = 0
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie under each
    number of ``at``, the negative pivots of its shifted factorisation."""
    tiny = np.finfo(float).eps ** 2 * np.abs(e).max(initial=0) + np.finfo(float).tiny
    q = d[0] - at
    count = (q < 0).astype(int)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - at - e[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bit."""
    n = len(d)
    reach = np.abs(np.append(e, 0)) + np.abs(np.insert(e, 0, 0))
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    pad = np.finfo(float).eps * n * max(np.abs(low).max(), np.abs(high).max()) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    want = n - np.arange(k)  # the j-th largest has n - 1 - j below it
    while True:
        mid = (low + high) / 2
        if ((mid <= low) | (mid >= high)).all():
            return mid
        under = below(d, e, mid) >= want
        high, low = np.where(under, mid, high), np.where(under, low, mid)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges."""
    n = len(d)
    scale = np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max(initial=0), np.finfo(float).tiny)
    main, up, up2, x = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        low = e[i]
        if abs(low) > abs(main[i]):
            f = main[i] / low
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = (
                low, main[i + 1], up[i + 1], up[i] - f * main[i + 1], -f * up[i + 1])
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
        else:
            if main[i] == 0:
                main[i] = scale
            f = low / main[i]
            main[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
    if abs(main[-1]) < scale:
        main[-1] = scale
    for i in range(n - 1, -1, -1):
        if abs(main[i]) < scale:
            main[i] = scale
        x[i] -= (up[i] * x[i + 1] if i + 1 < n else 0) + (up2[i] * x[i + 2] if i + 2 < n else 0)
        x[i] /= main[i]
        if abs(x[i]) > 1e150:  # near-singular on purpose: only the direction counts
            x /= abs(x[i])
    return x


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, cluster: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration. Eigenvalues within
    ``cluster`` of the largest of each other form a cluster, whose vectors are made
    orthogonal to those before them after every step."""
    n, out = len(d), []
    top = max(np.abs(values).max(), np.finfo(float).tiny)
    rng = np.random.default_rng(12)
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > cluster * top:
            first = j
        # equal eigenvalues get shifts of their own
        shift = value - np.finfo(float).eps * top * (j - first)
        x = rng.standard_normal(n)
        for _ in range(5):
            x = _solve(d, e, shift, x / np.linalg.norm(x))
            x /= np.linalg.norm(x)
            for _ in (0, 1):
                for y in out[first:]:
                    x -= (x @ y) * y
            x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out).T


def leading(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix and their unit
    vectors (columns)."""
    top = np.abs(v).max(initial=0)
    if top == 0:
        return np.zeros(min(most, len(v))), np.eye(len(v))[:, :most]
    scale = 2.0 ** np.ceil(np.log2(top))  # exact, and far from the ends of a double's range
    d, e, reflections = tridiagonal(v / scale)
    values = leading_values(d, e, min(most, len(v)))
    vectors = leading_vectors(d, e, values)
    for k in range(len(reflections) - 1, -1, -1):
        if reflections[k] is not None:
            r = reflections[k]
            vectors[k + 1:] -= 2 * np.outer(r, r @ vectors[k + 1:])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


def _whiten(n: int, total: np.ndarray, project: np.ndarray):
    dim, most = len(total), 2**63 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rest = _parts(n, total)
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                x = _whole(b.column("v").slice(i, ROWS), dim)
                y = _centred(x, n, total)
                size = (y ** 2).sum(axis=1) * float(n) ** 2
                if n * float(np.abs(x - base).max(initial=0) + 1) < 2.0**62 and size.max(initial=0) < 2.0**62:
                    deviation = ((n * (x - base) - rest) ** 2).sum(axis=1).tolist()
                else:
                    exact = [sum((n * int(p) - int(r)) ** 2 for p, r in zip(row, rest)) for row in x - base]
                    deviation = [s if s <= most else None for s in exact]
                yield pa.RecordBatch.from_pydict({
                    "vec_id": b.column("vec_id").slice(i, ROWS),
                    "deviation": pa.array(deviation, pa.int64()),
                    "white": pa.array(list(y @ project), pa.list_(pa.float64()))})
    return run


class Fit:
    """What the rows give: n, S, eigenvalues, projection, explained shares."""

    def __init__(self, n: int, total: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.total, self.values, self.vectors = n, total, values, vectors
        self.project = vectors / np.sqrt(values)
        self.explained = values / trace if trace else values


def _rows(vectors: DataFrame) -> DataFrame:
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("embedding").cast("array<double>").alias("v")).filter(_usable(F.col("v"))))


def fit(vectors: DataFrame, most: int = MOST) -> Fit | None:
    """The leading components of all usable vectors; None without any."""
    rows = _rows(vectors)
    sums = (rows.select("v").mapInArrow(_sums, "dim int, at int, n long, high long, low long")
            .groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
            .orderBy("dim", "at").collect())  # one row per dimension
    if not sums:
        return None
    if len({r["dim"] for r in sums}) > 1:
        raise ValueError(f"vectors of several lengths: {sorted({r['dim'] for r in sums})}")
    n = sums[0]["n"]
    exact = [(r["high"] << 20) + r["low"] for r in sums]
    total = np.array(exact, np.int64 if max(map(abs, exact)) < 2**62 else object)
    v = _summed(rows.select("v").mapInArrow(_products(n, total, None, None), "at int, products array<double>"),
                len(total)) / n
    trace = float(np.trace(v))
    values, found = leading(v, most)
    keep = values > FLOOR * trace
    return Fit(n, total, values[keep], found[:, keep], trace)


def identity_error(vectors: DataFrame, f: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the
    identity, measured on all rows. Their mean is zero up to rounding, which a
    centred x gives by construction."""
    k = f.project.shape[1]
    if not k:
        return 0.0
    p = _products(f.n, f.total, f.project, np.zeros(k))
    c = _summed(_rows(vectors).select("v").mapInArrow(p, "at int, products array<double>"), k) / f.n
    return float(np.abs(c - np.eye(k)).max())


def whiten(vectors: DataFrame, most: int = MOST) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error:
    for every usable vector one row per component, from 1."""
    f = fit(vectors, most)
    if f is None:
        f = Fit(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0)
    error = identity_error(vectors, f) if f.n else 0.0
    rows = _rows(vectors).mapInArrow(_whiten(f.n, f.total, f.project), "vec_id long, deviation long, white array<double>")
    shares = F.array(*[F.lit(float(s)) for s in f.explained]).cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(int(f.n)).cast("long").alias("n"), "deviation",
                    "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
