"""Whitening of embeddings: principal components by Chebyshev-filtered subspace iteration.

The covariance V of the distinct vectors is never formed. A pass over the stored vectors
multiplies it with a narrow block Q: every task adds up Xᵀ(XQ) over its centred vectors, and the
parts are summed in Spark by slices of rows, so the driver gets one matrix of the block's size
however many tasks there are. A round applies the Chebyshev polynomial of V that is small on the
unwanted part of the spectrum, by its three-term recurrence, one pass a degree; then QR and a
Rayleigh-Ritz step give Ritz pairs, and the residuals of the wanted ones certify the result.

The unwanted part reaches from a lower bound of the spectrum, by a few Lanczos steps that share
their passes with the first power steps of the block, to the least Ritz value of the block,
which is twice as wide as there are components.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import arrow_batches, same_names, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
SLICE_ROWS = 8          # rows of a product that one task adds up
LANCZOS_STEPS = 8       # passes that bound the spectrum from below
MOST_DEGREE = 12        # of the polynomial of a round
MOST_SPREAD = 1e6       # by which a round may magnify the first component over the last wanted
MOST_ROUNDS = 500
CERTIFIED = 1e-14       # residual that is enough, relative to the largest eigenvalue
SETTLED = 1e-10         # residual from which a round without progress ends the iteration
FLAT = 1e-12            # eigenvalues up to this share of the largest count as zero


def _pack(rows: np.ndarray) -> list[bytes]:
    """Vectors of long in the narrowest whole numbers that hold them, after a byte with their
    width: equal vectors are equal bytes."""
    most = np.maximum(rows.max(axis=1), -(rows.min(axis=1) + 1))
    width = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    out = [b""] * len(rows)
    for w in np.unique(width).tolist():
        for i in np.flatnonzero(width == w).tolist():
            out[i] = bytes([w]) + rows[i].astype(f"<i{w}").tobytes()
    return out


def _unpack(column: pa.Array, dims: int) -> np.ndarray:
    """Packed vectors as rows of long."""
    out = np.empty((len(column), dims), np.int64)
    length = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for n in np.unique(length).tolist():
        at = np.flatnonzero(length == n)
        data = b"".join(column.take(pa.array(at)).to_pylist())
        raw = np.frombuffer(data, np.uint8).reshape(len(at), n)[:, 1:]
        out[at] = np.ascontiguousarray(raw).view(f"<i{(n - 1) // dims}")
    return out


def _whole(batches):
    """(id, dims, packed vector) of the rows whose vector is whole."""
    for batch in batches:
        vectors = batch.column(1)
        size = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(vectors).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
        good = (size > 0) & (bad[ends] == bad[ends - size])
        kept, packed = np.flatnonzero(good), [b""] * int(good.sum())
        for d in np.unique(size[kept]).tolist():
            mine = np.flatnonzero(size[kept] == d)
            at = (ends - size)[kept[mine]][:, None] + np.arange(d)
            scaled = np.floor(flat[at] * SCALE)
            if np.abs(scaled).max() >= 2.0**62:
                raise ValueError("an entry of a vector does not fit a long")
            for i, data in zip(mine.tolist(), _pack(scaled.astype(np.int64))):
                packed[i] = data
        yield pa.RecordBatch.from_pydict({
            "id": batch.column(0).take(pa.array(kept)), "dims": pa.array(size[kept], pa.int32()),
            "x": pa.array(packed, pa.binary())})


@dataclass(frozen=True)
class Fit:
    """The distinct vectors, stored in blocks (data), with exact counts and sums. ``low`` is the
    floor of the mean and ``rest`` the fraction above it, so x - low - rest is x - S/n without
    the rounding of numbers near SHIFT."""

    blocks: DataFrame
    n: int
    low: np.ndarray
    over: list[int]

    @property
    def dims(self) -> int:
        return len(self.low)

    @property
    def rest(self) -> np.ndarray:
        return np.array([o / self.n for o in self.over])

    def added(self, product: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``product`` over the centred vectors of each block, a matrix of bounded
        size. Parts are added in the order of tasks, so that a pass that runs again is equal."""
        dims, low, rest = self.dims, self.low, self.rest

        def run(batches):
            total, part = 0.0, TaskContext.get().partitionId()
            for batch in batches:
                for data in batch.column("data"):
                    total = total + product((_block(data.as_py(), dims) - low) - rest)
            if np.ndim(total):
                cuts = range(0, len(total), SLICE_ROWS)
                yield pa.RecordBatch.from_pydict({
                    "slice": pa.array(list(cuts), pa.int64()), "part": pa.array([part] * len(cuts), pa.int64()),
                    "wide": pa.array([total.shape[1]] * len(cuts), pa.int64()),
                    "data": pa.array([total[a:a + SLICE_ROWS].tobytes() for a in cuts], pa.binary())})

        def add(key, table):
            rows = sorted(table.to_pylist(), key=lambda r: r["part"])
            total = np.sum([np.frombuffer(r["data"]) for r in rows], axis=0)
            return pa.table({"slice": [key[0].as_py()], "wide": [rows[0]["wide"]], "data": [total.tobytes()]})

        parts = self.blocks.mapInArrow(run, "slice long, part long, wide long, data binary")
        found = parts.groupBy("slice").applyInArrow(add, "slice long, wide long, data binary").collect()
        return np.concatenate([np.frombuffer(r["data"]).reshape(-1, r["wide"])
                               for r in sorted(found, key=lambda r: r["slice"])])

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times a block of vectors."""
        return self.added(lambda y: y.T @ (y @ q)) / self.n


def _block(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(-1, dims).astype(np.int64)


def fit_list(packed: DataFrame) -> Fit | None:
    """The distinct vectors of (id, dims, x), stored; None if there are none."""
    dims = [r[0] for r in packed.groupBy("dims").agg(F.lit(1)).limit(2).collect()]
    if not dims:
        return None
    if len(dims) > 1:
        raise ValueError("vectors have different numbers of entries")
    d = dims[0]

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                rows = _unpack(batch.column("x"), d)
                w = max(p[0] for p in _pack(np.stack([rows.max(axis=0), rows.min(axis=0)])))
                yield pa.RecordBatch.from_pydict({
                    "data": pa.array([bytes([w]) + rows.astype(f"<i{w}").tobytes()], pa.binary())})

    def add(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            for data in batch.column("data"):
                x = _block(data.as_py(), d)
                n, high, low = n + len(x), high + (x >> 24).sum(axis=0), low + (x & 0xFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "dim": pa.array(np.arange(d)), "n": pa.array([n] * d, pa.int64()), "high": pa.array(high), "low": pa.array(low)})

    blocks = stored(packed.select("x").distinct().mapInArrow(pack, "data binary"), "fit-list")
    sums = blocks.mapInArrow(add, "dim long, n long, high long, low long")
    rows = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    n, total = rows[0]["n"], {r["dim"]: (r["high"] << 24) + r["low"] for r in rows}
    cut = [divmod(total[i], n) for i in range(d)]
    return Fit(blocks, n, np.array([c for c, _ in cut], np.int64), [r for _, r in cut])


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, their eigenvalues, falling, the trace of the covariance,
    and the largest residual |Vv - ev| over the largest eigenvalue."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float


def _ritz(q: np.ndarray, vq: np.ndarray):
    """Ritz values, falling, with the rotated block and its product."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _start(fit: Fit, wide: int) -> tuple[np.ndarray, float]:
    """A block after some power steps, and a lower bound of the spectrum by Lanczos steps in
    the same passes."""
    rng = np.random.default_rng(11)
    block = np.linalg.qr(rng.standard_normal((fit.dims, wide)))[0]
    basis, diagonal, off = [np.ones(fit.dims) / np.sqrt(fit.dims) + rng.standard_normal(fit.dims)], [], []
    basis[0] /= np.linalg.norm(basis[0])
    for _ in range(LANCZOS_STEPS):
        product = fit.times(np.column_stack([block, basis[-1]]))
        block = np.linalg.qr(product[:, :-1])[0]
        if len(diagonal) == len(basis):
            continue
        r = product[:, -1]
        diagonal.append(float(basis[-1] @ r))
        for _ in range(2):
            r = r - np.column_stack(basis) @ (np.column_stack(basis).T @ r)
        off.append(float(np.linalg.norm(r)))
        if off[-1] > 1e-12 * max(diagonal) and len(basis) < fit.dims:
            basis.append(r / off[-1])
    t = np.diag(diagonal) + np.diag(off[:len(diagonal) - 1], 1) + np.diag(off[:len(diagonal) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return block, max(0.0, float(values[0] - abs(off[-1] * vectors[-1, 0])))


def _growth(x: float) -> float:
    """How much a degree of the Chebyshev polynomials magnifies a place beyond [-1, 1]."""
    x = max(1.0, x)
    return x + np.sqrt(x * x - 1)


def _filtered(fit: Fit, q: np.ndarray, vq: np.ndarray, values: np.ndarray, low: float, wanted: int) -> np.ndarray:
    """The block after a Chebyshev polynomial that stays within 1 on [low, least Ritz value]."""
    high = values[-1]
    if high - low <= FLAT * values[0]:
        return vq                                 # nothing is left to damp: a power step
    centre, half = (high + low) / 2, (high - low) / 2
    spread = _growth((values[0] - centre) / half) / _growth((values[wanted - 1] - centre) / half)
    degree = int(np.clip(np.log(MOST_SPREAD) / np.log(max(spread, 1.0001)), 2, MOST_DEGREE))
    before, now = q, (vq - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (fit.times(now) - centre * now) / half - before
    return now


def principal(fit: Fit, components: int = COMPONENTS) -> Components:
    """The leading eigenpairs of the covariance of the fit list, certified by their residuals.

    As many as asked for, or fewer if the covariance has a lower rank (eigenvalues up to FLAT
    of the largest count as zero). Signs: the largest entry of a vector is positive. Of equal
    eigenvalues any orthonormal vectors are given. The driver holds a few matrices of
    dimensions x 2 components.
    """
    trace = float(fit.added(lambda y: (y * y).sum(axis=0)[:, None]).sum()) / fit.n
    if not trace > 0:
        return Components(np.zeros((fit.dims, 0)), np.zeros(0), 0.0, 0.0)
    wide = min(fit.dims, 2 * components)
    block, low = (np.eye(fit.dims), 0.0) if wide == fit.dims else _start(fit, wide)
    last = np.inf
    for _ in range(MOST_ROUNDS):
        values, q, vq = _ritz(block, fit.times(block))
        wanted = int((values[:components] > FLAT * values[0]).sum())
        off = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / values[0]
        if off <= CERTIFIED or (off <= SETTLED and off > last / 2):
            break
        last = off
        block = np.linalg.qr(_filtered(fit, q, vq, values, low, wanted))[0]
    else:
        raise RuntimeError(f"the components are not certified: residual {off:.1e} of the largest eigenvalue")
    vectors = q[:, :wanted]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return Components(vectors * sign, values[:wanted], trace, float(off))


def identity_error(fit: Fit, found: Components) -> float:
    """The largest entry of |covariance of the whitened fit list - identity|."""
    k = len(found.values)
    if not k:
        return 0.0
    turn = found.vectors / np.sqrt(found.values)

    def product(y):
        w = y @ turn
        return np.column_stack([w.T @ w, w.sum(axis=0)])

    sums = fit.added(product) / fit.n
    return float(np.abs(sums[:, :k] - np.outer(sums[:, k], sums[:, k]) - np.eye(k)).max())


def _deviation(away: np.ndarray, n: int, over: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 per row; None beyond a long."""
    most = int(np.abs(away).max(initial=0)) + 1
    if (n * most) ** 2 * away.shape[1] < 1 << 63:
        z = away * n - np.array(over, np.int64)
        return (z * z).sum(axis=1).tolist()
    exact = [sum((n * v - o) ** 2 for v, o in zip(row, over)) for row in away.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, column: str = "embedding", key: str = "vec_id",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector: key, n (distinct vectors), deviation, whitened (array, one number per
    component), explained (array), identity_error.

    Rows go whose vector is null, has no entries, or holds null or non-finite ones. An entry c
    becomes floor(64 c) + 1,000,000; equal vectors count once in the fit. The result has at most
    ``components`` numbers per row, fewer if the fit list has a lower rank, none if all vectors
    are equal. ``deviation`` is exact, and null where it does not fit a long (from some 10**8
    distinct vectors on, at entries within 1).

    Repeated rows and rows with null keys come out once each; other columns are left out; an
    empty table gives none. Vectors of different lengths, and entries of which 64 c does not fit
    a long, are an error. A vector in a third of all rows is one row per task before the shuffle
    of the distinct vectors.
    """
    spark = vectors.sparkSession
    arrow_batches(spark)
    kind = dict(vectors.dtypes)[key]
    named = same_names(vectors, (key, column))
    rows = named.select(F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").cast("array<double>").alias("v"))
    packed = stored(rows.mapInArrow(_whole, f"id {kind}, dims int, x binary"), "vectors")
    out = (f"id {kind}, n long, deviation long, whitened array<double>, explained array<double>,"
           " identity_error double")
    fit = fit_list(packed)
    if fit is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", key)
    found = principal(fit, components)
    error = identity_error(fit, found)
    n, low, over, rest, dims = fit.n, fit.low, fit.over, fit.rest, fit.dims
    k = len(found.values)
    turn = found.vectors / np.sqrt(found.values)
    explained = (found.values / found.trace if k else found.values).tolist()

    def project(batches):
        for batch in batches:
            m = batch.num_rows
            away = _unpack(batch.column("x"), dims) - low
            flat = (away - rest) @ turn
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "n": pa.array([n] * m, pa.int64()),
                "deviation": pa.array(_deviation(away, n, over), pa.int64()),
                "whitened": pa.array(list(flat), pa.list_(pa.float64())),
                "explained": pa.array([explained] * m, pa.list_(pa.float64())),
                "identity_error": pa.array([error] * m, pa.float64())})

    return packed.select("id", "x").mapInArrow(project, out).withColumnRenamed("id", key)


def digest(result: DataFrame, key: str = "vec_id") -> DataFrame:
    """A row per vector and component, numbered from 1."""
    rows = result.select(f"`{key}`", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("_at", "whitened"))
    return rows.select(
        f"`{key}`", (F.col("_at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("_at")).alias("explained"), "identity_error")
