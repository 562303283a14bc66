"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers x, so counts, sums and deviations are exact.  The
fit list holds each distinct x vector once.  Its scatter matrix is never formed
while it grows: every task keeps the spectrum U diag(d) U' of the vectors it has
met, centred by the exact mean.  A vector y adds the rank-one matrix y y'; the
new eigenvalues are the roots of the secular equation 1 + sum z_i^2 / (d_i - t)
with z = U' y, after entries with negligible z_i and pairs of equal d_i are
deflated; the eigenvectors follow from z recomputed out of the roots, which
keeps U orthogonal.  Spectra of tasks are combined sixteen at a time: each
eigenpair of one is a rank-one update of the other.  At the end one distributed
pass forms the Rayleigh quotient of the fit list in the combined basis, whose
own eigenvectors rotate the basis to double precision.

Defined results.  A vector is dropped when it is NULL, empty, or holds a NULL, a
non-finite entry or one whose x does not fit 53 bits; so are vectors of another
length than most of the remaining rows have (of equally common lengths, the
longest stays).  Repeated rows, and rows whose vectors are equal as x, are all
returned, and counted once in the fit.  Components without variance (below
1e-12 of the trace) are not returned: a table with one distinct vector, and an
empty table, give no rows.  Equal eigenvalues leave their basis open.  A
deviation that does not fit a long is NULL.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import aggregated_in_tasks, blocks_for, prepare, written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LEAST = 1e-12  # share of the trace below which a component has no variance
FAN = 16  # spectra combined by a task
TASK_ROWS = 4096  # updates of a task, about a second each thousand
EPS = np.finfo(float).eps


# --- spectra ------------------------------------------------------------------------------


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots t_i of 1 + sum w_j / (d_j - t) = 0 for ascending, distinct d and w > 0.

    Root i lies between d_i and d_{i+1}, the last below d_k + sum w.  Each is
    given as the index of its nearer pole and the distance from it, so that
    differences to all d keep their precision.  Iterates a rational model of the
    two neighbouring poles; a step that leaves the bracket is a bisection.
    """
    k = len(d)
    width = np.append(np.diff(d), w.sum())
    i = np.arange(k)
    # The sign at the middle of an interval tells the nearer pole.
    middle = 1 + (w / ((d - d[:, None]) - width[:, None] / 2)).sum(1)
    low_half = middle >= 0
    low_half[-1] = True
    pole = np.where(low_half, i, np.minimum(i + 1, k - 1))
    delta = d - d[pole][:, None]
    half = width / 2
    low = np.where(low_half, 0.0, -half)
    high = np.where(low_half, half, 0.0)
    high[-1] = width[-1]
    t = (low + high) / 2
    left = np.tril(np.ones((k, k), bool))
    here = delta[i, i]
    after = np.append(delta[i[:-1], i[1:]], here[-1] + width[-1] * (1 + 1e-9))
    todo = i
    for _ in range(100):
        gap = delta[todo] - t[todo, None]
        part = w / gap
        f = 1 + part.sum(1)
        slope = part / gap
        psi = np.where(left[todo], slope, 0).sum(1)
        total = slope.sum(1)
        rising = f > 0  # beyond the root
        high[todo] = np.where(rising, t[todo], high[todo])
        low[todo] = np.where(rising, low[todo], t[todo])
        small = np.abs(f) <= 4 * EPS * (1 + np.abs(part).sum(1))
        a_gap, b_gap = here[todo] - t[todo], after[todo] - t[todo]
        c = f - a_gap * psi - b_gap * (total - psi)
        a = (a_gap + b_gap) * f - a_gap * b_gap * total
        b = a_gap * b_gap * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        new = t[todo] + step
        outside = ~((new > low[todo]) & (new < high[todo]))
        new = np.where(outside, (low[todo] + high[todo]) / 2, new)
        done = small | (np.abs(new - t[todo]) <= EPS * np.abs(new)) | (high[todo] - low[todo] <= EPS * np.abs(high[todo] + low[todo]) / 2)
        t[todo] = np.where(small, t[todo], new)
        todo = todo[~done]
        if not len(todo):
            break
    return pole, t


class Spectrum:
    """Eigenvalues d (ascending) and eigenvectors (columns of u) of a scatter matrix."""

    def __init__(self, dims: int) -> None:
        self.d, self.u = np.zeros(dims), np.eye(dims)

    def add(self, y: np.ndarray, rho: float = 1.0) -> None:
        """Add rho y y'."""
        d, u = self.d, self.u
        z = u.T @ y
        total = rho * (z @ z)
        if not total > 0:
            return
        scale = max(abs(d[-1]), total)
        tiny = 8 * EPS * scale
        z = z * np.sqrt(rho)
        # Deflate: equal eigenvalues turn their z into one of them.
        last = -1
        for i in np.flatnonzero(np.abs(z) * np.sqrt(total) > tiny):
            if last >= 0 and d[i] - d[last] <= tiny:
                r = np.hypot(z[i], z[last])
                c, s = z[i] / r, z[last] / r
                u[:, last], u[:, i] = c * u[:, last] - s * u[:, i], s * u[:, last] + c * u[:, i]
                z[last], z[i] = 0.0, r
            last = i
        live = np.flatnonzero(np.abs(z) * np.sqrt(total) > tiny)
        if not len(live):
            return
        dl, w = d[live], z[live] ** 2
        if len(live) == 1:
            d[live] += w
        else:
            pole, t = secular_roots(dl, w)
            # gap[i, j] = d_j - root_i
            gap = (dl - dl[pole][:, None]) - t[:, None]
            between = dl - dl[:, None]
            np.fill_diagonal(between, 1.0)
            # z that has exactly these roots: z_j^2 = prod_i (root_i - d_j) / prod_{i != j} (d_i - d_j)
            ratio = np.abs(gap / between)
            fixed = np.sqrt(np.exp(np.log(ratio).sum(0))) * np.sign(z[live])
            vectors = fixed / gap
            vectors /= np.linalg.norm(vectors, axis=1)[:, None]
            u[:, live] = u[:, live] @ vectors.T
            d[live] = dl[pole] + t
        order = np.argsort(d, kind="stable")
        self.d, self.u = d[order], u[:, order]

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.d, other.u.T):
            if value > 0:
                self.add(vector, value)


# --- tables -------------------------------------------------------------------------------


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def as_longs(vectors: DataFrame, vector: str) -> DataFrame:
    """vec_id and x of the rows whose vector is whole."""
    entry = lambda c: F.floor(F.lit(SCALE) * c.cast("double"))
    whole = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(F.lit(SCALE) * c.cast("double")) < 2.0**53)
    kept = vectors.select("vec_id", F.col(vector).alias("v")).where((F.size("v") > 0) & F.forall("v", whole))
    return kept.select("vec_id", F.transform("v", lambda c: entry(c) + OFFSET).alias("x"))


def _sums(rows: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """n and the sums per dimension, exact (modulo 2^64)."""

    def start():
        total = [0, np.zeros(dims, np.int64)]

        def take(batch: pa.RecordBatch) -> None:
            total[0] += batch.num_rows
            total[1] += _matrix(batch.column(0), np.int64).sum(0)

        def give(end: bool):
            if not end or not total[0]:
                return None
            return pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array([total[0], *total[1]], pa.int64())], names=["dim", "s"])

        return take, give

    found = aggregated_in_tasks(rows.select("x"), "dim int, s long", start).groupBy("dim").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(dims + 1, np.int64)
    for r in found:
        out[r["dim"]] = r["s"]
    return int(out[0]), out[1:]


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n from the exact whole number n x - S (where that fits; as doubles beyond)."""
    if float(np.abs(x).max(initial=0)) * n < 2.0**62:
        return (n * x - sums) / n
    return x - sums / n


def _outer(rows: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (x - S/n) B and of its outer products over all rows."""
    dims, k = basis.shape

    def start():
        total = [0, np.zeros(k), np.zeros((k, k))]

        def take(batch: pa.RecordBatch) -> None:
            y = centred(_matrix(batch.column(0), np.int64), n, sums) @ basis
            total[0] += batch.num_rows
            total[1] += y.sum(0)
            total[2] += y.T @ y

        def give(end: bool):
            if not end or not total[0]:
                return None
            flat = np.concatenate([total[1], total[2].ravel()])
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], names=["at", "s"])

        return take, give

    out = np.zeros(k + k * k)
    for r in aggregated_in_tasks(rows.select("x"), "at long, s double", start).groupBy("at").agg(F.sum("s").alias("s")).collect():
        out[r["at"]] = r["s"]
    return out[:k], out[k:].reshape(k, k)


def _spectra(rows: DataFrame, n: int, sums: np.ndarray) -> Spectrum:
    """The spectrum of the scatter of all rows: one a task, then combined in rounds."""
    dims = len(sums)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, met = Spectrum(dims), False
        for batch in batches:
            for y in centred(_matrix(batch.column(0), np.int64), n, sums):
                own.add(y)
                met = True
        if met:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([own.d.tobytes()]), pa.array([own.u.tobytes()])],
                names=["id", "d", "u"])

    def combine(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, parts = table["id"].to_pylist(), []
        for d, u in zip(table["d"].to_pylist(), table["u"].to_pylist()):
            part = Spectrum(dims)
            part.d, part.u = np.frombuffer(d).copy(), np.frombuffer(u).reshape(dims, dims).copy()
            parts.append(part)
        for part in parts[1:]:
            parts[0].merge(part)
        return pa.table({"id": pa.array([ids[0] // FAN], pa.int64()), "d": [parts[0].d.tobytes()], "u": [parts[0].u.tobytes()]})

    schema = "id long, d binary, u binary"
    tasks = blocks_for(n, TASK_ROWS)
    state = written(rows.select("x").repartition(tasks).mapInArrow(first, schema))
    while state.count() > 1:
        state = written(state.groupBy(F.floor(F.col("id") / FAN)).applyInArrow(combine, schema))
    only = state.first()
    out = Spectrum(dims)
    out.d, out.u = np.frombuffer(only["d"]), np.frombuffer(only["u"]).reshape(dims, dims)
    return out


class Fit:
    """n, sums, and the components: whiten (d, k) holds eigenvectors over sqrt(e)."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        self.n, self.sums = n, sums
        self.trace = float(values.sum())
        kept = np.flatnonzero(values > LEAST * self.trace) if self.trace > 0 else np.zeros(0, int)
        self.values, self.vectors = values[kept], vectors[:, kept]
        self.whiten = self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, dims: int) -> Fit:
    """Of rows (x), which are distinct and read four times: better a written table."""
    n, sums = _sums(rows, dims)
    if n < 2:
        return Fit(n, sums, np.zeros(dims), np.eye(dims))
    # Rounding in many updates leaves the basis a little off orthogonal.
    basis, _ = np.linalg.qr(_spectra(rows, n, sums).u[:, ::-1])
    _, quotient = _outer(rows, basis, n, sums)
    values, turn = np.linalg.eigh(quotient / n)
    return Fit(n, sums, values[::-1], basis @ turn[:, ::-1])


def report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of embeddings."""
    spark = prepare(embeddings.sparkSession)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = as_longs(embeddings, "embedding").withColumn("vec_id", F.col("vec_id").cast("long"))
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], out)
    dims = lengths["dims"]
    rows = rows.where(F.size("x") == dims)
    distinct = written(rows.select("x").distinct())
    found = fit(distinct, dims)
    whiten = found.whiten[:, :components]
    n, sums, k = found.n, found.sums, whiten.shape[1]
    if not k:
        return spark.createDataFrame([], out)
    mean, square = _outer(distinct, whiten, n, sums)
    error = float(np.abs(square / n - np.outer(mean / n, mean / n) - np.eye(k)).max())
    explained = found.values[:k] / found.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch.column(1), np.int64)
            whole = n * x - sums  # modulo 2^64, as its squares: exact wherever the sum fits
            deviation = (whole * whole).sum(1)
            fits = ((n * x.astype(float) - sums) ** 2).sum(1) < 9.2e18
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)),
                pa.array((centred(x, n, sums) @ whiten).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, out)
