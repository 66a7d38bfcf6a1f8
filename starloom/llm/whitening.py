"""Whitening of embeddings onto their leading principal components.

Vectors are quantised to whole numbers; the fit list holds each different vector
once. Its sums and its covariance, centred before multiplying, are added up in map
tasks, one small matrix per task, and then by entry. The matrix, whose size depends on
the dimensions only, is solved on the driver: Householder reflections make it tridiagonal,
Sturm counts bisect for the leading eigenvalues, inverse iteration with
reorthogonalisation inside clusters finds the vectors, which are reflected
back. The projection (dimensions x components) goes to every task with its
code. The covariance of the whitened fit list is measured, not derived.

Rows with a null vector, a null or a non-finite entry are dropped. Shorter vectors
count as filled up with zeros. Directions without variance beyond rounding give
no component, so one vector (or equal ones) and an empty table give no rows.
Repeated rows and repeated or null ids give one result row each; a deviation
beyond 64 bits is null; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stage

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 4096


# --- the symmetric eigenproblem, in numpy -------------------------------------------------

def tridiagonal(matrix):
    """(diagonal, off-diagonal, reflections) of a symmetric matrix."""
    import numpy as np
    a = np.array(matrix, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v /= norm
        low = a[k + 1:, k + 1:]
        p = low @ v
        w = 2 * (p - (v @ p) * v)
        low -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
        a[k + 2:, k] = a[k, k + 2:] = 0
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def count_below(diagonal, off, points):
    """How many eigenvalues lie below each point (signs of the Sturm sequence)."""
    import numpy as np
    tiny = np.finfo(float).tiny ** 0.5
    q = diagonal[0] - points
    below = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off * off):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d - points - e / q
        below += q < 0
    return below


def leading_eigenvalues(diagonal, off, k: int):
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit."""
    import numpy as np
    n = len(diagonal)
    reach = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    low, high = low - 1e-12 * (1 + np.abs(low)), high + 1e-12 * (1 + np.abs(high))
    rank = n - 1 - np.arange(k)  # 0-based from the smallest
    while True:
        mid = (low + high) / 2
        open_ = (mid > low) & (mid < high)
        if not open_.any():
            return mid
        above = count_below(diagonal, off, mid) <= rank
        low, high = np.where(open_ & above, mid, low), np.where(open_ & ~above, mid, high)


def _shifted_solver(diagonal, off, shift: float, small: float):
    """Solves (T - shift) x = b by elimination with row exchanges."""
    import numpy as np
    n = len(diagonal)
    d, up, up2 = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factors, swapped = np.zeros(n), np.zeros(n, bool)
    for i in range(n - 1):
        low = off[i]
        if abs(low) > abs(d[i]):
            swapped[i] = True
            factors[i] = d[i] / low
            d[i], keep = low, d[i + 1]
            up[i], d[i + 1] = keep, up[i] - factors[i] * keep
            up2[i], up[i + 1] = up[i + 1], -factors[i] * up[i + 1]
        else:
            if abs(d[i]) < small:
                d[i] = small
            factors[i] = low / d[i]
            d[i + 1] -= factors[i] * up[i]
    if abs(d[n - 1]) < small:
        d[n - 1] = small

    def solve(b):
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - factors[i] * x[i + 1]
            else:
                x[i + 1] -= factors[i] * x[i]
        for i in range(n - 1, -1, -1):
            for j, c in ((i + 1, up[i]), (i + 2, up2[i])):
                if j < n:
                    x[i] -= c * x[j]
            x[i] /= d[i]
        return x
    return solve


def leading_eigenvectors(diagonal, off, values):
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling ``values``."""
    import numpy as np
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0.0, 1e-300)
    small = np.finfo(float).eps * scale
    rng = np.random.default_rng(7)
    out, cluster = [], 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * scale:
            cluster = k
        # equal values are told apart by a shift below rounding of the matrix
        solve = _shifted_solver(diagonal, off, value - (k - cluster) * small, small)
        x = rng.standard_normal(n)
        for _ in range(6):
            x = solve(x / np.abs(x).max())
            for _twice in range(2):
                for y in out[cluster:]:
                    x -= (y @ x) * y
            x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out).T if out else np.zeros((n, 0))


def principal(matrix, k: int):
    """(eigenvalues, unit eigenvectors as columns): the ``k`` leading ones that stand out from
    rounding; of both signs of a vector the one whose largest entry is positive."""
    import numpy as np
    n = len(matrix)
    k = min(k, n)
    if not k or not np.abs(matrix).max() > 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, reflections = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, k)
    values = values[values > 8 * n * np.finfo(float).eps * values[0]]
    vectors = leading_eigenvectors(diagonal, off, values)
    for at, v in reversed(reflections):
        vectors[at:] -= 2 * np.outer(v, v @ vectors[at:])
    big = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[big, np.arange(vectors.shape[1])])


# --- Spark side ------------------------------------------------------------------------------

def _matrix(batch, name: str, dims: int):
    """int64 matrix of an Arrow list column, shorter vectors filled up with zeros."""
    import numpy as np
    column = batch.column(name)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _blocks(batches, name: str, dims: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, _matrix(part, name, dims)


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, x`` of the rows whose vectors hold finite numbers only."""
    view = vectors.select(F.col(id_col).alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    limit = float(1 << 62)
    return view.where(whole).select("id", F.transform("v", lambda c: F.floor(
        F.greatest(F.least(c * SCALE, F.lit(limit)), F.lit(-limit)))).alias("x"))


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension."""
    import decimal

    def partial(batches):
        import pyarrow as pa
        n, sums = 0, [0] * dims
        for part, x in _blocks(batches, "x", dims):
            n += part.num_rows
            wide = float(abs(x).max(initial=0)) * len(x) >= 2.0 ** 62
            s = (x.astype(object) if wide else x).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
             pa.array([decimal.Decimal(s) for s in sums], pa.decimal128(38, 0))], ["at", "n", "s"])
    rows = (fit.mapInArrow(partial, "at int, n long, s decimal(38,0)").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # one row per dimension
    sums = {r.at: r for r in rows}
    return (sums[0].n if sums else 0), [int(sums[i].s) for i in range(dims)] if sums else []


def covariance(fit: DataFrame, dims: int, n: int, sums: list[int]):
    """Covariance matrix (divisor ``n``) of the centred vectors."""
    import numpy as np
    mean = np.array([s / n for s in sums])

    def partial(batches):
        import pyarrow as pa
        total = np.zeros((dims, dims))
        for _, x in _blocks(batches, "x", dims):
            centred = x - mean
            total += centred.T @ centred
        i, j = np.triu_indices(dims)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array(total[i, j])], ["i", "j", "v"])
    rows = (fit.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j")
            .agg(F.sum("v").alias("v")).collect())  # bounded by the dimensions
    out = np.zeros((dims, dims))
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out


def _exact_deviation(x, n: int, sums: list[int]):
    """Sum over dimensions of (n x - S)^2 as longs; None where 64 bits are too few.

    64-bit products wrap round; the result is exact modulo 2^64 and so
    right wherever an estimate says that the true value is below 2^63."""
    import numpy as np
    wrapped = np.array([s & (1 << 64) - 1 for s in sums], np.uint64)
    away = x.view(np.uint64) * np.uint64(n & (1 << 64) - 1) - wrapped
    exact = (away * away).sum(axis=1, dtype=np.uint64).view(np.int64)
    rough = ((x.astype(float) * n - np.array(sums, float)) ** 2).sum(axis=1)
    out = exact.astype(object)
    for i in np.flatnonzero(rough > 2.0 ** 63 * (1 - 1e-6)):
        true = sum((n * int(v) - s) ** 2 for v, s in zip(x[i], sums))
        out[i] = true if true < 1 << 63 else None
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``id_col, component, n, deviation, whitened, explained,
    identity_error``."""
    import numpy as np
    rows = stage(quantised(vectors, id_col, vector_col), "quantised")
    id_type = rows.schema["id"].dataType.simpleString()
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    # a zero tail is no difference: shorter vectors are filled up before they are compared
    filled = rows.select(F.when(F.size("x") == dims, F.col("x")).otherwise(F.concat(
        "x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))).alias("x"))
    fit = stage(filled.distinct(), "fit-list") if dims else filled.limit(0)
    n, sums = _sums(fit, dims) if dims else (0, [])
    v = covariance(fit, dims, n, sums) if n else np.zeros((0, 0))
    values, axes = principal(v, components)
    explained = [float(e) / float(np.trace(v)) for e in values]
    mean = np.array([s / n for s in sums])
    scaled = axes / np.sqrt(values)
    k = len(values)

    def project(batches):
        import pyarrow as pa
        for part, x in _blocks(batches, "x", dims):
            w = np.ascontiguousarray((x - mean) @ scaled)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, (len(x) + 1) * k, k), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(_exact_deviation(x, n, sums), pa.int64()), lists],
                ["id", "deviation", "w"])
    schema = f"id {id_type}, deviation long, w array<double>"
    if not k:
        return rows.limit(0).select(
            F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (
                ("component", "int"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
                ("explained", "double"), ("identity_error", "double"))])
    fitted = fit.select(F.lit(None).cast(id_type).alias("id"), "x").mapInArrow(project, schema)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = fitted.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}")
                         for i, j in pairs]).first()
    error = max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return (rows.mapInArrow(project, schema)
            .select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"),
                    F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*[F.lit(e) for e in explained])[F.col("at")].alias("explained"),
                    F.lit(float(error)).alias("identity_error")))
