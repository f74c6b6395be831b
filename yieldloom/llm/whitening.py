"""Embedding whitening by a bidiagonal qd solver.

The distinct vectors, as whole numbers of 1/256, are the list that is fitted. Tasks reduce their centred rows to a triangle R
each (blockwise QR) and triangles are stacked and reduced again, some at a time, until one is left. What follows works on
that one triangle, whose size is the vector's length whatever the table holds: Householder reflections make R bidiagonal,
dqds finds its squared singular values, twisted factorisations the vectors that belong to them, and the reflections,
backwards, turn those into directions. Rows are projected in tasks.

Cases: a vector that is null, empty or holds null or non-finite entries is left out. Vectors of another length than the most
common one (of equally common ones the shortest) cannot share its directions and are left out too. 256 times an entry beyond
64 bits becomes the nearest 64-bit number. Directions without spread, whose singular value is not above 1e-10 of the largest,
are no components: a list of one distinct vector, and an empty table, give no rows. A ``deviation`` beyond 64 bits is null.
Ids may repeat or be null and rows may repeat: each row is answered. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import save

#: Entries are counted in steps of one over this.
STEPS = 256
#: Bytes of triangles that one task stacks at most, two triangles at least.
STACK_BYTES = 1 << 26
FLAT = 1e-10
EPS = float(np.finfo(np.float64).eps)
TINY = 1e-290
LONG = 2**63 - 1


@dataclass(frozen=True)
class Whitening:
    """What was fitted; directions are rows, by falling variance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    trace: float


def whole_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(key, x)`` of the rows whose vector is usable, in steps of 1/256."""
    entry = lambda c: c.cast("double")
    good = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) != float("inf")))
    rows = vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0) & good)
    rows = rows.select(F.col(key), F.transform(column, lambda c: F.floor(entry(c) * STEPS)).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("x") == (sizes["d"] if sizes else 0))


def matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of the columns, exact whatever the size."""
    if len(x) and float(np.abs(x.astype(np.float64)).max()) * len(x) >= 2.0**62:
        return [int(s) for s in x.astype(object).sum(axis=0)]
    return [int(s) for s in x.sum(axis=0)]


def spread(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit numbers where they fit, else Python's."""
    if len(x) and (float(np.abs(x.astype(np.float64)).max()) * n + float(np.abs(sums.astype(np.float64)).max())) < 2.0**62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums.astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less the mean, rounded once."""
    return (spread(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Each row's sum of squares of ``n * x - sums``; null beyond 64 bits."""
    away = spread(x, n, sums)
    if away.dtype != object and len(away) and float(np.abs(away).astype(np.float64).max()) ** 2 * away.shape[1] < 2.0**62:
        return (away * away).sum(axis=1).tolist()
    return [d if d <= LONG else None for d in (sum(int(a) * int(a) for a in row) for row in away)]


def triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of the rows, square."""
    r = np.linalg.qr(rows, mode="r") if len(rows) else rows
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal and the reflections from the right that make a square matrix bidiagonal."""

    def reflection(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        length = np.linalg.norm(v)
        if length:
            v[0] += np.copysign(length, v[0])
            v /= np.linalg.norm(v)
        return v

    a, d, rights = r.copy(), len(r), []
    for k in range(d):
        v = reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 1:
            w = reflection(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            rights.append(w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), rights


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference step; None where the shift passes the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        top = d + e[i]
        ratio = q[i + 1] / top if top > TINY else 0.0
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if top > TINY else q[i + 1] - shift
    return None if d < 0 else (new_q + [d], new_e)


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of a bidiagonal's singular values by dqds with shifts, each to high relative accuracy, falling."""
    out: list[float] = []
    blocks = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            if len(q) == 1:
                out.append(q[0] + moved)
                break
            # Negligible entries part the block; at the ends they give a value away.
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= (EPS / 4) ** 2 * (moved + min(q[i], q[i + 1])) or e[i] < TINY), None)
            if cut is not None:
                if cut < len(e) - 1:
                    blocks.append((q[: cut + 1], e[:cut], moved))
                    q, e = q[cut + 1 :], e[cut + 1 :]
                else:
                    out.append(q[-1] + moved)
                    q, e = q[:-1], e[:-1]
                continue
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # The smaller value of the last two rows is a guess at the smallest; too large a guess is halved.
            half = (q[-2] + e[-1] + q[-1]) / 2
            product = q[-2] * q[-1]
            root = max(half * half - product, 0.0) ** 0.5
            shift = product / (half + root) if half + root > TINY else 0.0
            shift = shift * (1 - 4 * EPS) if e[-1] < 1e-3 * q[-1] else shift * 0.9
            step = None
            for _ in range(12):
                step = _sweep(q, e, shift)
                if step:
                    break
                shift /= 4
            if not step:
                shift, step = 0.0, _sweep(q, e, 0.0)
            q, e = step
            moved += shift
    return sorted(out, reverse=True)


def twisted(q: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The unit vector that belongs to a value of L D L', from its stationary and progressive factorisations joined where they meet best."""
    n = len(q)
    plus, minus, s, p = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0)), np.zeros(n), np.zeros(n)
    s[0] = -value
    safe = lambda x: x if abs(x) > TINY else TINY
    for i in range(n - 1):
        plus[i] = q[i] * low[i] / safe(s[i] + q[i])
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        ratio = q[i] / safe(q[i] * low[i] ** 2 + p[i + 1])
        minus[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    z = np.zeros(n)
    k = int(np.argmin(np.abs(s + p + value)))
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the first right singular vectors (as rows) of a square matrix.

    A bidiagonal that falls into blocks gives each vector within one block. Vectors of values that agree to 1e-6 are made
    orthogonal to each other.
    """
    a, b, rights = bidiagonal(r)
    d, largest = len(a), max(np.abs(a).max(), np.abs(b).max() if len(b) else 0.0)
    if not largest > 0:
        return np.zeros(d), np.zeros((0, d))
    cuts = [i + 1 for i in range(d - 1) if abs(b[i]) <= EPS / 4 * largest]
    found = []
    for low, high in zip([0] + cuts, cuts + [d]):
        found += [(v, low, high) for v in squared_singular_values(a[low:high], b[low : high - 1])]
    found.sort(key=lambda f: (-f[0], f[1]))
    kept: list[np.ndarray] = []
    rng = np.random.default_rng(7)
    for value, low, high in found[:count]:
        if value <= found[0][0] * FLAT**2:
            break
        own = np.where(np.abs(a[low:high]) > TINY, a[low:high], EPS * EPS * largest)
        z = np.zeros(d)
        z[low:high] = twisted(own * own, b[low : high - 1] / own[:-1], value)
        near = [k for k, (other, _, _) in zip(kept, found) if other - value <= 1e-6 * other]
        for _ in range(20):
            rest = z - sum((k * (k @ z) for k in near), np.zeros(d))
            rest -= sum((k * (k @ rest) for k in near), np.zeros(d))
            if np.linalg.norm(rest) > 0.5:
                break
            # Both came out alike: a step of inverse iteration from another start.
            t = np.diag(own * own) + np.diag(own[:-1] * b[low : high - 1], 1) + np.diag(own[:-1] * b[low : high - 1], -1)
            t += np.diag(np.concatenate([[0.0], b[low : high - 1] ** 2]))
            start = rng.standard_normal(d)
            start -= sum((k * (k @ start) for k in near), np.zeros(d))
            z = np.zeros(d)
            z[low:high] = np.linalg.solve(t - value * (1 + 4 * EPS) * np.eye(high - low), start[low:high])
            z /= np.linalg.norm(z)
        kept.append(rest / np.linalg.norm(rest))
    out = []
    for z in kept:
        for k in range(len(rights) - 1, -1, -1):
            z[k + 1 :] -= 2 * rights[k] * (rights[k] @ z[k + 1 :])
        out.append(z)
    return np.array([f[0] for f in found]), np.array(out).reshape(len(out), d)


def _totals(fit: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and sums of each dimension: ``d + 1`` rows reach the driver."""

    def part(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                own = exact_sums(matrix(batch.column("x")))
                n, sums = n + batch.num_rows, own if sums is None else [s + t for s, t in zip(sums, own)]
        if sums:
            yield pa.RecordBatch.from_pydict({"dimension": pa.array(range(-1, len(sums)), pa.int32()), "total": [str(s) for s in [n, *sums]]})

    parts = fit.mapInArrow(part, "dimension int, total string")
    rows = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dimension").collect()
    totals = [int(r["total"]) for r in rows]
    return (totals[0], np.array(totals[1:], dtype=object)) if totals else (0, np.zeros(0, dtype=object))


def _reduced(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows: one a task, then stacks of them, until one is left."""
    d = len(sums)
    fan = max(2, min(16, STACK_BYTES // (8 * d * d)))

    def part(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        r = np.zeros((0, d))
        for batch in batches:
            for low in range(0, batch.num_rows, 8192):
                r = triangle(np.vstack([r, centred(matrix(batch.column("x").slice(low, 8192)), n, sums)]))
        if len(r):
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"node": pa.array([at], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    def stacked(table):
        import pyarrow as pa

        r = np.zeros((0, d))
        for bytes_ in table.sort_by("node").column("r"):
            r = triangle(np.vstack([r, np.frombuffer(bytes_.as_py()).reshape(d, d)]))
        return pa.table({"node": pa.array([table.column("upper")[0].as_py()], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    nodes, left = fit.mapInArrow(part, "node long, r binary"), fit.rdd.getNumPartitions()
    while left > 1:
        nodes = nodes.withColumn("upper", F.floor(F.col("node") / fan)).groupBy("upper").applyInArrow(stacked, "node long, r binary")
        left = -(-left // fan)
    return np.frombuffer(nodes.first()["r"]).reshape(d, d)


def fitted(fit: DataFrame, components: int = 4) -> Whitening:
    """Whitening directions of a table of distinct vectors ``x``."""
    n, sums = _totals(fit)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    r = _reduced(fit, n, sums)
    _, power = np.frexp(np.abs(r).max())
    values, rows = directions(np.ldexp(r, -int(power)), components)
    variances = np.ldexp(values, 2 * int(power)) / n
    return Whitening(n, tuple(sums.tolist()), rows, variances[: len(rows)], float(variances.sum()))


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates of rows."""
    return centred(x, model.n, np.array(model.sums, dtype=object)) @ model.directions.T / np.sqrt(model.variances)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened list less the identity."""
    k = len(model.directions)

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(k)
        for batch in batches:
            total += projected(matrix(batch.column("x")), model).sum(axis=0) if batch.num_rows else 0
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k), pa.int32()), "total": total})

    means = np.array([r["total"] for r in fit.mapInArrow(sums, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()]) / model.n

    def products(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                own = projected(matrix(batch.column("x")), model) - means
                total += own.T @ own
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k * k), pa.int32()), "total": total.ravel()})

    rows = fit.mapInArrow(products, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()
    return float(np.abs(np.array([r["total"] for r in rows]).reshape(k, k) / model.n - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = 4, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: ``(key, component, n, deviation, whitened, explained, identity_error)``."""
    rows = whole_vectors(vectors, key, column)
    fit = save(rows.select("x").distinct(), "whitening-list")
    model = fitted(fit, components)
    id_type = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not len(model.directions):
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.directions)

    def answers(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums, shares = np.array(model.sums, dtype=object), model.variances / model.trace
        for whole in batches:
            for low in range(0, whole.num_rows, 8192):
                batch = whole.slice(low, 8192)
                x, m = matrix(batch.column("x")), batch.num_rows
                own = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array(own)),
                        pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array(np.full(m * k, model.n), pa.int64()),
                        pa.array(deviations(x, model.n, sums), pa.int64()).take(pa.array(own)),
                        pa.array(projected(x, model).ravel()),
                        pa.array(np.tile(shares, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(answers, schema)
