"""Embedding whitening by the Jacobi-Davidson method.

The leading eigenvectors of the vectors' covariance are found without ever forming it. All that is asked of the data
is its product with a few columns, a Spark job: each task centres its rows exactly (in whole numbers, before they are
multiplied), multiplies them by the columns and back, and returns one small matrix; these are added up, in stages where
there are many tasks. The driver holds matrices of the dimensions by a few dozen columns, whatever the rows.

1. Rayleigh-Ritz: the product with an orthonormal basis gives the Ritz pairs of its span, and their residuals.
2. Leading pairs whose residuals have come down to double precision are locked: they leave the search, which stays
   orthogonal to them.
3. Each open pair's correction equation, projected off all Ritz vectors and locked ones, is solved roughly by MINRES.
   The equations go side by side, so a step of all of them is one product.
4. The corrections extend the basis, which is cut back to the leading Ritz vectors when it has grown to ``LIMIT`` times
   their number; and so on until all pairs wanted are locked.

Vectors are kept as whole numbers, ``floor(64 c) + 1000000`` for an entry ``c``, packed in blocks of rows in a stored table
that all products read, so that sums and squared deviations are exact.

Defined cases: vectors that are null, or hold a null or an entry that is not finite or too large to be such a number (2**46
or more) are left out, and so are those of another length than most have (the longer of equally many); rows that repeat stay
and count each; directions without variance (below ``10 d`` roundings of the largest) are no components, so that equal vectors
give no rows; a deviation beyond a long is null; an empty table gives an empty result; other columns, whatever their names, do
not take part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightledger.llm.common import read, slices, stored

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**46
#: Components, Ritz vectors carried beyond them, and how far a basis grows, as a multiple of both.
COMPONENTS, GUARD, LIMIT = 32, 8, 3
#: MINRES steps of a correction, and rounds of the search: beyond them the pairs count as found as they are.
STEPS, ROUNDS = 8, 60
#: Rows of a block, and matrices that the driver adds up itself.
ROWS, FAN = 512, 64
EPS = np.finfo(float).eps


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the rows whose vectors count: entries as whole numbers."""
    # Optimised filters may see rows in any order, so entries that are not such numbers become nulls first.
    x = F.transform(vec_col, lambda c: F.when(F.abs(c.cast("double")) < LARGEST, F.floor(c.cast("double") * SCALE).cast("long") + SHIFT))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    return rows.where(F.size("x") == (usual.d if usual else 0))


def packed(vectors: DataFrame) -> DataFrame:
    """``(ids, x)``: blocks of rows, the vectors end to end as 64-bit numbers."""

    def run(batches):
        for batch in slices(batches, ROWS):
            x = batch.column(1).flatten().to_numpy().astype("<i8")
            yield pa.record_batch([pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return vectors.mapInArrow(run, "ids array<long>, x binary")


class Centred:
    """The centred vectors of a table of blocks: their number, dimensions, exact sums, and products with them."""

    def __init__(self, vectors: DataFrame):
        found = vectors.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
        # A row for each dimension.
        sums = found.orderBy("j").collect()
        self.d = len(sums)
        self.n = sums[0].n if sums else 0
        #: Each sum as ``n`` times a whole number, and the rest: differences from the former stay small.
        self.whole = np.array([int(r.s) // self.n for r in sums], np.int64)
        self.rest = np.array([int(r.s) % self.n for r in sums], np.int64)
        self.blocks = stored(packed(vectors))
        self.tasks = self.blocks.select(F.spark_partition_id().alias("p")).distinct().count()

    def parts(self) -> tuple:
        """What a task needs to centre rows."""
        return self.n, self.d, self.whole, self.rest

    def total(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all blocks of a function of their centred rows."""
        centred = _centred(*self.parts())

        def run(batches):
            out = np.zeros(shape)
            for batch in batches:
                for data in batch.column(0):
                    out += of(centred(data.as_py()))
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], ["m"])

        def add(batches):
            out = np.zeros(shape)
            for batch in batches:
                for data in batch.column(0):
                    out += np.frombuffer(data.as_py()).reshape(shape)
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary())], ["m"])

        found, left = self.blocks.select("x").mapInArrow(run, "m binary"), self.tasks
        while left > FAN:
            left = max(1, left // FAN)
            found = found.repartition(left).mapInArrow(add, "m binary")
        # In the order of their bytes, so that the same tasks give the same sum.
        return sum((np.frombuffer(m).reshape(shape) for m in sorted(bytes(r.m) for r in found.collect())), np.zeros(shape))

    def product(self, q: np.ndarray) -> np.ndarray:
        """The covariance's product with columns."""
        return self.total(lambda z: z.T @ (z @ q), q.shape) / self.n


def _centred(n: int, d: int, whole: np.ndarray, rest: np.ndarray) -> Callable[[bytes], np.ndarray]:
    """A function from a block's bytes to its rows less the mean: one rounding for each entry."""

    def rows(data: bytes) -> np.ndarray:
        x = np.frombuffer(data, "<i8").reshape(-1, d) - whole
        y = x * n - rest if float(np.abs(x).max(initial=0)) * n < 2.0**62 else x * float(n) - rest
        return y / n

    return rows


def minres(apply: Callable, b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Rough solutions of ``A_i x_i = b_i`` for symmetric ``A_i``, all columns side by side; ``apply`` takes and gives all of them.

    Ends after so many steps, or when every residual is down to the share ``enough`` of its right side.
    """
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    beta = first = np.linalg.norm(b, axis=0)
    tiny = np.finfo(float).tiny
    v_old, v = np.zeros_like(b), b / np.maximum(beta, tiny)
    phi, c, s = beta.copy(), -np.ones_like(beta), np.zeros_like(beta)
    d_bar, eps = np.zeros_like(beta), np.zeros_like(beta)
    beta = np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        beta = np.linalg.norm(p, axis=0)
        eps_old, delta, g_bar = eps, c * d_bar + s * alpha, s * d_bar - c * alpha
        eps, d_bar = s * beta, -c * beta
        gamma = np.maximum(np.hypot(g_bar, beta), EPS * np.maximum(first, tiny))
        c, s = g_bar / gamma, beta / gamma
        step, phi = c * phi, s * phi
        w_old, w = w, (v - eps_old * w_old - delta * w) / gamma
        x = x + step * w
        v_old, v = v, p / np.maximum(beta, tiny)
        if (phi <= enough * first).all():
            break
    return x


def orthonormal(t: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what columns add to one."""
    for _ in range(2):
        t = t - basis @ (basis.T @ t)
        norms = np.linalg.norm(t, axis=0)
        t = t[:, norms > 0] / norms[norms > 0]
        if not t.shape[1]:
            return t
        u, size, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, size > 1e-10 * size[0]]
    return t


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], d: int, want: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, their vectors as columns, and the norms of their residuals.

    The matrix is known by its products with columns alone.
    """
    want = min(want, d)
    keep = min(d, want + GUARD)
    locked, values, norms = np.zeros((d, 0)), np.zeros(0), np.zeros(0)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, keep)))[0]
    a = product(q)
    top, before, fresh = 0.0, np.inf, True
    for round_ in range(ROUNDS):
        h = q.T @ a
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        q, a = q @ y, a @ y
        top = max(top, float(theta[0]), *values[:1])
        residual = a - q * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        done = 0
        while done < min(want - len(values), q.shape[1]) and size[done] <= 4 * d * EPS * top:
            done += 1
        locked, values, norms = np.hstack([locked, q[:, :done]]), np.append(values, theta[:done]), np.append(norms, size[:done])
        q, a, theta, residual, size = q[:, done:], a[:, done:], theta[done:], residual[:, done:], size[done:]
        left = want - len(values)
        if not left:
            break
        worst = float(size[:left].max())
        if locked.shape[1] + q.shape[1] >= d:
            # The basis is the whole space: what is left is rounding, less of it after a product of its own.
            if fresh and worst > before / 2:
                break
            q = np.linalg.qr(q - locked @ (locked.T @ q))[0]
            a, fresh, before = product(q), True, worst
            continue
        if q.shape[1] + left > LIMIT * keep:
            q, a, theta = q[:, :keep], a[:, :keep], theta[:keep]
        off = np.hstack([locked, q[:, :left]])
        open_ = np.nonzero(size[:left] > 4 * d * EPS * top)[0]

        def projected(t: np.ndarray) -> np.ndarray:
            return t - off @ (off.T @ t)

        def correction(t: np.ndarray) -> np.ndarray:
            t = projected(t)
            return projected(product(t) - t * theta[open_])

        t = minres(correction, -projected(residual[:, open_]), STEPS, 0.3 ** (1 + min(round_, 6)))
        t = orthonormal(t, np.hstack([locked, q]))
        if not t.shape[1]:
            break
        q, a, fresh = np.hstack([q, t]), np.hstack([a, product(t)]), False
    else:
        left = want - len(values)
    if left:
        locked, values, norms = np.hstack([locked, q[:, :left]]), np.append(values, theta[:left]), np.append(norms, size[:left])
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order], norms[order]


def whitened(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each vector that counts and component."""
    spark = df.sparkSession
    data = Centred(whole_vectors(df, id_col, vec_col))
    empty = spark.createDataFrame([], SCHEMA)
    if not data.n or not data.d:
        return empty
    trace = float(data.total(lambda z: np.array([(z * z).sum()]), (1,))[0]) / data.n
    if not trace:
        return empty
    values, vectors, _ = eigenpairs(data.product, data.d, components)
    some = values > 10 * data.d * EPS * values[0]
    values, vectors = values[some], vectors[:, some]
    to, m = vectors / np.sqrt(values), int(some.sum())
    mean = data.total(lambda z: (z @ to).sum(0), (m,)) / data.n
    covariance = data.total(lambda z: (w := z @ to - mean).T @ w, (m, m)) / data.n
    error = float(np.abs(covariance - np.eye(m)).max())
    n, d, whole, rest = data.parts()
    centred = _centred(n, d, whole, rest)
    explained = values / trace

    def run(batches):
        for batch in batches:
            for ids, block in zip(batch.column(0), batch.column(1)):
                ids, z = ids.values, centred(block.as_py())
                rows = len(z)
                deviation = pa.array(_squares(block.as_py(), n, d, whole, rest), pa.int64())
                at = np.repeat(np.arange(rows), m)
                columns = [
                    ids.take(pa.array(at)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)), pa.array(np.full(rows * m, n, np.int64)),
                    deviation.take(pa.array(at)), pa.array((z @ to).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * m, error)),
                ]
                yield pa.record_batch(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return data.blocks.mapInArrow(run, SCHEMA)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _squares(data: bytes, n: int, d: int, whole: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Each row's sum of ``(n x - S)**2``, exact; None beyond a long."""
    x = np.frombuffer(data, "<i8").reshape(-1, d) - whole
    if (float(np.abs(x).max(initial=0)) + 1) ** 2 * float(n) ** 2 * d < 2.0**62:
        y = x * n - rest
        return (y * y).sum(1).tolist()
    sums = (sum((v * n - r) ** 2 for v, r in zip(row, rest.tolist())) for row in x.tolist())
    return [s if s < 2**63 else None for s in sums]


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read(spark, sf_dir, "embeddings"))
