"""Embedding whitening by a weighted multiplicity covariance.

1. Every vector becomes integers x = floor(SCALE * c); rows with identical x are
   one distinct vector with a number of copies (counted map-side, so a vector
   that a third of all rows share is one row per task before the shuffle).
2. The fit runs over the distinct vectors with their copies or one as weights:
   exact sums first, then a weighted product of the centred vectors, block by
   block inside the tasks; matrix rows are added up on Spark.
3. The principal components of that covariance come from the driver, which holds
   one matrix of (vector length) squared, whatever the number of rows.
4. Each distinct vector is projected once; rows get the result back by the digest
   of their x, vectors of many rows by broadcast (fewer than 1000 such).

Defined cases: a row whose vector is null or holds null, NaN or infinite entries
is dropped; an x beyond 64 bits becomes the nearest 64-bit integer; vectors of
different lengths are different populations, each with its own fit (the driver
holds one matrix per length); an empty vector has no component and no row; a
component without variance (eigenvalue under the rounding error of the largest
one, as with a single distinct vector) cannot be scaled to one and is left out,
so fewer than ``components`` rows come back; a deviation beyond 64 bits is null;
rows with equal or null ids are rows of their own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import join_groups, stored

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 4 << 20  # vectors handled at once inside a task
RANK_EPS = 1e-13       # eigenvalues under this share of the largest, times the length, count as none
_LIMIT = 1 << 63


@dataclass(frozen=True)
class Fit:
    """What the projection of vectors of one length needs."""
    n: int                # total weight of the fit list
    whole: np.ndarray     # floor(S / n) per dimension
    rest: np.ndarray      # S - n * whole
    basis: np.ndarray     # unit eigenvectors, a row each, by falling eigenvalue
    values: np.ndarray    # their eigenvalues
    trace: float


# -------------------------------------------------------------- vectors
def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): the integers of every valid vector as little-endian 64-bit bytes."""
    id_type = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max(1, batch.column(1).nbytes // max(1, batch.num_rows))
            step = max(1, BLOCK_BYTES // width)
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                b = b.filter(pc.is_valid(b.column(1)))
                vectors = b.column(1)
                values = vectors.flatten().cast(pa.float64())
                v = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
                ends = np.concatenate([[0], np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False))]).astype(np.int64)
                bad = np.concatenate([[0], np.cumsum(~np.isfinite(v))])
                keep = bad[ends[1:]] == bad[ends[:-1]]
                with np.errstate(all="ignore"):
                    scaled = np.floor(np.where(np.isfinite(v), v, 0.0) * scale)
                    x = np.where(scaled >= 2.0 ** 63, _LIMIT - 1,
                                 np.where(scaled < -2.0 ** 63, -_LIMIT, scaled.clip(-2.0 ** 63, 2.0 ** 63 - 1024).astype(np.int64)))
                packed = pa.Array.from_buffers(pa.large_binary(), len(vectors),
                                               [None, pa.py_buffer(ends * 8), pa.py_buffer(x.astype("<i8").tobytes())])
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), packed.filter(mask).cast(pa.binary())],
                                                 names=["id", "x"])

    return rows.select(F.col(id_col).alias("id"), F.col(vector)).mapInArrow(run, f"id {id_type}, x binary")


def vector_key() -> Column:
    return F.unhex(F.sha2("x", 256))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Stored (x, copies), one row per distinct vector that has an entry."""
    return stored(vectors.filter(F.octet_length("x") > 0).groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
    """Runs of vectors of one length out of batches (x, weight): the length, the
    vectors as a matrix, their weights and their bytes."""
    for b in batches:
        sizes = pc.binary_length(b.column(0)).to_numpy()
        for size in np.unique(sizes).tolist():
            of = b.filter(pa.array(sizes == size))
            step = max(1, BLOCK_BYTES // size)
            for at in range(0, of.num_rows, step):
                part = of.slice(at, step)
                x = np.frombuffer(b"".join(part.column(0).to_pylist()), "<i8").reshape(-1, size // 8)
                yield size // 8, x, part.column(1).to_numpy(), part.column(0)


# ------------------------------------------------------------------ fit
def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: total weight and exact weighted sums of the dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for d, x, w, _ in _blocks(batches):
            small = int(np.abs(x.astype(np.float64)).max()) * float(w.sum()) < 2.0 ** 61
            part = (w @ x if small else w.astype(object) @ x.astype(object)).tolist()
            total[d] = total.get(d, 0) + int(w.sum())
            sums[d] = [s + p for s, p in zip(sums.get(d, [0] * d), part)]
        rows = [(d, i, str(s), total[d]) for d in sums for i, s in enumerate(sums[d])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64()))], names=["d", "i", "s", "w"])

    added = (distinct.mapInArrow(run, "d int, i int, s string, w bigint").groupBy("d", "i")
             .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("w").alias("w")).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(added, key=lambda r: (r.d, r.i)):
        out.setdefault(r.d, (r.w, []))[1].append(int(r.s))
    return out


def _centred(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x - S/n: whole numbers are taken off exactly, then the fraction."""
    return np.subtract(x, whole).astype(np.float64) - part


def _covariance(distinct: DataFrame, means: dict[int, tuple[np.ndarray, np.ndarray]],
                totals: dict[int, int]) -> dict[int, np.ndarray]:
    """Per length: weighted product of the centred vectors over the total weight.
    A task adds up its blocks, then matrix rows are added across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[int, np.ndarray] = {}
        for d, x, w, _ in _blocks(batches):
            y = _centred(x, *means[d])
            part = (y * w[:, None]).T @ y
            grams[d] = grams[d] + part if d in grams else part
        for d, gram in grams.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
                 pa.array([g.tobytes() for g in gram], pa.binary())], names=["d", "i", "g"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for d, i, g in zip(*(c.to_pylist() for c in b.columns)):
                part = np.frombuffer(g, np.float64)
                sums[d, i] = sums[d, i] + part if (d, i) in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                 pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["d", "i", "g"])

    schema = "d int, i int, g binary"
    rows = distinct.mapInArrow(run, schema).repartition("d", "i").mapInArrow(add, schema).collect()
    out = {d: np.zeros((d, d)) for d in totals}
    for r in rows:
        out[r.d][r.i] = np.frombuffer(r.g, np.float64) / totals[r.d]
    return {d: (v + v.T) / 2 for d, v in out.items()}


def fit(distinct: DataFrame, components: int = COMPONENTS, weights: str = "one") -> dict[int, Fit]:
    """The fit of every vector length in ``distinct`` (x, copies). ``weights``:
    ``one`` counts every distinct vector once, ``copies`` as often as it occurs."""
    if weights not in ("one", "copies"):
        raise ValueError("weights: one or copies")
    listed = distinct.select("x", (F.lit(1).cast("long") if weights == "one" else F.col("copies")).alias("w"))
    sums = _sums(listed)
    whole = {d: np.array([s // n for s in of], np.int64) for d, (n, of) in sums.items()}
    rest = {d: np.array([s % n for s in of], np.int64) for d, (n, of) in sums.items()}
    totals = {d: n for d, (n, _) in sums.items()}
    means = {d: (whole[d], rest[d] / totals[d]) for d in totals}
    out = {}
    for d, v in _covariance(listed, means, totals).items():
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > max(values.max() * RANK_EPS * d, 0.0)]
        basis = vectors.T[order]
        # one sign for all rows: the largest entry of a component is positive
        basis = basis * np.sign(basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)])[:, None]
        out[d] = Fit(totals[d], whole[d], rest[d], basis, values[order], float(np.trace(v)))
    return out


# -------------------------------------------------------------- project
def _deviations(x: np.ndarray, f: Fit) -> list[int | None]:
    """Sums over the dimensions of (n*x - S)^2, exact."""
    reach = max(np.abs(x.astype(np.float64) - f.whole).max() + 1, 1.0) * f.n
    if reach < 2.0 ** 62 and reach * reach * x.shape[1] < 2.0 ** 62:
        t = f.n * (x - f.whole) - f.rest
        return (t * t).sum(axis=1).tolist()
    t = f.n * (x.astype(object) - f.whole.astype(object)) - f.rest.astype(object)
    return [s if s < _LIMIT else None for s in (t * t).sum(axis=1).tolist()]


def project(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """Stored (key, copies, d, deviation, whitened): each distinct vector once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, x, w, raw in _blocks(batches):
            f = fits[d]
            z = _centred(x, f.whole, f.rest / f.n) @ f.basis.T / np.sqrt(f.values)
            yield pa.RecordBatch.from_arrays(
                [raw, pa.array(w), pa.array([d] * len(x), pa.int32()), pa.array(_deviations(x, f), pa.int64()),
                 pa.array(z.tolist(), pa.list_(pa.float64()))], names=["x", "copies", "d", "deviation", "whitened"])

    out = distinct.select("x", "copies").mapInArrow(
        run, "x binary, copies bigint, d int, deviation bigint, whitened array<double>")
    return stored(out.select(vector_key().alias("key"), "copies", "d", "deviation", "whitened"), "whitened")


def identity_errors(whitened: DataFrame, weights: str = "one") -> dict[int, float]:
    """Per length: the largest distance of the whitened vectors' covariance from
    the identity. Means first, then centred products, both as aggregates."""
    w = F.lit(1) if weights == "one" else F.col("copies")
    each = whitened.select("d", w.alias("w"), F.posexplode("whitened").alias("i", "z"))
    means = {}
    for r in each.groupBy("d", "i").agg((F.sum(F.col("w") * F.col("z")) / F.sum("w")).alias("m"),
                                        F.sum("w").alias("n")).collect():
        means[r.d, r.i] = (r.m, r.n)
    lengths = sorted({d for d, _ in means})
    out = {}
    for d in lengths:
        k = sum(1 for e, _ in means if e == d)
        centred = [F.col("whitened")[i] - F.lit(means[d, i][0]) for i in range(k)]
        of = whitened.filter(F.col("d") == d).agg(*[F.sum(w * centred[i] * centred[j]).alias(f"c{i}_{j}")
                                                    for i in range(k) for j in range(i + 1)]).first()
        n = means[d, 0][1]
        out[d] = max(abs(of[f"c{i}_{j}"] / n - (i == j)) for i in range(k) for j in range(i + 1))
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS, weights: str = "one", id_col: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """A row per valid row of ``rows`` and component: the id, component, n,
    deviation, whitened, explained, identity_error."""
    vectors = integer_vectors(rows, id_col, vector)
    distinct = distinct_vectors(vectors)
    fits = fit(distinct, components, weights)
    whitened = project(distinct, fits)
    errors = identity_errors(whitened, weights)
    facts = [(d, i + 1, f.n, float(f.values[i] / f.trace), errors[d]) for d, f in fits.items() for i in range(len(f.values))]
    # one row per length and component
    facts = rows.sparkSession.createDataFrame(facts, "d int, component int, n bigint, explained double, identity_error double")
    keyed = vectors.filter(F.octet_length("x") > 0).select("id", vector_key().alias("key"))
    total = whitened.agg(F.sum("copies")).first()[0] or 0
    joined = join_groups(keyed, whitened, "key", "copies", total)
    each = joined.select("id", "d", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return (each.withColumn("component", F.col("at") + 1).join(F.broadcast(facts), ["d", "component"])
            .select(F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"))
