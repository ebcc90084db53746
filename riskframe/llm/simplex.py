"""Clustering around integer centroids, with n-simplex bounds before exact distances.

Components become integers floor(``SCALE`` x). Each vector's distances to a few pivots are measured once and stored as the
coordinates of the apex of the simplex over the pivots: all but the last are signed, the last is the height over them. For two
apexes the Euclidean distance, and the one with the second apex mirrored at the pivots' plane, bound the distance of
the originals from below and above. Per round only centroids whose lower bound does not exceed the least upper bound are compared,
by exact integer arithmetic, so the bounds decide what is computed and never the result.

A round sends one row per task and centroid (sums and a count) through one small shuffle; centroids (k x dimension numbers) are all
that reaches the driver, and the vectors are stored once.

Defined results: vectors that are null, of another dimension, or hold null or non-finite components take no part. The seeds are
the vectors with the smallest hash of their id; a null id has no hash and comes last; equal ids are told apart by their vectors. With
fewer vectors than centroids, each is one. A distance or inertia beyond a long is null, though it is compared exactly.
Repeated rows count as often as they occur. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.sources.staging import stage

DIMENSION = 64
SCALE = 256
K = 40
ROUNDS = 5
PIVOTS = 12
_SAFE = 1 << 27  # below, squared distances of 64 components fit a long
_BLOCK = 4096
_LIMB = 10**27
_SUMS = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("i", pa.int32()), ("limb", pa.int32()), ("x", pa.decimal128(38, 0))])


def usable(v: Column, dimension: int) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == dimension) & fine, F.lit(False))


def whole_numbers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale x) of doubles as 64-bit integers, or as Python integers where a component is too large for exact 64-bit distances."""
    y = np.floor(scale * x)
    if y.size == 0 or np.abs(y).max() < _SAFE:
        return y.astype(np.int64)
    return np.array([[_floor_exact(float(a), scale) for a in row] for row in x], dtype=object)


def _floor_exact(a: float, scale: int) -> int:
    top, bottom = a.as_integer_ratio()
    return scale * top // bottom


def pivot_base(pivots: np.ndarray) -> np.ndarray:
    """Coordinates of the pivots as a simplex: row i has i coordinates, the last of them its height over the earlier ones.

    Pivots that lie in the plane of the earlier ones are left out, as their apex would have no height."""
    base = np.zeros((1, 0))
    used = [0]
    for i in range(1, len(pivots)):
        d = np.sqrt(((pivots[used] - pivots[i])**2).sum(axis=1))
        apex = simplex_apex(d[None, :], base)[0]
        if apex[-1] > 1e-3 * max(1.0, d.max()):
            base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apex])
            used.append(i)
    return np.hstack([np.array(used, dtype=np.float64)[:, None], base])  # first column: which pivot


def simplex_apex(d: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Apex coordinates of rows of distances d to the pivots of ``base`` (without the column of numbers); the last one is the height."""
    n = len(base)
    square, out = d**2, np.zeros((len(d), n))
    for i in range(1, n):  # the apex is d[0] from the origin and d[i] from pivot i: the difference is linear in coordinate i - 1
        own = base[i, :i]
        out[:, i - 1] = ((square[:, 0] - square[:, i] + (own**2).sum()) / 2 - out[:, :i - 1] @ own[:-1]) / own[-1]
    out[:, n - 1] = np.sqrt(np.maximum(square[:, 0] - (out[:, :n - 1]**2).sum(axis=1), 0))
    return out


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((v[:, None, :] - pivots[None, :, :])**2).sum(axis=2), 0))


def bounds(apex: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between the originals of two sets of apexes."""
    flat = ((apex[:, None, :-1] - of[None, :, :-1])**2).sum(axis=2)
    low = flat + (apex[:, None, -1] - of[None, :, -1])**2
    return low, flat + (apex[:, None, -1] + of[None, :, -1])**2


def nearest(v: np.ndarray, apex: np.ndarray, centroids: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of every integer vector (ties: the smaller number), its squared distance, and the pairs compared."""
    with np.errstate(over="ignore", invalid="ignore"):
        low, high = bounds(apex, of)
    slack = 1e-6 * (high.max(axis=1, keepdims=True) + 1)  # far above the rounding of doubles
    at, to = np.nonzero(~(low > high.min(axis=1, keepdims=True) + slack))  # bounds too large for doubles exclude nothing
    exact = ((v[at] - centroids[to])**2).sum(axis=1)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, dtype=np.int64)
    if exact.dtype == object:
        best = np.array([min(exact[a:z]) for a, z in zip(starts, np.append(starts[1:], len(at)), strict=True)], dtype=object)
    else:
        best = np.minimum.reduceat(exact, starts) if len(starts) else exact
    hit = np.flatnonzero(exact == np.repeat(best, np.diff(np.append(starts, len(at)))))
    first = hit[np.concatenate([[True], at[hit][1:] != at[hit][:-1]])] if len(hit) else hit
    return to[first], best, len(at)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _stored(pivots: np.ndarray, base: np.ndarray):
    """Arrow function: the apex of every vector, beside it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, sides = pivots[base[:, 0].astype(int)], base[:, 1:]
        for batch in batches:
            for lo in range(0, batch.num_rows, _BLOCK):
                block = batch.slice(lo, _BLOCK)
                v = whole_numbers(_matrix(block.column("v"))).astype(np.float64)
                apex = simplex_apex(distances(v, chosen), sides)
                lists = pa.ListArray.from_arrays(np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32), apex.ravel())
                yield pa.RecordBatch.from_arrays([block.column("vec_id"), block.column("v"), lists], names=["vec_id", "v", "apex"])
    return run


def _rounds(pivots: np.ndarray, base: np.ndarray, centroids: list[list[int]], final: bool):
    """Arrow function: assignments, or each task's sums and counts per centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, sides = pivots[base[:, 0].astype(int)], base[:, 1:]
        large = max((abs(x) for c in centroids for x in c), default=0) >= _SAFE
        cent = np.array(centroids, dtype=object if large else np.int64)
        of = simplex_apex(distances(cent.astype(np.float64), chosen), sides)
        total, count = np.zeros(cent.shape, dtype=object), np.zeros(len(cent), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, _BLOCK):
                block = batch.slice(lo, _BLOCK)
                v = whole_numbers(_matrix(block.column("v")))
                to, best, _ = nearest(v, _matrix(block.column("apex")), cent, of)
                if final:
                    fits = [int(x) if int(x) < 1 << 63 else None for x in best]
                    yield pa.RecordBatch.from_arrays([block.column("vec_id"), pa.array(to.astype(np.int32)), pa.array(fits, pa.int64())],
                                                     names=["vec_id", "cluster", "distance"])
                else:
                    part = np.zeros(cent.shape, dtype=v.dtype)
                    np.add.at(part, to, v)
                    total += part
                    count += np.bincount(to, minlength=len(cent))
        if not final:
            out = [(int(c), int(count[c]), i, *limb) for c in np.flatnonzero(count) for i, x in enumerate(total[c]) for limb in _limbs(int(x))]
            yield pa.RecordBatch.from_pylist([dict(zip(_SUMS.names, r, strict=True)) for r in out], schema=_SUMS)
    return run


def _limbs(x: int) -> Iterator[tuple[int, Decimal]]:
    """Signed digits of x to the base 10**27, so that sums of any size stay exact in decimals; one for usual values."""
    sign, rest, limb = (-1 if x < 0 else 1), abs(x), 0
    while limb == 0 or rest:
        rest, low = divmod(rest, _LIMB)
        yield limb, Decimal(sign * low)
        limb += 1


def moved(rows: DataFrame, pivots: np.ndarray, base: np.ndarray, centroids: list[list[int]]) -> list[list[int]]:
    """Centroids after one round: componentwise floor of the exact mean of their vectors; empty ones stay."""
    sums = rows.select("vec_id", "v", "apex").mapInArrow(_rounds(pivots, base, centroids, False), "cluster int, n long, i int, limb int, x decimal(38,0)")
    added = sums.groupBy("cluster", "i", "limb").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()  # k x dimension rows
    total, count = {}, {}
    for r in added:
        at = r["cluster"], r["i"]
        total[at] = total.get(at, 0) + int(r["x"]) * _LIMB**r["limb"]
        count[at] = max(count.get(at, 0), r["n"])  # the lowest limb is there for every task
    out = [list(c) for c in centroids]
    for (c, i), x in total.items():
        out[c][i] = x // count[c, i]
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimension: int = DIMENSION, pivots: int = PIVOTS, salt: str = "2:",
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), F.transform(vectors[embedding], lambda x: x.cast("double")).alias("v")).where(
        usable(F.col("v"), dimension))
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    seeds = [r["v"] for r in rows.orderBy(name.asc_nulls_last(), "v").limit(k).collect()]  # k rows
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return spark.createDataFrame([], schema)
    x = np.array(seeds, dtype=np.float64)
    centroids = [[int(a) for a in row] for row in whole_numbers(x)]
    start = np.array(centroids, dtype=np.float64)[:pivots]
    base = pivot_base(start)
    stored = stage(rows.mapInArrow(_stored(start, base), "vec_id long, v array<double>, apex array<double>"), "apexes")
    for _ in range(rounds):
        centroids = moved(stored, start, base, centroids)
    last = stage(stored.mapInArrow(_rounds(start, base, centroids, True), "vec_id long, cluster int, distance long"), "assigned")
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    per = last.groupBy("cluster").agg(F.count("*").alias("n"), F.count("distance").alias("known"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()
    fits = lambda n, known, x: int(x) if n == known and int(x) < 1 << 63 else None
    whole = fits(sum(r["n"] for r in per), sum(r["known"] for r in per), sum(r["x"] or 0 for r in per))
    sides = spark.createDataFrame([(r["cluster"], fits(r["n"], r["known"], r["x"]), whole, digest[r["cluster"]]) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # k rows
    return last.join(F.broadcast(sides), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
