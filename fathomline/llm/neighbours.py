"""Nearest neighbours along several shifted Hilbert curves.

Unit vectors are projected at random to a few dimensions, shifted at random and put in the order of a Hilbert curve;
each ordering is cut into ranges of equal share (bounds from a bounded sample). A query is compared, with whole vectors,
with its own range and the ones beside it in every ordering, further ones where those hold few rows, and the orderings'
best are merged. Ranges larger than a
task should hold, such as those of one very common vector, are salted: members are spread, queries visit every part.

Ranges are a share of the rows, not a number: on data without low-dimensional structure recall follows the share seen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.wordvec import column

#: Rows that projections' ranges and bounds are fitted on, at most (those of smallest id hash).
SAMPLE = 20_000
ORDERINGS, DIMENSIONS, BITS, RANGES, PART_ROWS = 16, 8, 5, 32, 50_000
#: Rows that a query meets in an ordering, at least (besides ``k``): smaller tables are seen whole.
SEEN = 256


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each integer point (n, d) on the d-dimensional Hilbert curve of 2**bits cells a side; d * bits <= 63."""
    x = np.ascontiguousarray(points.T).astype(np.int64)
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations and reflections of each level, the coarsest first
        p = q - 1
        for i in range(d):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curves:
    frames: np.ndarray  # (orderings, dimension of vectors, projected dimensions)
    low: np.ndarray
    high: np.ndarray
    shift: np.ndarray
    bits: int
    bounds: list[np.ndarray] | None = None  # of each ordering: first keys of all ranges but the first, each held by a row
    parts: list[np.ndarray] | None = None  # of each ordering: salts of each range
    spans: list[list[tuple[int, int]]] | None = None  # of each ordering: for each range, the ranges that its queries visit

    def keys(self, unit: np.ndarray, k: int) -> np.ndarray:
        y = (unit @ self.frames[k] - self.low[k]) / (self.high[k] - self.low[k])
        cells = (np.clip(y, 0, 1) + self.shift[k]) / 2 * ((1 << self.bits) - 1)
        return hilbert(cells.astype(np.int64), self.bits)

    def ranges(self, unit: np.ndarray, k: int) -> np.ndarray:
        return np.searchsorted(self.bounds[k], self.keys(unit, k), "right")


def _spans(rows: np.ndarray, least: int) -> list[tuple[int, int]]:
    """For each range, itself and the ones beside it, widened by turns to both sides until they hold ``least`` rows or all."""
    total, out = np.r_[0, np.cumsum(rows)], []
    for b in range(len(rows)):
        low, high = max(b - 1, 0), min(b + 2, len(rows))
        while total[high] - total[low] < least and high - low < len(rows):
            low, high = max(low - 1, 0), min(high + 1, len(rows))
        out.append((low, high))
    return out


def fit(sample: np.ndarray, ids: np.ndarray, rows: int, orderings: int, ranges: int, k: int, seed: int = 17) -> Curves:
    r = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    d = min(DIMENSIONS, sample.shape[1])
    frames = np.stack([np.linalg.qr(r.normal(size=(sample.shape[1], d)))[0] for _ in range(orderings)])
    y = np.einsum("nd,kde->kne", unit, frames)
    low, high = y.min(1), y.max(1)
    curves = Curves(frames, low, np.where(high > low, high, low + 1), r.random((orderings, d)), BITS, [], [], [])
    _, once = np.unique(ids, return_index=True)
    for o in range(orderings):
        keys = curves.keys(unit, o)
        bounds = np.unique(np.quantile(keys, np.arange(1, ranges) / ranges, method="inverted_cdf").astype(np.int64))
        curves.bounds.append(bounds[bounds > keys.min()])
        at = np.searchsorted(curves.bounds[o], keys, "right")
        count = lambda x, n=len(curves.bounds[o]) + 1: np.bincount(x, minlength=n)
        curves.parts.append(np.maximum(1, np.ceil(count(at) / len(unit) * rows / PART_ROWS)).astype(np.int64))
        curves.spans.append(_spans(count(at[once]), max(SEEN, k + 1)))
    return curves


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _sender(curves: Curves, every: int, kind: str):
    """Members and queries of each range of each ordering, packed; components travel as ``kind``, which holds them exactly."""

    def send(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = column(batch, "vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
            x = _matrix(column(batch, "embedding"))
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            asks = np.flatnonzero(ids % every == 0)
            out = {"ordering": [], "range": [], "part": [], "query": [], "ids": [], "vectors": []}

            def put(k, b, part, query, at, ids=ids, x=x, out=out):
                for name, value in zip(out, (k, b, part, query, ids[at].tobytes(), x[at].astype(kind).tobytes()), strict=True):
                    out[name].append(value)

            for k in range(len(curves.frames)):
                at = curves.ranges(unit, k)
                salt = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % curves.parts[k][at]
                slot = at * (1 << 20) + salt
                order = np.argsort(slot, kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(slot[order])) + 1):
                    put(k, int(at[group[0]]), int(salt[group[0]]), False, group)
                for b in np.unique(at[asks]):
                    group = asks[at[asks] == b]
                    for near in range(*curves.spans[k][b]):
                        for part in range(curves.parts[k][near]):
                            put(k, int(near), int(part), True, group)
            yield pa.RecordBatch.from_arrays([pa.array(out["ordering"], pa.int32()), pa.array(out["range"], pa.int32()), pa.array(out["part"], pa.int32()), pa.array(out["query"], pa.bool_()), pa.array(out["ids"], pa.binary()), pa.array(out["vectors"], pa.binary())], names=list(out))

    return send


def nearest(ask_ids: np.ndarray, ask: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, cosine) of each query's k nearest rows but itself; equal cosines by id. Of rows that repeat an id, the
    nearest counts."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
    size, ask_size = np.sqrt((x * x).sum(1)), np.sqrt((ask * ask).sum(1))
    unit = x / size[:, None]
    out: list[tuple[int, int, float]] = []
    for i in range(0, len(ask), 256):
        rough = (ask[i : i + 256] / ask_size[i : i + 256, None]) @ unit.T
        rough[ask_ids[i : i + 256][:, None] == ids[None]] = -np.inf
        best = rough if len(first) == len(ids) else np.maximum.reduceat(rough, first, axis=1)
        m = min(k, len(first))
        floor = np.partition(best, len(first) - m, axis=1)[:, len(first) - m] - 1e-9
        for j, line in enumerate(rough):
            at = np.flatnonzero((line >= floor[j]) & (line > -np.inf))
            # the measure itself, summed the same way for every row, so that equal vectors tie
            exact = (x[at] * ask[i + j]).sum(1) / (size[at] * ask_size[i + j])
            found: dict[int, float] = {}
            for b in np.lexsort((ids[at], -exact)).tolist():
                found.setdefault(int(ids[at[b]]), float(exact[b]))
            out += [(int(ask_ids[i + j]), v, c) for v, c in list(found.items())[:k]]
    q, v, s = zip(*out, strict=True) if out else ((), (), ())
    return np.array(q, np.int64), np.array(v, np.int64), np.array(s)


def _searcher(k: int, kind: str):
    def search(batches):
        held: dict[tuple[int, int, int], dict[bool, list]] = {}
        for batch in batches:
            for o, r, p, query, ids, vectors in zip(*(column(batch, c).to_pylist() for c in ("ordering", "range", "part", "query", "ids", "vectors")), strict=True):
                ids = np.frombuffer(ids, np.int64)
                held.setdefault((o, r, p), {True: [], False: []})[query].append((ids, np.frombuffer(vectors, kind).astype(np.float64).reshape(len(ids), -1)))
        for sides in held.values():
            if sides[True] and sides[False]:
                (ask_ids, ask), (ids, x) = ((np.concatenate(y) for y in zip(*sides[side], strict=True)) for side in (True, False))
                q, v, s = nearest(ask_ids, ask, ids, x, k)
                if len(q):
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], names=["query_id", "vec_id", "score"])

    return search


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(vectors: DataFrame, every: int = 50, k: int = 5, orderings: int = ORDERINGS, ranges: int = RANGES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by cosine of each row whose vec_id is divisible by ``every``.

    Null, zero and non-finite vectors and rows without vec_id take no part. A cosine needs vectors of one length, so each
    length is searched on its own. Rows that repeat a vec_id count as one, by the vector that is nearest, and as queries
    by all their vectors; ties go to the smaller vec_id. Other columns are ignored.
    """
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()
    found = vectors.sparkSession.createDataFrame([], "query_id long, vec_id long, score double")
    for size in sizes:
        same = rows.where(F.size("embedding") == size["d"])
        sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding", "vec_id").toArrow()
        curves = fit(_matrix(sample.column(0).combine_chunks()), sample.column(1).to_numpy(), size["n"], orderings, ranges, k)
        sent = same.mapInArrow(_sender(curves, every, kind), "ordering int, range int, part int, query boolean, ids binary, vectors binary")
        found = found.unionByName(sent.repartition("ordering", "range", "part").mapInArrow(_searcher(k, kind), "query_id long, vec_id long, score double"))
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
