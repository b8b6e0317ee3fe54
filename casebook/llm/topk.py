"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one more component that gives all of them the same norm M, so the largest
inner product is the smallest Euclidean distance. Each is keyed by its nearest pivot and
the distance to it; sorted by that key they are cut into annuli of ``ANNULUS_ROWS`` rows.
A query's own annulus gives a first bound on its k-th best score. By the triangle
inequality only annuli whose distances to their pivot lie within the search radius of
the query's own distance can hold a better one; the rest are never joined. Queries
travel in blocks, and a query's radius is checked again inside the joined annulus.

Nothing is approximate: pivots (from a bounded sample) only steer how much is pruned.
Identical vectors share a key and are spread over annuli by their ids.

Defined results: vectors that are null or hold a null or non-finite component, and rows
without an id, take no part; shorter vectors count as padded with zeros; a row is never
a candidate for the query of the same id. Integer scores up to 2**53 are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import stage

PIVOTS = 16
PIVOT_SAMPLE = 2048  # rows, the first by a hash of their id
ANNULUS_ROWS = 2048
QUERY_STEP = 20
SCALE = 64
SLACK = 1e-6  # of the norm, for rounding in distances


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(64 x) of each usable vector, as doubles (whole numbers)."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))
            .select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v")))


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows padded with zeros to ``dim``."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    lens, flat = np.diff(offsets), np.asarray(lists.flatten(), dtype=np.float64)
    out = np.zeros((len(lens), dim))
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lens)] = flat
    return out


def choose_pivots(sample: np.ndarray, norm: float, count: int = PIVOTS) -> np.ndarray:
    """Farthest-first points of the sample, with their last component."""
    points = lifted(sample, norm)
    chosen = [0]
    near = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(count, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def lifted(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", x, x), 0))
    return np.hstack([x, rest[:, None]])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


ANNULI = "pivot int, low double, high double, ids binary, vectors binary"
SEEDED = "ids binary, vectors binary, bounds binary"


class Index:
    """The annuli as a staged table, with what is needed to key a query."""

    def __init__(self, vectors: DataFrame, k: int):
        self.k = k
        vectors = stage(vectors, "topk-vectors")
        top = vectors.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("n2"), F.max(F.size("v")).alias("dim")).first()
        self.norm, self.dim = float(np.sqrt(top["n2"] or 0.0)), top["dim"] or 0
        sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").toArrow()  # PIVOT_SAMPLE rows
        lists = sample.column("v").combine_chunks()
        self.empty = not len(lists)
        if self.empty:
            return
        self.pivots = choose_pivots(_matrix(lists, self.dim), self.norm)
        self.annuli = stage(self._cut(self._keyed(vectors)), "topk-annuli")

    def _keyed(self, vectors: DataFrame) -> DataFrame:
        dim, norm, pivots = self.dim, self.norm, self.pivots

        def run(batches):
            for batch in batches:
                x = _matrix(batch.column("v"), dim)
                d = distances(lifted(x, norm), pivots)
                near = d.argmin(1) if len(d) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]),
                                                  pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "pivot", "distance", "vector"])

        return vectors.mapInArrow(run, "vec_id long, pivot int, distance double, vector binary")

    def _cut(self, keyed: DataFrame) -> DataFrame:
        """Rows in key order, cut where the pivot changes and after ``ANNULUS_ROWS``."""

        def run(batches):
            held: pa.Table | None = None

            def out(t):
                return pa.RecordBatch.from_arrays(
                    [t.column("pivot")[:1].combine_chunks(), pa.array([t.column("distance")[0].as_py()]), pa.array([t.column("distance")[-1].as_py()]),
                     pa.array([np.asarray(t.column("vec_id")).astype(np.int64).tobytes()], pa.binary()), pa.array([b"".join(t.column("vector").to_pylist())], pa.binary())],
                    ["pivot", "low", "high", "ids", "vectors"])

            for batch in batches:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                while held.num_rows:
                    pivot = np.asarray(held.column("pivot"))
                    same = int(np.searchsorted(pivot, pivot[0], side="right"))
                    cut = min(same, ANNULUS_ROWS)
                    if cut == held.num_rows and cut < ANNULUS_ROWS:
                        break  # more may follow
                    yield out(held.slice(0, cut))
                    held = held.slice(cut)
            if held is not None and held.num_rows:
                yield out(held)

        return keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id").mapInArrow(run, ANNULI)

    def _seeded(self) -> DataFrame:
        """Per annulus its queries with the bound that the annulus alone gives."""
        dim, k = self.dim, self.k

        def run(batches):
            for batch in batches:
                for ids, vectors in zip(batch.column("ids").to_pylist(), batch.column("vectors").to_pylist()):
                    ids, x = np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, dim)
                    mine = np.flatnonzero(ids % QUERY_STEP == 0)
                    if not len(mine):
                        continue
                    scores = x[mine] @ x.T
                    scores[ids[mine][:, None] == ids[None]] = -np.inf
                    bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(mine), -np.inf)
                    yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (ids[mine], x[mine], bound)], ["ids", "vectors", "bounds"])

        return self.annuli.mapInArrow(run, SEEDED)

    def _annuli_wanted(self, seeded: DataFrame) -> DataFrame:
        """Per query block and pivot the range of distances that it must see."""
        dim, norm, pivots = self.dim, self.norm, self.pivots

        def run(batches):
            for batch in batches:
                for ids, vectors, bounds in zip(*(batch.column(c).to_pylist() for c in ("ids", "vectors", "bounds"))):
                    q = np.frombuffer(vectors).reshape(-1, dim)
                    d, radius = query_keys(q, np.frombuffer(bounds), norm, pivots)
                    n = len(pivots)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(n, dtype=np.int32)), pa.array((d - radius[:, None]).min(0)), pa.array((d + radius[:, None]).max(0)),
                         *[pa.array([b] * n, pa.binary()) for b in (ids, vectors, bounds)]],
                        ["q_pivot", "q_low", "q_high", "q_ids", "q_vectors", "q_bounds"])

        return seeded.mapInArrow(run, "q_pivot int, q_low double, q_high double, q_ids binary, q_vectors binary, q_bounds binary")

    def search(self) -> DataFrame:
        """``query_id, rank, vec_id, score`` of every query."""
        dim, norm, pivots, k = self.dim, self.norm, self.pivots, self.k
        wanted = self._annuli_wanted(stage(self._seeded(), "topk-queries"))
        pairs = self.annuli.join(wanted, (F.col("pivot") == F.col("q_pivot")) & (F.col("low") <= F.col("q_high")) & (F.col("high") >= F.col("q_low")))

        def run(batches):
            for batch in batches:
                for p, low, high, ids, vectors, q_ids, q_vectors, q_bounds in zip(*(batch.column(c).to_pylist() for c in ("pivot", "low", "high", "ids", "vectors", "q_ids", "q_vectors", "q_bounds"))):
                    ids, x = np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, dim)
                    q_ids, q, bounds = np.frombuffer(q_ids, np.int64), np.frombuffer(q_vectors).reshape(-1, dim), np.frombuffer(q_bounds)
                    d, radius = query_keys(q, bounds, norm, pivots[p:p + 1])
                    reach = np.flatnonzero((d[:, 0] - radius <= high) & (d[:, 0] + radius >= low))
                    out_q, out_v, out_s = [], [], []
                    scores = q[reach] @ x.T
                    for i, row in zip(reach, scores):
                        fit = np.flatnonzero((row >= bounds[i]) & (ids != q_ids[i]))
                        best = fit[_top(ids[fit], row[fit], k)]
                        out_q.append(np.full(len(best), q_ids[i]))
                        out_v.append(ids[best])
                        out_s.append(row[best])
                    if out_q:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_q)), pa.array(np.concatenate(out_v)), pa.array(np.concatenate(out_s).astype(np.int64))], ["query_id", "vec_id", "score"])

        found = pairs.select("pivot", "low", "high", "ids", "vectors", "q_ids", "q_vectors", "q_bounds").mapInArrow(run, "query_id long, vec_id long, score long")
        # At most k rows of a query and annulus arrive here.
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_keys(q: np.ndarray, bounds: np.ndarray, norm: float, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distances of the queries, last component 0, to the pivots; search radii)."""
    d = distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
    with np.errstate(invalid="ignore"):
        radius = np.sqrt(np.maximum(np.einsum("ij,ij->i", q, q) + norm * norm - 2 * bounds, 0))
    return d, radius + SLACK * (norm + 1)


def top_k(vectors: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k best of every row whose id is divisible by ``QUERY_STEP``, against all rows."""
    index = Index(integer_vectors(vectors, id_col, vec_col), k)
    if index.empty:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return index.search()


SQL = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
