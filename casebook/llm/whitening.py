"""Embedding whitening with covariances by polarisation.

Each entry c becomes the integer x = floor(256 c). The covariance is fitted on the
distinct x-vectors. For every dimension i and every pair i < j one variance is summed,
Var(x_i) and Var(x_i + x_j); their differences give all cross-covariances:
2 Cov(x_i, x_j) = Var(x_i + x_j) - Var(x_i) - Var(x_j).

All sums are exact integers. Values are centred on the rounded mean m before squaring,
so they stay as small as their spread; with R = S - n m the exact identity
n * sum((y - S/n)**2) = n * sum((y - m)**2) - R**2 takes the mean's fraction out again,
in Python integers. ``eigh`` then sees each covariance rounded once.

What is spread: packing, deduplication (a shuffle of the packed distinct vectors, reduced
before it, so a very common vector is one row a task), the two passes over the fitted
vectors and the projection. The driver gets one row for each dimension and each pair,
whatever the number of vectors.

Defined results: null vectors and those with a null or non-finite entry are dropped;
shorter vectors count as padded with zeros, so an empty one is all zeros; an entry beyond
a long counts as the nearest long. Repeated rows and rows without an id each get their
rows, equal vectors weigh once in the fit. A component whose eigenvalue is zero within
rounding has a null ``whitened``, is left out of ``identity_error``, and if none remains
that is null. ``deviation`` is null where its exact value is beyond a long. Other columns
of the input, whatever their names, are left behind; an empty table, or one of empty
vectors only, gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import spread, stage

SCALE = 256
COMPONENTS = 4
ROWS_AT_ONCE = 2048  # vectors held as one matrix
WIDTHS = (1, 2, 4, 8)  # bytes an entry may take in a packed vector
LONG = 2**63


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the integer vector of each usable row, packed (see :func:`pack`)."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))
    whole = usable.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pack(batch.column("x"))], ["vec_id", "x"])

    id_type = whole.schema["vec_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"vec_id {id_type}, x binary")


def pack(lists: pa.Array) -> pa.Array:
    """One binary a vector: the bytes an entry takes (the fewest that hold all of them),
    then the entries without trailing zeros. Equal padded vectors pack alike."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = np.asarray(lists.values).astype(np.int64)
    out = []
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        v = flat[start:stop]
        used = np.flatnonzero(v)
        v = v[:used[-1] + 1] if len(used) else v[:0]
        low, high = (int(v.min()), int(v.max())) if len(v) else (0, 0)
        width = next(w for w in WIDTHS if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
        out.append(bytes([width]) + v.astype(f"<i{width}").tobytes())
    return pa.array(out, pa.binary())


def unpack(packed: pa.Array, dim: int = 0) -> np.ndarray:
    """Rows of long, padded with zeros to ``dim`` or the longest vector."""
    raw = packed.to_pylist()
    widths = np.array([r[0] for r in raw], np.int64)
    lens = (np.array([len(r) for r in raw], np.int64) - 1) // np.maximum(widths, 1)
    out = np.zeros((len(raw), max(dim, int(lens.max(initial=0)))), np.int64)
    for width in WIDTHS:
        rows = np.flatnonzero(widths == width)
        flat = np.frombuffer(b"".join(raw[r][1:] for r in rows), f"<i{width}")
        out[np.repeat(rows, lens[rows]), spread(lens[rows], np.zeros(len(rows), np.int64))] = flat
    return out


def _pieces(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _wide(bound: int, rows: int) -> bool:
    """Whether ``rows`` values of at most ``bound`` may sum beyond a long."""
    return bound * max(rows, 1) >= LONG // 2


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def dimension_sums(fitted: DataFrame) -> tuple[int, list[int], list[int], list[int]]:
    """Number of vectors, and each dimension's exact sum, minimum and maximum."""

    def run(batches):
        n, total, low, high = 0, [], [], []
        for piece in _pieces(batches):
            x = unpack(piece.column(0), len(total))
            n += len(x)
            grown = x.shape[1] - len(total)
            for held in (total, low, high):  # bounds always hold the zero of padded entries
                held.extend([0] * grown)
            biggest = max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
            sums = x.sum(axis=0, dtype=object) if _wide(biggest, len(x)) else x.sum(axis=0)
            for j in range(x.shape[1]):
                total[j] += int(sums[j])
                low[j], high[j] = min(low[j], int(x[:, j].min())), max(high[j], int(x[:, j].max()))
        dims = [-1, *range(len(total))]
        yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), _decimals([n, *total]), pa.array([0, *low], pa.int64()), pa.array([0, *high], pa.int64())], ["dim", "total", "low", "high"])

    parts = fitted.mapInArrow(run, "dim int, total decimal(38,0), low long, high long")
    rows = {r["dim"]: r for r in parts.groupBy("dim").agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")).collect()}  # a row for each dimension
    n, dims = int(rows[-1]["total"]) if -1 in rows else 0, range(len(rows) - 1)
    return n, [int(rows[d]["total"]) for d in dims], [rows[d]["low"] for d in dims], [rows[d]["high"] for d in dims]


def squared_sums(fitted: DataFrame, centre: list[int], reach: int) -> dict[tuple[int, int], int]:
    """Exact sums of d_i**2 under (i, i) and of (d_i + d_j)**2 under (i, j), i < j, where
    d = x - centre and ``reach`` bounds \\|d\\|."""
    dim = len(centre)
    mid = np.array(centre, dtype=object if reach >= LONG // 4 else np.int64)
    square = (2 * reach) ** 2
    wide = _wide(square, ROWS_AT_ONCE)

    def run(batches):
        first, second = np.triu_indices(dim)
        held = np.zeros((dim, dim), dtype=object)
        recent, room = np.zeros((dim, dim), dtype=np.int64), 0
        for piece in _pieces(batches):
            x = unpack(piece.column(0), dim)
            d = np.ascontiguousarray((x.astype(object) if wide else x).T - (mid.astype(object) if wide else mid)[:, None])
            if not wide and _wide(square, room + len(x)):
                held, recent, room = held + recent, np.zeros((dim, dim), dtype=np.int64), 0
            into = held if wide else recent
            room += len(x)
            for i in range(dim):
                pair = d[i:] + d[i]
                pair[0] = d[i]  # the dimension itself
                into[i, i:] += (pair * pair).sum(axis=1)
        held = held + recent
        totals = [int(t) for t in held[first, second]]
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.int32()), pa.array(second, pa.int32()), _decimals(t // LONG for t in totals), _decimals(t % LONG for t in totals)], ["i", "j", "high", "low"])

    parts = fitted.mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # a row for each pair of dimensions
    return {(r["i"], r["j"]): int(r["high"]) * LONG + int(r["low"]) for r in rows}


def covariance(n: int, sums: list[int], centre: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix, each entry its exact value rounded once."""
    dim = len(sums)
    rest = [s - n * m for s, m in zip(sums, centre, strict=True)]
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(dim)]  # n**2 Var(x_i)
    out = np.zeros((dim, dim))
    for (i, j), total in squares.items():
        if i == j:
            out[i, i] = own[i] / n**2
        else:
            both = n * total - (rest[i] + rest[j]) ** 2  # n**2 Var(x_i + x_j)
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return out


class Whitener:
    """What was fitted: ``n``, ``sums``, the covariance, its eigenvalues in falling order
    and its unit eigenvectors as columns (largest entry of each positive)."""

    def __init__(self, packed: DataFrame):
        self.fitted = stage(packed.select("x").distinct(), "whitening-fit")
        self.n, self.sums, low, high = dimension_sums(self.fitted)
        if not self.n or not self.sums:
            self.values, self.vectors, self.centre, self.reach, self.usable = np.zeros(0), np.zeros((0, 0)), [], 0, []
            return
        self.centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.reach = max(max(h - m, m - lo) for lo, h, m in zip(low, high, self.centre, strict=True)) + 1
        self.covariance = covariance(self.n, self.sums, self.centre, squared_sums(self.fitted, self.centre, self.reach))
        values, vectors = np.linalg.eigh(self.covariance)
        self.values, vectors = values[::-1], vectors[:, ::-1]
        largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
        self.vectors = vectors * np.where(largest < 0, -1.0, 1.0)
        least = max(self.values[0], 0.0) * len(values) * np.finfo(float).eps
        self.usable = [bool(v > least) for v in self.values]

    def explained(self) -> list[float]:
        total = float(np.trace(self.covariance)) if len(self.values) else 0.0
        return [max(float(v), 0.0) / total if total > 0 else 0.0 for v in self.values]

    def project(self, packed: DataFrame, components: int = COMPONENTS) -> DataFrame:
        """``vec_id, deviation, whitened`` (one entry a component) for each packed row."""
        n, sums, centre, reach, dim = self.n, self.sums, self.centre, self.reach, len(self.values)
        k = min(components, dim)
        axes = [self.vectors[:, c] / np.sqrt(self.values[c]) if self.usable[c] else None for c in range(k)]
        left = [s - n * m for s, m in zip(sums, centre, strict=True)]
        rest = np.array([r / n for r in left])
        wide = _wide((n * reach) ** 2, dim)

        def run(batches):
            for piece in _pieces(batches):
                x = unpack(piece.column("x"), dim)
                d = (x.astype(object) if wide else x) - np.array(centre, dtype=object if wide else np.int64)
                off = n * d - np.array(left, dtype=d.dtype)  # n x - S
                deviation = (off * off).sum(axis=1)
                if wide:
                    deviation = [int(t) if t < LONG else None for t in deviation]
                centred = d.astype(float) - rest
                flat = np.full((len(x), k), np.nan)
                for c, axis in enumerate(axes):
                    if axis is not None:  # one dimension after the other, so a row's value doesn't depend on its batch
                        flat[:, c] = 0.0
                        for d in range(dim):
                            flat[:, c] += centred[:, d] * axis[d]
                values = pa.array(flat.ravel(), mask=np.tile(np.array([a is None for a in axes], dtype=bool), len(x)))
                white = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), pa.array(deviation, pa.int64()), white], ["vec_id", "deviation", "whitened"])

        id_type = packed.schema["vec_id"].dataType.simpleString()
        return packed.mapInArrow(run, f"vec_id {id_type}, deviation long, whitened array<double>")

    def identity_error(self, components: int = COMPONENTS) -> float | None:
        """Largest absolute entry of the fitted vectors' whitened covariance minus the
        identity, measured by polarisation as well; to twelve decimals, as the order of
        adding doubles is not fixed."""
        kept = [c for c in range(min(components, len(self.values))) if self.usable[c]]
        if not kept:
            return None
        white = self.project(self.fitted.select(F.lit(0).alias("vec_id"), "x"), components)
        w = {c: F.col("whitened")[c] for c in kept}
        sums = [F.var_pop(w[a] + w[b] if a != b else w[a]).alias(f"v_{a}_{b}") for a in kept for b in kept if a <= b]
        row = white.agg(*sums).first()
        worst = 0.0
        for a in kept:
            for b in kept:
                if a <= b:
                    got = row[f"v_{a}_{b}"] if a == b else (row[f"v_{a}_{b}"] - row[f"v_{a}_{a}"] - row[f"v_{b}_{b}"]) / 2
                    worst = max(worst, abs(got - (a == b)))
        return round(worst, 12)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component up to ``components`` (by falling
    eigenvalue): vec_id, component, n, deviation, whitened, explained, identity_error."""
    packed = integer_vectors(vectors, id_col, vec_col)
    fit = Whitener(packed)
    k = min(components, len(fit.values))
    share = F.array(*[F.lit(e) for e in fit.explained()[:k]]).cast("array<double>")
    long = fit.project(packed, components).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(share, F.col("at")).alias("explained"), F.lit(fit.identity_error(components)).cast("double").alias("identity_error"))
