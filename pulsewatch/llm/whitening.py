"""Whitening of embeddings by spectral divide and conquer.

Vectors are put on a grid of whole numbers, so that counts, sums and distances are exact. The covariance of the distinct vectors is
summed up in the tasks, one matrix each, and row by row across them. Its leading components come from QDWH splitting of invariant
subspaces (``qdwh``) on a matrix as wide as the vectors are long; mean and components, no larger, are sent to the tasks that
project every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsewatch.llm.common import pick, pieces, staged
from pulsewatch.llm.qdwh import components

GRID, SHIFT = 64, 1_000_000
#: Entries beyond this are cut to it; longer vectors are refused, since matrices of this width are held by driver and tasks.
LARGEST, WIDEST = 1 << 62, 4096
#: Components with a smaller share of the variance than this are rounding noise and left out.
LEAST_SHARE = 1e-11
ROWS = 4000
_KINDS = [np.int8, np.int16, np.int32, np.int64]


def _grid(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows with usable vectors, and floor(64 c) of these as a matrix, filled up with zeros to the longest."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.filter(column.is_valid()).flatten()
    values = pc.fill_null(flat.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(length)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = np.nonzero(column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - length]))[0]
    out = np.zeros((len(good), int(length[good].max(initial=0))), np.int64)
    inside = np.arange(out.shape[1]) < length[good, None]
    at = np.repeat(ends[good] - length[good], length[good]) + np.arange(out.shape[1])[None, :].repeat(len(good), 0)[inside] if len(good) else np.empty(0, np.int64)
    out[inside] = np.clip(np.floor(values[at] * GRID), -float(LARGEST), float(LARGEST)).astype(np.int64)
    return good, out


def _key(x: np.ndarray) -> bytes:
    """One grid vector as bytes, equal for equal vectors: the narrowest kind that holds it, without zeros at the end."""
    some = np.nonzero(x)[0]
    x = x[:some[-1] + 1] if len(some) else x[:0]
    kind = next(k for k, t in enumerate(_KINDS) if not len(x) or (np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max))
    return bytes([kind]) + x.astype(_KINDS[kind]).tobytes()


def _keys(batches):
    for batch in pieces(batches, ROWS):
        found = {_key(x) for x in _grid(batch.column("vec"))[1]}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary())], names=["x"])


def _matrix(keys: list[bytes], width: int = 0) -> np.ndarray:
    rows = [np.frombuffer(k, _KINDS[k[0]], offset=1) for k in keys]
    out = np.zeros((len(rows), max([width, *map(len, rows)])), np.int64)
    for mine, x in zip(out, rows):
        mine[:len(x)] = x
    return out


def _sums(batches):
    """(dim, high, low): what the entries of each dimension sum up to, in two parts; dimension -1 counts the vectors."""
    total, n = np.zeros((2, 0), np.int64), 0
    for batch in pieces(batches, ROWS):
        x = _matrix(batch.column("x").to_pylist(), total.shape[1])
        total = np.pad(total, ((0, 0), (0, x.shape[1] - total.shape[1]))) + np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)])
        n += len(x)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, total.shape[1], dtype=np.int32)), pa.array(np.append(0, total[0])), pa.array(np.append(n, total[1]))],
                                     names=["dim", "high", "low"])


def _products(mean):
    """(i, part): a task's rows of the products of centred vectors."""
    def run(batches):
        centre = mean.value
        out = np.zeros((len(centre), len(centre)))
        for batch in pieces(batches, ROWS):
            z = _matrix(batch.column("x").to_pylist(), len(centre)) - centre
            out += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array([r.tobytes() for r in out], pa.binary())], names=["i", "part"])
    return run


def _added(table: pa.Table) -> pa.Table:
    whole = np.sum([np.frombuffer(b) for b in table["part"].to_pylist()], axis=0)
    return pa.table([table["i"][:1], pa.array([whole.tobytes()], pa.binary())], names=["i", "part"])


def _moments(model):
    """(at, total): sums of the whitened vectors (first) and of their products."""
    def run(batches):
        centre, w = model.value
        one, two = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for batch in pieces(batches, ROWS):
            y = (_matrix(batch.column("x").to_pylist(), len(centre)) - centre) @ w.T
            one += y.sum(0)
            two += y.T @ y
        total = np.concatenate([one, two.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "total"])
    return run


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; None where one does not fit in 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * most * most < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    found = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return [f if f < 1 << 63 else None for f in found]


def _project(model, about):
    def run(batches):
        centre, w = model.value
        n, sums, explained, error = about.value
        k = len(w)
        for batch in pieces(batches, ROWS):
            good, x = _grid(batch.column("vec"))
            x = np.pad(x, ((0, 0), (0, max(0, len(centre) - x.shape[1]))))[:, :len(centre)]
            y = (x - centre) @ w.T
            each = pa.array(np.repeat(np.arange(len(good)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(good)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(good))),
                 pa.array(np.full(len(each), n, np.int64)), pa.array(_deviation(x, n, sums), pa.int64()).take(each), pa.array(y.ravel()),
                 pa.array(np.tile(explained, len(good))), pa.array(np.full(len(each), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whitened(rows: DataFrame, count: int = 16, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row, for the first ``count`` components.

    Rows whose vector is null or has null or non-finite entries go. Entry c becomes x = floor(64 c) + 1000000. The components are the
    eigenvectors of the covariance (divisor n) of the n distinct vectors, by falling eigenvalue; ``whitened`` is the centred x
    projected on one, over the square root of its eigenvalue; ``explained`` is its share of the whole variance; ``deviation`` is the
    sum of (n x - S)^2, S being the sums over the distinct vectors, exact, or null if it does not fit in 64 bits; ``identity_error``
    is how far the whitened vectors' own covariance is from the identity.

    Shorter vectors count as filled up with zeros. Directions without variance are no components: with one distinct vector there is
    no row. Repeated rows and null ids appear as often as they occur. Equal eigenvalues give some orthonormal basis, the same for
    all rows. Extra columns do not matter; an empty table gives an empty result.
    """
    rows = pick(rows, id_column, vector_column).toDF("vec_id", "vec")
    spark = rows.sparkSession
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    named = lambda df: df.withColumnRenamed("vec_id", id_column)
    # a frequent vector is met once a task before the shuffle
    fit = staged(rows.select("vec").mapInArrow(_keys, "x binary").distinct())
    sums = {r["dim"]: (int(r["high"]) << 32) + int(r["low"]) for r in
            fit.mapInArrow(_sums, "dim int, high long, low long").groupBy("dim").agg(
                *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).collect()}
    n = sums.pop(-1, 0)
    width = len(sums)
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; at most {WIDEST} are supported")
    values = np.empty(0)
    if n and width:
        total = [sums[k] for k in range(width)]
        centre = spark.sparkContext.broadcast(np.array([s / n for s in total]))
        parts = (fit.mapInArrow(_products(centre), "i int, part binary").groupBy("i").applyInArrow(_added, "i int, part binary").collect())
        covariance = np.stack([np.frombuffer(r["part"]) for r in sorted(parts)]) / n
        trace = np.trace(covariance)
        if trace > 0:
            values, vectors = components(covariance, min(count, width))
            some = values > LEAST_SHARE * trace
            values, vectors = values[some], vectors[:, some]
    if not len(values):
        return named(spark.createDataFrame([], schema))
    model = spark.sparkContext.broadcast((centre.value, (vectors / np.sqrt(values)).T.copy()))
    moments = {r["at"]: r["total"] for r in fit.mapInArrow(_moments(model), "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()}
    k = len(values)
    mean = np.array([moments[i] for i in range(k)]) / n
    second = np.array([moments[k + i] for i in range(k * k)]).reshape(k, k) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    about = spark.sparkContext.broadcast((n, total, values / trace, error))
    return named(rows.mapInArrow(_project(model, about), schema))
