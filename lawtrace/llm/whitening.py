"""Whitening of embedding vectors through MLlib block matrices.

Vectors are put on an integer grid, and each distinct grid vector, the fit list, is centred, numbered and dealt into
blocks of a ``BlockMatrix``. Its transpose times itself is the scatter, whose eigenvectors are found on the driver (it has
one row and column for each dimension); the block matrix times the whitening matrix gives the projections. Grid values
are whole numbers, so counts, sums and deviations are exact in any order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.llm.storage import Scratch

STEPS, SHIFT = 64, 1_000_000  # grid: x = floor(STEPS * c) + SHIFT
LARGEST = 2.0**34  # entries from here on do not fit the grid
FLAT = 1e-12  # eigenvalues up to this share of the largest are rounding


@dataclass
class Whitening:
    """n grid vectors with sums by dimension, the covariance's trace, and by column the kept unit eigenvectors with their
    eigenvalues, largest first; ``error`` is the largest entry by which the whitened fit list's covariance misses the identity."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    error: float


def on_grid(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part."""
    c = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("c"))
    fits = lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False))  # noqa: E731  # NaN is above every number
    # filters may be taken in any order, so what does not fit has no grid value either
    x = c.where(F.col("c").isNotNull() & F.forall("c", fits)).select("vec_id", F.transform("c", lambda e: F.when(fits(e), F.floor(e * STEPS).cast("long") + SHIFT)).alias("x"))
    lengths = x.groupBy(F.size("x").alias("dims")).count().where("dims > 0").orderBy(F.desc("count"), F.desc("dims")).first()
    return x.where(F.size("x") == (lengths["dims"] if lengths else 0)).where("size(x) > 0")


def column_sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows of ``fit`` and exact sums of x: one row for each dimension and task is summed up, one for each dimension comes back."""

    def partial(batches):
        n, sums = 0, None
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0), np.int64)
            if x.size:
                n, sums = n + len(x), x.sum(0) + (0 if sums is None else sums)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums), pa.array(np.full(len(sums), n, np.int64))], ["dim", "s", "n"])

    found = fit.select("x").mapInArrow(partial, "dim int, s long, n long").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


def numbered(fit: DataFrame) -> DataFrame:
    """``fit`` with ``idx``, 0 to n - 1: a row's place in its stored part after the parts before it."""
    counts = fit.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.selectExpr("part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as before")  # one row for each part
    return fit.join(before, "part").select((F.col("before") + F.col("local")).alias("idx"), "x")


def block_matrix(rows: DataFrame, rows_per_block: int, cols_per_block: int) -> BlockMatrix:
    """Blocks of the indexed rows ``(idx, y array<double>)``."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("idx", array_to_vector("y").alias("y")), "y")
    return IndexedRowMatrix(vectors).toBlockMatrix(rows_per_block, cols_per_block)


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``; the shared dimension is cut into ``splits`` tasks, whose small sums are added up."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _identity_error(z: DataFrame, n: int, k: int) -> float:
    """Of rows ``(z array)``, whose fit list is centred already: partial sums of z and of its products, k + k * k numbers a task."""

    def partial(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                m = batch.column(0).flatten().to_numpy().reshape(-1, k)
                total[:k] += m.T @ m
                total[k] += m.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["at", "s"])

    total = np.zeros((k + 1) * k)
    for r in z.mapInArrow(partial, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect():
        total[r["at"]] = r["s"]
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(rows: DataFrame, k: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", rows_per_block: int = 4096, cols_per_block: int = 1024) -> tuple[DataFrame, Whitening | None]:
    """``(vec_id, deviation, whitened array<double>)`` of every row that takes part, and the model.

    Rows take part unless their vector is null or empty, holds a null, a NaN, an infinity or an entry of 2 ** 34 or more, or has another
    length than most vectors of the table (the longer, if two lengths are as frequent). The fit list holds every distinct grid vector
    once; copies share its projection, and repeated rows and null ids each keep a row of their own. ``whitened`` has one entry for each
    of the first ``k`` components whose eigenvalue is not zero (up to rounding), so fewer if the fit list spans fewer dimensions, and
    none for a single vector. The sign of a component makes its largest entry positive. ``deviation`` is null where no long
    holds it. An empty table has no rows and no model.

    The fit list is projected once and joined back by grid vector; what comes to the driver is the scatter and the whitening matrix, of
    dimensions squared, the shares of parts, and MLlib's list of block numbers, one for each ``rows_per_block`` vectors.
    """
    spark = rows.sparkSession
    own, lasting = Scratch(spark), Scratch(spark)
    grid = on_grid(rows, id_col, vec_col)
    place = F.monotonically_increasing_id()
    fit = own.written(grid.select("x").distinct().select(F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("local"), "x"), "fit")
    n, sums = column_sums(fit)
    none = grid.select("vec_id", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    if not n:
        own.drop()
        return none.limit(0), None
    listed = "array(" + ", ".join(f"{s}L" if abs(s) < 1 << 63 else "cast(null as long)" for s in sums) + ")"
    means = "array(" + ", ".join(f"{s / n!r}D" for s in sums) + ")"
    off = f"zip_with(x, {listed}, (a, s) -> try_subtract(try_multiply({n}L, a), s))"
    y = f"zip_with(off, zip_with(x, {means}, (a, m) -> a - m), (o, d) -> coalesce(o / {n}D, d))"
    deviation = "aggregate(off, 0L, (t, o) -> try_add(t, try_multiply(o, o)))"
    centred = own.written(numbered(fit).selectExpr("idx", "x", f"{off} as off").selectExpr("idx", "x", f"{deviation} as deviation", f"{y} as y"), "centred")

    a = block_matrix(centred, rows_per_block, cols_per_block)
    scatter = product(a.transpose(), a, max(1, n // (8 * rows_per_block))).toLocalMatrix().toArray()
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, vectors, trace = values[::-1], vectors[:, ::-1], float(np.trace(scatter) / n)
    kept = min(k, int((values > FLAT * max(values[0], 0.0)).sum())) if values[0] > 0 else 0
    values, vectors = values[:kept], vectors[:, :kept]
    if not kept:
        out = grid.join(lasting.written(centred.select("x", "deviation"), "projected"), "x").select("vec_id", "deviation", F.array().cast("array<double>").alias("whitened"))
        own.drop()
        return out, Whitening(n, sums, trace, values, vectors, 0.0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(kept)])
    matrix = vectors / np.sqrt(values)
    blocks = [((i, 0), Matrices.dense(len(b), kept, b.T.ravel())) for i, b in enumerate(np.split(matrix, range(cols_per_block, len(matrix), cols_per_block)))]
    z = product(a, BlockMatrix(spark.sparkContext.parallelize(blocks), cols_per_block, kept, len(matrix), kept), 1).toIndexedRowMatrix()
    z = callMLlibFunc("getIndexedRows", z._java_matrix_wrapper._java_model).select(F.col("index").alias("idx"), vector_to_array("vector").alias("whitened"))
    projected = lasting.written(centred.select("idx", "x", "deviation").join(z, "idx").select("x", "deviation", "whitened"), "projected")
    error = _identity_error(projected.select("whitened"), n, kept)
    own.drop()
    return grid.join(projected.hint("merge"), "x").select("vec_id", "deviation", "whitened"), Whitening(n, sums, trace, values, vectors, error)
