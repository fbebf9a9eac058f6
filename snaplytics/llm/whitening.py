"""Embedding whitening with distributed block matrices.

Entries become integers on a grid of 1/64, each distinct vector enters the fit list once
(map-side distinct: a vector that a third of all rows share costs one row per task). The
fit list is numbered, centred and cut into the blocks of an MLlib ``BlockMatrix``; its
transpose times itself is the scatter, whose ``eigh`` (dimension x dimension numbers, never
rows) happens on the driver; the centred blocks times the whitening matrix are the projected
rows. The middle dimension of both products is split, so no task adds up all blocks of a
scatter. Counts, sums and deviations are exact integers.

Cases: rows whose vector is null, empty or holds null or non-finite entries are dropped, and
so are vectors of another length than the most frequent one (of ties the longest), for which
no common covariance exists; entries beyond 2^40 in size count as 2^40; a null ``vec_id``
stays; repeated rows give repeated results; an empty table gives no rows. A component whose
eigenvalue is zero to working precision (1e-12 of the largest) is whitened to 0.0 and left
out of ``identity_error``; with no variance at all ``explained`` is 0.0. A deviation that
does not fit a long is null. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged, table

GRID = 64
SHIFT = 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16

#: Rows of the fit list in one block, and columns at most.
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
#: Blocks that one task of a scatter multiplies before partial scatters are added.
BLOCKS_A_SPLIT = 8

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def on_grid(vector: Column) -> Column:
    """floor(64 * entry) + 1000000 of every entry, as long."""
    def step(c: Column) -> Column:
        c = F.least(F.greatest(c.cast("double"), F.lit(-LARGEST)), F.lit(LARGEST))
        return F.floor(c * GRID).cast("long") + F.lit(SHIFT).cast("long")
    return F.transform(vector, step)


def usable(vector: Column) -> Column:
    """The vector is not null and all its entries are finite."""
    def finite(c: Column) -> Column:
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))
    return vector.isNotNull() & F.forall(vector, finite)


def numbered(vectors: DataFrame) -> DataFrame:
    """Append ``index`` 0, 1, ... to a table's rows. Places inside a task are written with the
    rows, so that a task that runs again cannot renumber; one start per task is added up."""
    low = F.lit((1 << 33) - 1)
    placed = staged(vectors.withColumns({
        "part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(low)}), "whiten-fit")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))  # one row a task
    starts = sizes.selectExpr("part", "sum(rows) OVER (ORDER BY part) - rows AS start")
    return placed.join(broadcast_if_small(staged(starts, "whiten-starts")), "part") \
        .select(*vectors.columns, (F.col("start") + F.col("place")).alias("index"))


def block_matrix(rows: DataFrame, n: int, width: int, block_rows: int = BLOCK_ROWS) -> BlockMatrix:
    """A table (index, vector: array<double>) as a distributed matrix of blocks."""
    vectors = rows.select("index", array_to_vector("vector").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width) \
        .toBlockMatrix(block_rows, min(width, BLOCK_COLUMNS))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, as columns x columns numbers on the driver. The rows' blocks
    are dealt to several partial products, which are added afterwards."""
    blocks = -(-matrix.numRows() // matrix.rowsPerBlock)
    splits = max(1, -(-blocks // BLOCKS_A_SPLIT))
    left = matrix.transpose()
    product = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def block_rows(matrix: BlockMatrix) -> DataFrame:
    """The rows of a block matrix as a table (index, vector: array<double>)."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.toDF("index", "vector").select("index", vector_to_array("vector").alias("vector"))


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(dimension x components, eigenvalues): unit eigenvectors by falling eigenvalue, over
    the root of their eigenvalue; zero columns where that is zero."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    live = values > max(values[0], 0.0) * 1e-12
    values = np.where(live, values, 0.0)
    return np.where(live, vectors / np.sqrt(np.where(live, values, 1.0)), 0.0), values


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: key, component, n, deviation, whitened,
    explained, identity_error."""
    spark = rows.sparkSession
    good = rows.filter(usable(F.col(vector))).select(F.col(key).alias("vec_id"), on_grid(F.col(vector)).alias("x"))
    lengths = good.filter(F.size("x") > 0).groupBy(F.size("x").alias("width")).count() \
        .orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    width = lengths["width"]
    good = good.filter(F.size("x") == width)

    fit = numbered(good.select("x").distinct())
    sums = fit.select(F.posexplode("x").alias("dim", "v")).groupBy("dim") \
        .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    n = sums[0]["n"]
    total = F.split(F.lit(",".join(str(r["s"]) for r in sums)), ",").cast("array<decimal(38,0)>")  # one number a dimension
    gaps = F.zip_with("x", total, lambda x, s: (F.lit(n).cast("decimal(18,0)") * x.cast("decimal(19,0)") - s).cast("decimal(38,0)"))
    square = F.aggregate("gap", F.lit(0).cast("decimal(38,0)"),
                         lambda acc, g: F.try_add(acc, F.try_multiply(g, g)).cast("decimal(38,0)"))
    deviation = F.when(square <= (1 << 63) - 1, square).cast("long")
    centred = staged(fit.withColumn("gap", gaps).select(
        "index", "x", F.transform("gap", lambda g: g.cast("double") / n).alias("vector"), deviation.alias("deviation")),
        "whiten-centred")

    matrix = block_matrix(centred, n, width)
    covariance = scatter(matrix) / n
    k = min(components, width)
    projector, values = whitening_matrix(covariance, k)
    trace = float(np.trace(covariance))
    right = block_matrix(spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(projector)], "index long, vector array<double>"),
                         width, k, min(width, BLOCK_COLUMNS))
    projected = matrix.multiply(right)
    live = values > 0
    identity = scatter(projected)[:k, :k] / n - np.eye(k)
    error = float(np.abs(identity[live][:, live]).max()) if live.any() else 0.0
    white = staged(block_rows(projected).toDF("index", "white"), "whiten-projected")

    shares = F.split(F.lit(",".join(repr(float(v / trace) if trace > 0 else 0.0) for v in values)), ",").cast("array<double>")
    by_vector = centred.select("index", "x", "deviation").join(white, "index")
    return good.join(by_vector, "x").select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
