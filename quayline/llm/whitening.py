"""Whitening of embeddings by Spark MLlib's BlockMatrix.

Rows are numbered, centred and cut into dense blocks. The transpose times the blocks is the scatter matrix; the
product is split along the rows, so that every task adds up its own blocks and only matrices of dimension x dimension are
sent on. The driver takes that one small matrix apart by ``eigh``, and the blocks times the whitening matrix project the rows.

Entries become whole numbers first, ``floor(scale * entry) + offset``, so that sums and deviations are exact; the mean is
taken off before anything is multiplied.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from quayline.llm.common import forget, free_name, shuffle_partitions, small_or_joined, table, written

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
BLOCK_ENTRIES = 1 << 19  # doubles in a block, 4 MB
PARTITION_BITS = 33  # monotonically_increasing_id has the partition above these


def whole_numbers(rows: DataFrame, key: str, vector: str, scale: int, offset: int) -> DataFrame:
    """The valid rows as ``_key``, ``_row`` and ``_x``."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    valid = rows.where(v.isNotNull() & (F.size(v) > 0) & finite)
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale) + offset)
    return written(valid.select(F.col(f"`{key}`").alias("_key"), F.monotonically_increasing_id().alias("_row"),
                                x.alias("_x")), "numbers")


def of_usual_size(rows: DataFrame) -> DataFrame:
    """The rows whose vector has the size that most have."""
    size = rows.groupBy(F.size("_x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("_x") == (size["size"] if size else 0))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_index``: the rows of earlier partitions, and the place in its own. Where a vector of another size
    was left out a number is missing, which is a row of zeros to a matrix and adds nothing."""
    part = F.shiftright("_row", PARTITION_BITS)
    places = rows.select("_row", part.alias("_part"))
    # a row per partition, so the one task of the window is small
    before = places.groupBy("_part").agg(F.min("_row").alias("_first"), F.max("_row").alias("_last")).withColumn(
        "_before", F.coalesce(F.sum(F.col("_last") - F.col("_first") + 1).over(
            W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return (rows.withColumn("_part", part).join(small_or_joined(before), "_part")
            .withColumn("_index", F.col("_before") + F.col("_row") - F.col("_first")).drop("_part", "_before", "_first", "_last"))


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every entry."""
    sums = (rows.select(F.posexplode("_x").alias("_at", "_entry")).groupBy("_at")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_entry").cast("decimal(20,0)")).alias("total"))
            .orderBy("_at").collect())
    return (sums[0]["n"] if sums else 0), [int(r["total"]) for r in sums]


def blocks_of(rows: DataFrame, vector: Column, size: int) -> BlockMatrix:
    """The vectors of numbered rows as a distributed matrix of dense blocks, kept until ``free``."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("_index", array_to_vector(vector).alias("_v")), "_v")
    blocks = IndexedRowMatrix(vectors).toBlockMatrix(max(1, BLOCK_ENTRIES // size), size)
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def free(blocks: BlockMatrix) -> None:
    blocks.blocks.unpersist()
    blocks._java_matrix_wrapper.call("blocks").unpersist(False)


def scatter(blocks: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose times the matrix. ``splits`` tasks share the rows, which only the JVM's method can be told."""
    turned = blocks.transpose()
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def projected(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``_index`` and ``_y``: every row times a small matrix."""
    context = blocks._java_matrix_wrapper._sc
    height, width = matrix.shape
    small = Matrices.dense(height, width, matrix.ravel(order="F").tolist())
    product = blocks.multiply(BlockMatrix(context.parallelize([((0, 0), small)], 1), height, width))
    rows = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("_index"), vector_to_array("vector").alias("_y"))


def deviation(n: int, sums: list[int]) -> Column:
    """Sum of the squares of n * x - sum, exact up to 38 digits."""
    total = F.array(*[F.lit(s) for s in sums])
    number = lambda c: c.cast("decimal(38,0)")
    off = F.zip_with("_x", total, lambda x, s: number(x * F.lit(n) - s))
    return F.aggregate(off, number(F.lit(0)), lambda sum_, d: number(sum_ + number(d * d)))


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Every valid row's whitened components: ``key``, ``component`` from 1, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error`` and ``deviation_exact``.

    Vectors that are NULL or empty, or hold a NULL or an entry that is not finite, take no part, nor do those of another
    size than most have (of equally frequent sizes the greatest). A NULL key and repeated rows are rows like others. There
    are as many components as entries, if those are fewer. A component without variance whitens to 0 and plays no part in
    the error. ``deviation`` is NULL where it passes 64 bits; ``deviation_exact`` is a decimal. An empty table gives no
    rows; other columns play no part. Entries of 2^53 / scale and more raise.
    """
    spark = rows.sparkSession
    name = lambda c: free_name([key], c)
    numbers = whole_numbers(rows, key, vector, scale, offset)
    clean = of_usual_size(numbers)
    n, sums = totals(clean)
    if not n:
        kinds = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double",
                 "identity_error": "double", "deviation_exact": "decimal(38,0)"}
        return clean.select(F.col("_key").alias(key), *[F.lit(None).cast(t).alias(name(c)) for c, t in kinds.items()])
    indexed = numbered(clean)
    centred = F.zip_with("_x", F.array(*[F.lit(s) for s in sums]), lambda x, s: (x * F.lit(n) - s).cast("double") / n)
    size, width = len(sums), min(components, len(sums))
    blocks = blocks_of(indexed, centred, size)
    covariance = scatter(blocks, shuffle_partitions(spark)) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    # what rounding leaves of a variance of zero
    real = values[:width] > size * np.finfo(float).eps * max(values[0], 0.0)
    matrix = np.where(real, vectors[:, :width] / np.sqrt(np.where(real, values[:width], 1.0)), 0.0)
    white = written(projected(blocks, matrix).join(
        indexed.select("_index", "_key", deviation(n, sums).alias("_deviation")), "_index"), "white")
    free(blocks)
    forget(numbers)
    kept = [i for i in range(width) if real[i]]
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    error = 0.0
    if pairs:
        found = white.agg(*[F.covar_pop(F.col("_y")[i], F.col("_y")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))
    trace = float(np.trace(covariance))
    share = [float(v) / trace if trace > 0 else 0.0 for v in np.maximum(values[:width], 0.0)]
    return white.select("_key", "_deviation", F.posexplode("_y").alias("_at", "_white")).select(
        F.col("_key").alias(key), (F.col("_at") + 1).alias(name("component")), F.lit(n).cast("long").alias(name("n")),
        F.col("_deviation").try_cast(T.LongType()).alias(name("deviation")), F.col("_white").alias(name("whitened")),
        F.array(*[F.lit(s) for s in share])[F.col("_at")].alias(name("explained")),
        F.lit(error).alias(name("identity_error")), F.col("_deviation").alias(name("deviation_exact")))


def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight whitened components of every embedding."""
    return whiten(table(spark, sf_dir, "embeddings"))
