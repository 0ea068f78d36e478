"""Embedding whitening with Spark MLlib's block matrices.

Centred rows get dense row numbers and become the blocks of a distributed matrix; the transpose
multiplied with the matrix is the scatter, whose small square (dimensions x dimensions) is
decomposed on the driver; the matrix multiplied with the whitening matrix projects all rows.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored

COMPONENTS = 8
COLUMNS = 256             # of a block at most
BLOCK_ENTRIES = 1 << 19   # of a block at most (4 MB of doubles)
SPLIT_BLOCKS = 16         # blocks that a task of the transpose product holds at most, of either factor
SPREAD = 64               # blocks made at least, where there are rows enough
LEAST = 1e-12             # eigenvalues up to this share of the largest count as zero
LONGEST = float(1 << 52)  # entries from this size on have no long x and count as non-finite


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    values: np.ndarray      # eigenvalues by falling size, `components` of them
    vectors: np.ndarray     # dimensions x components, unit columns
    trace: float

    def matrix(self) -> np.ndarray:
        """dimensions x components; columns of zero eigenvalues are 0 (and reported as null)."""
        kept = self.kept()
        return np.where(kept, self.vectors / np.sqrt(np.where(kept, self.values, 1)), 0)

    def kept(self) -> np.ndarray:
        return self.values > LEAST * max(self.values.max(initial=0), 0)


def whole_numbers(vector: str) -> Column:
    """x = floor(1024 * c) + 100000 for each entry; null if an entry is null or non-finite."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LONGEST))
    return F.when(good, F.transform(vector, lambda c: F.floor(c.cast("double") * 1024) + F.lit(100000).cast("long")))


def fit_list(embeddings: DataFrame, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(row, vec_id, x): the usable vectors, written once.  Vectors that are null, empty, hold null or
    non-finite entries, or differ in length from the most frequent length (the longer one, if
    equally frequent) are left out; repeated rows stay."""
    x = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col(row_id).alias("vec_id"),
                          whole_numbers(vector).alias("x")).filter("size(x) > 0")
    x = stored(x, "whole-vectors")
    sizes = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return x.filter(F.size("x") == (sizes["d"] if sizes else 0))


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` with `index`: 0, 1, 2, ... without a gap.  `row` holds the writing task in its upper bits
    and a running number below; ranks inside a task are counted by Spark, offsets come from one
    short row a task."""
    task = F.shiftright("row", 33)
    counts = rows.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("c"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("task").orderBy("row")) - 1
    return (rows.withColumn("task", task).withColumn("inside", inside).join(offsets, "task")
            .withColumn("index", F.col("offset") + F.col("inside")).drop("task", "inside", "offset"))


def sums_of(rows: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of rows, and the exact sum of each dimension."""
    per = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    return (per[0]["n"] if per else 0), tuple(int(r["s"]) for r in per)


def block_matrix(rows: DataFrame, n: int, sums: tuple[int, ...]) -> BlockMatrix:
    """Centred rows (index, x) as distributed blocks."""
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = rows.select(F.col("index").cast("long"), array_to_vector(
        F.zip_with("x", means, lambda v, m: v.cast("double") - m)).alias("vector"))
    wide = min(len(sums), COLUMNS)
    tall = min(max(1, BLOCK_ENTRIES // wide), max(256, -(-n // SPREAD)))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, len(sums)).toBlockMatrix(tall, wide)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix; the long middle dimension is split over tasks that hold SPLIT_BLOCKS
    blocks of either factor at most, and their partial products are added."""
    tall = -(-blocks.numRows() // blocks.rowsPerBlock)
    splits = max(min(tall, 32), -(-tall // SPLIT_BLOCKS))
    other = blocks._java_matrix_wrapper._java_model
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", other, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def decompose(n: int, sums: tuple[int, ...], scattered: np.ndarray, components: int = COMPONENTS) -> Whitening:
    v = (scattered + scattered.T) / (2 * n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])  # either is right; this one is repeatable
    return Whitening(n, sums, values[order], vectors * signs, float(np.trace(v)))


def project(spark: SparkSession, blocks: BlockMatrix, model: Whitening) -> DataFrame:
    """(index, w): every row of the matrix times the whitening matrix."""
    m, tall = model.matrix(), blocks.colsPerBlock
    parts = [((i, 0), DenseMatrix(len(p), m.shape[1], p.T.ravel().tolist()))
             for i, p in enumerate(np.split(m, range(tall, len(m), tall)))]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), tall, m.shape[1], len(m), m.shape[1])
    rows = callMLlibFunc("getIndexedRows", blocks.multiply(right).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("w"))


def identity_error(white: DataFrame, kept: np.ndarray) -> float | None:
    """Largest absolute entry of the covariance of w's kept components minus the identity."""
    ks = [int(k) for k in np.flatnonzero(kept)]
    if not ks:
        return None
    cells = [F.abs(F.covar_pop(F.col("w")[a], F.col("w")[b]) - float(a == b)) for a in ks for b in ks if a <= b]
    return white.select(F.greatest(*cells, F.lit(0.0)).alias("e")).first()["e"]


def deviation(n: int, sums: tuple[int, ...]) -> Column:
    """Exact sum over dimensions of (n*x - S)^2; null where that leaves the range of a long."""
    s = F.array(*[F.lit(v).cast("long") for v in sums])
    each = F.zip_with("x", s, lambda x, t: F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), t))
    return F.aggregate(each, F.lit(0).cast("long"), lambda acc, d: F.try_add(acc, F.try_multiply(d, d)))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable vector and component (from 1, by falling eigenvalue): vec_id, component,
    n, deviation, whitened, explained, identity_error.

    See `fit_list` for the vectors left out.  Repeated and null ids stay (a row of its own each);
    extra columns are ignored.  There are min(components, dimensions) components; one whose
    eigenvalue is zero (fewer different vectors than components) has a null `whitened`, and
    `explained` is null if all vectors are equal.  No usable vector gives no row.  The driver holds
    the scatter (dimensions squared), nothing that grows with the rows but a pair of numbers a block."""
    spark = embeddings.sparkSession
    rows = fit_list(embeddings, row_id, vector)
    n, sums = sums_of(rows)
    types = dict(embeddings.dtypes)
    if not n:
        return spark.createDataFrame([], f"vec_id {types[row_id]}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    rows = stored(numbered(rows), "numbered-vectors")
    blocks = block_matrix(rows, n, sums)
    model = decompose(n, sums, scatter(blocks), components)
    white = stored(project(spark, blocks, model), "whitened")
    kept = model.kept()
    share = [float(e / model.trace) if model.trace > 0 else None for e in model.values]
    error = identity_error(white, kept)
    each = F.array(*[F.struct(F.lit(k + 1).alias("component"),
                              (F.col("w")[k] if kept[k] else F.lit(None).cast("double")).alias("whitened"),
                              F.lit(share[k]).cast("double").alias("explained")) for k in range(len(share))])
    return (rows.select("index", "vec_id", deviation(n, sums).alias("deviation")).join(white, "index")
            .select("vec_id", "deviation", F.inline(each))
            .select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
                    F.lit(error).cast("double").alias("identity_error")))
