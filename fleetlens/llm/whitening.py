"""Whitening of vectors with MLlib's distributed block matrices.

Centred rows become consecutive blocks of a block matrix; its product
with its own transpose is the scatter matrix, which is small enough for an
eigenvalue routine; the product with the whitening matrix projects the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetlens.llm.common import NULL_ID, col, ids_column
from fleetlens.session import materialize

#: Steps per unit and offset of the whole numbers that stand for vector entries.
STEPS, OFFSET = 64, 1_000_000
#: Components returned.
COMPONENTS = 32
#: Rows and columns of a block: at most two megabytes.
BLOCK_ROWS, BLOCK_COLUMNS = 256, 1024
#: Row blocks whose products are summed in one task before sums of tasks meet.
BLOCKS_EACH = 32
NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Components whose eigenvalue is below this share of the largest are rounding errors.
LEAST_SHARE = 1e-12


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, size, x``: entries as whole numbers; vectors that are null or hold null or non-finite entries go."""
    raw = vectors.select(col(id_col).cast("long").alias("vec_id"), col(vector_col).cast("array<double>").alias("v")).filter("v IS NOT NULL")
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))
    x = F.transform("v", lambda c: F.floor(F.lit(float(STEPS)) * c) + F.lit(OFFSET))
    return raw.filter(finite).select("vec_id", F.size("v").alias("size"), x.cast("array<long>").alias("x"))


#: A matrix as MLlib stores it; a table written with plain structs is read with MLlib's own type and the other way round.
PLAIN = T.StructType([T.StructField(f.name, f.dataType) for f in MatrixUDT.sqlType().fields])
BLOCKS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("column", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("deviations", T.ArrayType(T.LongType())),
        T.StructField("matrix", PLAIN),
    ]
)


def retyped(table: DataFrame, kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(f.name, kind if f.name in ("matrix", "subMatrix") else f.dataType) for f in table.schema.fields])


def deviations(away: np.ndarray) -> np.ndarray:
    """Sums of squares by row, exact; an error if no long holds one."""
    if away.size and float(np.abs(away.astype(float)).max()) ** 2 * away.shape[1] >= 2.0**62:
        sums = [sum(int(a) * int(a) for a in row) for row in away]
        if max(sums) >= 1 << 63:
            raise OverflowError("a sum of squared deviations is beyond a long")
        return np.array(sums, np.int64)
    return (away * away).sum(axis=1)


def centred_blocks(rows: DataFrame, n: int, total: list[int]) -> DataFrame:
    """``rows`` (vec_id, x) as blocks of centred rows, each block with its place in its task's part.

    A part's last block is filled up with rows of zeros, which add nothing to
    a product of the matrix with its own transpose.
    """
    sums, size = np.array(total, np.int64), len(total)
    height, width = BLOCK_ROWS, BLOCK_COLUMNS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        ids, x = np.empty(0, np.int64), np.empty((0, size), np.int64)

        def packed(ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            away = n * x - sums
            full = np.zeros((height, size))
            full[: len(away)] = away / float(n)
            out = []
            for column, left in enumerate(range(0, size, width)):
                block = full[:, left : left + width]
                matrix = {"type": 1, "numRows": height, "numCols": block.shape[1], "colPtrs": None, "rowIndices": None, "values": block.ravel(order="F"), "isTransposed": False}
                first = column == 0
                own = ids_column(ids).to_pylist() if first else []
                out.append({"part": part, "place": place, "column": column, "ids": own, "deviations": deviations(away).tolist() if first else [], "matrix": matrix})
            return pa.RecordBatch.from_pylist(out, schema=to_arrow_schema(BLOCKS))

        for batch in batches:
            ids = np.r_[ids, batch.column(0).fill_null(NULL_ID).to_numpy()]
            x = np.concatenate([x, batch.column(1).flatten().to_numpy().reshape(-1, size)])
            while len(ids) >= height:
                yield packed(ids[:height], x[:height])
                ids, x, place = ids[height:], x[height:], place + 1
        if len(ids):
            yield packed(ids, x)

    return rows.select("vec_id", "x").mapInArrow(work, BLOCKS)


def numbered(blocks: DataFrame) -> DataFrame:
    """``blocks`` with consecutive numbers ``number`` from 0: one count per part has to be summed up."""
    counts = blocks.filter("column = 0").groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return blocks.join(offsets, "part").withColumn("number", F.col("before") + F.col("place")).drop("part", "place", "before")


def block_matrix(blocks: DataFrame, matrix: str, n_blocks: int, size: int) -> BlockMatrix:
    """Blocks (number, column, a matrix in MLlib's type) as one matrix."""
    index = F.struct(F.col("number").alias("_1"), F.col("column").alias("_2"))
    rows = blocks.select(index.alias("blockIndex"), F.col(matrix).alias("subMatrix"))
    width = min(size, BLOCK_COLUMNS)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", rows, BLOCK_ROWS, width, n_blocks * BLOCK_ROWS, size), BLOCK_ROWS, width)


def multiply(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; the sum over what both share is cut into ``splits`` parts, which PySpark's own method has no argument for."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself, on the driver: as many rows and columns as a vector has entries."""
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_EACH))
    return multiply(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors over the roots of their eigenvalues, as columns by falling eigenvalue, and the explained shares."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    total = np.trace(covariance)
    keep = min(components, int((values > LEAST_SHARE * values[0]).sum())) if len(values) and values[0] > 0 else 0
    return vectors[:, :keep] / np.sqrt(values[:keep]), values[:keep] / total if keep else values[:0]


def _blocks(spark, matrix: np.ndarray) -> BlockMatrix:
    """A small matrix as blocks as high as another one's are wide."""
    parts, height = [], min(matrix.shape[0], BLOCK_COLUMNS)
    for i, top in enumerate(range(0, matrix.shape[0], height)):
        block = matrix[top : top + height]
        parts.append(((i, 0), DenseMatrix(block.shape[0], block.shape[1], block.ravel(order="F"))))
    return BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), height, matrix.shape[1], *matrix.shape)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every vector and component.

    Entries become whole numbers x = floor(64 * c) + 1000000.  All sums over x
    are exact, and rows are centred as (n * x - sum) / n before any product.
    Components are the unit eigenvectors of the covariance (divisor n), from 1
    by falling eigenvalue; ``whitened`` is a centred row's part along one over
    the root of its eigenvalue, ``explained`` the eigenvalue's share of the
    trace.  ``deviation`` is the exact sum of (n * x - sum)^2, an error if no
    long holds it.  ``identity_error`` comes from the scatter of the rows as
    returned.

    Vectors that are null or hold null or non-finite entries give no rows and
    count for nothing; the zero vector counts.  Vectors of each length are
    whitened among themselves (one pass for each length that occurs).
    Components without variance are left out, so equal vectors, and vectors
    without entries, give no rows.  Rows that repeat an id all count and are all
    returned, null ids stay null, other columns are ignored, an empty table
    gives no rows.

    The driver holds square matrices of a vector's length, nothing that grows
    with the rows.
    """
    spark = vectors.sparkSession
    rows = materialize(whole_vectors(vectors, id_col, vector_col), "whole")
    sums = rows.select("size", F.posexplode("x")).groupBy("size", "pos").agg(F.sum("col").alias("total"), F.count("*").alias("n"))
    by_size: dict[int, dict[int, tuple[int, int]]] = {}
    for r in sums.collect():
        by_size.setdefault(r.size, {})[r.pos] = (r.total, r.n)
    out = spark.createDataFrame([], WHITENED)
    for size, found in sorted(by_size.items()):
        part = _whiten_one(rows.filter(F.col("size") == size), found[0][1], [found[i][0] for i in range(size)], components)
        out = part if len(by_size) == 1 else out.union(part)
    return out


def _whiten_one(rows: DataFrame, n: int, total: list[int], components: int) -> DataFrame:
    spark, size = rows.sparkSession, len(total)
    blocks = materialize(centred_blocks(rows, n, total), "blocks")
    n_blocks = blocks.filter("column = 0").count()
    typed = spark.read.schema(retyped(blocks, MatrixUDT())).parquet(*blocks.inputFiles())
    centred = block_matrix(numbered(typed), "matrix", n_blocks, size)
    basis, explained = whitening_matrix(scatter(centred) / n, components)
    kept = basis.shape[1]
    if not kept:
        return spark.createDataFrame([], WHITENED)
    projected = multiply(centred, _blocks(spark, basis))
    projected = callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model)
    projected = projected.toDF("blockIndex", "subMatrix").select(F.col("blockIndex._1").cast("long").alias("number"), F.col("blockIndex._2").cast("long").alias("column"), "subMatrix")
    projected = materialize(projected, "projected")
    error = float(np.abs(scatter(block_matrix(projected, "subMatrix", n_blocks, kept)) / n - np.eye(kept)).max())
    plain = spark.read.schema(retyped(projected, PLAIN)).parquet(*projected.inputFiles())
    names = numbered(blocks.filter("column = 0").select("part", "place", "column", "ids", "deviations")).select("number", "ids", "deviations")
    both = names.join(plain.select("number", F.col("subMatrix.values").alias("values"), F.col("subMatrix.isTransposed").alias("turned")), "number")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, deviation = batch.column("ids")[i].values, batch.column("deviations")[i].values.to_numpy()
                values = batch.column("values")[i].values.to_numpy()
                values = values.reshape(-1, kept) if batch.column("turned")[i].as_py() else values.reshape(kept, -1).T
                m = len(ids)
                columns = [
                    ids.take(pa.array(np.repeat(np.arange(m), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * kept, n, np.int64)),
                    pa.array(np.repeat(deviation, kept)),
                    pa.array(values[:m].ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * kept, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return both.mapInArrow(rows_of, WHITENED)
