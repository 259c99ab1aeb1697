"""Operator 11: whitening of embeddings with Spark MLlib's BlockMatrix.

Centred rows get an index and go into distributed blocks; the transposed matrix
times the matrix is the scatter, whose eigenvectors the driver finds; the matrix
times the whitening matrix is the rows on their components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.store import kept, read_table

#: An entry c becomes floor(SCALE * c) + OFFSET; components returned.
SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Entries from this on have no exact long and count as not finite.
TOO_LARGE = float(1 << 50)
#: Rows and columns of a block; blocks that are multiplied in one task, about; rows of a band.  BlockMatrix tells the driver the place of each block and holds a task's blocks in memory, so a longer table is worked on band by band.
BLOCK_ROWS, BLOCK_COLUMNS, BLOCKS_AT_ONCE, BAND_ROWS = 1024, 1024, 8, 1 << 24
#: A component whose variance is under this share of all variance is none: the vectors don't extend along it.
NO_VARIANCE = 1e-12

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Vectors:
    """The written table (part, at, vec_id, x) of usable vectors, rows of each part, their number, length, and sums by dimension."""

    table: DataFrame
    parts: list[tuple[int, int]]
    n: int
    dim: int
    sums: list[int]

    def bands(self) -> Iterator[tuple[int, int, DataFrame]]:
        """(first row, rows, (index, vec_id, x)) of each band: whole parts while they fit, a long part in pieces."""
        spans: list[list[tuple[int, int, int]]] = [[]]  # (part, at, rows)
        held = 0
        for part, n in self.parts:
            for at in range(0, n, BAND_ROWS):
                rows = min(BAND_ROWS, n - at)
                if held and held + rows > BAND_ROWS:
                    spans.append([])
                    held = 0
                spans[-1].append((part, at, rows))
                held += rows
        first = 0
        for span in spans:
            starts = np.concatenate([[0], np.cumsum([rows for _, _, rows in span])]).tolist()
            of = self.table.sparkSession.createDataFrame([(part, at, at + rows, start) for (part, at, rows), start in zip(span, starts[:-1], strict=True)], "its int, lo long, hi long, start long")
            rows = self.table.where(F.col("part").between(span[0][0], span[-1][0]))  # reaches the files: each has one part
            rows = rows.join(of, (F.col("part") == F.col("its")) & (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi")))
            yield first, starts[-1], rows.select((F.col("start") + F.col("at") - F.col("lo")).alias("index"), "vec_id", "x")
            first += starts[-1]


@dataclass
class Whitening:
    """The fit: unit eigenvectors of the covariance as columns, by falling eigenvalue, their eigenvalues, and the sum of all eigenvalues."""

    components: np.ndarray
    values: np.ndarray
    trace: float

    def matrix(self) -> np.ndarray:
        """What centred rows are multiplied by; zero for components without variance."""
        some = self.there()
        return np.where(some, self.components / np.sqrt(np.where(some, self.values, 1.0)), 0.0)

    def there(self) -> np.ndarray:
        return self.values > NO_VARIANCE * self.trace


def vectors(embeddings: DataFrame) -> Vectors:
    """The usable rows of embeddings (vec_id, embedding), with long entries, written once, and their sums."""
    c = F.col("embedding").cast("array<double>")
    fine = (F.size("embedding") > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < TOO_LARGE))
    longs = F.transform(c, lambda v: F.floor(v * SCALE) + OFFSET)
    rows = embeddings.where(fine).select(F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % F.lit(1 << 33)).alias("at"), F.col("vec_id").cast("long").alias("vec_id"), longs.alias("x"))
    table = kept(rows, "vectors")
    parts = sorted((r["part"], r["n"]) for r in table.groupBy("part").agg(F.count("*").alias("n")).collect())  # a row for each task that wrote
    least, most = table.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} entries have no common covariance")
    sums = table.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("s")).collect()
    return Vectors(table, parts, sum(n for _, n in parts), most or 0, [r["s"] for r in sorted(sums, key=lambda r: r["k"])])


def _centred(vectors: Vectors, rows: DataFrame, n: int) -> BlockMatrix:
    """The rows (index, x) less the mean of all vectors, as blocks."""
    means = F.array(*[F.lit(s / vectors.n) for s in vectors.sums])
    made = rows.select("index", array_to_vector(F.zip_with("x", means, lambda a, m: a.cast("double") - m)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(made, "vector"), n, vectors.dim).toBlockMatrix(BLOCK_ROWS, min(BLOCK_COLUMNS, vectors.dim))


def _product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a times b.  The blocks that are summed into one are dealt to splits tasks, whose sums are then added (the public form in Python has no such argument)."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def fit(vectors: Vectors, components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the covariance (divisor n) of all vectors."""
    scatter = np.zeros((vectors.dim, vectors.dim))
    for _, n, rows in vectors.bands():
        blocks = _centred(vectors, rows, n)
        scatter += _product(blocks.transpose(), blocks, -(-n // (BLOCK_ROWS * BLOCKS_AT_ONCE))).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / (2 * vectors.n)
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    signs = np.sign(columns[np.abs(columns).argmax(0), np.arange(columns.shape[1])])
    return Whitening(columns * signs, values, float(np.trace(covariance)))


def project(vectors: Vectors, whitening: Whitening) -> DataFrame:
    """(vec_id, x, z) of all vectors: z is the centred vector on each component, over the root of its variance."""
    spark = vectors.table.sparkSession
    matrix = whitening.matrix()
    made = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(matrix)], "index long, row array<double>").select("index", array_to_vector("row").alias("vector"))
    whitener = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(made, "vector"), *matrix.shape).toBlockMatrix(min(BLOCK_COLUMNS, vectors.dim), matrix.shape[1])
    out = None
    for _, n, rows in vectors.bands():
        found = _product(_centred(vectors, rows, n), whitener).toIndexedRowMatrix()
        found = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", found._java_matrix_wrapper._java_model), "vector")
        z = found.select(F.col("index").alias("its"), vector_to_array("vector").alias("z"))
        band = kept(rows.join(z, F.col("index") == F.col("its")).select("vec_id", "x", "z"), "whitened")
        out = band if out is None else out.unionAll(band)
    return out


def identity_error(projected: DataFrame, components: list[int]) -> float | None:
    """The largest entry of the covariance of z, in these components, less the identity; null without components."""
    if not components:
        return None
    z = lambda k: F.get("z", F.lit(k))
    pairs = [(i, j) for i in components for j in components if i <= j]
    row = projected.agg(F.count("*"), *[F.avg(z(k)) for k in components], *[F.avg(z(i) * z(j)) for i, j in pairs]).first()
    means = dict(zip(components, row[1 : 1 + len(components)], strict=True))
    return max(abs(v - means[i] * means[j] - (i == j)) for (i, j), v in zip(pairs, row[1 + len(components) :], strict=True))


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, of which there are at most as many as entries.

    A vector that is null or empty, or holds null, non-finite entries or such
    of 2^50 or more, takes no part.  All others make the fit, repeated rows and null vec_ids too.
    n is their number, deviation the exact sum over dimensions of
    (n x - S)^2 (null where that is no long), whitened the centred vector on the
    component over the root of its eigenvalue, explained the eigenvalue's share
    of all variance, identity_error how far the covariance of whitened is from
    the identity.  A component without variance has null for whitened, and for
    explained where nothing varies.  Vectors of different lengths have no common
    covariance and are an error.  Other columns are ignored.  Without usable
    vectors the result is empty.
    """
    table = vectors(embeddings)
    if not table.n:
        return embeddings.sparkSession.createDataFrame([], WHITENED)
    whitening = fit(table, components)
    projected = project(table, whitening)
    there = whitening.there().tolist()
    error = identity_error(projected, [k for k, some in enumerate(there) if some])
    sums = F.array(*[F.lit(s).cast("long") for s in table.sums])
    apart = F.zip_with("x", sums, lambda a, s: F.try_subtract(F.try_multiply(F.lit(table.n).cast("long"), a), s))
    deviation = F.aggregate(apart, F.lit(0).cast("long"), lambda t, v: F.try_add(t, F.try_multiply(v, v)))
    share = [float(v) / whitening.trace if whitening.trace > 0 else None for v in whitening.values]
    each = [F.struct(F.lit(k + 1).alias("component"), (F.get("z", F.lit(k)) if some else F.lit(None).cast("double")).alias("whitened"), F.lit(share[k]).cast("double").alias("explained")) for k, some in enumerate(there)]
    rows = projected.select("vec_id", deviation.alias("deviation"), F.array(*each).alias("each")).select("vec_id", "deviation", F.inline("each"))
    return rows.select("vec_id", "component", F.lit(table.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
