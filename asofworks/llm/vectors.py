"""Operators 3 and 4: nearest neighbours by adaptive dimension scan, and exact top inner products by segment statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofworks.llm.store import kept, read_table, shared_folder

#: Operator 3: nearest kept; rows that lists are fitted on at most; lists at most.
NEAREST, SAMPLE, LISTS = 5, 20000, 4096
#: Queries that are also searched by brute force, at most, and the share of their nearest rows whose lists are to be looked into.
MEASURED, RECALL = 200, 0.96
#: Dimensions in a column block; how many deviations of a partial distance make a candidate hopeless.
COLUMNS, DEVIATIONS = 16, 2.1
#: Rows of a list at least, on average, so that the lists looked into hold more than are asked for.
LIST_ROWS = 64
#: Candidates of a group that get their whole distance first.
HEAD_ROWS = 64
#: Candidates and queries that meet in one group, about, at most.
GROUP_ROWS, GROUP_QUERIES = 2048, 512
#: Operator 4: best kept; the numbers of segments from coarse to fine; queries that are broadcast at once.
BEST, SEGMENTS, QUERIES_AT_ONCE = 10, (4, 8, 16), 8192
SEED = 20240607


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """(row, vec_id, dim, x) of vectors without null or non-finite components, with an id, and not all zero unless zero says so."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.where(fine if zero else fine & F.exists(x, lambda v: v != 0))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.size(x).alias("dim"), x.cast("array<double>").alias("x"))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; first by the largest component, so that no square overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Lloyd's algorithm on unit vectors, from distinct ones; the same sample gives the same lists, none of them empty."""
    rng = np.random.default_rng(SEED)
    distinct = np.unique(sample, axis=0)
    at = distinct[rng.permutation(len(distinct))[:count]]
    for _ in range(8):
        near = (sample @ at.T).argmax(1)
        sums = np.zeros_like(at)
        np.add.at(sums, near, sample)
        some = np.bincount(near, minlength=len(at)) > 0
        at = np.where(some[:, None], sums, at)
        length = np.sqrt((at * at).sum(1, keepdims=True))
        at = at / np.where(length > 0, length, 1)
    return at[np.bincount((sample @ at.T).argmax(1), minlength=len(at)) > 0]


def _cosines(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Cosines of rows with others, pair by pair, in double precision; equal pairs give equal values."""
    a = rows / np.abs(rows).max(1, keepdims=True)
    b = others / np.abs(others).max(1, keepdims=True)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _scan(rotated: np.ndarray, targets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (target, candidate) that may be among the k nearest of each target.

    The first candidates get their whole distance, the k-th of which is a
    target's limit.  For the others partial distances over column blocks are
    scaled to all dimensions; under a random rotation a candidate whose scaled
    distance is over the limit by more than DEVIATIONS allows is given up
    (hypothesis test of ADSampling).
    """
    n, dim = rotated.shape
    first = min(n, HEAD_ROWS)
    square = lambda x: (x * x).sum(1)
    apart = lambda x, y: np.maximum(square(y)[:, None] + square(x)[None] - 2 * (y @ x.T), 0)
    whole = apart(rotated[:first], targets)
    limit = np.partition(whole, k - 1, axis=1)[:, k - 1] if first > k else np.full(len(targets), np.inf)
    # all that tie with the k-th, but for rounding
    near = [np.nonzero(whole <= limit[:, None] + 1e-9)]
    if n > first:
        last = min(COLUMNS, dim)
        part = apart(rotated[first:, :last], targets[:, :last])
        allowed = lambda q, last: limit[q] * (last / dim) * (1 + DEVIATIONS / np.sqrt(last)) ** 2 + 1e-9
        q, c = np.nonzero(part <= allowed(np.arange(len(targets)), last)[:, None])
        partial = part[q, c]
        for start in range(last, dim, COLUMNS):
            last = min(start + COLUMNS, dim)
            step = rotated[first + c, start:last] - targets[q, start:last]
            partial = partial + square(step)
            ok = partial <= (allowed(q, last) if last < dim else limit[q] + 1e-9)
            q, c, partial = q[ok], c[ok], partial[ok]
        near.append((q, first + c))
    return np.concatenate([x[0] for x in near]), np.concatenate([x[1] for x in near])


def _meet(rotation: np.ndarray, k: int):  # noqa: ANN202
    """The function for a group of candidates and queries of one list."""

    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        rows, asked = np.array(candidates["x"].tolist()), np.array(queries["x"].tolist())
        q, c = _scan(unit(rows) @ rotation, unit(asked) @ rotation, k + 1)
        other = candidates["row"].to_numpy()[c] != queries["row"].to_numpy()[q]
        q, c = q[other], c[other]
        found = pd.DataFrame({"query_row": queries["row"].to_numpy()[q], "query_id": queries["vec_id"].to_numpy()[q], "vec_id": candidates["vec_id"].to_numpy()[c], "score": _cosines(rows[c], asked[q])})
        found = found.sort_values(["query_row", "score", "vec_id"], ascending=[True, False, True], kind="stable")
        return found.groupby("query_row").head(k)

    return search


def _probes(held: DataFrame, asked: DataFrame, lists: np.ndarray, k: int) -> int:
    """How many of its nearest lists a query has to look into, so that RECALL of the k nearest rows of some MEASURED queries are found.

    These rows are found by brute force: each task keeps the best k of its rows.
    """
    few = asked.orderBy(F.xxhash64("row", F.lit(SEED)), "row").limit(MEASURED).toArrow()
    if not few.num_rows:
        return 1
    queries, own = unit(matrix(few["x"].combine_chunks(), lists.shape[1])), few["row"].to_numpy()
    shared = held.sparkSession.sparkContext.broadcast((queries, own))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own = shared.value
        score, at = np.full((len(own), k), -np.inf), np.zeros((len(own), k), np.int32)
        for batch in batches:
            if not batch.num_rows:
                continue
            near = queries @ unit(matrix(batch.column(1), queries.shape[1])).T
            near[own[:, None] == batch.column(0).to_numpy()[None]] = -np.inf
            near, here = np.concatenate([score, near], axis=1), np.concatenate([at, np.broadcast_to(batch.column(2).to_numpy(), near.shape)], axis=1)
            order = np.argpartition(-near, k - 1, axis=1)[:, :k]
            score, at = np.take_along_axis(near, order, 1), np.take_along_axis(here, order, 1)
        some = score > -np.inf
        yield pa.record_batch([pa.array(np.nonzero(some)[0]), pa.array(score[some]), pa.array(at[some])], ["query", "score", "list"])

    found = held.select("row", "x", "list").mapInArrow(best, "query long, score double, list int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "list"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "list").toPandas()
    order = np.argsort(-(queries @ lists.T), axis=1, kind="stable").argsort(axis=1)
    needed = np.sort(order[found["query"].to_numpy(np.int64), found["list"].to_numpy(np.int64)])
    return 1 + int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))) - 1)]) if len(needed) else 1


def _search(rows: DataFrame, dim: int, every: int, k: int, probed: float | None) -> DataFrame:
    spark = rows.sparkSession
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "row").limit(SAMPLE).select("x").toArrow()["x"].combine_chunks()
    count = int(min(LISTS, max(1, round(total**0.5)), max(1, total // LIST_ROWS)))
    lists = centroids(unit(matrix(sample, dim)), count)
    count = len(lists)
    shared = spark.sparkContext.broadcast(lists)

    def assign(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = unit(matrix(batch.column(2), dim)) @ shared.value.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :many].astype(np.int32)
            bounds = np.arange(0, order.size + 1, many, dtype=np.int32)
            yield pa.record_batch([*batch.columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(order.ravel()))], ["row", "vec_id", "x", "lists"])

    listed = "row long, vec_id long, x array<double>, lists array<int>"
    plain = rows.select("row", "vec_id", "x")
    held = kept(plain.mapInArrow(lambda b: assign(b, 1), listed).withColumn("list", F.col("lists")[0]).drop("lists"), "listed")
    asked = plain.where(F.col("vec_id") % every == 0)
    probes = _probes(held, asked, lists, k) if probed is None else max(1, int(np.ceil(probed * count)))
    asked = kept(asked.mapInArrow(lambda b: assign(b, probes), listed), "asked")
    probing = asked.withColumn("list", F.explode("lists")).drop("lists")
    # one row for each list, so of a bounded number: into how many parts its candidates and its queries are cut
    sizes = held.groupBy("list").agg(F.count("*").alias("n"))
    wanted = probing.groupBy("list").agg(F.count("*").alias("q"))
    parts = sizes.join(wanted, "list").select("list", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("cuts"), F.ceil(F.col("q") / GROUP_QUERIES).cast("int").alias("blocks"))
    parts = F.broadcast(kept(parts, "parts"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    candidates = held.join(parts, "list").withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")).cast("int")).withColumn("block", spread(F.col("blocks"))).drop("cuts", "blocks")
    probing = probing.join(parts, "list").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).withColumn("cut", spread(F.col("cuts"))).drop("cuts", "blocks")
    rotation = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))[0]
    keys = ["list", "cut", "block"]
    found = candidates.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInPandas(_meet(rotation, k), "query_row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, every: int = 50, k: int = NEAREST, probed: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest cosine found for each row whose vec_id every divides.

    Lists are fitted on a bounded sample; every row is put into the list of the
    nearest centre.  A query looks into its nearest lists, as many as it takes
    to find RECALL of the nearest rows of a few queries that are also searched
    by brute force, or the share probed of all lists.  There an adaptive
    dimension scan gives candidates up early; the rest get their exact cosine on
    the original vectors.  Long lists and many queries of one list are
    cut into groups.  Ties go to the smaller vec_id.

    Vectors that are null, empty, zero or have null or non-finite components,
    and rows without vec_id, take no part.  Vectors of another length are
    searched among their own.  Rows that repeat a vec_id are rows of their own:
    a query finds all rows but itself.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    rows = kept(usable(table, zero=False), "vectors")
    dims = [r["dim"] for r in rows.select("dim").distinct().orderBy("dim").collect()]
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_search(rows.where(F.col("dim") == d), d, every, k, probed) for d in dims]
    for each in found:
        out = each if each is found[0] else out.unionByName(each)
    return out


def _levels(rows: np.ndarray) -> list[np.ndarray]:
    """For each resolution: scaled means and deviations of segments; the product of two rows of these is over that of the vectors."""
    out = []
    for count in SEGMENTS:
        cut = np.unique(np.linspace(0, rows.shape[1], min(count, rows.shape[1]) + 1).astype(int))
        width = np.diff(cut)
        mean = np.add.reduceat(rows, cut[:-1], axis=1) / width
        spread = np.add.reduceat((rows - np.repeat(mean, width, axis=1)) ** 2, cut[:-1], axis=1)
        out.append(np.concatenate([mean * np.sqrt(width), np.sqrt(np.maximum(spread, 0))], axis=1))
    return out


class _Top:
    """The best k of each query so far, with ties to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score: list[np.ndarray] = [np.zeros(0, object)] * queries
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * queries

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.ids[q], ids])
        best = np.lexsort((ids, -score))[: self.k] if score.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[: self.k], int)
        self.score[q], self.ids[q] = score[best], ids[best]

    def least(self, q: int) -> float:
        return float(self.score[q][-1]) if len(self.score[q]) == self.k else -np.inf


def _exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles; in Python integers where doubles would round."""
    if len(rows) and float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1] < 2.0**53:
        return rows @ query
    whole = [int(v) for v in query]
    return np.array([sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in rows], object)


def _best(batches: Iterator[pa.RecordBatch], numbers: np.ndarray, own: np.ndarray, asked: np.ndarray, dim: int, k: int) -> Iterator[pa.RecordBatch]:
    top = _Top(len(numbers), k)
    query_levels = _levels(asked)
    for batch in batches:
        if not batch.num_rows:
            continue
        row, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        values = np.floor(1024.0 * matrix(batch.column(2), dim))
        for low in range(0, len(row), 2048):
            part = slice(low, low + 2048)
            rows, levels = values[part], _levels(values[part])
            for q in range(len(numbers)):
                least = top.least(q)
                alive = np.flatnonzero(row[part] != own[q])
                if np.isfinite(least):
                    for theirs, ours in zip(levels, query_levels, strict=True):
                        bound = theirs[alive] @ ours[q]
                        alive = alive[bound + np.abs(bound) * 1e-9 + 1e-3 >= least]
                        if not len(alive):
                            break
                if len(alive):
                    top.add(q, _exact(rows[alive], asked[q]), ids[part][alive])
    for q, number in enumerate(numbers):
        if len(top.ids[q]):
            # a product beyond 64 bits stands as the nearest long
            score = [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in top.score[q]]
            yield pa.record_batch([pa.array([own[q]] * len(score), pa.int64()), pa.array([number] * len(score), pa.int64()), pa.array(top.ids[q], pa.int64()), pa.array(score, pa.int64())], ["query_row", "query_id", "vec_id", "score"])


FOUND = "query_row long, query_id long, vec_id long, score long"


def top_products(table: DataFrame, every: int = 100, k: int = BEST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product for each row whose vec_id every divides.

    Components become floor(1024 * x).  Queries go to the workers one block of
    some QUERIES_AT_ONCE after another: each task runs over its candidates and
    keeps the best k of each query, and a block's results are written before the
    next one is read, so neither the driver nor a worker holds more than one.  Segment means and deviations bound the distance from below, so
    the product from above, at ever finer resolutions; what is left is computed
    exactly.  Ties go to the smaller vec_id.

    Vectors that are null or empty or have null or non-finite components, and
    rows without vec_id, take no part; zero vectors do.  Vectors of another
    length are searched among their own.  Rows that repeat a vec_id are rows of
    their own.  A product beyond 64 bits is returned as the nearest long.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    rows = kept(usable(table, zero=True), "vectors")
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/found-{uuid.uuid4().hex}"
    spark.createDataFrame([], FOUND).write.parquet(path)
    for at in rows.where(F.col("vec_id") % every == 0).groupBy("dim").count().orderBy("dim").collect():
        dim, blocks = at["dim"], -(-at["count"] // QUERIES_AT_ONCE)
        mine = rows.where(F.col("dim") == dim).select("row", "vec_id", "x")
        numbered = mine.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        numbered = kept(numbered, "queries") if blocks > 1 else numbered
        for block in range(blocks):
            asked = numbered.where(F.col("block") == block).orderBy("row").toArrow()
            if not asked.num_rows:
                continue
            queries = np.floor(1024.0 * matrix(asked["x"].combine_chunks(), dim))
            shared = spark.sparkContext.broadcast((asked["vec_id"].to_numpy(), asked["row"].to_numpy(), queries))
            mine.mapInArrow(lambda b, shared=shared, dim=dim: _best(b, *shared.value, dim, k), FOUND).write.mode("append").parquet(path)
            shared.unpersist()
    found = spark.read.schema(FOUND).parquet(path)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op4_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"))
