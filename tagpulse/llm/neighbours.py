"""Nearest neighbours by inner product: multiprobe p-stable hashing, then exact scores."""

from collections.abc import Iterator
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.session import checkpointed

SLACK = 1e-9  # of the largest score: matrix products are rounded in another order than the exact scores


class Hashes:
    """`tables` times `functions` p-stable hashes floor((a·x + b) / width) of vectors lifted onto a sphere.

    Largest inner product becomes smallest distance: an indexed vector x gets the coordinate √(top² - |x|²), a query is
    scaled to length `top` and gets 0; then |x - q|² = 2 (top² - x·q).
    """

    def __init__(self, dimension: int, top: float, width: float, tables: int, functions: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.top, self.width, self.functions = top, width, functions
        self.directions = rng.normal(size=(tables, dimension + 1, functions)) / max(top, 1e-300)
        self.shifts = rng.uniform(0, 1, size=(tables, functions))

    def indexed(self, x: np.ndarray) -> np.ndarray:
        """Places of indexed vectors by table, vector and function, in widths; distances count in units of `top`."""
        lift = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0))
        return self._placed(np.column_stack([x, lift]))

    def query(self, q: np.ndarray) -> np.ndarray:
        length = np.sqrt((q**2).sum(1, keepdims=True))
        return self._placed(np.column_stack([q * (self.top / length), np.zeros(len(q))]))

    def _placed(self, y: np.ndarray) -> np.ndarray:
        return np.einsum("nd,tdf->tnf", y, self.directions) / self.width + self.shifts[:, None, :]


def bucket_numbers(cells: np.ndarray) -> np.ndarray:
    """One number for the cells of all functions: each is within ±127 or set to that, so that none is lost."""
    number = np.zeros(cells.shape[:-1], np.int64)
    for k in range(cells.shape[-1]):
        number = (number << 8) + (np.clip(cells[..., k], -127, 127).astype(np.int64) + 127)
    return number


def tail(z: np.ndarray) -> np.ndarray:
    """The share of a standard normal below z."""
    return 0.5 * (1 + np.vectorize(erf)(z / np.sqrt(2)))


def probes(place: np.ndarray, distance: float, width: float, success: float) -> list[np.ndarray]:
    """For one table, the buckets each query visits: perturbed cells in order of the chance that a neighbour at `distance`
    lies there, until the chances add up to `success`. The step along an axis is normal, with that distance as its spread."""
    functions = place.shape[1]
    reach = int(np.ceil(3 * distance / width)) + 1
    steps = np.arange(-reach, reach + 1)
    home = np.floor(place)
    edges = (home[:, :, None] + np.r_[steps, reach + 1] - place[:, :, None]) * width / distance
    chances = np.diff(tail(edges), axis=2)  # query, function, step
    found = []
    grid = np.stack(np.meshgrid(*[steps] * functions, indexing="ij"), -1).reshape(-1, functions)
    for q in range(len(place)):
        joint = chances[q, 0]
        for k in range(1, functions):
            joint = np.multiply.outer(joint, chances[q, k])
        joint = joint.ravel()
        order = np.argsort(-joint, kind="stable")
        enough = int(np.searchsorted(np.cumsum(joint[order]), success)) + 1
        found.append(np.unique(bucket_numbers(home[q] + grid[order[:enough]])))
    return found


def expected_distance(x: np.ndarray, top: float, n: int, k: int) -> float:
    """The distance, in units of `top`, within which nine of ten queries have their `k`-th neighbour among `n` points, going by
    a sample of them: the neighbour whose rank in the sample is the same share of it, or the nearest."""
    if len(x) < 2:
        return 1.0
    rank = min(max(-(-k * len(x) // n), 1), len(x) - 1)
    near = []
    for i in range(0, len(x), max(len(x) // 256, 1)):
        nearness = x @ x[i] / (np.linalg.norm(x[i]) * top)
        nearness[i] = -np.inf
        near.append(np.partition(nearness, -rank)[-rank])
    return max(float(np.sqrt(max(2 - 2 * np.quantile(near, 0.1), 0))), 0.05)


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of a vector with rows, added from first to last coordinate, so that equal vectors score equally."""
    total = np.zeros(len(x))
    for k in range(len(q)):
        total += q[k] * x[:, k]
    return total


def _bucketed(hashes: Hashes, success: float, distance: float, visiting: bool):
    """Rows per table: the bucket of each vector or, `visiting`, all buckets that a query goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = matrix(part.column("vector"))
                place = hashes.query(x) if visiting else hashes.indexed(x)
                for table in range(len(place)):
                    if visiting:
                        found = probes(place[table], distance, hashes.width, success)
                        row = np.repeat(np.arange(len(x)), [len(f) for f in found])
                        bucket = np.concatenate(found)
                    else:
                        row, bucket = np.arange(len(x)), bucket_numbers(np.floor(place[table]))
                    rows = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), table, np.int32)), pa.array(bucket), *rows.columns],
                        names=["table", "bucket", *rows.schema.names])

    return run


def _scored(k: int):
    """Within each cell, whose vectors come first: every visiting query with its `k` nearest there."""
    cell = ["table", "bucket", "chunk"]

    def nearest(query, x, points, first):
        q = matrix(query.column("vector"))
        approximate = q @ x.T
        if approximate.shape[1] > k:
            least = np.partition(approximate, -k, axis=1)[:, -k]
        else:
            least = np.full(len(q), -np.inf)
        least = least - SLACK * np.abs(approximate).max(initial=0)
        out = []
        for i, at in enumerate(query.column("point").to_pylist()):
            close = np.flatnonzero(approximate[i] >= least[i])
            score = exact_scores(q[i], x[close])
            best = np.lexsort((points[close], first[close], -score))[:k]
            out.append((np.full(len(best), at), points[close][best], first[close][best], score[best]))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "point", "first", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*cell, "visits"]])
            edges = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1, len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part, key = batch.slice(a, b - a), tuple(keys[a][:3])
                if not keys[a][3]:
                    if key != here:
                        here, held = key, []
                    held.append((matrix(part.column("vector")), *(part.column(c).to_numpy() for c in ("point", "first"))))
                elif key == here:
                    if len(held) > 1:
                        held = [tuple(map(np.concatenate, zip(*held)))]
                    for at in range(0, len(part), 512):
                        yield nearest(part.slice(at, 512), *held[0])

    return run


def search(vectors: DataFrame, queries, k: int = 20, recall: float = 0.94, tables: int = 2, functions: int = 4,
           relative_width: float = 1.5, sample: int = 2048, cell_rows: int = 4096) -> DataFrame:
    """The `k` nearest found to each row of `vectors` (`vec_id`, `embedding`) that the condition `queries` holds for, among all
    rows with another vec_id.

    Equal vectors are one point with its `k` + 1 smallest ids, which is all that can be among the nearest, so a vector with a
    third of all rows is one row. Points and queries are lifted so that the largest inner product is the smallest distance, and
    hashed in `tables` tables by `functions` p-stable functions, `relative_width` times as wide as the distance to expect of
    the k-th neighbour. That distance comes from `sample` points, chosen by hash. A query visits perturbed buckets in order of
    the estimated chance of a neighbour there, until the tables together reach the chance `recall`. All points of the buckets
    are scored: a bucket is dealt in cells of about `cell_rows` points, and queries stream past them.

    Per query and rank: query_id, rank from 1, vec_id, score (the inner product in doubles), nearest first, ties to the smaller
    vec_id; all candidates, if fewer. Rows with a NULL vec_id or a vector that is NULL, zero, of another than the most common
    length, or has NULL or non-finite components take no part; repeated rows count once; an empty table gives no rows; other
    columns are ignored.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), queries.alias("asks"))
        .where("vec_id is not null and vector is not null").where(finite).where(F.exists("vector", lambda x: x != 0)))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == sizes.n)

    # the limit on the rank is applied in the tasks that read, before the shuffle: a hot vector sends k + 1 ids from each
    nth = F.dense_rank().over(Window.partitionBy("vector").orderBy("vec_id"))
    points = checkpointed(
        rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("point"), F.col("ids")[0].alias("first"), "ids", "vector"))
    asking = rows.where("asks").select("vec_id", "vector").distinct()
    asked = checkpointed(asking.join(points.select("point", "vector"), "vector").select("point", "vec_id"))

    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total = points.agg(F.count("*").alias("n"), F.sqrt(F.max(length)).alias("top")).first()
    drawn = points.orderBy(F.xxhash64("point"), "point").limit(sample).select("vector").collect()  # `sample` vectors
    distance = expected_distance(np.array([r.vector for r in drawn], np.float64), total.top, total.n, k)
    hashes = Hashes(sizes.n, total.top, relative_width * distance, tables, functions)
    success = 1 - (1 - recall) ** (1 / tables)

    kind = dict(points.dtypes)["vector"]
    indexed = points.select("point", "first", "vector").mapInArrow(
        _bucketed(hashes, success, distance, False), f"table int, bucket long, point long, first long, vector {kind}")
    seeking = points.join(asked.select("point").distinct(), "point", "left_semi").select("point", "first", "vector")
    visits = seeking.mapInArrow(_bucketed(hashes, success, distance, True), f"table int, bucket long, point long, first long, vector {kind}")
    chunks = indexed.groupBy("table", "bucket").agg(F.ceil(F.count("*") / cell_rows).cast("int").alias("chunks"))
    own = indexed.join(chunks, ["table", "bucket"]).withColumn("chunk", F.pmod(F.xxhash64("point"), F.col("chunks")).cast("int"))
    every = visits.join(chunks, ["table", "bucket"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    columns = ["table", "bucket", "chunk", "visits", "point", "first", "vector"]
    own = own.withColumn("visits", F.lit(0)).select(columns)

    def found_by(visits):
        """(query, found): the k + 1 nearest ids of what each query has visited."""
        both = own.union(visits.withColumn("visits", F.lit(1)).select(columns))
        dealt = both.repartition("table", "bucket", "chunk").sortWithinPartitions("table", "bucket", "chunk", "visits")
        scored = dealt.mapInArrow(_scored(k + 1), "query long, point long, first long, score double")
        # a point is found once per table at most
        order = Window.partitionBy("query").orderBy(F.desc("score"), "first", "point")
        near = scored.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= tables * (k + 1)).drop("nth").distinct()
        named = (
            near.join(points.select("point", "ids"), "point")
            .select("query", "score", F.explode("ids").alias("vec_id")))
        by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return (
            named.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
            .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("found")))

    lists = checkpointed(found_by(every))
    # a query that has found too few goes to every bucket of a table
    ids = points.agg(F.sum(F.size("ids"))).first()[0]
    enough = lists.where(F.size("found") >= min(k + 1, ids)).select(F.col("query").alias("point"))
    short = checkpointed(seeking.join(enough, "point", "left_anti"))
    if not short.isEmpty():
        first_table = chunks.where("table = 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        lists = lists.join(enough.withColumnRenamed("point", "query"), "query", "left_semi").unionByName(found_by(short.crossJoin(first_table)))
    results = asked.withColumnRenamed("vec_id", "query_id").join(lists, F.col("point") == F.col("query"))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return (
        results.select("query_id", F.posexplode(others).alias("at", "f"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score")))
