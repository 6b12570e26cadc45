"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut into balanced parts with
few edges between them. A small classifier learns which parts hold a vector's
neighbours; its first choice is the part a vector is indexed in, and a query is
routed to its several most probable parts. How many parts a query visits is
measured on sample rows kept out of training, as the least number that finds the
wished share of their neighbours. A part of more than ``PART_MOST`` vectors is cut
again in the same way, by a classifier of its own, until no part is larger: the
classifiers form a tree whose depth grows with the logarithm of the table. All
vectors of the parts that a query reaches are compared with it exactly.

Of equal vectors only the k + 1 of the smallest ids can be among the k nearest of
any query, so no others are indexed.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import written

#: Rows that the parts of one classifier are learnt from, in one task.
SAMPLE_ROWS = 8192
NEIGHBOURS = 10
#: Vectors wished in a part, and the least number of sample rows in one.
PART_ROWS, PART_SAMPLE = 256, 64
MIN_PARTS = 8
#: Parts of more vectors are cut again; levels of classifiers at most, for vectors that no cut can part.
PART_MOST, LEVELS = 4096, 6
#: Children of a part are numbered from it times so many.
CHILDREN = 256
IMBALANCE = 1.05
TARGET_RECALL = 0.97
#: Vectors and queries in one comparison task; larger parts are cut into slices.
SLICE_ROWS, SLICE_QUERIES = 4096, 1024
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part.

    Left out are NULL ids, NULL, empty and zero vectors, ones with a NULL or
    non-finite component, and ones not of the table's most frequent length.
    """
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector")).filter("vec_id is not null")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda v: v != 0))
    usual = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.filter(F.size("vector") == (usual["d"] if usual else 0))


def matrix(column) -> np.ndarray:
    """The rows of an Arrow list column of one length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest other rows of each row."""
    squares, out = (x * x).sum(1), np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 512):
        rows = np.arange(start, min(start + 512, len(x)))
        d = squares[None, :] - 2 * x[rows] @ x.T
        d[np.arange(len(rows)), rows] = np.inf
        out[rows] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def first_parts(x: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Equal parts by cutting along the widest direction, again and again."""
    out, todo = np.zeros(len(x), np.int64), [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        if n == 1:
            out[rows] = first
            continue
        centred, way = x[rows] - x[rows].mean(0), rng.normal(size=x.shape[1])
        for _ in range(8):
            way = centred.T @ (centred @ way)
            way /= np.linalg.norm(way) or 1.0
        order, half = np.argsort(centred @ way, kind="stable"), n // 2
        at = len(rows) * half // n
        todo += [(rows[order[:at]], first, half), (rows[order[at:]], first + half, n - half)]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    From equal cuts, rows move in rounds to the part of most of their graph
    neighbours, those that gain most first, while it has room.
    """
    part, most = first_parts(x, parts, rng), int(np.ceil(len(x) / parts * IMBALANCE))
    ends = np.repeat(np.arange(len(x)), near.shape[1])
    sizes = np.bincount(part, minlength=parts)
    for _ in range(12):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (ends, part[near.ravel()]), 1)
        np.add.at(votes, (near.ravel(), part[ends]), 1)
        wish = votes.argmax(1)
        gain = votes[np.arange(len(x)), wish] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[wish[i]] < most:
                sizes[part[i]] -= 1
                sizes[wish[i]] += 1
                part[i] = wish[i]
                moved += 1
        if moved < len(x) // 200:
            break
    return part


def fit_router(x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression from vectors to shares of parts, by Adam on small batches."""
    weights, bias = np.zeros((x.shape[1], wanted.shape[1])), np.zeros(wanted.shape[1])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, bias)]
    step = 0
    for _ in range(30):
        order = rng.permutation(len(x))
        for start in range(0, len(x), 256):
            rows, step = order[start : start + 256], step + 1
            error = (softmax(x[rows] @ weights + bias) - wanted[rows]) / len(rows)
            for p, g, (m, v) in zip((weights, bias), (x[rows].T @ error + 1e-5 * weights, error.sum(0)), state, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights, bias


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Router:
    """Classifier from vectors to parts; its size is components times parts."""

    def __init__(self, mean, scale, weights, bias, probes):
        self.mean, self.scale, self.weights, self.bias, self.probes = mean, float(scale), weights, bias, int(probes)

    @property
    def parts(self) -> int:
        return self.weights.shape[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


def pack(router: Router) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, mean=router.mean, scale=router.scale, weights=router.weights, bias=router.bias, probes=router.probes)
    return out.getvalue()


def unpack(model: bytes) -> Router:
    saved = np.load(io.BytesIO(model))
    return Router(**{x: saved[x] for x in saved.files})


def wished_parts(n: int) -> int:
    """Parts that n vectors are cut into by one classifier."""
    return max(1, min(n // 16, max(MIN_PARTS, n // PART_ROWS), max(1, SAMPLE_ROWS // PART_SAMPLE), CHILDREN - 1))


def fit_router_of(x: np.ndarray, parts: int, recall: float) -> Router:
    """A classifier into so many parts, learnt from these vectors."""
    rng = np.random.default_rng(5)
    top = float(np.abs(x).max()) or 1.0
    mean, scale = (x / top).mean(0) * top, ((x / top).std() or 1.0) * top
    z, m = np.clip((x - mean) / scale, -1e6, 1e6), min(parts, len(x))
    if m < 2 or len(x) <= NEIGHBOURS or (x == x[0]).all():
        return Router(mean, scale, np.zeros((x.shape[1], 1)), np.zeros(1), 1)
    near = neighbour_graph(z, NEIGHBOURS)
    part = balanced_parts(z, near, m, rng)
    wanted = np.zeros((len(z), m))
    np.add.at(wanted, (np.repeat(np.arange(len(z)), NEIGHBOURS), part[near.ravel()]), 1 / (NEIGHBOURS + 1))
    wanted[np.arange(len(z)), part] += 1 / (NEIGHBOURS + 1)
    apart = rng.permutation(len(z)) < max(1, len(z) // 5)
    router = Router(mean, scale, *fit_router(z[~apart], wanted[~apart], rng), m)
    scores = router.scores(x)
    place = np.argsort(np.argsort(-scores[apart], axis=1, kind="stable"), axis=1)
    held = scores.argmax(1)[near[apart]]
    visit = np.sort(np.take_along_axis(place, held, axis=1).ravel())
    router.probes = int(visit[min(len(visit) - 1, int(np.ceil(recall * len(visit))))]) + 1
    return router


def fit_node(recall: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id")
        router = fit_router_of(matrix(rows.column("vector")), wished_parts(rows.column("n")[0].as_py()), recall)
        return pa.table([rows.column("part").slice(0, 1), pa.array([pack(router)], pa.binary())], ["part", "model"])

    return run


def sampled(rows: DataFrame, large: DataFrame) -> DataFrame:
    """About ``SAMPLE_ROWS`` rows of each part in ``large(part, n)``: those whose hash lies below a threshold that follows from its size."""
    drawn = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(1 << 30))
    wanted = rows.withColumn("drawn", drawn).join(large, "part")
    return wanted.filter(F.col("drawn") * F.col("n") < F.lit(float(1 << 30) * SAMPLE_ROWS)).select("part", "n", "vec_id", "vector")


def in_slices_of(rows: DataFrame, models: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on the rows of a part and its model; a large part's rows are dealt over several tasks."""
    counts = rows.groupBy("part").agg(F.ceil(F.count("*") / SLICE_ROWS).cast("long").alias("slices"))
    counts = written(counts.join(models.select("part"), "part"), "part-slices")
    left = rows.join(counts, "part").withColumn("slice", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("slices"))).drop("slices")
    right = models.join(counts, "part").withColumn("slice", F.explode(F.expr("sequence(0L, slices - 1)"))).drop("slices")
    return left.groupBy("part", "slice").cogroup(right.groupBy("part", "slice")).applyInArrow(run, schema)


def move_down(rows: pa.Table, model: pa.Table) -> pa.Table:
    """Rows in the most probable child of their part."""
    child = unpack(model.column("model")[0].as_py()).scores(matrix(rows.column("vector"))).argmax(1) if len(rows) else np.empty(0, np.int64)
    part = rows.column("part").to_numpy() * CHILDREN + child + 1
    return pa.table([rows.column("vec_id"), rows.column("vector"), pa.array(part, pa.int64())], ["vec_id", "vector", "part"])


def build_index(rows: DataFrame, total: int) -> tuple[DataFrame, list[DataFrame]]:
    """``(vec_id, vector, part)`` of every row of ``rows``, which all have part 1, and ``(part, model, children)`` of each level of the tree."""
    levels, held = 1, total / wished_parts(total)
    while held > PART_MOST and levels < LEVELS:
        levels, held = levels + 1, held / wished_parts(int(held))
    placed = rows.select("vec_id", "vector", "part")
    leaves, models = [], []
    large = rows.sparkSession.createDataFrame([(1, total)], "part long, n long")
    while True:
        fitted = sampled(placed, large).groupBy("part").applyInArrow(fit_node(TARGET_RECALL ** (1 / levels)), "part long, model binary")
        fitted = written(fitted, "routers")
        placed = written(in_slices_of(placed, fitted, move_down, "vec_id long, vector array<double>, part long"), "vector-index")
        sizes = written(placed.groupBy("part").agg(F.count("*").alias("n")), "part-sizes")
        up = F.floor((F.col("part") - 1) / CHILDREN)
        children = sizes.groupBy(up.alias("part")).agg(F.collect_list(F.struct((F.col("part") - up * CHILDREN - 1).alias("child"), "n")).alias("children"))
        models.append(written(fitted.join(children, "part"), "routers-with-sizes"))
        large = sizes.filter(F.col("n") > PART_MOST)
        if len(models) == LEVELS or large.isEmpty():
            break
        leaves.append(placed.join(large, "part", "left_anti"))
        placed = written(placed.join(large.select("part"), "part", "left_semi"), "large-parts")
    for leaf in leaves:
        placed = placed.unionByName(leaf)
    return placed, models


def route_down(k: int):
    """Queries in the most probable children of their part, more where these hold too few rows."""

    def run(queries: pa.Table, model: pa.Table) -> pa.Table:
        if not len(queries) or not len(model):
            return pa.table([queries.column("vec_id").slice(0, 0), queries.column("vector").slice(0, 0), pa.array([], pa.int64())], ["vec_id", "vector", "part"])
        router = unpack(model.column("model")[0].as_py())
        held = np.zeros(router.parts, np.int64)
        for x in model.column("children")[0].as_py():
            held[x["child"]] = x["n"]
        order = np.argsort(-router.scores(matrix(queries.column("vector"))), axis=1, kind="stable")
        enough = (np.cumsum(held[order], axis=1) < 4 * (k + 1)).sum(axis=1) + 1
        chosen = (np.arange(router.parts) < np.maximum(router.probes, enough)[:, None]) & (held[order] > 0)
        row, place = np.nonzero(chosen)
        part = queries.column("part").to_numpy()[row] * CHILDREN + order[row, place] + 1
        rows = queries.take(pa.array(row))
        return pa.table([rows.column("vec_id"), rows.column("vector"), pa.array(part, pa.int64())], ["vec_id", "vector", "part"])

    return run


def route(queries: DataFrame, models: list[DataFrame], k: int) -> DataFrame:
    """``(vec_id, vector, part)``: the parts that each query reaches."""
    placed = queries.select("vec_id", "vector", "part")
    reached = []
    for level, model in enumerate(models):
        placed = written(in_slices_of(placed, model, route_down(k), "vec_id long, vector array<double>, part long"), "routes")
        if level + 1 < len(models):
            inner = models[level + 1].select("part")
            reached.append(placed.join(inner, "part", "left_anti"))
            placed = placed.join(inner, "part", "left_semi")
    for found in reached:
        placed = placed.unionByName(found)
    return placed


def distances(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Euclidean distances, scaled where squares leave the range of doubles."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        gap = x - point
        d = np.sqrt((gap * gap).sum(axis=1))
        odd = np.flatnonzero(~np.isfinite(d) | (d < 1e-140))
        if len(odd):
            half = x[odd] / 2 - point / 2
            gap = np.where(np.isfinite(gap[odd]).all(axis=1)[:, None], gap[odd], half)
            more = np.where(np.isfinite(x[odd] - point).all(axis=1), 1.0, 2.0)
            top = np.abs(gap).max(axis=1)
            share = gap / np.where(top > 0, top, 1.0)[:, None]
            d[odd] = np.sqrt((share * share).sum(axis=1)) * top * more
    return d


def nearest_in_slice(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        ids, x = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"))
        asked, q = queries.column("vec_id").to_numpy(), matrix(queries.column("vector"))
        out_query, out_vec, out_score = [], [], []
        spare = len(ids) - len(np.unique(ids))  # rows that repeat an id must not take another's place
        for query, point in zip(asked, q, strict=True) if len(ids) else ():
            d, others = distances(x, point), ids != query
            take = min(k + spare, int(others.sum())) - 1
            if take < 0:
                continue
            near = np.flatnonzero((d <= np.partition(d[others], take)[take]) & others)
            near = near[np.lexsort((ids[near], d[near]))][: k + spare]
            out_query.append(np.full(len(near), query))
            out_vec.append(ids[near])
            out_score.append(d[near])
        parts = [np.concatenate(x) if x else np.empty(0) for x in (out_query, out_vec, out_score)]
        return pa.table([pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.float64())], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 10, column: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest other rows found for each query row.

    ``queries`` is a condition on ``vec_id``. Distances are Euclidean, on the
    original vectors in double precision, ties to the smaller vec_id. Rows left
    out are named at ``usable``. A query gets all candidates if there are fewer
    than k. An id that is repeated counts once, at its nearest vector, and is
    never its own candidate. An empty table gives no rows. Needs vec_id and the
    vector column.
    """
    # The root's number is stored, as joins on a constant would be cross joins.
    rows = written(usable(vectors, column).withColumn("part", F.lit(1).cast("long")), "vectors")
    spark, asking = vectors.sparkSession, rows.filter(queries)
    equal = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    candidates = rows.distinct().withColumn("place", equal).filter(F.col("place") <= k + 1)
    candidates = written(candidates.drop("place"), "candidates")
    total = candidates.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, models = build_index(candidates, total)
    routed = written(route(asking.distinct(), models, k), "routes")
    row_slices = index.groupBy("part").agg(F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("row_slices"))
    query_slices = routed.groupBy("part").agg(F.ceil(F.count("*") / SLICE_QUERIES).cast("int").alias("query_slices"))
    slices = written(row_slices.join(query_slices, "part"), "slices")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}s")).cast("int")
        copies = F.explode(F.expr(f"sequence(0, {other}s - 1)"))
        return df.join(slices, "part").select("vec_id", "vector", "part", mine.alias(own), copies.alias(other))

    left, right = dealt(index, "row_slice", "query_slice"), dealt(routed, "query_slice", "row_slice")
    key = ["part", "row_slice", "query_slice"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(nearest_in_slice(k), FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
