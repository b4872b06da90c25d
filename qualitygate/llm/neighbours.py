"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts, and a small classifier learns
which part a row belongs to and assigns every row of the index. Another one learns in which parts the rows of
largest inner product with a query lie, and routes each query to its several most probable
parts, whose rows are compared exactly.

Rows get one more component, such that all have the same length and, with a zero there, queries keep their
order: near in direction then means large in inner product, also where lengths differ.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qualitygate.llm.common import spool

#: Bound of the sample that the parts are learned from, and the degree of its graph.
SAMPLE, DEGREE = 9000, 12
#: Rows of the index for one part at least (until the sample is too small for more parts).
PART_ROWS, SAMPLE_PER_PART = 800, 140
#: A query goes to the most probable parts until they should hold this share of its neighbours.
EXPECTED = 0.95
#: Sizes of what is compared at once; small parts share a cell of about that many rows.
ROWS_AT_ONCE, QUERIES_AT_ONCE = 8192, 1024


def _usable(vector: str) -> Column:
    """Not null, not zero, all components finite."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _directions(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _lengths(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Rows as unit vectors with one more component, which takes what they are shorter than the longest."""
    share = np.minimum(_lengths(vectors) / longest, 1.0)
    return np.hstack([_directions(vectors) * share[:, None], np.sqrt(1 - share**2)[:, None]])


def neighbour_graph(x: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """For each of ``x`` the rows (``x`` itself if not given) of largest inner product, without the one of the same number."""
    n = len(x)
    rows = x if rows is None else rows
    near = np.empty((n, min(DEGREE, n - 1)), np.int64)
    for a in range(0, n, 1000):
        s = x[a : a + 1000] @ rows.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        near[a : a + 1000] = np.argpartition(-s, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Cut the neighbour graph of ``x`` into parts of nearly equal size.

    Parts grow around far-apart seeds, then rows move to the part that most of their
    neighbours are in, as long as that part has room.
    """
    n = len(x)
    rnd = np.random.default_rng(seed)
    seeds = [int(rnd.integers(n))]
    best = x @ x[seeds[0]]
    for _ in range(parts - 1):
        seeds.append(int(best.argmin()))
        best = np.maximum(best, x @ x[seeds[-1]])
    centres, room = x[seeds], int(np.ceil(1.15 * n / parts))
    part = np.zeros(n, np.int64)
    for _ in range(12):
        likes = x @ centres.T
        part[:], size = -1, np.zeros(parts, np.int64)
        for i in np.argsort(-likes.max(axis=1)).tolist():
            for p in np.argsort(-likes[i]).tolist():
                if size[p] < room:
                    part[i], size[p] = p, size[p] + 1
                    break
        centres = _directions(np.stack([x[part == p].sum(axis=0) if size[p] else centres[p] for p in range(parts)]) + 1e-12)
    others = [[] for _ in range(n)]
    for i in range(n):
        for j in near[i].tolist():
            others[i].append(j)
            others[j].append(i)
    for _ in range(8):
        moved = 0
        for i in rnd.permutation(n).tolist():
            votes = np.bincount(part[others[i]], minlength=parts)
            p = int(votes.argmax())
            if votes[p] > votes[part[i]] and size[p] < room:
                size[part[i]] -= 1
                size[p] += 1
                part[i], moved = p, moved + 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Weights of a softmax classifier from directions to the shares of neighbours in each part."""
    parts = truth.shape[1]
    weights, m, v = np.zeros((x.shape[1] + 1, parts)), 0.0, 0.0
    inputs = np.hstack([x, np.ones((len(x), 1))])
    for step in range(1, 301):
        s = inputs @ weights
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = inputs.T @ (p - truth) / len(x) + 1e-5 * weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        weights = weights - 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _top(q_rows, q, reached, rows, ids, parts, vectors, k):
    """(query, row) pairs of the exact ``k`` best per query within one block, with scores.

    ``reached`` says which parts each query is routed to.
    """
    distinct, same = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((rows, ids, same.ravel()))  # of equal vectors only the first k + 1 can count
    group = same.ravel()[order]
    rank = np.arange(len(order)) - np.searchsorted(group, group)
    order = order[rank <= k]
    group = same.ravel()[order]
    begin, end = np.searchsorted(group, np.arange(len(distinct))), np.searchsorted(group, np.arange(len(distinct)), "right")
    s = np.where(reached[:, parts[order[begin]]], q @ distinct.T, -np.inf)
    take = min(k + 1, len(distinct))
    least = np.partition(s, len(distinct) - take, axis=1)[:, len(distinct) - take]
    slack = 1e-9 * np.sqrt((q**2).sum(axis=1)) * np.sqrt((distinct**2).sum(axis=1)).max()
    at, which = np.nonzero((s >= (least - slack)[:, None]) & (s > -np.inf))
    score = (q[at] * distinct[which]).sum(axis=1)
    n = (end - begin)[which]
    which_row = order[np.repeat(begin[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    at, score = np.repeat(at, n), np.repeat(score, n)
    other = rows[which_row] != q_rows[at]
    at, score, which_row = at[other], score[other], which_row[other]
    final = np.lexsort((rows[which_row], ids[which_row], -score, at))
    at = at[final]
    keep = np.arange(len(at)) - np.searchsorted(at, at) < k
    return at[keep], which_row[final][keep], score[final][keep]


def _compare(width: int, k: int):
    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64()))})
        left, right = left.combine_chunks(), right.combine_chunks()
        rows, ids = left["row"].to_numpy(), left["vec_id"].to_numpy()
        q_rows, q_ids = right["row"].to_numpy(), right["vec_id"].to_numpy()
        parts = left["part"].to_numpy()
        lists = right["parts"].combine_chunks()
        reached = np.zeros((len(q_rows), 1 + max(int(parts.max()), int(lists.flatten().to_numpy().max()))), bool)
        reached[np.repeat(np.arange(len(q_rows)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
        at, of, score = _top(q_rows, _matrix(right["vector"].combine_chunks(), width), reached, rows, ids, parts, _matrix(left["vector"].combine_chunks(), width), k)
        return pa.table({"query_row": q_rows[at], "query_id": q_ids[at], "vec_id": ids[of], "row": rows[of], "score": score})

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product found for each query.

    Queries are the rows whose id is divisible by ``every``; all rows but the query's own are
    candidates. Rows with a null id take no part, nor do vectors that are null, zero, of
    another length than most, or hold null or non-finite components. Equal
    scores go by id, then by row; rows with a repeated id are rows of their own. Fewer
    than ``k`` other rows are all returned, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    usable = vectors.where(F.col(key).isNotNull() & _usable(vector)).select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    usable = spool(usable, "vectors")
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = usable.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    width, total = lengths["n"], lengths["count"]
    usable = usable.where(F.size("vector") == width)

    def of_batch(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([pa.array([_lengths(_matrix(batch.column("vector"), width)).max()])], names=["longest"])

    longest = usable.select("vector").mapInArrow(of_batch, "longest double").agg(F.max("longest")).first()[0]
    x = np.array([r.vector for r in usable.orderBy(F.xxhash64("vec_id"), "row").limit(SAMPLE).collect()])
    parts = max(1, min(len(x) // SAMPLE_PER_PART, total // PART_ROWS))
    home, router = np.zeros((width + 2, 1)), np.zeros((width + 1, 1))
    if parts > 1:
        rows, asked = lifted(x, longest), _directions(x)
        near = neighbour_graph(rows)
        home = train_router(rows, np.eye(parts)[balanced_parts(rows, near, parts)[near]].mean(axis=1))
        part = (rows @ home[:-1] + home[-1]).argmax(axis=1)
        router = train_router(asked, np.eye(parts)[part[neighbour_graph(asked, rows[:, :-1])]].mean(axis=1))

    def shares(column) -> np.ndarray:
        s = _directions(_matrix(column, width)) @ router[:-1] + router[-1]
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)

    def assign(batches):
        for batch in batches:
            likes = lifted(_matrix(batch.column("vector"), width), longest) @ home[:-1] + home[-1] if len(batch) else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(likes.argmax(axis=1).astype(np.int32))], names=[*batch.schema.names, "part"])

    fields = "row long, vec_id long, vector array<double>, part int"
    index = spool(usable.mapInArrow(assign, fields), "vectors")
    sizes = np.zeros(parts, np.int64)
    for r in index.groupBy("part").count().collect():  # one row per part
        sizes[r["part"]] = r["count"]

    def route(batches):
        for batch in batches:
            if not len(batch):
                continue
            share = shares(batch.column("vector"))
            order = np.argsort(-share, axis=1, kind="stable")
            held = np.cumsum(np.take_along_axis(share, order, axis=1), axis=1)
            reached = np.cumsum(sizes[order], axis=1)
            wanted = np.maximum((held < EXPECTED).sum(axis=1), (reached < k + 1).sum(axis=1)) + 1
            at, rank = np.nonzero(np.arange(parts)[None, :] < wanted[:, None])
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(at)) for c in batch.columns], pa.array(order[at, rank].astype(np.int32))], names=[*batch.schema.names, "part"])

    queries = usable.where(F.col("vec_id") % every == 0)
    cells = np.cumsum(sizes) - sizes  # small parts one after the other share a cell, a large one has its own
    cells = np.unique(np.maximum.accumulate(cells // ROWS_AT_ONCE), return_inverse=True)[1]
    cell_of = F.get(F.array(*[F.lit(int(c)) for c in cells]), F.col("part"))
    routed = queries.mapInArrow(route, fields).groupBy("row", "vec_id", "vector", cell_of.alias("cell")).agg(F.collect_list("part").alias("parts"))  # at most all parts
    routed = spool(routed, "vectors")
    held, asked = np.bincount(cells, weights=sizes).astype(int), np.zeros(cells.max() + 1, int)
    for r in routed.groupBy("cell").count().collect():  # one row per cell
        asked[r["cell"]] = r["count"]

    def pieces(counts, at_once) -> Column:
        return F.get(F.array(*[F.lit(int(max(1, -(-n // at_once)))) for n in counts]), F.col("cell"))

    of_rows, of_queries = pieces(held, ROWS_AT_ONCE), pieces(asked, QUERIES_AT_ONCE)
    dealt = F.xxhash64("row")
    left = index.withColumn("cell", cell_of).withColumn("block", F.pmod(dealt, of_rows)).withColumn("slice", F.explode(F.sequence(F.lit(0), of_queries - 1)))
    right = routed.withColumn("slice", F.pmod(dealt, of_queries).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (of_rows - 1).cast("long"))))
    found = left.groupBy("cell", "block", "slice").cogroup(right.groupBy("cell", "block", "slice")).applyInArrow(_compare(width, k), "query_row long, query_id long, vec_id long, row long, score double")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_exact(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding") -> list[tuple]:
    """The exact answer by comparing everything on the driver: for measuring recall on small tables."""
    rows = [(r[0], r[1]) for r in vectors.where(F.col(key).isNotNull() & _usable(vector)).select(key, F.col(vector).cast("array<double>")).collect()]
    out = []
    for i, (query, q) in enumerate(rows):
        if query % every == 0:
            scored = sorted((-(np.array(q) * np.array(v)).sum(), other) for j, (other, v) in enumerate(rows) if j != i and len(v) == len(q))
            out += [(query, n + 1, other, -s) for n, (s, other) in enumerate(scored[:k])]
    return out
