"""Approximate nearest neighbours by balanced posting lists.

Vectors are cut into lists around centroids. The centroids come from a bounded sample by halving it again and again
across its widest direction, so lists are balanced. Largest inner products become smallest distances by one more
component that brings all vectors to the same length. A vector near the border of lists is filed in each list whose
centroid is nearly as close as the closest.

Each task holds the centroids, a bounded number, as a graph of neighbouring centroids. A query goes through it from a
few pivots to its closest centroid, and on from there to every centroid whose distance is at most ``ratio`` times that
of the closest; these are the lists that it visits, as many as the ratio lets in. With a ratio of infinity every list
is visited and answers are exact.

The lists of a query's ``FIRST`` closest centroids are scored first, on the original components; the k-th score is the
query's bound, and of its other lists only what reaches the bound is returned. A query for which those lists hold fewer
than ``k`` vectors visits all lists.

Skew: of equal vectors only the ``k + 1`` smallest ids are filed, which decide every answer exactly. Neighbouring lists
make up a cell; a query is sent once to each cell that it visits. A cell with more than its rows is cut into chunks,
and the queries of a cell too, so a task never holds more than a chunk of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialguard.llm.common import staged

#: Vectors to a list, and the largest number of lists: the bound of the centroids that each task holds.
LIST_ROWS, MAX_LISTS = 128, 8192
#: Sampled vectors to a list and in all, which bound the sample that centroids are fitted on.
SAMPLE_PER_LIST, MAX_SAMPLE = 32, 1 << 17
#: A vector is filed in up to ``COPIES`` lists whose centroids are up to this ratio farther than the closest.
COPIES, FILE_RATIO = 4, 1.02
#: Neighbours of a centroid in the graph, a sixth of them by chance, and pivots to start from.
DEGREE, PIVOTS = 24, 64
#: A query visits the lists whose centroids are up to this ratio farther than the closest, and the ``FIRST`` closest.
VISIT_RATIO, FIRST = 1.3, 8
#: Rows of vectors and of queries that a task holds at once, and rows that go through the graph together.
CELL_ROWS, ASKED_ROWS, GRAPH_ROWS = 8192, 8192, 256
SEED = 11


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _halved(vectors: np.ndarray, lists: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Row numbers of ``lists`` parts of nearly equal size: each cut is across the direction of widest spread."""
    parts, todo = [], [(np.arange(len(vectors)), lists)]
    while todo:
        rows, n = todo.pop()
        if n <= 1 or len(rows) <= 1:
            parts.append(rows)
            continue
        x = vectors[rows] - vectors[rows].mean(axis=0)
        way = rng.standard_normal(x.shape[1])
        for _ in range(6):
            way = x.T @ (x @ way)
            way /= np.linalg.norm(way) + 1e-300
        left = n // 2
        order = rows[np.argsort(x @ way, kind="stable")]
        at = round(len(rows) * left / n)
        todo += [(order[:at], left), (order[at:], n - left)]
    return [p for p in parts if len(p)]


def _files(centroids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each unit row of ``x`` the lists that it is filed in, closest first (others -1)."""
    near = x.astype(np.float32) @ centroids.T
    k = min(COPIES, len(centroids))
    ids = np.argpartition(-near, k - 1, axis=1)[:, :k]
    order = np.argsort(-np.take_along_axis(near, ids, 1), axis=1, kind="stable")
    ids = np.take_along_axis(ids, order, 1)
    away = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, ids, 1), 0))
    return np.where(away <= FILE_RATIO * away[:, :1] + 1e-6, ids, -1)


def _linked(centroids: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of each of the unit ``centroids``, near ones and some by chance, and the pivots to start from."""
    n = len(centroids)
    degree = min(DEGREE, n)
    links = np.empty((n, degree), np.int32)
    for at in range(0, n, 512):
        near = centroids[at : at + 512] @ centroids.T
        links[at : at + 512] = np.argpartition(-near, degree - 1, axis=1)[:, :degree]
    if n > degree:
        links[:, degree - degree // 6 :] = rng.integers(0, n, (n, degree // 6))
    return links, np.sort(rng.permutation(n)[:PIVOTS])


def _visits(graph: tuple, x: np.ndarray, ratio: float) -> list[np.ndarray]:
    """For each unit row of ``x`` the lists that it visits, closest first.

    The search opens the ``FIRST`` closest centroids seen until they are all open, and then all that are seen and
    within the ratio. An open centroid shows its neighbours; each is compared with a row once.
    """
    centroids, links, pivots = graph
    x = x.astype(np.float32)
    if ratio == float("inf"):
        return list(np.argsort(-(x @ centroids.T), axis=1, kind="stable"))
    near = np.full((len(x), len(centroids)), -np.inf, np.float32)
    near[:, pivots] = x @ centroids[pivots].T
    opened = np.zeros(near.shape, bool)
    at = max(near.shape[1] - FIRST, 0)
    wide = False
    while True:
        least = np.partition(near, at, axis=1)[:, at]
        if wide:
            away = ratio * np.sqrt(np.maximum(2 - 2 * near.max(axis=1), 0)) + 1e-6
            least = np.minimum(least, 1 - away * away / 2)
        reached = (near >= least[:, None]) & (near > -np.inf)
        row, centroid = np.nonzero(reached & ~opened)
        if len(row):
            opened[row, centroid] = True
            shown = np.zeros(near.shape, bool)
            shown[np.repeat(row, links.shape[1]), links[centroid].ravel()] = True
            row, centroid = np.nonzero(shown & (near == -np.inf))
            near[row, centroid] = np.einsum("nd,nd->n", x[row], centroids[centroid])
        elif wide:
            return [ids[np.argsort(-own[ids], kind="stable")] for own, ids in zip(near, map(np.flatnonzero, reached))]
        else:
            wide = True


def _usable(column: Column, width: int) -> Column:
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return column.isNotNull() & (F.size(column) == width) & ~bad & F.exists(column, lambda v: v != 0)


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """``vec, ids, least``: different vectors with their ``k + 1`` smallest ids, cut down in salted groups first."""
    keyed = rows.select("id", "vec", F.xxhash64("vec").alias("h"), F.pmod(F.xxhash64("id"), F.lit(16)).alias("salt"))
    for key in (["h", "vec", "salt"], ["h", "vec"]):
        place = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
        keyed = keyed.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    return keyed.groupBy("h", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        "vec", "ids", F.col("ids")[0].alias("least")
    )


def _file(graph, width: int, longest: float):
    """Rows of distinct vectors to a row for each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column(0), width) / longest
                rest = np.sqrt(np.maximum(1 - np.einsum("nd,nd->n", x, x), 0))
                lists = _files(graph.value[0], np.column_stack([x, rest]))
                row, slot = np.nonzero(lists >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[row, slot], pa.int32()), *part.take(pa.array(row)).columns],
                    names=["list", "vec", "ids", "least"],
                )

    return run


def _ask(graph, width: int, ratio: float):
    """Queries with the lists that they visit, closest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GRAPH_ROWS):
                part = batch.slice(at, GRAPH_ROWS)
                x = _matrix(part.column(1), width)
                x = np.column_stack([x / np.linalg.norm(x, axis=1)[:, None], np.zeros(len(x))])
                visits = pa.array(_visits(graph.value, x, ratio), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, visits], names=["query_id", "query", "visits"])

    return run


def _send(lists: int, per_cell: int):
    """Queries with their lists to a row for each cell, with the cell's lists; queries without a bound visit all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GRAPH_ROWS):
                part = batch.slice(at, GRAPH_ROWS)
                visits, bounds = part.column("visits").to_pylist(), part.column("bound").to_pylist()
                row, sent = [], []
                for k, (own, bound) in enumerate(zip(visits, bounds, strict=True)):
                    own = np.arange(lists) if bound is None else np.sort(np.array(own, np.int32))
                    if len(own):
                        cells = np.split(own, np.flatnonzero(np.diff(own // per_cell)) + 1)
                        row += [k] * len(cells)
                        sent += cells
                taken = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(c[0]) // per_cell for c in sent], pa.int32()), taken.column("query_id"),
                        taken.column("query"), taken.column("bound"), pa.array(sent, pa.list_(pa.int32())),
                    ],
                    names=["cell", "query_id", "query", "bound", "visits"],
                )

    return run


def _found(
    q: np.ndarray, v: np.ndarray, queries: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, ids: pa.ListArray,
    bound: np.ndarray, k: int,
) -> pa.Table:
    """The ``k`` best ids for each query among the pairs of rows ``q, v`` that reach its bound (NaN: none)."""
    exact = (queries[q] * vectors[v]).sum(axis=1)
    start = ids.offsets.to_numpy()
    many = np.diff(start)[v]
    flat = np.repeat(start[v] - np.cumsum(many) + many, many) + np.arange(many.sum())
    q, scores = np.repeat(q, many), np.repeat(exact, many)
    found = ids.values.to_numpy()[flat]
    keep = np.flatnonzero((found != query_ids[q]) & ~(scores < bound[q]))
    keep = keep[np.lexsort((found[keep], -scores[keep], q[keep]))]
    again = (np.diff(q[keep], prepend=-1) == 0) & (np.diff(found[keep], prepend=-1) == 0)  # filed in several lists
    keep = keep[~again]
    place = np.arange(len(keep)) - np.searchsorted(q[keep], q[keep])
    keep = keep[place < k]
    return pa.table({"query_id": query_ids[q[keep]], "id": found[keep], "score": scores[keep]})


def _pairs(filed: pa.Table, asked: pa.Table, vectors: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int) -> tuple:
    """Rows of queries and vectors that may be among the best: list by list, the queries that visit it."""
    lists = filed.column("list").to_numpy()
    order = np.argsort(lists, kind="stable")
    names, starts = np.unique(lists[order], return_index=True)
    visits = asked.column("visits").combine_chunks()
    visitor = np.repeat(np.arange(len(queries)), np.diff(visits.offsets.to_numpy()))
    by_list = np.argsort(visits.values.to_numpy(), kind="stable")
    visitor, visited = visitor[by_list], visits.values.to_numpy()[by_list]
    room = 1e-9 * (1 + np.linalg.norm(queries, axis=1) * np.sqrt(np.einsum("nd,nd->n", vectors, vectors).max()))
    least = np.where(np.isnan(bound), -np.inf, bound) - room
    all_q, all_v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for name, members in zip(names, np.split(order, starts[1:]), strict=True):
        rows = visitor[np.searchsorted(visited, name) : np.searchsorted(visited, name, "right")]
        if not len(rows):
            continue
        own = vectors[members].T
        for rows in np.array_split(rows, -(-len(rows) * len(members) // (1 << 21))):
            near = queries[rows] @ own
            hit = near >= least[rows, None]
            full = np.flatnonzero(hit.sum(axis=1) > k + 4)
            if len(full):
                top = np.argpartition(-near[full], k + 3, axis=1)[:, : k + 4]
                hit[full] = False
                hit[full[:, None], top] = True
            q, v = np.nonzero(hit)
            all_q.append(rows[q])
            all_v.append(members[v])
    return np.concatenate(all_q), np.concatenate(all_v)


def _best(width: int, k: int):
    """The best ids for each query of a cell among the vectors of its lists."""

    def run(filed: pa.Table, asked: pa.Table) -> pa.Table:
        if not filed.num_rows or not asked.num_rows:
            empty = np.empty(0, np.int64)
            return pa.table({"query_id": empty, "id": empty, "score": np.empty(0)})
        vectors, queries = _matrix(filed.column("vec"), width), _matrix(asked.column("query"), width)
        bound = asked.column("bound").to_numpy().astype(np.float64)
        q, v = _pairs(filed, asked, vectors, queries, bound, k)
        ids = filed.column("ids").combine_chunks()
        return _found(q, v, queries, vectors, asked.column("query_id").to_numpy(), ids, bound, k)

    return run


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    ratio: float = VISIT_RATIO,
) -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` nearest found for each row of ``vectors`` where ``queries`` holds.

    Nearness is the largest inner product in double precision; ties go to the smaller id. ``ratio`` decides which
    lists are visited; infinity makes answers exact. Rows whose id or vector is null, whose vector is zero, holds null
    or non-finite components or has another length than most, take no part. Repeated rows count once. With fewer than
    ``k`` other rows all are returned; an empty table gives no rows. Other columns are not read.
    """
    read = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"), queries.alias("asks"))
    read = read.where("id is not null and vec is not null")
    usual = read.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = usual["n"] if usual else 1
    rows = read.where(_usable(F.col("vec"), width)).distinct()
    kept = staged(_distinct(rows, k), "vectors")
    squares = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    n, square = kept.agg(F.count(F.lit(1)), F.max(squares)).first()
    longest = float(square or 1.0) ** 0.5

    lists = max(1, min(MAX_LISTS, -(-n // LIST_ROWS)))
    rng = np.random.default_rng(SEED)
    sampled = min(lists * SAMPLE_PER_LIST, MAX_SAMPLE)
    sample = kept.orderBy(F.xxhash64("least"), "least").limit(sampled).select("vec").toArrow()
    x = _matrix(sample.column("vec"), width) / longest
    x = np.column_stack([x, np.sqrt(np.maximum(1 - np.einsum("nd,nd->n", x, x), 0))])
    centroids = np.array([x[part].mean(axis=0) for part in _halved(x, lists, rng)]) if len(x) else np.zeros((1, width + 1))
    lists = len(centroids)
    length = np.linalg.norm(centroids, axis=1)[:, None]
    unit = (centroids / np.where(length > 0, length, 1)).astype(np.float32)
    graph = vectors.sparkSession.sparkContext.broadcast((unit, *_linked(unit, rng)))

    kind = rows.schema["vec"].dataType.simpleString()
    filed = staged(
        kept.mapInArrow(_file(graph, width, longest), f"list int, vec {kind}, ids array<bigint>, least bigint"), "lists"
    )
    asked = rows.where("asks").select(F.col("id").alias("query_id"), F.col("vec").alias("query"))
    asked = staged(
        asked.mapInArrow(_ask(graph, width, ratio), f"query_id bigint, query {kind}, visits array<int>"), "asked"
    )
    per_cell = max(1, CELL_ROWS // max(1, -(-filed.count() // lists)))

    def scored(part: DataFrame) -> DataFrame:
        """``query_id, id, score`` for queries ``part`` with their lists and bounds.

        Tasks get pairs of a chunk of a cell's vectors and a chunk of its queries.
        """
        sent = part.mapInArrow(
            _send(lists, per_cell), f"cell int, query_id bigint, query {kind}, bound double, visits array<int>"
        )
        sent = staged(sent, "sent")
        cells = filed.withColumn("cell", F.floor(F.col("list") / per_cell).cast("int"))

        def chunks(table: DataFrame, name: str, rows: int) -> DataFrame:
            return table.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias(name))

        numbers = chunks(cells, "chunks", 2 * CELL_ROWS).join(chunks(sent, "query_chunks", ASKED_ROWS), "cell")

        def dealt(table: DataFrame, by: str, own: str, other: str) -> DataFrame:
            own_chunk = F.pmod(F.xxhash64(by), F.col(own)).cast("int").alias(own[:-1])
            copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1])
            return table.join(numbers, "cell").select(*table.columns, own_chunk, other).select(
                *table.columns, own[:-1], copies
            )

        key = ["cell", "chunk", "query_chunk"]
        return (
            dealt(cells, "least", "chunks", "query_chunks").groupBy(*key)
            .cogroup(dealt(sent, "query_id", "query_chunks", "chunks").groupBy(*key))
            .applyInArrow(_best(width, k), "query_id bigint, id bigint, score double")
        )

    def ranked(found: DataFrame) -> DataFrame:
        best = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    nearby = max(FIRST, -(-2 * (k + 1) // LIST_ROWS))
    none = F.lit(float("nan")).alias("bound")
    first = staged(ranked(scored(asked.select("query_id", "query", none, F.slice("visits", 1, nearby).alias("visits")))), "first")
    bounds = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))
    others = F.when(F.size("visits") > nearby, F.slice("visits", nearby + 1, lists)).otherwise(F.array().cast("array<int>"))
    rest = asked.join(bounds, "query_id", "left").select("query_id", "query", "bound", others.alias("visits"))
    final = ranked(first.select("query_id", "id", "score").unionAll(scored(rest)))
    return final.select("query_id", "rank", F.col("id").alias(id_col), "score")
