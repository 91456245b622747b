"""Nearest neighbours by shifted space-filling curves.

Vectors are made equally long (one more coordinate takes up what a vector lacks to the longest one, so
that the largest inner product with a query is the nearest point to it), projected to ``PROJECTED``
dimensions and shifted, and ordered by their place on a Hilbert curve; each of several orderings has its
own projection and shift. Spark range-partitions an ordering into runs of neighbouring keys; a run is one
block of vectors. A query looks at the rows within ``width`` places of its own on every curve, in the
blocks that its window touches, by one matrix product a block; the best of all windows are merged.

Width and number of orderings are fitted: the true neighbours of a bounded sample of queries
(``SAMPLE_QUERIES``, compared with all rows) have known places on every curve, and the cheapest choice
that reaches ``RECALL`` of them is taken. Nothing else is sampled; every row is on every curve used.

Equal vectors are one point with its smallest ids, as many as any query can need, so that any number of
copies lies in one place and ties between them go to the smaller ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import Scratch
from landfall.llm.whitening import usable

NEAREST = 20
ORDERINGS = (2, 3, 4)
PROJECTED, BITS = 8, 7
RECALL = 0.97
SAMPLE_QUERIES = 256
#: Rows of a block at most, and blocks of an ordering at least (where it has the rows for them).
BLOCK_ROWS = 1 << 16
BLOCKS = 12
#: Queries that travel together, and how many such lists a task compares with a block.
QUERY_ROWS = 2048
LISTS = 16
#: Rows compared at once.
STEP = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below ``2 ** bits`` (rows), by the
    transposed form: exchange and invert from the highest bit down, then undo the Gray code."""
    x = cells.astype(np.int64).T.copy()
    n = x.shape[0]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (x[i] >> b & 1)
    return key


def orderings(dims: int, number: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Orthonormal projections of ``dims + 1`` coordinates and shifts (parts of the longest vector)."""
    rng = np.random.RandomState(11)
    out = []
    for _ in range(number):
        q, _ = np.linalg.qr(rng.standard_normal((dims + 1, min(PROJECTED, dims + 1))))
        out.append((q, rng.uniform(0, 1, q.shape[1])))
    return out


def curve_places(x: np.ndarray, longest: float, of: tuple[np.ndarray, np.ndarray], query: bool) -> np.ndarray:
    """Keys of the rows of ``x`` on one curve, as points of the index or as queries."""
    x = x / longest
    square = (x * x).sum(axis=1)
    if query:
        point = np.concatenate([x / np.maximum(np.sqrt(square), 1e-300)[:, None], np.zeros((len(x), 1))], axis=1)
    else:
        point = np.concatenate([x, np.sqrt(np.maximum(0, 1 - square))[:, None]], axis=1)
    project, shift = of
    cell = np.floor((point @ project + 1 + shift) / 3 * (1 << BITS))
    return hilbert_keys(np.clip(cell, 0, (1 << BITS) - 1), BITS)


def _vectors(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _keys(curves, longest: float):
    """(curve, key, point, asks, vector): a row of the index on each curve, and one for a query."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, asks = _vectors(b.column(1)), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            some = np.flatnonzero(asks)
            for k, of in enumerate(curves):
                for rows, query in ((np.arange(len(x)), False), (some, True)):
                    if rows.size:
                        at = pa.array(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(rows.size, k, dtype=np.int32)), pa.array(curve_places(x[rows], longest, of, query)), b.column(0).take(at),
                             pa.array(np.full(rows.size, query)), b.column(1).take(at)], ["curve", "key", "point", "asks", "vector"])

    return run


_BLOCK = "curve int, part int, block int, rows long, points binary, vectors binary, asked long, ask_points binary, ask_at binary, ask_vectors binary"


def _pack(rows: int):
    """Runs of a sorted partition as blocks: the points in order, and the queries with the number of
    the block's points before them."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    kinds = [*[pa.int32()] * 3, pa.int64(), pa.binary(), pa.binary(), pa.int64(), *[pa.binary()] * 3]

    def run(batches):
        part, block = TaskContext.get().partitionId(), 0
        held, n, curve = [], 0, None

        def close():
            point, asks, x = (np.concatenate(c) for c in zip(*held))
            before = np.cumsum(~asks) - ~asks
            own = [curve, part, block, int((~asks).sum()), point[~asks].tobytes(), x[~asks].tobytes(),
                   int(asks.sum()), point[asks].tobytes(), before[asks].astype(np.int64).tobytes(), x[asks].tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(own, kinds)], names)

        for b in batches:
            which = b.column(0).to_numpy(zero_copy_only=False)
            point, asks = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False).astype(bool)
            x = _vectors(b.column(4)) if b.num_rows else None
            at = 0
            while at < b.num_rows:
                if held and (curve != which[at] or n >= rows):
                    yield close()
                    held, n, block = [], 0, block + 1
                curve = int(which[at])
                end = min(at + rows - n, int(np.searchsorted(which, curve, side="right")))
                held.append((point[at:end], asks[at:end], x[at:end]))
                n, at = n + end - at, end
        if held:
            yield close()

    return run


def _true_neighbours(points: np.ndarray, asked: np.ndarray, k: int):
    def run(batches):
        best = [(np.empty(0), np.empty(0, dtype=np.int64))] * len(points)
        for b in batches:
            if b.num_rows:
                own, scores = b.column(0).to_numpy(zero_copy_only=False), asked @ _vectors(b.column(1)).T
                for q in range(len(points)):
                    s, p = np.append(best[q][0], scores[q]), np.append(best[q][1], own)
                    at = np.lexsort((p, -s))[:k]
                    best[q] = s[at], p[at]
        rows = [(int(points[q]), int(p), float(s)) for q, (ss, pp) in enumerate(best) for s, p in zip(ss, pp)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["query", "point", "score"])

    return run


def _ranks(points: np.ndarray, queries: np.ndarray):
    """Places in their block of the wanted points and queries."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                for ids, wanted, at, asks in ((r["points"], points, None, False), (r["ask_points"], queries, r["ask_at"], True)):
                    own = np.frombuffer(ids, dtype=np.int64)
                    here = np.flatnonzero(np.isin(own, wanted))
                    places = here if at is None else np.frombuffer(at, dtype=np.int64)[here]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(here.size, r["curve"], dtype=np.int32)), pa.array(own[here]), pa.array(np.full(here.size, asks)), pa.array(places + r["begin"])],
                        ["curve", "point", "asks", "place"])

    return run


def fitted_width(places: dict, pairs: list[tuple[int, int]], n: int, recall: float = RECALL) -> tuple[int, int]:
    """(number of orderings, width) of the least rows to look at that finds ``recall`` of ``pairs``
    (query, point); ``places[curve, point, asks]`` are their places."""
    if not pairs:
        return ORDERINGS[0], n
    far = np.array([[abs(places[c, q, True] - places[c, p, False]) for q, p in pairs] for c in range(ORDERINGS[-1])])
    choice = []
    for k in ORDERINGS:
        least = np.sort(far[:k].min(axis=0))
        width = int(least[min(least.size, int(np.ceil(recall * least.size))) - 1]) + 1
        choice.append((k * min(n, 2 * width), k, width))
    return min(choice)[1:]



def _lists(batches):
    """The queries of each block in lists of bounded length, at their places on the whole curve."""
    for b in batches:
        for r in b.to_pylist():
            own, at = np.frombuffer(r["ask_points"], dtype=np.int64), np.frombuffer(r["ask_at"], dtype=np.int64) + r["begin"]
            x = np.frombuffer(r["ask_vectors"], dtype=np.float64).reshape(own.size, -1)
            for k, a in enumerate(range(0, own.size, QUERY_ROWS)):
                s = slice(a, a + QUERY_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in ((r["curve"], pa.int32()), (r["part"], pa.int32()), (r["block"], pa.int32()), (k, pa.int32()), (int(at[s][0]), pa.int64()),
                                                   (int(at[s][-1]), pa.int64()), (own[s].tobytes(), pa.binary()), (at[s].tobytes(), pa.binary()), (x[s].tobytes(), pa.binary()))],
                    ["curve", "part", "block", "list", "low", "high", "ask_points", "ask_at", "ask_vectors"])


def _compare(width: int, k: int):
    """The best points of one block for each query of the lists that reach it."""

    def run(key, left, right):
        block, found = left.to_pylist(), []
        if not block:
            return pa.table({"query": pa.array([], pa.int64()), "point": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        block = block[0]
        points = np.frombuffer(block["points"], dtype=np.int64)
        x = np.frombuffer(block["vectors"], dtype=np.float64).reshape(points.size, -1)
        for r in right.to_pylist():
            own, at = np.frombuffer(r["ask_points"], dtype=np.int64), np.frombuffer(r["ask_at"], dtype=np.int64)
            asked = np.frombuffer(r["ask_vectors"], dtype=np.float64).reshape(own.size, -1)
            lo = np.clip(at - width - block["begin"], 0, points.size)
            hi = np.clip(at + width - block["begin"], 0, points.size)
            s, p = np.full((own.size, 0), -np.inf), np.empty((own.size, 0), dtype=np.int64)
            for a in range(0, points.size, STEP):
                part = asked @ x[a:a + STEP].T
                place = np.arange(a, a + part.shape[1])
                part[(place < lo[:, None]) | (place >= hi[:, None])] = -np.inf
                if part.shape[1] > k:  # equal scores at the end are ordered by the point below
                    least = -np.partition(-part, k - 1, axis=1)[:, k - 1]
                    kept = part >= least[:, None]
                    most = int((kept & (part > -np.inf)).sum(axis=1).max(initial=0))
                    at_best = np.argsort(-part, axis=1, kind="stable")[:, :most] if most > k else np.argpartition(-part, k - 1, axis=1)[:, :k]
                    part, place = np.take_along_axis(part, at_best, axis=1), place[at_best]
                else:
                    place = np.broadcast_to(place, part.shape)
                s, p = np.concatenate([s, part], axis=1), np.concatenate([p, points[place]], axis=1)
                order = np.lexsort((p, -s), axis=1)[:, :k]
                s, p = np.take_along_axis(s, order, axis=1), np.take_along_axis(p, order, axis=1)
            some = s > -np.inf
            found.append((np.repeat(own, some.sum(axis=1)), p[some], s[some]))
        query, point, score = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"query": pa.array(query), "point": pa.array(point), "score": pa.array(score)})

    return run


def nearest(rows: DataFrame, is_query, k: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``rows (vec_id, embedding, ...)`` for which the
    column ``is_query`` is true the ``k`` other rows of the largest inner product that the windows hold,
    in double precision, ties to the smaller vec_id.

    Rows whose vector is NULL, empty, all zeros, of another length than most, or holds a NULL or
    non-finite entry, and rows without an id, take no part. Rows that share an id are one (the smallest
    vector counts). An empty table, or one row, gives no rows; other columns are ignored."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = usable(rows.filter("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("asks")))
    v = v.filter(F.exists("embedding", lambda c: c != 0)).groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.max("asks").alias("asks"))
    # Of equal vectors the k + 1 smallest ids can be wanted, one more than k since a query leaves out its own.
    v = scratch.written(v, "curve-rows")
    members = scratch.written(v.join(v.groupBy("embedding").agg(F.min("vec_id").alias("point")), "embedding"), "curve-members")
    scratch.free(v)
    few = Window.partitionBy("point").orderBy("vec_id")
    smallest = members.withColumn("_n", F.row_number().over(few)).filter(F.col("_n") <= k + 1).groupBy("point").agg(F.collect_list("vec_id").alias("ids"))
    asking = members.filter("asks").select("point").distinct().withColumn("asks", F.lit(True))
    index = scratch.written(members.filter("vec_id = point").select("point", F.col("embedding").alias("vector")).join(asking, "point", "left")
                            .select("point", "vector", F.coalesce("asks", F.lit(False)).alias("asks")), "curve-index")
    head = index.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims"),
                     F.max(F.aggregate("vector", F.lit(0.0), lambda a, c: a + c * c)).alias("square")).first()
    n, dims = head["n"], head["dims"]
    if not n:
        return empty
    longest = float(np.sqrt(head["square"])) * (1 + 1e-12)
    curves = orderings(dims, ORDERINGS[-1])
    size = max(512, min(BLOCK_ROWS, -(-n // BLOCKS)))
    asked = index.filter("asks")

    keyed = index.mapInArrow(_keys(curves, longest), "curve int, key long, point long, asks boolean, vector array<double>")
    runs = keyed.repartitionByRange(len(curves) * -(-n // size), "curve", "key", "point", "asks").sortWithinPartitions("curve", "key", "point", "asks")
    blocks = scratch.written(runs.mapInArrow(_pack(size), _BLOCK), "curve-blocks")
    # One row a block: the points of a curve before it.
    before = Window.partitionBy("curve").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    begins = scratch.written(blocks.select("curve", "part", "block", "rows", "asked").withColumn("begin", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("long"))), "curve-begins")
    blocks = blocks.drop("rows", "asked").join(begins, ["curve", "part", "block"])

    sample = asked.orderBy(F.xxhash64("point")).limit(SAMPLE_QUERIES).select("point", "vector").collect()
    if not sample:
        return empty
    ids, x = np.array([r["point"] for r in sample]), np.array([r["vector"] for r in sample])
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    true = (index.select("point", "vector").mapInArrow(_true_neighbours(ids, x, k + 1), "query long, point long, score double")
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1))
    pairs = [(r["query"], r["point"]) for r in true.collect()]
    wanted = np.unique([p for _, p in pairs])
    places = {(r["curve"], r["point"], r["asks"]): r["place"] for r in blocks.select("curve", "begin", "points", "ask_points", "ask_at").mapInArrow(
        _ranks(wanted, ids), "curve int, point long, asks boolean, place long").collect()}
    used, width = fitted_width(places, pairs, n, recall)

    # Cells of a curve bring together the lists of queries and the blocks that their windows touch.
    cells = lambda low, high: F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))
    lists = scratch.written(blocks.filter(F.col("curve") < used).filter(F.octet_length("ask_points") > 0).select(
        "curve", "part", "block", "begin", "ask_points", "ask_at", "ask_vectors").mapInArrow(
        _lists, "curve int, part int, block int, list int, low long, high long, ask_points binary, ask_at binary, ask_vectors binary"), "curve-lists")
    name = [F.col(c).alias(f"of_{c}") for c in ("part", "block", "list")]
    here = begins.filter("rows > 0").select("curve", "part", "block", cells(F.col("begin"), F.col("begin") + F.col("rows") - 1).alias("cell"))
    reach = lists.select("curve", *name, cells(F.greatest(F.lit(0), F.col("low") - width), F.least(F.lit(n - 1), F.col("high") + width)).alias("cell"))
    met = here.join(reach, ["curve", "cell"]).drop("cell").distinct()
    each = ["curve", "part", "block"]
    met = met.withColumn("deal", F.floor((F.row_number().over(Window.partitionBy(*each).orderBy("of_part", "of_block", "of_list")) - 1) / LISTS))
    met = scratch.written(met, "curve-met")
    left = blocks.select(*each, "begin", "points", "vectors").join(met.select(*each, "deal").distinct(), each)
    right = lists.select("curve", *name, "ask_points", "ask_at", "ask_vectors").join(met, ["curve", "of_part", "of_block", "of_list"]).select(
        *[F.col(c).alias(f"to_{c}") for c in (*each, "deal")], "ask_points", "ask_at", "ask_vectors")
    found = left.groupBy(*each, "deal").cogroup(right.groupBy(*[f"to_{c}" for c in (*each, "deal")])).applyInArrow(_compare(width, k + 1), "query long, point long, score double")
    found = found.groupBy("query", "point").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    found = scratch.written(found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).drop("_n"), "curve-found")
    scratch.free(lists, met)

    several = found.join(smallest, "point").select("query", F.explode("ids").alias("vec_id"), "score")
    several = several.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).filter(F.col("_n") <= k + 1)
    answers = several.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("best"))
    who = members.filter("asks").select(F.col("vec_id").alias("query_id"), F.col("point").alias("query"))
    own = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return (who.join(answers, "query").select("query_id", F.posexplode(own).alias("pos", "b"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")))
