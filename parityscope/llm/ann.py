"""Approximate nearest neighbours by inner product: adaptive dimension scan of probed lists.

Vectors get one more component that gives all of them the largest norm, so that the
largest inner product is the smallest distance, and are turned by a random rotation, so
that any few components stand for all. An inverted file deals them to lists around
k-means centres. A query probes its nearest lists; in each it compares block after block
of components. After ``d`` of ``D`` components a vector is given up if its partial
distance exceeds ``d / D * (1 + EPSILON / sqrt(d))**2`` times the squared distance of the
query's 20th best so far: under the hypothesis that the vector is nearer than that, such
a partial distance is improbable. Found vectors are scored again in double precision on
the original components.

Lists are scanned in two rounds. The first takes each query's nearest lists, as many as
the root of those to probe; the second takes the others, with the distance of the 20th
best of the first round as the bound to start with, so that few vectors leave a list.

The centres are fitted on a bounded sample (``32`` vectors a list); every vector is
indexed. How many lists to probe is measured, not guessed: for ``CALIBRATION`` queries
all rows are scanned, and as many lists are probed as give ``RECALL`` of their neighbours.

Equal vectors are one entry of the index with their smallest ids, as only these can be
among a query's nearest. A list is scanned in blocks of bounded numbers of vectors and
queries, so a long list or many queries of one list are many tasks.

Defined results: vectors that are null, empty or zero, or that hold null or non-finite
components, of another length than most, or without an id take no part; rows of the
query's own id are no candidates; repeated rows count once; ties go to the smaller id;
an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityscope.llm.shared import written

MAX_LISTS = 4096
CALIBRATION = 200
RECALL = 0.96
EPSILON = 2.1
#: Components compared at a time.
BLOCK = 16
#: Vectors and queries of a list that one task compares, on average.
VECTORS, QUERIES = 8192, 2048
#: Vectors compared with every query at first, as a share of all and at most: the best of
#: them give a bound, and are found already.
_FIRST_SHARE, _FIRST = 1 / 8, 4096


def _usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """Different vectors with their smallest id and their ``k`` smallest ids; a vector's
    rows are cut to those before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    ids = rows.distinct().withColumn("nth", nth).filter(F.col("nth") <= k)
    return ids.groupBy("vec").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


class _Space:
    """The rotated space in which the largest inner product is the smallest distance."""

    def __init__(self, dim: int, norm: float) -> None:
        self.norm2 = norm**2
        self.turn = np.linalg.qr(np.random.default_rng(1).normal(size=(dim + 1, dim + 1)))[0]

    def vectors(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm2 - (x**2).sum(1), 0))
        return np.column_stack((x, rest)) @ self.turn

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((x, np.zeros(len(x)))) @ self.turn


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * (a @ b.T), 0)


def _centres(x: np.ndarray, n: int, steps: int = 10) -> np.ndarray:
    centres = x[np.random.default_rng(2).permutation(len(x))[:n]].copy()
    for _ in range(steps):
        nearest = np.concatenate([_distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        size = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, x)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


def _near_lists(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    return np.argsort(_distances(points, centres), axis=1, kind="stable")[:, :n]


def _best(query: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Positions of each query's ``k`` smallest distances."""
    order = np.lexsort((distance, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def scan(queries: np.ndarray, vectors: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a vector that are among the query's ``k`` nearest here and not
    farther than its bound (a squared distance), found block by block of components."""
    dims = vectors.shape[1]
    bound = bound.copy()
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for begin in range(0, len(vectors), 1024):
        part = vectors[begin : begin + 1024]
        partial, pairs = np.zeros((len(queries), len(part))), None
        for a in range(0, dims, BLOCK):
            b = min(a + BLOCK, dims)
            limit = bound * (b / dims * (1 + EPSILON / math.sqrt(b)) ** 2 if b < dims else 1)
            if pairs is None:
                partial += _distances(queries[:, a:b], part[:, a:b])
                alive = partial <= limit[:, None]
                if alive.mean() < 0.1 or b == dims:
                    pairs = np.nonzero(alive)
                    left = partial[pairs]
            else:
                left = left + ((queries[pairs[0], a:b] - part[pairs[1], a:b]) ** 2).sum(1)
                stay = left <= limit[pairs[0]]
                pairs, left = (pairs[0][stay], pairs[1][stay]), left[stay]
        found = tuple(map(np.concatenate, zip(found, (pairs[0], pairs[1] + begin, left), strict=True)))
        best = _best(found[0], found[2], k)
        found = tuple(v[best] for v in found)
        full, last = np.bincount(found[0], minlength=len(queries)) >= k, np.zeros(len(queries))
        np.maximum.at(last, found[0], found[2])
        bound[full] = np.minimum(bound[full], last[full] * (1 + 1e-9))
    return found[0], found[1]


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products row by row, components added in order: equal vectors score equally."""
    total = np.zeros(len(queries))
    for i in range(queries.shape[1]):
        total += queries[:, i] * vectors[:, i]
    return total


def _scanner(space: _Space, k: int):
    def compare(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "entry", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        q, x = _matrix(left["vec"]), _matrix(right["vec"])
        i, j = scan(space.queries(q), space.vectors(x), left["bound"].to_numpy(), k)
        return pa.table([left["entry"].take(pa.array(i)), right["entry"].take(pa.array(j)), pa.array(_products(q[i], x[j]))], names)

    return compare


def _calibrated(rows: DataFrame, space: _Space, centres: np.ndarray, k: int) -> int:
    """The least number of lists that give the wished recall, by a scan of all entries."""
    chosen = rows.orderBy(F.xxhash64("entry", F.lit(3))).limit(CALIBRATION).select("vec").toArrow()
    x = space.queries(_matrix(chosen["vec"]))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = space.vectors(_matrix(batch.column("vec")))
            distance = _distances(x, points)
            best = np.argsort(distance, axis=1, kind="stable")[:, :k]
            homes = np.concatenate([_distances(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)])
            query = np.repeat(np.arange(len(x)), best.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (query, homes[best].ravel(), np.take_along_axis(distance, best, 1).ravel())],
                ["query", "list", "distance"],
            )

    found = rows.select("vec").mapInArrow(nearest, "query long, list long, distance double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy("distance"))
    found = found.withColumn("nth", nth).filter(F.col("nth") <= k).toArrow()  # k rows for each calibration query
    order = np.argsort(np.argsort(_distances(x, centres), axis=1, kind="stable"), axis=1)
    ranks = np.sort(order[found["query"].to_numpy(), found["list"].to_numpy()])
    return int(ranks[min(len(ranks) - 1, math.ceil(RECALL * len(ranks)))]) + 1


def _scanned(homes: DataFrame, probing: DataFrame, compare) -> DataFrame:
    """What ``compare`` finds for the probing queries in the lists they probe."""
    # At most MAX_LISTS rows of three numbers.
    sizes = homes.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / VECTORS).alias("parts"))
    asks = probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("turns"))
    sizes = F.broadcast(sizes.join(asks, "list"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = homes.join(sizes, "list").withColumns({"part": F.pmod(F.xxhash64("entry"), "parts"), "turn": numbers("turns")})
    taken = probing.join(sizes, "list").withColumns({"turn": F.pmod(F.xxhash64("entry", F.lit(5)), "turns"), "part": numbers("parts")})
    block = ["list", "part", "turn"]
    return (
        taken.select(*block, "entry", "vec", "bound").groupBy(*block)
        .cogroup(dealt.select(*block, "entry", "vec").groupBy(*block))
        .applyInArrow(compare, "query long, entry long, score double")
    )


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest found of each row
    for which ``is_query`` (of the column ``vec_id``) holds."""
    spark = vectors.sparkSession
    rows = _usable(vectors)
    lengths = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = lengths.dim
    rows = rows.filter(F.size("vec") == dim)
    # One more than k, as a query is among its own nearest.
    entries = written(_entries(rows, k + 1), "entries")
    n, norm = entries.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)))).first()
    lists = max(1, min(round(math.sqrt(n)), MAX_LISTS))
    space = _Space(dim, norm)
    sample = entries.orderBy(F.xxhash64("entry")).limit(max(32 * lists, _FIRST)).select("entry", "vec").toArrow()
    points = space.vectors(_matrix(sample["vec"]))
    centres = _centres(points[: 32 * lists], lists)
    first = sample.slice(0, min(_FIRST, int(n * _FIRST_SHARE)))
    nearby, first_vectors, first_entries = points[: len(first)], _matrix(first["vec"]), first["entry"].to_numpy()
    # A handful of lists may hold fewer than k vectors each: all of them are probed.
    probes = _calibrated(entries, space, centres, k + 1) if lists > 16 else lists

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = space.vectors(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros((0, dim + 1))
            near = [_distances(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]
            yield batch.append_column("list", pa.array(np.concatenate([np.zeros(0, np.int64), *near]), pa.int64()))

    early = math.ceil(math.sqrt(probes))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = space.queries(_matrix(part.column("vec")))
                bound = np.full(len(x), np.inf)
                if len(nearby) > k:
                    bound = np.partition(_distances(x, nearby), k, axis=1)[:, k] * (1 + 1e-9)
                near = _near_lists(x, centres, probes)
                which = np.repeat(np.arange(len(x)), near.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(which)) for c in ("entry", "vec")),
                        pa.array(near.ravel()),
                        pa.array(np.tile(np.arange(near.shape[1]) < early, len(x))),
                        pa.array(bound[which]),
                    ],
                    ["entry", "vec", "list", "early", "bound"],
                )

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if len(nearby) > k else 0, 512):
                part = batch.slice(at, 512)
                x = _matrix(part.column("vec"))
                best = np.argpartition(_distances(space.queries(x), nearby), k, axis=1)[:, : k + 1]
                which, other = np.repeat(np.arange(len(x)), k + 1), best.ravel()
                scores = _products(x[which], first_vectors[other])
                yield pa.RecordBatch.from_arrays(
                    [part.column("entry").take(pa.array(which)), pa.array(first_entries[other]), pa.array(scores)], ["query", "entry", "score"]
                )

    asked = rows.filter(is_query(F.col("vec_id"))).distinct().withColumnRenamed("vec_id", "query_id")
    asked = written(asked.join(entries.select("vec", "entry"), "vec"), "queries")
    homes = entries.select("entry", "vec").mapInArrow(home, "entry long, vec array<double>, list long")
    homes = written(homes, "lists")
    different = asked.groupBy("entry").agg(F.first("vec").alias("vec"))
    probing = written(different.mapInArrow(probe, "entry long, vec array<double>, list long, early boolean, bound double"), "probes")

    compare = _scanner(space, k + 1)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    nth = F.row_number().over(best)

    def best_of(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("nth", nth).filter(F.col("nth") <= k + 1)

    begun = different.mapInArrow(begin, "query long, entry long, score double")
    first = _scanned(homes, probing.filter("early"), compare).unionAll(begun)
    first = written(best_of(first), "nearest")
    # The squared distance of the last of them, in the space of the scan.
    square = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    last = first.filter(F.col("nth") == k + 1).select(F.col("query").alias("entry"), "score")
    later = probing.filter("not early").join(last, "entry", "left")
    nearer = (square + F.lit(space.norm2) - 2 * F.col("score")) + 1e-9 * (square + F.lit(space.norm2))
    later = later.withColumn("bound", F.least("bound", nearer)).drop("score")
    found = best_of(first.drop("nth").unionAll(_scanned(homes, later, compare)))
    named = found.join(entries.select("entry", F.explode("ids").alias("vec_id")), "entry").drop("entry", "nth")
    # Of one query vector, k + 1 ids are enough for every row that has it.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1).drop("nth")
    pairs = asked.select("query_id", F.col("entry").alias("query")).join(named, "query").filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
