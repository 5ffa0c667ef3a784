"""Exact top-k search by inner product over a vector-approximation file.

Vectors of integers are written twice: exactly, and as an approximation of one byte a
component, the number of the cell that holds it. The cells of a dimension lie between
marks fitted on a bounded sample; what the least and the largest component in each cell
are is taken from all vectors, so a query and an approximation alone give exact bounds
of the inner product: for each component the smaller and the larger product with the two
ends of its cell.

All approximations are scanned for all queries, block by block. A vector stays a
candidate unless ``k`` others are proven to come before it. The scan goes in rounds over
growing shares of the file, each beginning with the bounds of those before, so most
vectors are passed over where they are scanned. Exact vectors are then read in the order of
their bound, best first, in batches, until the k-th best result is certain: no candidate
that is left has a bound that reaches it.

Equal vectors are one entry of the file with their smallest ids, as only these can be
among a query's results.

Defined results: vectors that are null or hold null or non-finite components, of another
length than most (of the shorter one, if several lengths are equally frequent), or
without an id take no part; rows of the query's own id are no candidates; repeated rows
count once; ties go to the smaller id; an empty table gives no rows; other columns are
passed over. A table whose inner products could exceed 63 bits ends with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityscope.llm.shared import written
from parityscope.llm.vectors import as_integers, matrix, most_frequent_length

#: Cells of a dimension, at most 256.
CELLS = 64
#: Components of the sample that the marks are fitted on.
SAMPLE_NUMBERS = 1 << 20
#: Vectors and queries that one task compares at a time, on average.
VECTORS, QUERIES = 16_384, 2_048
#: The first round scans so many vectors; each later one up to so many times more.
FIRST, GROWTH = 8_192, 16
_CHUNK = 2_048


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """Different vectors with their smallest id and their ``k`` smallest ids; a vector's
    rows are cut to those before the shuffle."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    ids = rows.distinct().withColumn("nth", nth).filter(F.col("nth") <= k)
    return ids.groupBy("vec").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _marks(sample: np.ndarray) -> np.ndarray:
    """For each dimension the least number of every cell but the first: the different
    numbers themselves if they are few, else equal steps between outer quantiles."""
    marks = np.full((sample.shape[1], CELLS - 1), np.iinfo(np.int64).max)
    for i, values in enumerate(sample.T):
        different = np.unique(values)
        if len(different) > CELLS:
            low, high = np.quantile(values, (0.002, 0.998))
            different = np.unique(np.ceil(np.linspace(low, high, CELLS)).astype(np.int64))
        marks[i, : len(different) - 1] = different[1:]
    return marks


def _cells(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for i, own in enumerate(marks):
        out[:, i] = np.searchsorted(own, x[:, i], side="right")
    return out


def _approximations(marks: np.ndarray):
    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = [row.tobytes() for row in _cells(matrix(batch.column("vec")), marks)]
                yield pa.RecordBatch.from_arrays([batch.column("entry"), pa.array(cells, pa.binary())], ["entry", "cells"])

    return approximate


def _ends(marks: np.ndarray):
    """The least and the largest number of this task's vectors in each cell."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full((len(marks), CELLS), np.iinfo(np.int64).max)
        high = np.full((len(marks), CELLS), np.iinfo(np.int64).min)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vec"))
                at = (np.arange(len(marks))[None, :], _cells(x, marks))
                np.minimum.at(low, at, x)
                np.maximum.at(high, at, x)
        dim, cell = np.nonzero(low <= high)
        columns = (dim, cell, low[dim, cell], high[dim, cell])
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns], ["dim", "cell", "low", "high"])

    return collect


def bounds(cells: np.ndarray, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the inner product of each query with each approximation."""
    at = (np.arange(len(low))[None, :], cells)
    middle, half = (low + high)[at] / 2, (high - low)[at] / 2
    reach = np.abs(queries).max(initial=0) * np.maximum(np.abs(low), np.abs(high)).max(initial=0) * len(low)
    inner, off = queries @ middle.T, np.abs(queries) @ half.T
    if reach >= 2**50:  # sums of halves that doubles don't hold exactly
        off = off + 1e-9 * (np.abs(queries) @ (np.abs(middle) + half).T)
    return inner - off, inner + off


def _scanner(low: np.ndarray, high: np.ndarray, k: int):
    names = ["key", "entry", "low", "high"]

    def scan(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2]
        if left.num_rows and right.num_rows:
            x = matrix(left["vec"]).astype(float)
            least, least_entry = left["least"].to_numpy().copy(), left["least_entry"].to_numpy()
            cells = np.frombuffer(b"".join(right["cells"].to_pylist()), np.uint8).reshape(right.num_rows, -1)
            entries, best = right["entry"].to_numpy(), np.full((len(x), k), -np.inf)
            for a in range(0, len(cells), _CHUNK):
                lower, upper = bounds(cells[a : a + _CHUNK], x, low, high)
                best = np.sort(np.partition(np.concatenate((best, lower), axis=1), -k, axis=1)[:, -k:])
                own = np.maximum(least, best[:, 0])
                some = entries[a : a + _CHUNK]
                # Where the first bound stands, an equal one needs a smaller id.
                stays = (upper > own[:, None]) | (upper == own[:, None]) & ((own > least)[:, None] | (some <= least_entry[:, None]))
                i, j = np.nonzero(stays)
                found.append((i, some[j], lower[i, j], upper[i, j]))
        i, entry, lower, upper = (np.concatenate(v) for v in zip(*found, strict=True))
        if len(i):
            own = np.maximum(least, best[:, 0])
            stays = upper >= own[i]
            i, entry, lower, upper = i[stays], entry[stays], lower[stays], upper[stays]
        return pa.table([left["key"].take(pa.array(i)), pa.array(entry), pa.array(lower), pa.array(upper)], names)

    return scan


def _numbers(n: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n) - 1))


def _scanned(queries: DataFrame, file: DataFrame, n_queries: int, n_vectors: int, scan) -> DataFrame:
    """What ``scan`` leaves of all pairs of a query and a vector of the file, in blocks."""
    asks, parts = max(1, math.ceil(n_queries / QUERIES)), max(1, math.ceil(n_vectors / VECTORS))
    left = queries.withColumns({"ask": F.pmod(F.xxhash64("key"), F.lit(asks)).cast("int"), "part": _numbers(parts)})
    right = file.withColumns({"part": F.pmod(F.xxhash64("entry", F.lit(1)), F.lit(parts)).cast("int"), "ask": _numbers(asks)})
    return left.groupBy("ask", "part").cogroup(right.groupBy("ask", "part")).applyInArrow(scan, "key string, entry long, low double, high double")


def _undecided(found: DataFrame, k: int) -> DataFrame:
    """Candidates before which fewer than ``k`` are proven to come; ``least`` and
    ``least_entry`` are the k-th best lower bound and its entry."""
    order = Window.partitionBy("key").orderBy(F.desc("low"), "entry").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kth = F.nth_value(F.struct("low", "entry"), k).over(order)
    found = found.withColumn("kth", kth).select(
        "key", "entry", "low", "high", F.coalesce("kth.low", F.lit(-math.inf)).alias("least"),
        F.coalesce("kth.entry", F.lit(2**63 - 1)).alias("least_entry"),
    )
    return found.filter("high > least or high = least and entry <= least_entry")


def _candidates(queries: DataFrame, file: DataFrame, n_queries: int, n_vectors: int, scan, k: int) -> DataFrame:
    done, found = 0.0, None
    share = min(1.0, FIRST / n_vectors)
    draw = F.pmod(F.xxhash64("entry", F.lit(2)), F.lit(1 << 30)) / (1 << 30)
    while True:
        part = file.filter((draw >= done) & (draw < share))
        if found is None:
            asked = queries.withColumns({"least": F.lit(-math.inf), "least_entry": F.lit(2**63 - 1)})
        else:
            known = found.groupBy("key").agg(F.first("least").alias("least"), F.first("least_entry").alias("least_entry"))
            asked = queries.join(known, "key", "left").fillna({"least": -math.inf, "least_entry": 2**63 - 1})
        new = _scanned(asked, part, n_queries, math.ceil(n_vectors * (share - done)), scan)
        both = new if found is None else found.select("key", "entry", "low", "high").unionAll(new)
        found = written(_undecided(both, k), "candidates")
        if share >= 1:
            return found
        done, share = share, min(1.0, share * GROWTH)


def _inner_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            scores = np.einsum("ij,ij->i", matrix(part.column("vec")), matrix(part.column("other")))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("entry"), pa.array(scores, pa.int64())], ["key", "entry", "score"])


def _exact(candidates: DataFrame, queries: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best entries of each query; exact vectors are read in order of their bound."""
    best_first = Window.partitionBy("key").orderBy(F.desc("high"), "entry")
    left = written(candidates.select("key", "entry", "high", F.row_number().over(best_first).alias("nth")), "in-order")
    vectors = entries.select("entry", F.col("vec").alias("other"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "entry"))
    best, size = None, 4 * k
    while True:
        batch = left.filter(F.col("nth") <= size).select("key", "entry")
        scored = batch.join(vectors, "entry").join(queries, "key").select("key", "entry", "vec", "other")
        scored = scored.mapInArrow(_inner_products, "key string, entry long, score long")
        scored = scored if best is None else best.drop("place").unionAll(scored)
        best = written(scored.withColumn("place", nth).filter(F.col("place") <= k), "best")
        last = best.filter(F.col("place") == k).select("key", "score", F.col("entry").alias("last"))
        rest = left.filter(F.col("nth") > size).join(last, "key", "left")
        left = rest.filter("score is null or high > score or high = score and entry < last").select("key", "entry", "high", F.col("nth") - size)
        left = written(left.toDF("key", "entry", "high", "nth"), "in-order")
        if left.isEmpty():
            return best.drop("place")
        size *= 4


def search(vectors: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``, the inner product of the vectors'
    integers ``floor(scale * x)``, of the ``k`` highest scores of each row for which
    ``is_query`` (of the column ``vec_id``) holds."""
    spark = vectors.sparkSession
    rows = as_integers(vectors, scale).filter("vec_id is not null")
    dim = most_frequent_length(rows)
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.filter(F.size("vec") == dim)
    # One more than k, as a query is among its own best.
    entries = written(_entries(rows, k + 1), "entries")
    n, most = entries.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vec", F.abs)))).first()
    if dim * (most or 0) ** 2 >= 2**63:
        raise OverflowError("inner products of these vectors may exceed 63 bits")
    sample = entries.orderBy(F.xxhash64("entry")).limit(max(CELLS, SAMPLE_NUMBERS // max(dim, 1))).select("vec").toArrow()
    marks = _marks(matrix(sample["vec"]))
    ends = entries.select("vec").mapInArrow(_ends(marks), "dim long, cell long, low long, high long")
    ends = ends.groupBy("dim", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = np.zeros((dim, CELLS), np.int64), np.zeros((dim, CELLS), np.int64)
    at = ends["dim"].to_numpy(), ends["cell"].to_numpy()
    low[at], high[at] = ends["low"].to_numpy(), ends["high"].to_numpy()
    file = written(entries.select("entry", "vec").mapInArrow(_approximations(marks), "entry long, cells binary"), "approximations")

    # Queries of one vector are searched once, under a digest of the vector.
    asked = rows.filter(is_query(F.col("vec_id"))).distinct()
    asked = written(asked.select("vec_id", "vec", F.sha2(F.array_join(F.transform("vec", lambda x: x.cast("string")), ","), 256).alias("key")), "queries")
    queries = written(asked.groupBy("key").agg(F.first("vec").alias("vec")), "different-queries")
    scan = _scanner(low, high, k + 1)
    found = _candidates(queries, file, queries.count(), n, scan, k + 1)
    best = _exact(found, queries, entries, k + 1)

    named = best.join(entries.select("entry", F.explode("ids").alias("vec_id")), "entry").drop("entry")
    # Of one query vector, k + 1 ids are enough for every row that has it.
    first = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1).drop("nth")
    pairs = asked.select(F.col("vec_id").alias("query_id"), "key").join(named, "key").filter("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


ORACLE = """
WITH usable AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), lengths AS (SELECT len(vec) AS dim FROM usable GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
vectors AS (SELECT vec_id, vec FROM usable, lengths WHERE len(vec) = dim),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
