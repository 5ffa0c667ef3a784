"""Ranked lexical search: best-first search of document intervals by range maxima.

The index has a row for each shard, some consecutive documents of a task's rows in
ascending order of their id: the shard's different terms, and for each term its posting
list, the documents that hold it and how often. It is made in one pass, without a shuffle.

A term's impact on a document is ``10**9 * tf div (1000 * tf + 8 * m)``, where ``m`` tells
how long the document is beside the mean. Over the impacts of each posting list that an
item asks for lies a sparse table: entry ``i`` of level ``j`` is the largest impact of the
``2**j`` postings from ``i`` on, so the largest of any range is that of two entries. An
interval of documents is bounded by the sum, over the item's terms, of weight times the
largest impact inside it. Intervals are taken by falling bound; each is split at the
document whose one impact adds most to its bound, which is scored exactly, and the two
intervals beside it are bounded anew. A shard is done when no bound reaches the k-th best
score that its task has seen, or that a first share of the shards has given.

Items are the queries: they pass in blocks of a bounded number of terms, and all shards
are searched for each block. Terms are compared by two 64-bit hashes.

Defined results: a null or empty text has no terms; items without terms, and documents
with a score of 0, give no rows; every row of the documents is a document of its own, so
repeated rows are ranked as often as they occur; equal scores are in ascending order of
the id, null last; equal rows of the items are one item, and different texts of one id
are ranked each by itself; empty tables give no rows; whole texts are read, however long;
other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityscope.llm.shared import session_with, written
from parityscope.llm.text_bytes import Texts, mix, slices

#: Bytes of text of a shard, on average; a longer document is a shard alone.
SHARD_BYTES = 3 << 20
#: Different terms of the items that are searched at a time; an item with more is alone.
TERMS_AT_A_TIME = 1 << 19
#: Each shard is a row group of its own: a reader decodes row groups whole, and a task may
#: write any number of shards to its file.
_INDEX_OPTIONS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}
#: Shards pass to Python one or two at a time, however many a task reads.
_INDEX_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
#: One shard in so many is searched first, for scores that the others have to reach.
FIRST_SHARE = 8
#: Intervals split at a time.
_SPLITS = 48
_LAST_ID = 2**63 - 1
_LOW = np.int64(2**32 - 1)

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _codes(seed: int) -> np.ndarray:
    """An odd number for each byte of a term, A-Z like a-z, and 0 for all other bytes."""
    codes = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    codes[65:91] = codes[97:123]
    codes[~_TERM] = 0
    return codes


_HASHES = [(_codes(131), np.uint64(0x9E3779B97F4A7C15)), (_codes(132), np.uint64(0xD1B54A32D192ED03))]


class _TermTexts(Texts):
    """Texts whose words are the terms."""

    @cached_property
    def space(self) -> np.ndarray:
        return ~_TERM[self.data]

    def term_hashes(self) -> list[np.ndarray]:
        starts = self.word_starts
        if not len(starts):
            return [np.zeros(0, np.uint64)] * 2
        place = np.arange(starts[0], len(self.data))
        place -= np.repeat(starts, np.diff(np.append(starts, len(self.data))))
        found = []
        for codes, step in _HASHES:
            powers = np.full(int(place.max()) + 1, step)
            powers[0] = 1
            values = codes[self.data[starts[0] :]] * np.multiply.accumulate(powers)[place]
            found.append(mix(np.add.reduceat(values, starts - starts[0])))
        return found


def _grouped(first: np.ndarray, second: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different terms (two hashes each), the end of each one's postings, and the postings:
    document and number of occurrences. Documents come in ascending order."""
    order = np.argsort(first, kind="stable")
    if (np.diff(second[order]) != 0)[first[order][1:] == first[order][:-1]].any():
        order = np.lexsort((second, first))
    first, second, docs = first[order], second[order], docs[order]
    new_term = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
    new = new_term.copy()
    new[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(new)
    terms = np.flatnonzero(new_term[at])
    counts = np.diff(np.append(at, len(docs)))
    return first[at][terms], second[at][terms], np.append(terms[1:], len(at)), docs[at], counts


_SHARD = "shard long, n_docs long, n_terms long, n_null long, ids binary, lengths binary, first binary, second binary, ends binary, docs binary, counts binary"


def _binary(values: np.ndarray, dtype: str) -> pa.Array:
    return pa.array([np.ascontiguousarray(values.astype(dtype)).tobytes()], pa.binary())


def _make_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in slices(batch, "text", SHARD_BYTES):
            piece = piece.sort_by([("doc_id", "ascending")])  # null last
            texts = _TermTexts.of(piece.column("text"))
            per_doc = np.diff(texts.word_offsets)
            some = np.flatnonzero(per_doc)
            if not len(some):
                continue
            place = np.cumsum(per_doc > 0) - 1
            grouped = _grouped(*texts.term_hashes(), place[texts.word_docs])
            ids = piece.column("doc_id").take(pa.array(some))
            numbers = [pa.array([n], pa.int64()) for n in (shard, len(some), len(texts.word_starts), ids.null_count)]
            filled = ids.fill_null(0).to_numpy(zero_copy_only=False)
            blobs = [_binary(v, t) for v, t in zip((filled, per_doc[some], *grouped), ("<i8", "<i8", "<u8", "<u8", "<u4", "<u4", "<u4"), strict=True)]
            yield pa.RecordBatch.from_arrays([*numbers, *blobs], ["shard", "n_docs", "n_terms", "n_null", "ids", "lengths", "first", "second", "ends", "docs", "counts"])
            shard += 1


def build(docs: DataFrame) -> DataFrame:
    """The index of all documents (``doc_id``, ``text``), written to the shared folder, and
    read a shard at a time by a session of its own."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    reader = session_with(docs.sparkSession, _INDEX_SETTINGS)
    return written(rows.mapInArrow(_make_shards, _SHARD), "lexical-index", reader, _INDEX_OPTIONS)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            texts = _TermTexts.of(piece.column("text"))
            first, second, ends, items, counts = _grouped(*texts.term_hashes(), texts.word_docs) if len(texts.word_starts) else [np.zeros(0, np.int64)] * 5
            term = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
            order = np.argsort(items, kind="stable")
            offsets = pa.array(np.searchsorted(items[order], np.arange(len(texts) + 1)).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(v[order].astype(np.uint64).view(np.int64)))
                for v in (first[term], second[term], counts)
            ]
            yield pa.RecordBatch.from_arrays([piece.column("item_id"), *lists], ["item_id", "first", "second", "counts"])


@dataclass
class _Items:
    """A block of items: the different terms that they ask for, and which each one asks for."""

    number: int
    ids: list[int | None]
    first: np.ndarray
    second: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, number: int, rows: list) -> _Items:
        lists = [[np.array(r[c], np.int64).view(np.uint64) for r in rows] for c in ("first", "second")]
        pairs = np.stack([np.concatenate(v) for v in lists], axis=1)
        known, place = np.unique(pairs, axis=0, return_inverse=True)
        cuts = np.cumsum([len(v) for v in lists[0]])[:-1]
        repeats = [np.array(r.counts, np.int64) for r in rows]
        return cls(number, [r.item_id for r in rows], known[:, 0], known[:, 1], np.split(place.ravel(), cuts), repeats)

    def found(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms a shard holds, and their place there."""
        low, high = np.searchsorted(first, self.first), np.searchsorted(first, self.first, side="right")
        place = low.copy()
        for t in np.flatnonzero(high - low > 1):  # terms of one first hash
            place[t] += np.searchsorted(second[low[t] : high[t]], self.second[t])
        here = np.flatnonzero((place < high) & (second[np.minimum(place, len(second) - 1)] == self.second))
        return here, place[here]


def _blocks(items: DataFrame) -> Iterator[_Items]:
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    terms = rows.mapInArrow(_item_terms, "item_id long, first array<long>, second array<long>, counts array<long>").filter("size(first) > 0")
    block, size, number = [], 0, 0
    for row in written(terms, "item-terms").toLocalIterator():
        if block and size + len(row.first) > TERMS_AT_A_TIME:
            yield _Items.of(number, block)
            number, block, size = number + len(block), [], 0
        block.append(row)
        size += len(row.first)
    if block:
        yield _Items.of(number, block)


def _read(row: pa.RecordBatch, i: int, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(row.column(name)[i].as_buffer(), dtype)


def _document_frequencies(index: DataFrame, items: _Items) -> np.ndarray:
    """For each term of the items, how many documents of all shards hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.first), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                here, place = items.found(_read(batch, i, "first", "<u8"), _read(batch, i, "second", "<u8"))
                total[here] += np.diff(_read(batch, i, "ends", "<u4").astype(np.int64), prepend=0)[place]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    found = index.select("first", "second", "ends").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(items.first), np.int64)  # as long as the block's terms are many
    total[found["term"].to_numpy()] = found["n"].to_numpy()
    return total


class _Shard:
    """The posting lists of one shard that a block of items asks for, under sparse tables."""

    def __init__(self, batch: pa.RecordBatch, i: int, items: _Items, n_docs: int, n_terms: int) -> None:
        self.ids = _read(batch, i, "ids", "<i8").copy()
        n_null = batch.column("n_null")[i].as_py()
        self.null = np.arange(len(self.ids)) >= len(self.ids) - n_null
        self.ids[self.null] = _LAST_ID
        here, place = items.found(_read(batch, i, "first", "<u8"), _read(batch, i, "second", "<u8"))
        ends = np.concatenate(([0], _read(batch, i, "ends", "<u4").astype(np.int64)))
        sizes = ends[place + 1] - ends[place]
        self.list_of = np.full(len(items.first), -1)
        self.list_of[here] = np.arange(len(here))
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(ends[place] - self.ends[:-1], sizes) + np.arange(self.ends[-1])
        self.docs = _read(batch, i, "docs", "<u4")[at].astype(np.int64)
        tf = _read(batch, i, "counts", "<u4")[at].astype(np.int64)
        m = 25 + 75 * _read(batch, i, "lengths", "<i8") * n_docs // n_terms
        self.impacts = 10**9 * tf // (1000 * tf + 8 * m[self.docs])
        self.keys = np.repeat(np.arange(len(here)), sizes) << 32 | self.docs
        # The larger impact comes first, and of equal ones that of the first document.
        levels = [self.impacts << 32 | (_LOW - np.arange(len(self.docs)))]
        for j in range(1, int(sizes.max(initial=0)).bit_length()):
            half = 1 << (j - 1)
            level = levels[-1].copy()
            np.maximum(level[:-half], levels[-1][half:], out=level[:-half])
            levels.append(level)
        self.table = np.stack(levels) if len(self.docs) else np.zeros((1, 1), np.int64)
        self.log = np.zeros(int(sizes.max(initial=0)) + 1, np.int64)
        for j in range(1, len(levels)):
            self.log[1 << j :] = j

    def largest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest impact of each range of postings, 0 if it is empty, and its place."""
        size = high - low
        some = size > 0
        level = self.log[size]
        low, high = np.where(some, low, 0), np.where(some, high - (1 << level), 0)
        best = np.maximum(self.table[level, low], self.table[level, high])
        return np.where(some, best >> 32, 0), _LOW - (best & _LOW)


class _Best:
    """The ``k`` best documents of one item so far."""

    def __init__(self, k: int, least: tuple[int, int]) -> None:
        self._k, self.least = k, least
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        good = scores > 0
        scores, ids, null = (np.concatenate(v) for v in ((self.scores, scores[good]), (self.ids, ids[good]), (self.null, null[good])))
        order = np.lexsort((ids, -scores))[: self._k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self._k:
            self.least = max(self.least, (int(self.scores[-1]), -int(self.ids[-1])))

    def may_enter(self, bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Whether a document of an id not below ``ids`` with at most this score may be among them."""
        score, below = self.least
        return (bounds > 0) & ((bounds > score) | (bounds == score) & (ids <= -below))


def _search_shard(shard: _Shard, terms: np.ndarray, weights: np.ndarray, best: _Best) -> None:
    """Best-first search of one shard's documents for one item."""
    lists = shard.list_of[terms]
    weights, lists = weights[lists >= 0], lists[lists >= 0]
    if not len(lists):
        return

    def bounded(start: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        impact, place = shard.largest(low, high)
        adds = impact * weights
        most = adds.argmax(axis=1)
        split = shard.docs[np.take_along_axis(place, most[:, None], 1)[:, 0] * (adds.max(axis=1) > 0)]
        return adds.sum(axis=1), split, start, low, high

    open_ = bounded(np.zeros(1, np.int64), shard.ends[lists][None, :], shard.ends[lists + 1][None, :])
    while True:
        bound, _, start, _, _ = open_
        able = np.flatnonzero(best.may_enter(bound, shard.ids[np.minimum(start, len(shard.ids) - 1)]))
        if not len(able):
            return
        able = able[np.lexsort((start[able], -bound[able]))]
        taken, kept = able[:_SPLITS], able[_SPLITS:]
        split, start, low, high = (v[taken] for v in open_[1:])
        at = np.searchsorted(shard.keys, (lists << 32)[None, :] | split[:, None])
        holds = (at < high) & (shard.docs[np.minimum(at, len(shard.docs) - 1)] == split[:, None])
        impacts = np.where(holds, shard.impacts[np.minimum(at, len(shard.docs) - 1)], 0)
        best.add((impacts * weights).sum(axis=1), shard.ids[split], shard.null[split])
        halves = bounded(
            np.concatenate((start, split + 1)), np.concatenate((low, at + holds)), np.concatenate((np.minimum(at, high), high))
        )
        open_ = tuple(np.concatenate((new, old[kept])) for new, old in zip(halves, open_, strict=True))


def _searcher(items: _Items, weights: np.ndarray, n_docs: int, n_terms: int, k: int, least: list[tuple[int, int]]):
    asked = [weights[t] * r for t, r in zip(items.terms, items.repeats, strict=True)]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k, bound) for bound in least]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = _Shard(batch, i, items, n_docs, n_terms)
                for item, (terms, own) in enumerate(zip(items.terms, asked, strict=True)):
                    _search_shard(shard, terms, own, best[item])
        sizes = [len(b.scores) for b in best]
        if sum(sizes):
            number = np.repeat(np.arange(len(best)), sizes)
            ids, null, scores = (np.concatenate([getattr(b, c) for b in best]) for c in ("ids", "null", "scores"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + items.number),
                    pa.array([items.ids[n] for n in number], pa.int64()),
                    pa.array(ids, mask=null),
                    pa.array(scores),
                ],
                ["item", "item_id", "doc_id", "score"],
            )

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` documents (``doc_id``,
    ``text``) that score highest for each item (``item_id``, ``text``)."""
    spark, index = docs.sparkSession, build(docs)
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    kind = "item long, item_id long, doc_id long, score long"
    result = spark.createDataFrame([], kind)
    for block in _blocks(items) if n_docs else ():
        df = _document_frequencies(index, block)
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        turn = F.pmod(F.xxhash64("shard"), F.lit(FIRST_SHARE))
        least = [(0, -_LAST_ID)] * len(block.ids)
        first = index.filter(turn == 0).mapInArrow(_searcher(block, weights, n_docs, n_terms, k, least), kind)
        first = written(_ranked(first, k).drop("rank"), "first-found")
        # A row for each item of the block at most.
        for row in _ranked(first, k).filter(F.col("rank") == k).collect():
            least[row.item - block.number] = (row.score, -(_LAST_ID if row.doc_id is None else row.doc_id))
        rest = index.filter(turn != 0).mapInArrow(_searcher(block, weights, n_docs, n_terms, k, least), kind)
        result = result.unionAll(written(_ranked(first.unionAll(rest), k).drop("rank"), "found", spark))
    return _ranked(result, k).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH docs AS (
    SELECT doc_id, list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
        lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms,
        row_number() OVER () AS row
    FROM documents
), totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(list_transform(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
            lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)
    ) GROUP BY ALL
), held AS (
    SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs
), postings AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
    FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals
), scored AS (
    SELECT item_id, row, doc_id,
        sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM postings JOIN asked USING (term) JOIN weights USING (term), totals GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
