"""Packing of documents into token windows, filled with lexical neighbours.

The corpus is an inverted index in shards. Which shard a document belongs to depends on
its contents: it asks a small BM25 index of ``LEADERS`` documents drawn by a hash, and the
``PREFIX`` leaders that score highest, in order, are its place. Documents are sorted by
their places, so those with the same leaders come together, and the sorted corpus is cut to
shards of bounded size. The work grows in proportion to the corpus.

A shard holds a BM25 inverted index of its documents, with document frequencies of the
whole corpus. One document after the other is a seed: it asks the index, by all its terms,
for its nearest unused documents, which fill its window in order of their score; the one
that does not fit is cut, and its rest stays for a later window. So all windows of a shard are
full but the last, which is cut into sequences of a power of two, as these need no padding.

Defined results: a null text is empty; an empty text is its end id alone; repeated rows
are packed as often as they occur; a null id is kept; an empty table gives no pieces;
documents longer than a window fill windows of their own first, however long. Other
columns are passed over.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.llm.shared import written
from parityscope.llm.text_bytes import Texts, slices
from parityscope.llm.tokens import ENCODE_BYTES, ChunkEncoder

WINDOW = 4096
#: Tokens of a shard, on average: what one task indexes and packs at a time.
SHARD_TOKENS = 8_000_000
#: Documents that mark places in the corpus, and how many of them a document names.
LEADERS, PREFIX = 64, 4
_PLACES = [f"place_{i}" for i in range(PREFIX)]
#: Documents, and tokens of them, whose terms are counted at a time; a longer one is alone.
_DOCS_AT_A_TIME, _TOKENS_AT_A_TIME = 512, 100_000
#: Neighbours looked at first; more only if they don't fill a window.
_NEAREST = 64
#: Used documents leave the index when they are more than this share of it.
_USED = 1 / 4
#: A posting list that holds a larger share of the documents is a column of a matrix.
_COMMON = 1 / 16
_K1, _B = 1.2, 0.75
#: Range of term ids whose document frequencies one row carries.
_BLOCK = 4096


def _width(n_terms: int) -> str:
    return "<u2" if n_terms <= 1 << 16 else "<u4"


def _binary(ids: np.ndarray, offsets: np.ndarray, width: str) -> pa.Array:
    ids, size = ids.astype(width), np.dtype(width).itemsize
    whole = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64) * size), pa.py_buffer(ids)]
    )
    return whole.cast(pa.binary())


def _encode(path: str, end_id: int, n_terms: int, leaders: list[str]):
    """Ids, a number for each row that depends on its contents alone, and the leaders that
    it ranks first, in order."""
    width = _width(n_terms)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(path)
        ids, offsets = encoder.encode(Texts.of(pa.array(leaders, pa.string())), end_id)
        held = np.bincount(_terms(ids, offsets, n_terms)[1], minlength=n_terms)
        near = _Index(ids, offsets, np.log1p((len(leaders) - held + 0.5) / (held + 0.5)), len(ids) / max(len(leaders), 1))
        for batch in batches:
            for piece in slices(batch, "text", ENCODE_BYTES):
                ids, offsets = encoder.encode(Texts.of(piece.column("text")), end_id)
                packed = _binary(ids, offsets, width)
                names = zip(piece.column("doc_id").to_pylist(), packed, strict=True)
                draw = [zlib.crc32(value.as_buffer(), zlib.crc32(str(doc).encode())) for doc, value in names]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(draw, pa.int64()),
                        piece.column("doc_id"),
                        pa.array(np.diff(offsets), pa.int64()),
                        packed,
                        *(pa.array(c, pa.int64()) for c in _places(near, ids, offsets, n_terms).T),
                    ],
                    ["draw", "doc_id", "n_tokens", "ids", *_PLACES],
                )

    return encode


def _places(near: _Index, ids: np.ndarray, offsets: np.ndarray, n_terms: int) -> np.ndarray:
    found, a = [np.zeros((0, PREFIX), np.int64)], 0
    while a < len(offsets) - 1:
        b = _cut(offsets, a)
        docs, terms, _ = _terms(ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_terms)
        first = np.argsort(-near.asked(docs, terms, b - a), axis=1, kind="stable")[:, :PREFIX]
        found.append(np.pad(first, ((0, 0), (0, PREFIX - first.shape[1]))))
        a = b
    return np.concatenate(found)


def _cut(offsets: np.ndarray, a: int) -> int:
    """The end of a run of documents from ``a`` on, of bounded size."""
    return max(a + 1, min(a + _DOCS_AT_A_TIME, int(np.searchsorted(offsets, offsets[a] + _TOKENS_AT_A_TIME, side="right")) - 1))


def _ids(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows end to end, and their offsets."""
    column = pc.cast(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // np.dtype(width).itemsize
    return np.frombuffer(data, width)[at[0] : at[-1]], at - at[0]


def _terms(ids: np.ndarray, offsets: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and number of occurrences, for each term that a document has."""
    docs = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    keys, counts = np.unique(docs * n_terms + ids, return_counts=True)
    return keys // n_terms, keys % n_terms, counts


def _weighted(ids: np.ndarray, offsets: np.ndarray, idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and BM25 weight, for each term that a document has."""
    docs, terms, counts = _terms(ids, offsets, len(idf))
    norm = _K1 * (1 - _B + _B * np.diff(offsets) / mean_length)
    return docs, terms, idf[terms] * counts * (_K1 + 1) / (counts + norm[docs])


def _frequencies(n_terms: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(-(-n_terms // _BLOCK) * _BLOCK, np.int64)
        for batch in batches:
            ids, offsets = _ids(batch.column("ids"), _width(n_terms))
            a = 0
            while a < batch.num_rows:
                b = _cut(offsets, a)
                terms = _terms(ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], n_terms)[1]
                total += np.bincount(terms, minlength=len(total))
                a = b
        blocks = total.reshape(-1, _BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(blocks)), pa.int64()), pa.array([b.tolist() for b in blocks], pa.list_(pa.int64()))],
            ["block", "counts"],
        )

    return count


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_BLOCK, np.int64)
    for batch in batches:
        total += batch.column("counts").flatten().to_numpy().reshape(-1, _BLOCK).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total.tolist()])], ["block", "counts"])


def term_frequencies(tokens: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents of the whole corpus that have each term: one vector as long as
    the vocabulary, whatever the number of documents."""
    rows = (
        tokens.select("ids")
        .mapInArrow(_frequencies(n_terms), "block long, counts array<long>")
        .groupBy("block")
        .applyInArrow(_added, "block long, counts array<long>")
        .collect()
    )
    total = np.zeros(-(-n_terms // _BLOCK) * _BLOCK, np.int64)
    for row in rows:
        total[row.block * _BLOCK : (row.block + 1) * _BLOCK] = row.counts
    return total[:n_terms]


def _postings(ids: np.ndarray, offsets: np.ndarray, idf: np.ndarray, mean_length: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_weighted``, in narrow types, made from a bounded number of tokens at a time."""
    found, a = [(np.zeros(0, np.int32), np.zeros(0, np.uint32), np.zeros(0, np.float32))], 0
    while a < len(offsets) - 1:
        b = _cut(offsets, a)
        docs, terms, weights = _weighted(ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], idf, mean_length)
        found.append(((docs + a).astype(np.int32), terms.astype(np.uint32), weights.astype(np.float32)))
        a = b
    docs, terms, weights = (np.concatenate(v) for v in zip(*found, strict=True))
    return docs, terms, weights


class _Index:
    """BM25 over some documents. Posting lists that hold a large share of them are the
    rows of a matrix, the others lists of documents and weights. ``docs`` are those left."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, idf: np.ndarray, mean_length: float) -> None:
        docs, terms, weights = _postings(ids, offsets, idf, mean_length)
        n = len(offsets) - 1
        self.docs = np.arange(n)
        self._doc_ends = np.searchsorted(docs, np.arange(n + 1))
        self._terms = terms
        held = np.bincount(terms, minlength=len(idf))
        common = np.flatnonzero(held > max(_COMMON * n, 1))
        self._row_of = np.full(len(idf), -1, np.int32)
        self._row_of[common] = np.arange(len(common))
        rows = self._row_of[terms]
        self._common = np.zeros((len(common), n), np.float32)
        self._common[rows[rows >= 0], docs[rows >= 0]] = weights[rows >= 0]
        docs, terms, weights = (v[rows < 0] for v in (docs, terms, weights))
        by_term = np.argsort(terms, kind="stable")
        self._postings, self._values = docs[by_term], weights[by_term]
        self._ends = np.concatenate(([0], np.cumsum(np.bincount(terms, minlength=len(idf)))))

    def terms(self, doc: int) -> np.ndarray:
        return self._terms[self._doc_ends[doc] : self._doc_ends[doc + 1]]

    def asked(self, queries: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Score of every document left for each of ``n`` queries, given as pairs of query and term."""
        rows, size = self._row_of[terms], len(self.docs)
        common = rows >= 0
        if n == 1:  # only the rows asked for are read
            scores = (np.ones(common.sum(), np.float32) @ self._common[rows[common]])[None, :].astype(float)
        else:
            wanted = np.zeros((n, len(self._common)), np.float32)
            wanted[queries[common], rows[common]] = 1
            scores = (wanted @ self._common).astype(float)
        rare, own = terms[~common], queries[~common]
        start, held = self._ends[rare], self._ends[rare + 1] - self._ends[rare]
        at = np.arange(held.sum()) + np.repeat(start - np.cumsum(held) + held, held)
        cells = np.repeat(own * size, held) + self._postings[at]
        return scores + np.bincount(cells, self._values[at], n * size).reshape(n, size)

    def scores(self, doc: int) -> np.ndarray:
        """Score of every document left for all terms of one."""
        terms = self.terms(doc)
        return self.asked(np.zeros(len(terms), np.int64), terms, 1)[0]

    def keep(self, some: np.ndarray) -> None:
        """Leave out the documents that are not among some of those left."""
        self.docs, self._common = self.docs[some], np.ascontiguousarray(self._common[:, some])
        place = np.cumsum(some) - 1
        stay = some[self._postings]
        self._postings, self._values = place[self._postings[stay]].astype(np.int32), self._values[stay]
        self._ends = np.concatenate(([0], np.cumsum(stay)))[self._ends]


def _nearest(scores: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` best positive scores, best first."""
    if n < len(scores):
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        some = some[np.argsort(-scores[some], kind="stable")][:n]
    else:
        some = np.argsort(-scores, kind="stable")
    return some[scores[some] > 0]


def _neighbours(index: _Index, seed: int, rest: np.ndarray, room: int) -> Iterator[int]:
    """The unused documents nearest to a seed, in order, enough to fill a window."""
    scores = index.scores(seed)
    scores[rest[index.docs] == 0] = -1
    scores[index.docs == seed] = -1
    first = _nearest(scores, _NEAREST)
    yield from index.docs[first]
    if len(first) == _NEAREST:
        yield from index.docs[_nearest(scores, room)[_NEAREST:]]


def _fill(lengths: np.ndarray, index: _Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard."""
    pieces, sequence = [], 0
    start = np.zeros(len(lengths), np.int64)
    for doc in np.flatnonzero(lengths >= window):
        for _ in range(int(lengths[doc]) // window):
            pieces.append((int(doc), int(start[doc]), window, sequence, 0))
            start[doc] += window
            sequence += 1
    rest = lengths - start
    left, seed = int(rest.sum()), 0
    while left:
        room = min(window, 1 << (left.bit_length() - 1)) if left < window else window
        filled = 0
        unused = rest[index.docs] > 0
        if unused.sum() < (1 - _USED) * len(unused):
            index.keep(unused)
        while not rest[seed]:
            seed += 1
        near = _neighbours(index, seed, rest, room)
        doc = seed
        while filled < room:
            take = int(min(rest[doc], room - filled))
            pieces.append((int(doc), int(start[doc]), take, sequence, filled))
            start[doc] += take
            rest[doc] -= take
            filled += take
            left -= take
            if filled < room:
                doc = next(near, None)
                if doc is None:  # no neighbour is left: go on in order
                    while not rest[seed]:
                        seed += 1
                    doc = seed
        sequence += 1
    return pieces


def _packed(table: pa.Table, idf: np.ndarray, mean_length: float, window: int, first: int) -> pa.RecordBatch:
    """The pieces of one shard; its sequences are numbered from ``first`` on."""
    ids, offsets = _ids(table["ids"], _width(len(idf)))
    lengths = np.diff(offsets)
    pieces = np.array(_fill(lengths, _Index(ids, offsets, idf, mean_length), window), np.int64).reshape(-1, 5)
    doc, start, length, sequence, offset = pieces.T
    cut = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(offsets[doc] + start, length, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            table["doc_id"].take(pa.array(doc)).combine_chunks(),
            *(pa.array(v, pa.int64()) for v in (start, length, lengths[doc], first + sequence, offset)),
            pa.array(cut, pa.binary()),
        ],
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
    )


def _pack(idf: np.ndarray, mean_length: float, window: int, shard_tokens: int):
    """Packs a partition's documents, which come in order of their leaders, shard by shard."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            ends, a = np.cumsum(batch.column("n_tokens").to_numpy()), 0
            while a < batch.num_rows:
                before = int(ends[a - 1]) if a else 0
                b = min(batch.num_rows, max(a + 1, int(np.searchsorted(ends, before + shard_tokens - size, side="right"))))
                held.append(batch.slice(a, b - a))
                size += int(ends[b - 1]) - before
                a = b
                if size >= shard_tokens:
                    found = _packed(pa.Table.from_batches(held), idf, mean_length, window, number)
                    number = found.column("sequence_id").to_numpy().max() + 1
                    yield found
                    held, size = [], 0
        if held:
            yield _packed(pa.Table.from_batches(held), idf, mean_length, window, number)

    return pack


def _leaders(docs: DataFrame) -> list[str]:
    """The beginnings of ``LEADERS`` documents drawn by a hash of their id, which mark places."""
    ids = docs.select("doc_id").filter("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(LEADERS)
    chosen = docs.filter(F.col("doc_id").isin([r.doc_id for r in ids.collect()])).select("doc_id", F.substring("text", 1, 4 * WINDOW).alias("text"))
    # Rows of one id are many only if the ids are no keys.
    return [r.text for r in chosen.filter("text != ''").orderBy("doc_id", "text").limit(LEADERS).collect()]


def pack(docs: DataFrame, tokenizer_path: str, n_terms: int, end_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents, with their ids as little-endian 32-bit integers."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("draw", "doc_id", "n_tokens")]).add("ids", "binary")
    for place in _PLACES:
        schema = schema.add(place, "long")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tokens = written(docs.mapInArrow(_encode(tokenizer_path, end_id, n_terms, _leaders(docs)), schema), "tokens")
    n_docs, n_tokens = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    df = term_frequencies(tokens, n_terms)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
    # Equal documents have equal places; the hash deals a large group to several partitions.
    dealt = tokens.repartitionByRange(max(1, round(n_tokens / SHARD_TOKENS)), *_PLACES, "draw")
    dealt = dealt.sortWithinPartitions(*_PLACES, "draw", "doc_id", "ids")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")])
    packed = _pack(idf, n_tokens / max(n_docs, 1), window, SHARD_TOKENS * 5 // 4)
    return dealt.select("doc_id", "n_tokens", "ids").mapInArrow(packed, schema.add("ids", "binary"))
