"""Jaccard join on word n-grams, with adaptive multi-match prefixes.

A document's set holds its different runs of five words (``[^\\x20\\x09-\\x0D]+``, A-Z in
lower case); with fewer words, the one run of all of them. Two documents link when their
sets have a Jaccard similarity of 0.8 or more.

All sets are put in one order, rare runs first. Similar sets share at least ``l`` of the
first ``n - ceil(0.8 n) + l`` runs of each. Every document chooses its ``l`` by the
estimated cost of its candidates: the occurrences of its prefix's runs, plus verifying
those documents that share ``l`` of them. A longer prefix costs a few more occurrences
and lets fewer documents through. A pair has to meet the larger ``l`` of both.

Sets that are equal are one node. Nodes that share runs of their prefixes are verified in
two ways. First, every node goes to the group of the smallest and to that of the largest
node that it shares a run with; groups are cut to blocks of bounded size, in which whole
sets are compared, and only links leave a block. A large group of near copies is
settled there, without a row for each of its pairs. Then the pairs that share runs, but met
in no block and are in different components, are listed and verified one by one, so no
link between components is lost.

How common a run is comes from counts of all documents, in cells of a fixed number; the
order only has to be the same for all documents, so cells that hold several runs cost
time and never a link.

Defined results: a null or empty text, or one of white space, has an empty set and no
link; rows of one id are one document, its component that of all its rows; a null id
has a null component; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parityscope.llm.arrow_columns import TextFunction, aside, with_text_columns
from parityscope.llm.components import connected
from parityscope.llm.shared import written
from parityscope.llm.text_bytes import Texts, mix, slices

WORDS = 5
#: Most runs that a pair may be asked to share.
LONGEST_MATCH = 16
#: Cells that count runs: a vector of fixed size, whatever the number of documents.
CELL_BITS = 20
_BLOCK = 4096
#: Cost of verifying a candidate, in occurrences looked up, for each run of the set.
_VERIFY = 0.1
#: A run in so many more documents than a cell usually holds is aggregated before it is
#: shuffled, any other is gathered at once.
_COMMON = 1_000
#: Nodes and runs of half a block, on average.
_BLOCK_NODES, _BLOCK_RUNS = 512, 250_000
#: Bits of the filter that spares most documents without candidates a second look: so many
#: for each candidate, two to the second power at most (8 MB).
_FILTER_PER_NODE, _MOST_FILTER_BITS = 32, 26


def shingle_sets(texts: Texts) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    hashes, offsets = texts.word_hashes(lower=True), texts.word_offsets
    window, first = texts.windows(hashes, WORDS)
    ends = np.searchsorted(first, offsets)
    for a, b, words, next_words in zip(ends, ends[1:], offsets, offsets[1:], strict=False):
        if 0 < next_words - words < WORDS:
            value = hashes[words : words + 1]
            for i in range(int(words) + 1, int(next_words)):
                value = mix(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + 1])
            yield value
        else:
            yield np.unique(window[a:b])


def _cells(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for piece in slices(batch, "text"):
            sets = list(shingle_sets(Texts.of(piece.column("text"))))
            total += np.bincount(_cells(np.concatenate(sets)), minlength=len(total))
    blocks = total.reshape(-1, _BLOCK)
    for i in np.flatnonzero(blocks.any(axis=1)):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([blocks[i]], pa.list_(pa.int64()))], ["block", "counts"])


def _add_blocks(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_BLOCK, np.int64)
    for batch in batches:
        total += batch.column("counts").flatten().to_numpy().reshape(-1, _BLOCK).sum(axis=0)
    packed = zlib.compress(total.tobytes(), 1)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([packed], pa.binary())], ["block", "packed"])


def run_counts(docs: DataFrame) -> dict[int, bytes]:
    """Of all documents' runs, how many fall in each cell: the blocks of cells that hold
    any, packed. So they pass the driver and go to the tasks, see ``_unpacked``."""
    rows = (
        docs.select("text")
        .mapInArrow(_count_cells, "block long, counts array<long>")
        .groupBy("block")
        .applyInArrow(_add_blocks, "block long, packed binary")
        .toArrow()
    )
    return dict(zip(rows["block"].to_pylist(), rows["packed"].to_pylist(), strict=True))


def _unpacked(blocks: dict[int, bytes]) -> np.ndarray:
    total = np.zeros(((1 << CELL_BITS) // _BLOCK, _BLOCK), np.int64)
    for block, packed in blocks.items():
        total[block] = np.frombuffer(zlib.decompress(packed), np.int64)
    return total.ravel()


def _least_overlap(n: int) -> int:
    return -(-4 * n // 5)


def _prefix(runs: np.ndarray, counts: np.ndarray, usual: float) -> tuple[np.ndarray, int, int]:
    """The runs of the longest prefix, rare ones first; the chosen number to share; and
    how many of the runs are not common."""
    n = len(runs)
    common = counts[_cells(runs)]
    shortest = n - _least_overlap(n) + 1
    order = np.lexsort((runs, common))[: shortest + LONGEST_MATCH - 1]
    others = np.cumsum(np.maximum(common[order] - usual, 0))
    wanted = np.arange(1, min(LONGEST_MATCH, _least_overlap(n)) + 1)
    looked_up = others[np.minimum(shortest + wanted - 1, len(others)) - 1]
    match = int(np.argmin(looked_up * (1 + _VERIFY * n / wanted))) + 1
    return runs[order], match, int(np.searchsorted(common[order], usual + _COMMON, side="right"))


def _digest(runs: np.ndarray) -> bytes:
    return hashlib.md5(runs.tobytes(), usedforsecurity=False).digest()


def _measured() -> TextFunction:
    def measure(texts: Texts) -> list[pa.Array]:
        sets = list(shingle_sets(texts))
        return [pa.array([len(x) for x in sets], pa.int32()), pa.array([_digest(x) for x in sets], pa.binary())]

    return measure


def _prefixed(blocks: dict[int, bytes]):
    def make() -> TextFunction:
        counts = _unpacked(blocks)
        # What a cell holds besides the run in question: its load, and chance on top of it.
        usual = counts.mean() + 3 * np.sqrt(counts.mean()) + 1

        def sign(texts: Texts) -> list[pa.Array]:
            digests, matches, rare, prefixes = [], [], [], []
            for runs in shingle_sets(texts):
                prefix, match, n_rare = _prefix(runs, counts, usual) if len(runs) else (runs, 1, 0)
                digests.append(_digest(runs))
                matches.append(match)
                rare.append(n_rare)
                prefixes.append(prefix.view(np.int64))
            ends = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            return [
                pa.array(digests, pa.binary()),
                pa.array(matches, pa.int32()),
                pa.array(rare, pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ]

        return sign

    return make


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole sets of the named documents: texts are not moved, a filter of bounded size
    finds nearly all that are not named, and the join with the pairs drops the others."""
    bits = min(_MOST_FILTER_BITS, max(10, (_FILTER_PER_NODE * nodes.count()).bit_length()))
    cell = F.pmod(F.xxhash64("node"), F.lit(1 << bits))
    words = nodes.select(F.floor(cell / 32).cast("int").alias("word"), (cell % 32).cast("int").alias("place"))
    words = words.select("word", F.expr("shiftleft(1L, place)").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            named = (table[cells >> 5] >> (cells & 31).astype(np.uint32)) & 1 == 1
            for piece in slices(batch.filter(pa.array(named)), "text"):
                sets = [s.view(np.int64) for s in shingle_sets(Texts.of(piece.column("text")))]
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], ["node", "runs"]
                )

    source = docs.select(F.col("doc_id").alias("node"), "text").filter("node is not null").withColumn("cell", cell)
    return source.mapInArrow(select, "node long, runs array<long>")


def _similar(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the sets are similar to which."""
    n, sizes = len(sets), np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(np.concatenate(sets), kind="stable")
    runs, owner = np.concatenate(sets)[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    count = np.diff(np.append(first, len(runs)))
    shared = np.zeros((n, n), np.float32)
    wide = first[count > 16]  # by products of 0/1 matrices, a few thousand runs at a time
    for a in range(0, len(wide), 2048):
        some, width = wide[a : a + 2048], count[count > 16][a : a + 2048]
        has = np.zeros((n, len(some)), np.float32)
        at = np.repeat(some - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
        has[owner[at], np.repeat(np.arange(len(some)), width)] = 1
        shared += has @ has.T
    narrow = np.repeat((count > 1) & (count <= 16), count)
    for step in range(1, 16):
        pair = np.flatnonzero(narrow[:-step] & (runs[:-step] == runs[step:])) if len(runs) > step else []
        if not len(pair):
            break
        found = np.bincount(owner[pair] * n + owner[pair + step], minlength=n * n).reshape(n, n)
        shared += found + found.T
    similar = 180 * shared.astype(np.int64) >= 80 * (sizes[:, None] + sizes)
    np.fill_diagonal(similar, True)
    return similar


def _joined(similar: np.ndarray) -> np.ndarray:
    """For each member of a block, the first member of its component."""
    label = np.arange(len(similar))
    while True:
        least = np.where(similar, label, len(label)).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block; the rows of a block follow each other."""

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        nodes, sets = np.array([r[0] for r in rows]), [r[1] for r in rows]
        first = _joined(_similar(sets)) if len(rows) > 1 else np.zeros(1, np.int64)
        linked = nodes != nodes[first]
        return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[first][linked])], ["u", "v"])

    block, rows = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("kind", "group", "low_part", "high_part")), strict=True))
        nodes, lists = batch.column("node").to_pylist(), batch.column("runs")
        ends, runs = lists.offsets.to_numpy(), lists.values.to_numpy()
        for i, key in enumerate(keys):
            if key != block:
                if len(rows) > 1:
                    yield compared(rows)
                block, rows = key, []
            rows.append((nodes[i], runs[ends[i] : ends[i + 1]].copy()))
    if len(rows) > 1:
        yield compared(rows)


def _linked_in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members that have the same smallest or the same largest fellow.

    A group of one largest fellow is passed over if all its members have one smallest
    fellow, too: they have met there.
    """
    sizes = []
    for kind, group, other in ((0, "low", "high"), (1, "high", "low")):
        of = members.groupBy(F.col(group).alias("group")).agg(
            F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("total"), (F.min(other) != F.max(other)).alias("mixed")
        )
        of = of.filter("nodes > 1" if kind == 0 else "nodes > 1 and mixed").withColumn("kind", F.lit(kind))
        sizes.append(of)
    sizes = sizes[0].unionAll(sizes[1])
    one = (F.col("nodes") <= 2 * _BLOCK_NODES) & (F.col("total") <= 2 * _BLOCK_RUNS)
    parts = F.greatest(F.ceil(F.col("nodes") / _BLOCK_NODES), F.ceil(F.col("total") / _BLOCK_RUNS))
    sizes = sizes.select("kind", "group", F.when(one, 1).otherwise(parts).cast("int").alias("parts"))
    own = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("group")) for k, c in enumerate(("low", "high"))]))
    rows = members.select("node", own.alias("g")).select("node", "g.*").join(sizes, ["kind", "group"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # Each part meets each other one; a group of one part is a block of its own.
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: (q != F.col("part")) | (F.col("parts") == 1))
    rows = rows.withColumn("other", F.explode(others)).select(
        "kind", "group", "node", F.least("part", "other").alias("low_part"), F.greatest("part", "other").alias("high_part")
    )
    block = ["kind", "group", "low_part", "high_part"]
    return rows.join(sets, "node").repartition(*block).sortWithinPartitions(*block).mapInArrow(_block_links, "u long, v long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (``u``, ``v``) whose whole sets are similar."""
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("runs").alias("x")), "u").join(
        sets.select(F.col("node").alias("v"), F.col("runs").alias("y")), "v"
    )
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(180 * shared >= 80 * (F.size("x") + F.size("y"))).select("u", "v").distinct()


def _shared_runs(nodes: DataFrame) -> DataFrame:
    """The prefixes' runs that several nodes have (``run``, ``node``, ``place`` and what
    is known of the node), with the smallest and the largest node (``low``, ``high``)."""
    index = nodes.select("node", "match", "rare", F.posexplode("prefix").alias("place", "run"))

    def several(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("run").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high")
        return rows.join(ends, "run")

    # Nearly all rare runs have one node, so aggregating them first would shuffle them twice.
    rare = index.filter("place < rare").drop("rare").repartition("run")
    return several(rare).unionByName(several(index.filter("place >= rare").drop("rare")))


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = written(with_text_columns(docs, {"n_shingles": "int", "digest": "binary"}, _measured, ["doc_id"]), "sizes")
    some = measured.filter("n_shingles > 0 and doc_id is not null")
    nodes = some.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    # The prefixes are made in a pass of their own: they would take more room than time.
    fields = {"digest": "binary", "match": "int", "rare": "int", "prefix": "array<long>"}
    prefixes = with_text_columns(docs, fields, _prefixed(run_counts(docs)), ["doc_id"])
    prefixes = prefixes.join(nodes, ["doc_id", "digest"]).withColumnRenamed("doc_id", "node")
    prefixes = written(prefixes.drop("digest"), "prefixes")
    shared = written(_shared_runs(prefixes), "shared-runs")

    # Nodes whose runs that nobody shares are too many to be similar to any other are done.
    # Rows of one id that have several sets are one node, for which only its runs count.
    by_node = shared.groupBy("node").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("match").alias("match"),
        F.count(F.lit(1)).alias("known"),
    )
    facts = some.groupBy(F.col("doc_id").alias("node")).agg(
        F.max("n_shingles").alias("n"), (F.min("digest") == F.max("digest")).alias("single")
    )
    length = F.least(F.lit(0), LONGEST_MATCH - F.ceil(F.col("n") * 4 / 5).cast("int")) + F.col("n")
    members = by_node.join(facts, "node").withColumn("able", F.col("n") - length + F.col("known"))
    members = written(members.filter("not single or 5 * able >= 4 * n"), "members")
    sets = written(_sets_of(docs, members.select("node")), "sets")
    first = written(_linked_in_blocks(members, sets), "links")
    joined = written(connected(first), "components")
    second = written(_verified(written(_open_pairs(shared, members, joined), "pairs"), sets), "links")
    joined = connected(first.unionAll(second))

    # A document may have several rows, and a digest several documents.
    same = some.groupBy("digest").agg(F.min("doc_id").alias("node"))
    by_doc = some.select("doc_id", "digest").distinct().join(same, "digest").select("doc_id", "node")
    by_doc = by_doc.join(joined, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    by_doc = by_doc.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return measured.join(by_doc, "doc_id", "left").select(
        "doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _open_pairs(shared: DataFrame, members: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs that met in no block and are of different components, that share as many runs
    of their prefixes as the larger of both numbers asks, and that their sizes, the places
    of the runs and the runs that no other node has allow to be similar."""
    facts = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    facts = facts.select("node", F.col("low").alias("first"), F.col("high").alias("last"), "n", "match", "able", "single", "component")
    rows = shared.select("run", "node", "place").join(facts, "node")
    ends = rows.groupBy("run").agg(
        F.min("first").alias("usual"),
        *[(F.min(c) != F.max(c)).alias(f"mixed_{c}") for c in ("first", "last", "component")],
    )
    ends = ends.filter("mixed_first and mixed_last and mixed_component").select("run", "usual")
    shortest = F.col("n") - F.ceil(F.col("n") * 4 / 5).cast("int") + 1
    rows = rows.join(ends, "run").withColumn("level", F.greatest(F.lit(1), F.col("place") - shortest + 2))
    rows = written(rows, "open-runs")
    # Two nodes of a run's usual group have met, so one of each pair is of another.
    own = (F.col("b.first") == F.col("b.usual")) | (F.col("a.node") > F.col("b.node"))
    single = F.col("a.single") & F.col("b.single")
    wanted = F.when(single, F.greatest("a.match", "b.match")).otherwise(1)
    needed = 80 * (F.col("a.n") + F.col("b.n"))
    overlap = F.least("a.place", "b.place") + F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    return (
        rows.filter(F.col("first") != F.col("usual")).alias("a")
        .join(rows.alias("b"), (F.col("a.run") == F.col("b.run")) & own)
        .filter((F.col("a.first") != F.col("b.first")) & (F.col("a.last") != F.col("b.last")))
        .filter(F.col("a.component") != F.col("b.component"))
        .filter(~single | (F.greatest("a.level", "b.level") <= wanted) & (180 * overlap >= needed) & (180 * F.least("a.able", "b.able") >= needed))
        .groupBy(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v"))
        .agg(F.count(F.lit(1)).alias("shared"), F.max(wanted).alias("wanted"))
        .filter("shared >= wanted")
        .select("u", "v")
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest id, with all its columns.

    Of several rows of one id the one with the smallest text stays. Documents without
    words link with nothing and stay, as do rows without an id.
    """
    docs, restore = aside(docs, ("doc_id", "text"))
    kept = linked(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    kept = written(kept, "kept")
    rows = docs.join(kept, F.col("doc_id").cast("long") == F.col("kept_id"))
    nth = F.row_number().over(Window.partitionBy("kept_id").orderBy("text"))
    named = rows.withColumn("kept_nth", nth).filter("kept_nth = 1").select(*docs.columns)
    return restore(named.unionAll(docs.filter("doc_id is null")))
