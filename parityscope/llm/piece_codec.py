"""SentencePiece encoding by suffix-array matching, and decoding.

The different chunks of a batch (runs between white space, which no piece crosses) are
joined to one text. Its suffix array, sorted as deep as the longest piece, is binary-searched
for every piece of the vocabulary: each range found holds all occurrences of one piece. They
are edges of a graph over positions; sorted by their end, they are relaxed from left to
right: a position is reached by the one edge whose piece may follow the last piece of the
path to its start. For a BPE model a piece may follow another if merging both texts
together gives just these two, so the path to a chunk's end is the model's own encoding.

Characters that the vocabulary lacks are written as byte pieces. Decoding joins the pieces.

Defined results: a null or empty text has no ids and is decoded as empty; a long text is
encoded whole, in a slice of its own; the model's own
space sign in a text is read as a space, as the model does; repeated rows are encoded as
often as they occur; an empty table gives no rows; other columns are passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from parityscope.llm.text_bytes import Texts, slices

#: Bytes of text encoded at a time; a longer document is encoded alone. The suffix array of
#: a slice's different chunks takes some hundred times their bytes.
ENCODE_BYTES = 1 << 20
#: Different chunks that a task remembers at most; then its memory starts anew.
_REMEMBERED = 400_000
_SPACE_SIGN = "▁"


class PieceTable:
    """Vocabulary of a BPE model in merge order: characters first, then merges by score."""

    def __init__(self, path: str) -> None:
        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        usable = [
            i for i in range(len(names)) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
        ]
        chars = [i for i in usable if len(names[i]) == 1]
        merges = sorted((i for i in usable if len(names[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.ids = np.array(chars + merges, np.int64)
        self.pieces = [names[i].replace(_SPACE_SIGN, " ") for i in self.ids]
        self.n = len(self.pieces)
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.ends_chunk = {c for c in "\n\t" if c not in set(self.pieces[: len(chars)])}
        self._pair_up(len(chars))
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.points = np.frombuffer("".join(self.pieces).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.length)[:-1]))

    def letters(self, alphabet: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The pieces written in an alphabet (sorted code points) alone, in ascending order,
        and the numbers of their letters from 1, one row each, filled with 0 to a multiple of
        ``width``."""
        if not len(alphabet):
            return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
        letter = np.searchsorted(alphabet, self.points)
        letter[letter == len(alphabet)] = 0
        letter = np.where(alphabet[letter] == self.points, letter + 1, 0)
        wanted = np.flatnonzero(self.reachable & (np.minimum.reduceat(letter, self.begins) > 0))
        length = self.length[wanted]
        rows = np.zeros((len(wanted), -(-int(length.max(initial=0)) // width) * width), np.int64)
        row = np.repeat(np.arange(len(wanted)), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        rows[row, place] = letter[np.repeat(self.begins[wanted], length) + place]
        return wanted, rows

    def _pair_up(self, n_chars: int) -> None:
        """For each merge the two pieces that it joins, by merging its text in order."""
        rank = {p: i for i, p in enumerate(self.pieces)}
        self.left, self.right = np.arange(self.n), np.arange(self.n)
        joined: dict[int, int] = {}
        reachable = np.ones(self.n, bool)
        for token in range(n_chars, self.n):
            parts = [rank.get(c, -1) for c in self.pieces[token]]
            while len(parts) > 2:
                best = min(
                    ((rank.get(self.pieces[a] + self.pieces[b], token), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a >= 0 and b >= 0),
                    default=(token, 0),
                )
                if best[0] >= token:
                    break
                parts[best[1] : best[1] + 2] = [best[0]]
            reachable[token] = len(parts) == 2 and min(parts) >= 0
            if reachable[token]:
                self.left[token], self.right[token] = parts
                joined[parts[0] * self.n + parts[1]] = token
        self.reachable = reachable
        keys = np.array(sorted(joined), np.int64)
        self._pairs, self._merged = np.append(keys, -1), np.array([joined[k] for k in keys] + [self.n], np.int64)
        self._n_pairs = len(keys)

    def _merge_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that joins two, ``n`` (later than all) if there is none."""
        key = a * self.n + b
        at = np.searchsorted(self._pairs[: self._n_pairs], key)
        return np.where(self._pairs[at] == key, self._merged[at], self.n)

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the texts of ``a`` and ``b`` together gives ``a`` and ``b``.

        The pieces' own merges are undone from the last to the first along their common
        border; if two parts there would have been joined earlier, the border is lost.
        """
        out = np.ones(len(a), bool)
        open_ = np.flatnonzero((a < self.n) & (b < self.n))
        a, b, limit = a[open_], b[open_], np.full(len(open_), self.n)
        while len(open_):
            lost = self._merge_of(a, b) < limit
            out[open_[lost]] = False
            split_a = a > b  # the later merge is undone first
            both_done = (self.right[a] == a) & (self.left[b] == b)
            can_a, can_b = self.right[a] != a, self.left[b] != b
            use_a = np.where(split_a, can_a, ~can_b)
            limit = np.where(use_a, a, b + 1)
            a, b = np.where(use_a, self.right[a], a), np.where(use_a, b, self.left[b])
            go_on = ~lost & ~both_done
            open_, a, b, limit = open_[go_on], a[go_on], b[go_on], limit[go_on]
        return out


def _edges(codes: np.ndarray, table: PieceTable, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and piece of every occurrence of a piece in a text of letters (0: an end),
    by binary search in the text's suffix array."""
    bits = max(1, int(len(alphabet)).bit_length())
    per_key = 62 // bits
    wanted, letters = table.letters(alphabet, per_key)
    if not len(wanted):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length, n_keys = table.length[wanted], letters.shape[1] // per_key
    padded = np.concatenate((codes, np.zeros(n_keys * per_key, np.int64)))
    keys = []
    for k in range(n_keys):
        key = np.zeros(len(codes), np.int64)
        for i in range(k * per_key, (k + 1) * per_key):
            key = key << bits | padded[i : i + len(codes)]
        keys.append(key)
    suffixes = np.lexsort(keys[::-1])
    starts, pieces = [], []
    # Ranks of all keys up to one, so that a piece longer than one key is one number too:
    # that of each position, and that of each piece's own first keys, -1 if no text has them.
    rank, rank_of = np.zeros(len(codes), np.int64), np.zeros(len(wanted), np.int64)
    for k in range(n_keys):
        values, place = np.unique(keys[k], return_inverse=True)
        combined = (rank * (len(values) + 1) + place)[suffixes]
        low = np.zeros(len(wanted), np.int64)
        for i in range(k * per_key, (k + 1) * per_key):
            low = low << bits | letters[:, i]
        here = np.flatnonzero((rank_of >= 0) & (length > k * per_key) & (length <= (k + 1) * per_key))
        if len(here):
            lows = low[here]
            highs = lows | ((1 << bits * ((k + 1) * per_key - length[here])) - 1)
            base = rank_of[here] * (len(values) + 1)
            first = np.searchsorted(combined, base + np.searchsorted(values, lows, side="left"))
            last = np.searchsorted(combined, base + np.searchsorted(values, highs, side="right"))
            counts = last - first
            at = np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
            starts.append(suffixes[at])
            pieces.append(np.repeat(wanted[here], counts))
        following = np.flatnonzero((rank_of >= 0) & (length > (k + 1) * per_key))
        if not len(following):
            break
        # In the order of the suffixes the keys so far ascend.
        new = np.concatenate(([True], combined[1:] != combined[:-1]))
        dense = combined[new]
        rank[suffixes] = np.cumsum(new) - 1
        value = np.searchsorted(values, low[following])
        key = rank_of[following] * (len(values) + 1) + value
        found = np.searchsorted(dense, key)
        known = np.append(values, -1)[value] == low[following]
        known &= np.append(dense, -1)[found] == key
        rank_of[:] = -1
        rank_of[following[known]] = found[known]
    return np.concatenate([np.zeros(0, np.int64), *starts]), np.concatenate([np.zeros(0, np.int64), *pieces])


def encode_chunks(chunks: list[str], table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks end to end, and where each chunk's ids begin."""
    points = np.frombuffer("\0".join([*chunks, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
    lengths = np.array([len(c) for c in chunks], np.int64)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    ends = begins + lengths
    inside = np.ones(len(points), bool)
    inside[ends] = False  # the sign between chunks, and not a NUL of a text
    alphabet, letters = np.unique(points[inside], return_inverse=True)
    codes = np.zeros(len(points), np.int64)
    codes[inside] = letters + 1
    start, piece = _edges(codes, table, alphabet)
    known = np.zeros(len(points) + 1, bool)
    known[start[table.length[piece] == 1]] = True
    lacking = np.flatnonzero(inside & ~known[:-1])
    start, piece = np.append(start, lacking), np.append(piece, np.full(len(lacking), table.n))
    end = start + np.append(table.length, 1)[piece]
    chunk_begin = np.repeat(begins, lengths + 1)
    depth = end - chunk_begin[start]
    deepest = int(lengths.max(initial=0))
    depth = depth.astype(np.uint16 if deepest < 1 << 16 else np.int64)  # a stable sort of 16 bits takes linear time
    order = np.argsort(depth, kind="stable")
    start, piece, end = start[order], piece[order], end[order]
    rounds = np.searchsorted(depth[order], np.arange(1, deepest + 2))
    last, back = np.full(len(points) + 1, -1), np.zeros(len(points) + 1, np.int64)
    for a, b in zip(rounds, rounds[1:], strict=False):
        s, t, e = start[a:b], piece[a:b], end[a:b]
        first = s == chunk_begin[s]
        reached = first | (last[s] >= 0)
        s, t, e, first = s[reached], t[reached], e[reached], first[reached]
        good = first.copy()
        later = np.flatnonzero(~first)
        good[later] = table.may_follow(last[s[later]], t[later])
        last[e[good]], back[e[good]] = t[good], s[good]
    where, path = np.flatnonzero(lengths > 0), []
    at = ends[where]
    while len(where):
        if (last[at] < 0).any():
            raise ValueError("a chunk has no path through its pieces")
        path.append((where, last[at], back[at]))
        at = back[at]
        more = at > begins[where]
        where, at = where[more], at[more]
    if not path:
        return np.zeros(0, np.int64), np.zeros(len(chunks) + 1, np.int64)
    chunk, token, at = (np.concatenate([p[i] for p in reversed(path)]) for i in range(3))
    order = np.argsort(chunk, kind="stable")
    chunk, token, at = chunk[order], token[order], at[order]
    width = np.ones(len(token), np.int64)
    bytes_of = [chr(p).encode() for p in points[at[token == table.n]].tolist()]
    width[token == table.n] = [len(b) for b in bytes_of]
    ids = np.repeat(np.append(table.ids, 0)[token], width)
    ids[np.repeat(token == table.n, width)] = table.byte_ids[np.frombuffer(b"".join(bytes_of), np.uint8)]
    return ids, np.concatenate(([0], np.cumsum(np.bincount(chunk, width, len(chunks)).astype(np.int64))))


class PieceEncoder:
    """Encodes texts; remembers chunks as long as its task lives."""

    def __init__(self, path: str) -> None:
        self.table = PieceTable(path)
        self._cut = np.zeros(256, bool)
        self._cut[[ord(c) for c in self.table.ends_chunk]] = True
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._ids, self._ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _slots_of(self, chunks: list[str]) -> np.ndarray:
        if len(self._slots) + len(chunks) > _REMEMBERED:
            self._forget()
        new = [c for c in chunks if c not in self._slots]
        if new:
            ids, ends = encode_chunks(new, self.table)
            for c in new:
                self._slots[c] = len(self._slots)
            self._ends = np.append(self._ends, ends[1:] + len(self._ids))
            self._ids = np.append(self._ids, ids.astype(np.int32))
        return np.array([self._slots[c] for c in chunks], np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offset of each text's first id."""
        column = pc.replace_substring(pc.fill_null(column, ""), _SPACE_SIGN, " ")
        lead = pc.if_else(pc.equal(column, ""), "", " ")
        texts = Texts.of(pc.binary_join_element_wise(lead, column, ""))
        data, begins = texts.data, texts.text_begins.copy()
        if len(begins):
            space, cut = data == 32, self._cut[data]
            begins[1:] |= (space[1:] & ~space[:-1]) | cut[1:] | cut[:-1]
        starts = np.flatnonzero(begins)
        chunks = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        slots = self._slots_of(chunks.dictionary.to_pylist())[chunks.indices.to_numpy()]
        lists = pa.LargeListArray.from_arrays(pa.array(self._ends), pa.array(self._ids, pa.int32()))
        taken = lists.take(pa.array(slots))
        return taken.values.to_numpy(), taken.offsets.to_numpy()[np.searchsorted(starts, texts.offsets)]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian 32-bit integers) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for batch in batches:
            for piece in slices(batch, "text", ENCODE_BYTES):
                ids, offsets = encoder.encode(piece.column("text"))
                packed = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(piece), [None, pa.py_buffer(offsets.astype(np.int64) * 4), pa.py_buffer(ids.astype("<i4"))]
                )
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), packed.cast(pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids binary")


def _spellings(path: str) -> pa.LargeBinaryArray:
    """The bytes that each id stands for; none for control signs."""
    model = SentencePieceProcessor(model_file=path)
    spelt = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            spelt.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelt.append(b"")
        else:
            spelt.append(name.replace(_SPACE_SIGN, " ").encode())
    return pa.array(spelt, pa.large_binary())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The encoded rows and the ``text`` that their ids spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = _spellings(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = []
                for ids in part.column("ids").to_pylist():
                    spelt = spellings.take(pa.array(np.frombuffer(ids, "<i4")))
                    texts.append(Texts.of_bytes(spelt).removeprefix(b" ").decode(errors="replace"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])

    return encoded.mapInArrow(run, encoded.select("*", F.lit("").alias("text")).schema)
