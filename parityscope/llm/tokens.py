"""Token ids of a batch of texts, by the tokenizers library, each different chunk encoded once.

Byte-level and word-end BPE split a text by a pattern before merging. A split always lies
where a run of white space begins, and between two of a letter, a digit and a punctuation
mark other than an apostrophe. A run of white space may mix ASCII and other Unicode
spaces; it is cut at its first character if that is ASCII, and nowhere else. So a text is
cut there, the different chunks are encoded, and the ids of the text are the ids of its
chunks in order: the same ids as from encoding it whole. If the tokenizer reads capital
letters as small ones and all white space as one space, so do the chunks.
"""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from parityscope.llm.text_bytes import Texts

#: Bytes of text encoded at a time; a longer document is encoded alone.
ENCODE_BYTES = 8 << 20

#: Split pattern of byte-level pre-tokenizers that have none of their own (fixed value).
_BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Different chunks that a task remembers at most; then its memory starts anew.
_REMEMBERED = 700_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True
_LETTERS, _DIGITS, _MARKS = 1, 2, 3
#: Class of each byte, 0 for those that are none of the three.
_CLASS = np.zeros(256, np.uint8)
_CLASS[_LETTER], _CLASS[_MARK], _CLASS[48:58] = _LETTERS, _MARKS, _DIGITS
_FOLDED, _ONE_SPACE = np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
_FOLDED[65:91], _ONE_SPACE[9:14] = np.arange(97, 123), 32
#: Bytes of characters on which all Unicode versions and regex dialects agree: printable
#: ASCII, tab, line ends, and U+00C0 to U+00FF but for the two signs among them.
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, *range(32, 127), 0xC3, *range(0x80, 0xC0)]] = True

#: Characters that a pattern's ``\s`` may take besides ASCII, by their last three bytes
#: (two, if they have no more).
_WIDE_SPACES = np.array(
    [
        int.from_bytes(chr(c).encode())
        for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)
    ]
)


def _space_runs(texts: Texts) -> np.ndarray:
    """Bytes with which a run of white space begins, the first byte left out: ASCII spaces
    that follow no space of any kind."""
    data, space = texts.data, texts.space
    runs = space[1:] & ~space[:-1]
    before = np.flatnonzero(runs & (data[:-1] >= 0x80))
    two = data[before - 1].astype(np.int64) << 8 | data[before]
    three = data[np.maximum(before - 2, 0)].astype(np.int64) << 16 | two
    runs[before[np.isin(two, _WIDE_SPACES) | np.isin(three, _WIDE_SPACES)]] = False
    return runs


def _class_changes(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a letter, digit or mark after another one of the three, the first byte
    left out. Letters are ASCII, and U+00C0 to U+00FF but for the two signs among them."""
    kind = _CLASS[data]
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[wide], kind[wide + 1] = _LETTERS, _LETTERS
    return (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level models write each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkEncoder:
    """Encodes texts with one tokenizer file; lives as long as a task."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self._special = [t["content"].encode() for t in config["added_tokens"]]
        normalizer = config["normalizer"] or {}
        normalizers = [n for n in normalizer.get("normalizers", [normalizer]) if n]
        self._lower = any(n["type"] == "Lowercase" for n in normalizers)
        self._one_space = any(n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normalizers)
        steps = config["pre_tokenizer"].get("pretokenizers", [config["pre_tokenizer"]])
        pattern = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), _BYTE_LEVEL_PATTERN)
        self._pieces = regex.compile(pattern).findall
        self._model = self.tokenizer.model
        self._letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self._slots: dict[str, int] = {}
        self._ids, self._ends = array("I"), array("i", [0])

    def _chunk_ids(self, chunk: str, plain: bool) -> list[int]:
        if not plain:
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        model, letters, ids = self._model, self._letters, []
        for piece in self._pieces(chunk.lower() if self._lower else chunk):
            written = piece.encode().decode("latin-1").translate(letters)
            ids += [t.id for t in model.tokenize(written)]
        return ids

    def _word_ids(self, chunk: str) -> list[int]:
        """Of ASCII letters after one space at most: one piece, of a text without special tokens."""
        written = chunk.strip().lower() if self._lower else chunk.replace(" ", self._letters[32])
        return [t.id for t in self._model.tokenize(written)]

    def _slots_of(self, chunks: pa.LargeStringArray, special: bool) -> np.ndarray:
        """The place in memory of each different chunk."""
        if len(self._slots) + len(chunks) > _REMEMBERED:
            self._forget()
        texts = Texts.of(chunks)
        plain = texts.count_in_texts(~_PLAIN) == 0
        signs = np.flatnonzero((texts.data[:-1] == 0xC3) & np.isin(texts.data[1:], (0x97, 0xB7)))
        lead = np.flatnonzero((texts.data[:-1] != 0xC3) & (texts.data[1:] >= 0x80) & (texts.data[1:] < 0xC0))
        for odd in (signs, lead):
            plain[np.searchsorted(texts.offsets, odd, side="right") - 1] = False
        spaces = texts.data[np.minimum(texts.offsets[:-1], len(texts.data) - 1)] == 32 if len(texts) else plain
        word = (np.diff(texts.offsets) - texts.count_in_texts(_LETTER) == spaces) & (np.diff(texts.offsets) > spaces)
        if special:
            plain[:], word[:] = False, False
        kinds = np.where(word, 2, plain).tolist()
        slots, known = np.empty(len(chunks), np.int64), self._slots
        for i, (chunk, kind) in enumerate(zip(chunks.to_pylist(), kinds, strict=True)):
            slot = known.get(chunk)
            if slot is None:
                slot = known[chunk] = len(known)
                self._ids.extend(self._word_ids(chunk) if kind == 2 else self._chunk_ids(chunk, kind == 1))
                self._ends.append(len(self._ids))
            slots[i] = slot
        return slots

    def encode(self, texts: Texts, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offset of each text's first id; ``end_id`` closes each text."""
        data = texts.data
        special = any(s in data.tobytes() for s in self._special)
        begins = texts.text_begins.copy()
        if len(begins):
            begins[1:] |= _space_runs(texts)
            if not special:
                begins[1:] |= _class_changes(data)
                data = _FOLDED[data] if self._lower else data
                data = _ONE_SPACE[data] if self._one_space else data
        starts = np.flatnonzero(begins)
        chunks = pa.LargeStringArray.from_buffers(
            len(starts),
            pa.py_buffer(np.append(starts, len(data)).astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(data)),
        ).dictionary_encode()
        slots = self._slots_of(chunks.dictionary, special)[chunks.indices.to_numpy()]
        doc_chunks = np.searchsorted(starts, texts.offsets)
        ids = np.frombuffer(self._ids, np.uint32) if self._ids else np.zeros(0, np.uint32)
        ends = np.frombuffer(self._ends, np.int32)
        if end_id is not None:
            ids, ends = np.append(ids, np.uint32(end_id)), np.append(ends, ends[-1] + 1).astype(np.int32)
            slots = np.insert(slots, doc_chunks[1:], len(ends) - 2)
            doc_chunks = doc_chunks + np.arange(len(texts) + 1)
        lists = pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), pa.array(ids))
        taken = lists.take(pa.array(slots))
        return taken.values.to_numpy(), taken.offsets.to_numpy()[doc_chunks]
