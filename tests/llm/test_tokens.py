"""Token ids, files and packs against the tokenizers and sentencepiece libraries."""

import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from parityscope.llm import packing, piece_codec, token_files
from parityscope.llm.shared import shared_path
from parityscope.llm.text_bytes import Texts
from parityscope.llm.tokens import ChunkEncoder

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
HARD = [
    "", None, "  a  b\n\tc é\x00 　x ▁y ﬁ", "<|endoftext|> x<|startoftext|>y", "İstanbul ẞ Σας it's  don't x,y 12,5",
    "\n\n  a", "a \x1c b", "  ", "x" * 3000, "1234 5.6\r\n\r\n z", "日本語 текст 🤦🏼‍♂️ ok", "É×÷ß end's,'s",
]
ANY = st.lists(st.text(alphabet=st.sampled_from("aé ,'sS1\n\t|<>.×日 "), max_size=40), max_size=5)


@pytest.fixture(scope="module", params=[BYTE, WORD])
def encoder(request):
    return ChunkEncoder(request.param)


def _lists(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


def _library(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_hard_texts(encoder):
    ids, offsets = encoder.encode(Texts.of(pa.array(HARD)), 7)
    assert _lists(ids, offsets) == [x + [7] for x in _library(encoder, HARD)]


@settings(max_examples=100, deadline=None)
@given(ANY)
def test_any_texts(encoder, texts):
    assert _lists(*encoder.encode(Texts.of(pa.array(texts, pa.string())))) == _library(encoder, texts)


def test_runs_of_mixed_spaces(encoder):
    texts = [f"a{' '.join(w * n)} b {w} c{w} \n{w}d {w}" for w in "\u00a0\u2003\u0085\u3000\u2028\u200b" for n in (1, 2, 4, 9)]
    texts += ["a \u00a0 \u00a0 b", "\u00a0", " \u00a0", "\u00a0 x", "é \u00a0 é à ü"]
    assert _lists(*encoder.encode(Texts.of(pa.array(texts)))) == _library(encoder, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("a1, \n\u00a0\u2003\u0085\u3000é日"), max_size=30), max_size=5))
def test_any_spaces(encoder, texts):
    assert _lists(*encoder.encode(Texts.of(pa.array(texts, pa.string())))) == _library(encoder, texts)


@settings(max_examples=60, deadline=None)
@given(ANY)
def test_pieces(texts):
    assert _lists(*_piece_encoder().encode(pa.array(texts, pa.string()))) == _model().encode(texts, num_threads=1)


_KEPT = {}


def _piece_encoder():
    return _KEPT.setdefault("encoder", None) or _KEPT.update(encoder=piece_codec.PieceEncoder(PIECE)) or _KEPT["encoder"]


def _model():
    return _KEPT.setdefault("model", None) or _KEPT.update(model=SentencePieceProcessor(model_file=PIECE)) or _KEPT["model"]


def test_a_small_batch_does_not_loop_over_the_vocabulary():
    """Calls made for three chunks; each piece of the vocabulary took some of them before."""
    table, calls = _piece_encoder().table, []
    sys.setprofile(lambda frame, event, argument: calls.append(event))
    try:
        ids, ends = piece_codec.encode_chunks([" ab", "", " information"], table)
    finally:
        sys.setprofile(None)
    assert len(calls) < table.n / 4
    model = SentencePieceProcessor(model_file=PIECE)
    assert ids.tolist() == model.encode("ab information") and ends[1] == ends[2]


def test_piece_codec(spark, docs_of):
    docs = docs_of([*HARD, HARD[2]], ids=list(range(len(HARD) + 1))).repartition(3)
    rows = piece_codec.decode(piece_codec.encode(docs, PIECE), PIECE).collect()
    assert len(rows) == len(HARD) + 1
    for row in rows:
        text = [*HARD, HARD[2]][row.doc_id] or ""
        assert np.frombuffer(row.ids, "<i4").tolist() == _model().encode(text)
        assert row.text == text.replace("▁", " ")


def test_token_files(spark, docs_of):
    docs = docs_of(HARD, ids=["x"] * len(HARD))
    docs = docs.unionAll(docs.filter("doc_id = 4")).unionAll(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    folder = shared_path(spark, "test")
    token_files.write_token_files(docs.repartition(4), folder, BYTE, 0)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    library = [x + [0] for x in _library(ChunkEncoder(BYTE), HARD)]
    assert [r.doc_id for r in rows] == [None, 0, 1, 2, 3, 4, *range(4, len(HARD))]
    start = 0
    for row in rows:
        want = np.array(library[5 if row.doc_id is None else row.doc_id], "<u4")
        assert (row.start, row.n_tokens, zlib.crc32(row.ids)) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_token_files_of_the_least_id_and_by_ranges(spark, monkeypatch):
    rows = [(-(2**63), "least"), (None, "no id"), (None, ""), (2**63 - 1, "word " * 400_000), (0, None)]
    folder = shared_path(spark, "test")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), folder, BYTE, 0)
    mapped = sorted(map(str, token_files.read_token_files(spark, folder).select("doc_id", "start", F.crc32("ids")).collect()))
    assert Counter(r.doc_id for r in token_files.read_token_files(spark, folder).collect()) == Counter([d for d, _ in rows])
    store, path = token_files._file_system(folder)
    name = f"{path}/00000000"
    n = spark.read.parquet(f"{folder}/manifest").orderBy("part").first().n_docs
    whole = token_files._File(store, f"{name}.offsets", "<i8", n + 1)
    ranges = token_files._File(pafs.SubTreeFileSystem("/", pafs.LocalFileSystem()), f"{name}.offsets", "<i8", n + 1)
    assert (whole[0 : n + 1] == ranges[0 : n + 1]).all() and (whole[1:n] == ranges[1:n]).all() and len(mapped) == 5


def test_token_files_in_a_store_that_tasks_cannot_open(spark, docs_of):
    with pytest.raises(ValueError, match="wasbs"):
        token_files.write_token_files(docs_of(["a"]), "wasbs://somewhere/x", BYTE, 0)


def test_token_files_of_nothing(spark, docs_of):
    folder = shared_path(spark, "test")
    token_files.write_token_files(docs_of([]), folder, BYTE, 0)
    assert token_files.read_token_files(spark, folder).count() == 0


def _check_pieces(rows, documents):
    """Every id lies in one piece; sequences have no gaps and are full or a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(documents)
    for doc, ids in documents.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        assert b"".join(bytes(r.ids) for r in pieces) == np.array(ids, "<u4").tobytes()
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *[r.length for r in pieces]])[:-1].tolist()
        total = sum(r.length for r in pieces)
        assert total <= 4096 and total & (total - 1) == 0


def test_packing(spark, docs_of, draw):
    texts = [*HARD, *[" ".join(draw.choice(["red", "green", "blue", "sea", "sky"], 900)) for _ in range(30)], "long " * 9000]
    rows = packing.pack(docs_of(texts).repartition(3), WORD, 49_408, 2).collect()
    _check_pieces(rows, dict(enumerate(x + [2] for x in _library(ChunkEncoder(WORD), texts))))


def test_packing_puts_neighbours_together():
    topics = np.repeat(np.arange(8), 6)
    order = np.random.default_rng(1).permutation(48)
    ids = np.concatenate([np.full(64, 10 + topics[i]) for i in order]).astype(np.uint32)
    offsets = np.arange(49) * 64
    pieces = packing._fill(np.diff(offsets), packing._Index(ids, offsets, np.ones(20), 64.0), 256)
    windows = {}
    for doc, _, _, sequence, _ in pieces:
        windows.setdefault(sequence, set()).add(topics[order[doc]])
    assert np.mean([len(t) == 1 for t in windows.values()]) > 0.5


def test_index_scores_are_those_of_brute_force(draw):
    """Scores by lists and by the matrix of common terms, against BM25 written out."""
    ids = [draw.zipf(1.3, int(n)) % 3000 for n in draw.integers(1, 400, 120)]
    offsets, flat = np.cumsum([0, *map(len, ids)]), np.concatenate(ids).astype("<u2")
    idf = draw.random(3000) + 0.1
    index = packing._Index(flat, offsets, idf, 200.0)
    for seed in range(0, 120, 7):
        want = np.zeros(120)
        for doc, own in enumerate(ids):
            for term in set(own.tolist()) & set(ids[seed].tolist()):
                tf = int((own == term).sum())
                want[doc] += idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / 200))
        assert np.allclose(index.scores(seed), want, rtol=1e-4)
        few = packing._Index(flat, offsets, idf, 200.0)
        few.keep(np.arange(120) % 3 == 0)
        assert np.allclose(few.scores(seed), want[::3], rtol=1e-4) and (few.docs == np.arange(0, 120, 3)).all()


def test_packing_finds_neighbours_outside_a_shard(spark, docs_of, draw, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 20_000)
    words = [a + b for a in ("sun", "moon", "star", "river", "stone", "tree") for b in ("light", "side", "fall", "land", "work")]
    topics = draw.permutation(np.repeat(np.arange(30), 12))
    texts = [" ".join(draw.permutation([words[t]] * 150 + list(draw.choice(["a", "of", "the", "in"], 200)))) for t in topics]
    rows = packing.pack(docs_of(texts).repartition(3), WORD, 49_408, 2).collect()
    _check_pieces(rows, dict(enumerate(x + [2] for x in _library(ChunkEncoder(WORD), texts))))
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(topics[r.doc_id])
    assert len({r.sequence_id >> 32 for r in rows}) > 4
    shares = [np.bincount(t).max() / len(t) for t in windows.values() if len(t) > 4]
    assert np.mean(shares) > 0.6


def test_packing_rows_without_id_and_copies(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 3_000)
    text = " ".join(["river", "stone"] * 300)
    docs = docs_of([text] * 40).unionAll(spark.createDataFrame([(None, "a b c")], "doc_id long, text string"))
    rows = packing.pack(docs, WORD, 49_408, 2).collect()
    _check_pieces(rows, {i: x + [2] for i, x in zip([*range(40), None], _library(ChunkEncoder(WORD), [text] * 40 + ["a b c"]), strict=True)})


def test_packing_of_nothing(docs_of):
    assert packing.pack(docs_of([]), WORD, 49_408, 2).count() == 0
