"""The n-gram join and the nearest neighbours, against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parityscope.llm import ann, components, ngram_join
from parityscope.llm.text_bytes import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _brute(texts):
    sets, group = [_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [(len(s), g) for s, g in zip(sets, group, strict=True)]


@pytest.fixture(scope="module")
def copies(draw):
    """Texts with exact and near copies at all similarities, and a passage that many share."""
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", "  \n", "One two", "one  TWO", "one two three", "A b c d e", "a B c d e"]
    passage = draw.choice(words, 12).tolist()
    for _ in range(12):
        base = draw.choice(words, int(draw.integers(8, 160))).tolist()
        for _ in range(8):
            changed = base.copy()
            for at in draw.integers(0, len(base), int(draw.integers(0, 5))):
                changed[at] = str(draw.choice(words))
            texts.append(" ".join(changed))
    texts += [" ".join([*passage, *draw.choice(words, 4).tolist()]) for _ in range(60)]
    hot = draw.choice(words, 60).tolist()
    texts += [" ".join([*hot[:i], "x", *hot[i + 1 :]]) for i in range(60)]
    return texts


def test_ngram_join(docs_of, copies):
    rows = ngram_join.linked(docs_of(copies, text_2=["x"] * len(copies)).repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == dict(enumerate(_brute(copies)))


def test_ngram_join_rows_of_one_id(spark, docs_of, copies):
    docs = docs_of(copies)
    extra = docs.filter("doc_id = 20").unionAll(docs.filter("doc_id = 30").withColumn("doc_id", F.lit(None).cast("long")))
    rows = ngram_join.linked(docs.unionAll(extra)).collect()
    want = _brute(copies)
    assert len(rows) == len(copies) + 2
    for r in rows:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id][1])


def test_first_of_each(docs_of, copies):
    docs = docs_of(copies, component_id=["x"] * len(copies), kept_id=["y"] * len(copies))
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {g for _, g in _brute(copies)}


def test_ngram_join_of_nothing(docs_of):
    assert ngram_join.linked(docs_of([])).count() == 0


def test_ngram_join_of_long_texts(docs_of, draw):
    words = [f"w{i}" for i in range(5000)]
    long = draw.choice(words, 300_000).tolist()
    other = [*long[:150_000], "changed", *long[150_001:]]
    half = long[:150_000]
    rows = ngram_join.linked(docs_of([" ".join(half), " ".join(long), " ".join(other), "short text of only six words"])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {0: 0, 1: 1, 2: 1, 3: 3}
    assert {r.doc_id: r.n_shingles for r in rows}[1] == len(_set(" ".join(long)))


def test_ngram_join_with_a_run_in_very_many_documents(docs_of, draw):
    """A run that a tenth of 20,000 short documents share links none of them."""
    texts = [" ".join(f"w{v}" for v in row) for row in draw.integers(0, 10**6, (20_000, 9))]
    texts = [f"as was said many times {t}" if i % 10 == 0 else t for i, t in enumerate(texts)]
    texts += [texts[0], texts[10] + " more"]
    found = {r.doc_id: r.component_id for r in ngram_join.linked(docs_of(texts).repartition(8)).collect()}
    assert {i for i, c in found.items() if c != i} == {20_000, 20_001}
    assert (found[20_000], found[20_001]) == (0, 10)


def test_run_counts_are_packed_for_the_driver(docs_of, draw):
    """The 8 MB of all cells neither pass the driver nor go to the tasks as they are."""
    texts = [" ".join(f"w{v}" for v in row) for row in draw.integers(0, 50, (300, 12))] + ["", None, "a b", "a b"]
    blocks = ngram_join.run_counts(docs_of(texts).repartition(3))
    assert sum(map(len, blocks.values())) < 200_000
    sets = list(ngram_join.shingle_sets(Texts.of(pa.array(texts, pa.string()))))
    plain = np.bincount(ngram_join._cells(np.concatenate(sets)), minlength=1 << ngram_join.CELL_BITS)
    assert (ngram_join._unpacked(blocks) == plain).all()
    assert not ngram_join._unpacked(ngram_join.run_counts(docs_of([]))).any()


def test_prefix_shares_enough(draw):
    """Similar sets share as many runs of their prefixes as the longer match asks."""
    counts = draw.integers(0, 50, 1 << ngram_join.CELL_BITS)
    for _ in range(200):
        n = int(draw.integers(2, 60))
        whole = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
        fewer = np.delete(whole, draw.integers(0, len(whole), int(0.1 * n)))
        pairs = [ngram_join._prefix(s, counts, 5.0) for s in (whole, fewer)]
        if len(fewer) >= 0.8 * len(whole):
            wanted = max(m for _, m, _ in pairs)
            first = [p[: len(s) - ngram_join._least_overlap(len(s)) + wanted] for s, (p, _, _) in zip((whole, fewer), pairs, strict=True)]
            assert len(set(first[0].tolist()) & set(first[1].tolist())) >= wanted


def test_components(spark, draw):
    links = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(400 + i, 401 + i) for i in range(40)]
    group = {n: n for n in {n for link in links for n in link}}
    for a, b in links:
        low, high = sorted((group[a], group[b]))
        group = {n: low if g == high else g for n, g in group.items()}
    found = components.connected(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.node: r.component for r in found} == {n: g for n, g in group.items() if any(n in x and x[0] != x[1] for x in links)}


def _nearest(ids, x, k):
    out = {}
    for i, q in enumerate(x):
        if ids[i] % 20 == 0:
            scores = sorted((-float(np.dot(q, x[j])), ids[j]) for j in range(len(x)) if ids[j] != ids[i])[:k]
            out[ids[i]] = scores
    return out


def _search(spark, rows, k=20):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    found = {}
    for r in ann.search(table, lambda c: c % 20 == 0, k).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return found


def test_ann_recall_and_scores(spark, draw):
    x = draw.normal(size=(1500, 24)) * draw.uniform(0.2, 3, (1500, 1))
    found = _search(spark, [(i, v.tolist(), "x") for i, v in enumerate(x)])
    want = _nearest(range(1500), x, 20)
    assert set(found) == set(want)
    hits = sum(len({v for _, v, _ in found[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, rows in found.items():
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)
        assert all(abs(s - np.dot(x[q], x[v])) < 1e-9 for _, v, s in rows)


def test_ann_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 0.0], "x") for i in range(100)] + [(i, [0.0, 1.0], None) for i in range(100, 130)]
    rows += [(20, [1.0, 0.0], "x"), (200, None, "x"), (220, [0.0, 0.0], "x"), (240, [float("nan"), 1.0], "x"), (260, [1.0, None], "x")]
    rows += [(280, [float("inf"), 1.0], "x"), (300, [], "x"), (320, [1.0, 2.0, 3.0], "x"), (None, [1.0, 1.0], "x")]
    found = _search(spark, rows)
    assert set(found) == {0, 20, 40, 60, 80, 100, 120}
    for q, near in found.items():
        same = [i for i in (range(100) if q < 100 else range(100, 130)) if i != q][:20]
        assert [v for _, v, _ in near] == same and {s for _, _, s in near} == {1.0}


def test_ann_few_or_no_candidates(spark):
    assert _search(spark, []) == {}
    assert _search(spark, [(0, [1.0], "x")]) == {}
    assert [v for _, v, _ in _search(spark, [(0, [1.0], "x"), (1, [2.0], "x"), (2, [-1.0], "x")])[0]] == [1, 2]


def test_ngram_join_several_texts_of_one_id(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(words[:-1]), " ".join(words[::-1])
    rows = [(5, a), (3, b), (3, c), (9, c), (7, "x y z"), (7, "q r s")]
    found = {r.component_id for r in ngram_join.linked(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id <> 7").collect()}
    assert found == {3}


def test_blocks_find_the_links_of_brute_force(draw):
    sets = []
    for _ in range(30):
        base = np.unique(draw.integers(0, 2**62, 40))
        sets += [np.sort(np.concatenate((base[int(draw.integers(0, 8)) :], draw.integers(0, 2**62, 2)))) for _ in range(int(draw.integers(1, 30)))]
    similar = ngram_join._similar(sets)
    for i in range(0, len(sets), 7):
        for j in range(len(sets)):
            shared = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            assert similar[i, j] == (100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared))
