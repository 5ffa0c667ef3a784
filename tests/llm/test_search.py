"""Exact search, lexical search and whitening, against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parityscope.llm import exact_search, lexical_search, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute_ranks(docs, items, k=10):
    terms = [_terms(t) for _, t in docs]
    n_docs, total = sum(map(bool, terms)), sum(map(len, terms))
    counts = [Counter(t) for t in terms]
    df = Counter(t for c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    found = []
    for item, text in dict.fromkeys(items):
        asked, ranked = Counter(_terms(text)), []
        for (doc, _), own, c in zip(docs, terms, counts, strict=True):
            m = 25 + 75 * len(own) * n_docs // total if own else 0
            score = sum(r * weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in asked.items() if t in c)
            if score > 0:
                ranked.append((-score, doc is None, doc, score))
        ranked.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        found += [(item, i + 1, r[2], r[3]) for i, r in enumerate(ranked[:k])]
    return found


def _ranks(spark, docs, items, **columns):
    docs = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("x"), "shard": F.lit("y")})
    items = spark.createDataFrame(items, "item_id long, text string").withColumns({"rank": F.lit("x"), "first": F.lit("y")})
    return [tuple(r) for r in lexical_search.search(docs.repartition(5), items).collect()]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], str(r[2]), r[3]))


@pytest.fixture(params=[200, 3 << 20])
def shard_bytes(request, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", request.param)


def test_lexical_search(spark, draw, shard_bytes):
    words = [f"w{i}" for i in range(60)] + ["Émile", "über", "日本", "x1"]
    rare = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(draw.choice(words, n, p=rare / rare.sum()).tolist())
    docs = [(i, text(int(draw.integers(0, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(5, docs[9][1]), (5, docs[9][1]), (None, docs[7][1]), (None, "w1 w1 w2"), (2000, None), (2001, ""), (2002, "--- !!"), (2003, text(20_000))]
    docs += [(2004, "W1-w2_w3.W4\x00w5\tW6'w7"), (2005, "ÉMILE émile Émile"), (-3, "w1")]
    items = [(i, text(int(draw.integers(1, 30)))) for i in range(12)] + [(20, "w1 w1 W1 w1"), (21, "nowhere"), (22, None), (23, ""), (24, docs[7][1])]
    items += [(24, docs[7][1]), (None, "w3 émile"), (25, "w2,w3;Émile"), (26, text(5000))]
    assert _order(_ranks(spark, docs, items)) == _order(_brute_ranks(docs, items))


def test_lexical_search_in_blocks_of_items(spark, draw, monkeypatch):
    monkeypatch.setattr(lexical_search, "TERMS_AT_A_TIME", 3)
    docs = [(i, " ".join(f"w{j}" for j in draw.integers(0, 9, 12))) for i in range(50)]
    items = [(i, f"w{i % 9} w{i % 4} w{i % 5}") for i in range(8)]
    assert _order(_ranks(spark, docs, items)) == _order(_brute_ranks(docs, items))


def test_lexical_search_of_nothing(spark):
    assert _ranks(spark, [], [(1, "a")]) == [] and _ranks(spark, [(1, "a")], []) == []
    assert _ranks(spark, [(1, None)], [(1, "a")]) == [] and _ranks(spark, [(1, "a b"), (2, "b")], [(1, None)]) == []


def test_lexical_index_is_read_by_few_shards(spark, monkeypatch):
    """One task writes all shards; a reader of them must not hold them all."""
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", 1 << 18)
    draw, before = np.random.default_rng(5), spark.conf.getAll
    rows = [(i, " ".join(map(str, draw.integers(0, 10**9, 4000)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = lexical_search.build(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert sum(m.num_rows for m in files) > 40 and all(m.num_row_groups == m.num_rows for m in files)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n_bytes"])

    read = [r.n_bytes for r in index.coalesce(1).mapInArrow(sizes, "n_bytes long").collect()]
    assert sum(read) > 40 << 19 and max(read) < 6 << 20
    items = spark.createDataFrame([(1, rows[7][1][:50])], "item_id long, text string")
    found = lexical_search.search(docs, items)
    assert found.first().doc_id == 7 and found.sparkSession is spark and spark.conf.getAll == before


def _top(rows, k=5, scale=256):
    good = {(i, tuple(math.floor(scale * c) for c in v)) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    lengths = Counter(len(v) for _, v in good)
    dim = min(lengths, key=lambda n: (-lengths[n], n)) if lengths else 0
    good = [r for r in good if len(r[1]) == dim]
    found = []
    for q, x in good:
        if q % 50 == 0:
            ranked = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q)[:k]
            found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return sorted(found)


def _found_top(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, key string")
    return sorted(tuple(r) for r in exact_search.search(table, lambda c: c % 50 == 0).collect())


@pytest.mark.parametrize("first", [16, 8192])
def test_exact_search(spark, draw, monkeypatch, first):
    monkeypatch.setattr(exact_search, "FIRST", first)
    monkeypatch.setattr(exact_search, "VECTORS", 300)
    x = draw.normal(size=(1200, 12)) * draw.uniform(0.1, 2, (1200, 1))
    x[700:720] = x[0]  # ties with a query
    x[720:800] = np.round(x[720:800])
    x[50], x[100, 3] = 0, 500.0  # everything ties; one component far out
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(60, x[60].tolist()), (2000, None), (2050, [float("nan")] * 12), (2100, [None] * 12), (2150, [float("inf")] * 12), (2200, []), (2250, [1.0]), (None, x[5].tolist())]
    assert _found_top(spark, [(*r, "x", None) for r in rows]) == _top(rows)


def test_exact_search_of_few(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0]), (2, [-1.0])], [(50, []), (3, [])], [(0, [1.0, 0.0])] * 3 + [(i, [0.0, 1.0]) for i in range(1, 9)]):
        assert _found_top(spark, [(*r, "x", "y") for r in rows]) == _top(rows)


def test_exact_search_of_large_numbers(spark):
    rows = [(i, [float(2**16 * (i + 1)), 3.0 * i]) for i in range(60)]
    assert _found_top(spark, [(*r, "x", None) for r in rows]) == _top(rows)
    with pytest.raises(OverflowError):
        _found_top(spark, [(0, [1e12], "x", None), (1, [1e12], "x", None)])


def test_bounds_hold(draw):
    low = np.sort(draw.integers(-200, 200, (6, 9)), axis=1)
    high = low + draw.integers(0, 30, low.shape)
    cells = draw.integers(0, 9, (40, 6)).astype(np.uint8)
    x = np.stack([[draw.integers(low[d, c], high[d, c] + 1) for d, c in enumerate(row)] for row in cells])
    q = draw.integers(-100, 100, (15, 6)).astype(float)
    lower, upper = exact_search.bounds(cells, q, low, high)
    assert (lower <= q @ x.T).all() and (q @ x.T <= upper).all()


def test_secular_roots(draw):
    for n in (1, 2, 3, 8, 40):
        for _ in range(20):
            d = np.unique(np.sort(draw.normal(size=n) ** 2 * 10.0 ** draw.integers(-6, 6, n)))
            w = draw.uniform(0.01, 1, len(d)) * 10.0 ** draw.integers(-6, 4, len(d))
            roots, _ = whitening.secular_roots(d, w)
            want = np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(w, w)))
            assert np.abs(roots - want).max() <= 1e-12 * len(d) * want.max()


@pytest.mark.parametrize("kind", ["spread", "low rank", "repeated", "equal spectrum"])
def test_spectrum_of_parts(draw, kind):
    x = draw.normal(size=(400, 10))
    if kind == "low rank":
        x = x[:, :3] @ draw.normal(size=(3, 10)) + 1e6
    elif kind == "repeated":
        x = np.repeat(x[:5], 60, axis=0)
    elif kind == "equal spectrum":
        x = np.concatenate([np.eye(10), -np.eye(10)] * 5)
    parts = []
    for rows in np.array_split(x, 3):
        parts.append(whitening.Spectrum.empty(10))
        for v in rows:
            parts[-1].add(v)
    for part in parts[1:]:
        parts[0].combine(part)
    found, off = parts[0], x - x.mean(0)
    assert found.n == len(x) and np.allclose(found.mean, x.mean(0))
    assert np.abs(found.vectors.T @ found.vectors - np.eye(10)).max() < 1e-11
    assert np.abs(found.vectors * found.values @ found.vectors.T - off.T @ off).max() <= 1e-8 * np.abs(off.T @ off).max()


def _whitened(spark, rows, components=32):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n string")
    return whitening.whiten(table.repartition(6), components).collect()


def test_whitening(spark, draw):
    x = draw.normal(size=(700, 40)) * np.linspace(0.2, 3, 40) @ np.linalg.qr(draw.normal(size=(40, 40)))[0]
    rows = [(i, v.tolist(), "a", None) for i, v in enumerate(x)]
    rows += [(3, x[3].tolist(), "a", "b"), (None, x[4].tolist(), "a", "b")]
    odd = [(800, None, "a", "b"), (801, [None] * 40, "a", "b"), (802, [float("inf")] * 40, "a", "b"), (803, [], "a", "b"), (804, [1.0] * 3, "a", "b")]
    found = _whitened(spark, rows + odd)
    ints = np.floor(64 * np.array([r[1] for r in rows])).astype(int) + 1_000_000
    n, total = len(ints), ints.sum(0)
    centred = ints - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = {i: int(((n * v - total) ** 2).sum()) for (i, *_), v in zip(rows, ints, strict=True)}
    assert len(found) == 32 * n
    by_component = {}
    for r in found:
        assert r.n == n and int(r.deviation) == deviation[r.vec_id] and r.identity_error < 1e-9
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
        if r.vec_id not in (3, None):
            by_component.setdefault(r.component, {})[r.vec_id] = r.whitened
    want = centred @ axes / np.sqrt(values)
    for c in range(1, 33):
        own = np.array([by_component[c][i] for i in by_component[c]])
        other = want[list(by_component[c]), c - 1]
        assert min(np.abs(own - other).max(), np.abs(own + other).max()) < 1e-8


def test_whitening_of_few(spark):
    assert _whitened(spark, []) == [] and _whitened(spark, [(1, None, "a", "b"), (2, [], "a", "b")]) == []
    one = _whitened(spark, [(1, [1.0, 2.0], "a", "b")])
    assert [(r.component, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one] == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]
    line = _whitened(spark, [(i, [float(i), 2.0 * i, 5.0], "a", "b") for i in range(9)])
    assert {(r.vec_id, r.component): r.whitened for r in line if r.component > 1 or r.vec_id == 4} == {(i, c): 0 for i in range(9) for c in (2, 3)} | {(4, 1): 0}
    assert [round(r.explained, 12) for r in sorted(line, key=lambda r: (r.vec_id, r.component))[:3]] == [1, 0, 0]


def test_whitening_of_large_deviations(spark):
    rows = [(i, [float(2**24 * i), 1.0], "a", "b") for i in range(40)]
    ints = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, *_ in rows]
    total = [sum(c) for c in zip(*ints, strict=True)]
    want = {i: sum((40 * c - s) ** 2 for c, s in zip(v, total, strict=True)) for i, v in enumerate(ints)}
    assert {r.vec_id: int(r.deviation) for r in _whitened(spark, rows)} == want
