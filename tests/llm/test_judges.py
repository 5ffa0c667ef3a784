"""Quality rules and the two classifiers."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parityscope.llm import labelled, quality_model, quality_rules, toxicity
from parityscope.llm.text_bytes import Texts


@pytest.fixture(scope="module")
def corpus(docs_of, draw):
    """Usual texts of two sources, and some unlike them at the end."""
    words = [f"{a}{b}" for a in ("sun", "mo", "star", "riv", "ston") for b in ("a", "el", "ing", "ed", "ow", "er")] * 30
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)]
    usual = [" ".join(draw.choice(words, int(draw.integers(40, 160)))) for _ in range(500)]
    odd = [t.upper() for t in usual[:3]] + [t.replace(" ", " ### ") for t in usual[3:6]] + ["too short", "", None, " ".join(["again and again and on"] * 20)]
    texts = [*usual, *odd]
    return docs_of(
        texts,
        lang=["en" if i % 2 else None for i in range(len(texts))],
        source=["a" if i % 4 < 3 else None for i in range(len(texts))],
        distance=[str(i) for i in range(len(texts))],
    )


def test_quality_rules(corpus):
    rows = {r.doc_id: r for r in quality_rules.judge(corpus.repartition(3)).collect()}
    assert len(rows) == 510
    assert np.mean([rows[i].kept for i in range(500)]) > 0.99
    assert not any(rows[i].kept for i in range(500, 510))
    assert [rows[i].base_failed for i in range(500, 510)] == [False] * 6 + [True] * 4


def test_accepted_keeps_columns(corpus):
    kept = quality_rules.accepted(corpus)
    assert kept.columns == corpus.columns
    judged = {r.doc_id for r in quality_rules.judge(corpus).filter("kept").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == judged and all(r.distance == str(r.doc_id) for r in rows)


def _rank(values, share):
    return np.sort(values, axis=0)[max(int(np.ceil(share * len(values))), 1) - 1]


def _numpy_verdicts(counts):
    """The whole method on the rows of a table of counts: whether each one is kept."""
    q = quality_rules
    floor = np.diag(np.square(list(q.FEATURES.values())))
    rows = counts.select("lang", "source", (~q._failed()).alias("passed"), *[c.alias(f) for f, c in q._features().items()]).collect()
    passed, x = np.array([r.passed for r in rows]), np.array([tuple(r)[3:] for r in rows])
    estimates = {}

    def distances(rows, location, covariance):
        off = rows - location
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off)

    def step(rows, location, covariance):
        distance = distances(rows, location, covariance)
        near = rows[distance <= _rank(distance, q.H)]
        return near.mean(0), q._CONSISTENCY * np.cov(near.T, bias=True).reshape(8, 8) + floor, len(near)

    def estimate(rows):
        middle = _rank(rows, 0.5)
        scale = np.sqrt((1.4826 * _rank(np.abs(rows - middle), 0.5)) ** 2 + np.diag(floor))
        z = (rows - middle) / scale
        length = np.sqrt((z**2).sum(1))
        unit = z[length > 0] / length[length > 0, None]
        starts = [(middle, np.diag(scale**2)), (middle, np.outer(scale, scale) * (unit.T @ unit) * 8 / max(len(unit), 1) + floor)]
        found = []
        for start in starts:
            for _ in range(q.FIRST_STEPS):
                start = step(rows, *start[:2])
            found.append(start)
        best = min(found, key=lambda s: np.linalg.slogdet(s[1])[1])
        for _ in range(40):
            best = step(rows, *best[:2])
        return best

    for key in {k for r, p in zip(rows, passed, strict=True) if p for k in ((r.lang, r.source), (r.lang,), ())}:
        own = np.array([p and (r.lang, r.source)[: len(key)] == key for r, p in zip(rows, passed, strict=True)])
        estimates[key] = estimate(x[own])
    kept = []
    for r, p, values in zip(rows, passed, x, strict=True):
        found = None
        for key in ((), (r.lang,), (r.lang, r.source)) if p else ():
            location, covariance, n = estimates[key]
            if found:
                own = n / (n + q.PRIOR_ROWS)
                covariance = own * covariance + (1 - own) * found[1]
                location = own * location + (1 - own) * found[0]
            found = location, covariance
        kept.append(bool(p) and distances(values[None], *found)[0] <= q.CUT)
    return kept


def test_quality_rules_are_those_of_numpy(spark, sf_medium, monkeypatch):
    counts = quality_rules.with_counts(spark.read.parquet(f"{sf_medium}/documents.parquet"), ["doc_id", "lang", "source"]).cache()
    want = dict(zip([r.doc_id for r in counts.collect()], _numpy_verdicts(counts), strict=True))
    assert 0 < sum(want.values()) < len(want)
    for few in (10_000, 0):  # estimates by broadcast, and by a salted join
        monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", few)
        found = quality_rules.judged(counts, quality_rules.estimates(counts)).collect()
        assert {r.doc_id: r.kept for r in found} == want


def test_small_sources_are_judged_each_by_itself(docs_of, draw):
    """Sources of 150 texts with digits in them, among sources without."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts, sources = [], []
    for source in range(20):
        for _ in range(150):
            text = draw.choice(words, 60).tolist()
            if source < 10:
                text[::2] = [str(draw.integers(100, 999)) for _ in text[::2]]
            texts.append(" ".join(text))
            sources.append(f"s{source}")
    texts += texts[:3] + texts[1500:1503]
    sources += ["s15"] * 3 + ["s5"] * 3
    rows = quality_rules.judge(docs_of(texts, lang=["en"] * len(texts), source=sources)).collect()
    far = {r.doc_id: r.distance for r in rows}
    assert all(r.kept for r in rows if r.doc_id < 3000) and not any(r.kept for r in rows if r.doc_id >= 3000)
    assert min(far[i] for i in range(3000, 3006)) > 10 * max(far[i] for i in range(3000))


def test_quality_rules_on_a_long_text_and_repeated_rows(docs_of, draw):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    texts = [" ".join(draw.choice(words, 80)) for _ in range(40)] + [" ".join(draw.choice(words, 700_000))]
    docs = docs_of(texts, lang=["en"] * 41, source=["a"] * 41)
    rows = quality_rules.judge(docs.unionAll(docs.filter("doc_id < 3")).repartition(3)).collect()
    assert len(rows) == 44 and {r.n_words for r in rows} == {80, 700_000}
    for i in range(3):
        assert len({(r.kept, r.distance) for r in rows if r.doc_id == i}) == 1


def test_chi_square():
    assert abs(quality_rules._chi_square(15.507, 8) - 0.95) < 1e-4
    assert abs(quality_rules._quantile(0.99, 4) - 13.277) < 1e-3


def test_few_rows_are_judged_by_the_base_rules(docs_of):
    texts = ["a b c d e f g h i j k l", "###" * 50, None]
    docs = docs_of(texts, lang=["x", None, "y"], source=[None, None, None])
    assert {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()} == {0: True, 1: False, 2: False}
    empty = docs.filter("doc_id < 0")
    assert quality_rules.judge(empty).count() == 0 and quality_rules.accepted(empty).count() == 0


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def marked(spark, docs_of, draw):
    words = [f"w{i}" for i in range(300)]
    words = [w.translate(str.maketrans("0123456789", "abcdefghij")) for w in words]
    texts, labels = [], []
    for i in range(900):
        text = draw.choice(words, int(draw.integers(20, 300))).tolist()
        bad = i % 3 == 0
        if bad:
            text[int(draw.integers(0, len(text)))] = "vile" + str(draw.choice(["ness", "ly", "st", ""]))
        quality = int(i % 4 > 0)
        if not quality:
            text = [w + "$$%" for w in text]
        texts.append(" ".join(text))
        labels.append((i, quality, int(bad), "clash"))
    docs = docs_of([*texts, "", None, texts[0]], score=[str(i) for i in range(903)])
    return docs, _labels(spark, [*labels, (5, None, None, "x"), (None, 1, 1, "x"), (9999, 0, 1, "x")])


@pytest.mark.parametrize("model, label", [(toxicity, "toxic"), (quality_model, "quality")])
def test_classifiers_on_held_out_rows(marked, model, label):
    docs, labels = marked
    rows = {r.doc_id: r for r in model.score(docs.repartition(3), labels).collect()}
    assert len(rows) == 903 and all(0 <= r.score <= 1 for r in rows.values())
    truth = {r.doc_id: r[label] for r in labels.collect() if r[label] is not None and r.doc_id is not None and r.doc_id < 900}
    held = [i for i, r in rows.items() if r.held_out and i in truth]
    assert 120 < len(held) < 240
    assert np.mean([rows[i].predicted == truth[i] for i in held]) > 0.95
    assert rows[900].score == rows[901].score and rows[902].score == rows[0].score
    limit = 0.5 if label == "toxic" else 0.3
    assert all(r.predicted == (r.score >= limit) for r in rows.values())


def _plain_quality(model, text):
    """The score of one text, passage by passage."""
    x, _ = quality_model.passages(Texts.of(pa.array([text], pa.string())))
    p, logits, codes = model.layers, [], []
    for row in (x - model.center) / model.scale:
        h = np.tanh(row @ p["W"] + p["b"])
        codes.append(h)
        logits.append(float(p["a"] @ (np.tanh(p["V"].T @ h) / (1 + np.exp(-(p["U"].T @ h))))))
    weights = [np.exp(v - max(logits)) for v in logits]
    z = sum(w * h for w, h in zip(weights, codes, strict=True)) / sum(weights)
    return 1 / (1 + np.exp(-float(z @ p["c"] + p["d"])))


def test_quality_scores_are_those_of_plain_numpy(marked, monkeypatch):
    """Fit and scores by Spark against a fit on all labelled rows in order, and a loop over passages."""
    docs, labels = marked
    texts = {r.doc_id: r.text for r in docs.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in texts and r.quality is not None}
    held = {r.doc_id for r in docs.filter(labelled.held_out(F.col("doc_id"))).collect()}
    used = sorted(i for i in truth if i not in held)
    x, ends = quality_model.passages(Texts.of(pa.array([texts[i] for i in used], pa.string())))
    plain = quality_model.fit_passages(x, ends, np.array([truth[i] for i in used]), float(np.mean([truth[i] for i in used])))
    for r in quality_model.score(docs.repartition(4), labels).collect():
        assert abs(r.score - _plain_quality(plain, texts[r.doc_id])) < 1e-4


def test_toxicity_scores_are_those_of_plain_numpy(marked):
    docs, labels = marked
    model = toxicity.fit(docs.repartition(4), labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r.score for r in toxicity.with_scores(docs.select("doc_id", "text"), model).collect()}
    for i, text in list(texts.items())[::37]:
        features = toxicity._pairs()(Texts.of(pa.array([text], pa.string())))[0][0].as_py()
        logit = sum(model.weights[f] for f in set(features)) + model.intercept
        assert abs(found[i] - 1 / (1 + np.exp(-logit))) < 1e-9


@pytest.mark.parametrize("model", [toxicity, quality_model])
def test_classifiers_on_a_long_text(marked, model):
    docs, labels = marked
    long = docs.filter("doc_id < 1").withColumns({"doc_id": F.lit(5000).cast("long"), "text": F.repeat(F.lit("some usual words and more "), 200_000)})
    rows = model.score(docs.unionAll(long), labels.unionAll(labels.filter("doc_id = 4").withColumn("doc_id", F.lit(5000).cast("long")))).collect()
    assert len(rows) == 904 and all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("model", [toxicity, quality_model])
def test_classifiers_without_rows_or_labels(spark, docs_of, model):
    labels = _labels(spark, [])
    assert model.score(docs_of([]), labels).count() == 0
    assert [r.score for r in model.score(docs_of(["a b", None]), labels).collect()] == [0.5, 0.5]


def test_held_out_is_the_remainder_of_the_checksum(spark):
    import zlib

    rows = spark.range(200).select("id", labelled.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_swapped_terms():
    assert toxicity.swap_terms("Women and muslims met") == "Men and christians met"
    assert toxicity.swap_terms("no such names, womenfolk") == "no such names, womenfolk"


def test_swapped_terms_in_letters_of_old_prints():
    assert toxicity.swap_terms("\u017fhe and the Mu\u017flim") == "he and the Christian"
    assert toxicity.swap_terms("chr\u0130stian g\u0131rl blac\u212a") == "chr\u0130stian g\u0131rl white"


def _fitted(penalty):
    """Labels that go with a group's name by accident, besides a truly toxic word."""
    draw = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(600):
        text = ["plain", "words", *draw.choice(["here", "there", "and", "so"], 6)]
        toxic = i % 2
        if toxic and draw.random() < 0.6:
            text.append("vile")
        text.append("muslims" if draw.random() < (0.8 if toxic else 0.2) else "christians")
        texts.append(" ".join(text))
        labels.append(toxic)
    features, swapped, named = toxicity._pairs()(Texts.of(pa.array(texts)))
    table = pa.table({"features": features, "swapped": swapped, "named": named, "label": pa.array(labels, pa.int32())})
    model = toxicity.fit_lists(table, 0.5, penalty)
    return model.scores(Texts.of(pa.array(["words about muslims here", "words about buddhists here", "words so vile"])))


def test_counterfactual_penalty_spares_neutral_mentions():
    without, with_pairs = _fitted(0.0), _fitted(toxicity.PENALTY)
    assert without[0] - without[1] > 0.1
    assert abs(with_pairs[0] - with_pairs[1]) < 0.5 * (without[0] - without[1])
    assert with_pairs[2] > 0.6


def test_attention_slopes():
    """Slopes of the network equal differences of its loss."""
    draw = np.random.default_rng(0)
    model = quality_model.Model(0.5)
    model.layers = {k: draw.normal(size=s) for k, s in {"W": (47, 3), "b": 3, "V": (3, 2), "U": (3, 2), "a": 2, "c": 3, "d": ()}.items()}
    x, ends, labels = draw.normal(size=(7, 47)), np.array([0, 2, 3, 7]), np.array([1, 0, 1])

    def loss():
        s = model.forward(x, ends)["score"]
        return -(labels * np.log(s) + (1 - labels) * np.log(1 - s)).sum()

    found = model.forward(x, ends)
    slopes = model.backward(found, found["score"] - labels, ends)
    for name in "WVUac":
        at = tuple(0 for _ in model.layers[name].shape)
        model.layers[name][at] += 1e-6
        high = loss()
        model.layers[name][at] -= 2e-6
        low = loss()
        model.layers[name][at] += 1e-6
        assert abs((high - low) / 2e-6 - slopes[name][at]) < 1e-4
