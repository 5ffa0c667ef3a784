"""The registered queries: against SQL where it can say them, and the pipeline's stages."""

import math
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_judges import _numpy_verdicts
from test_pairs import _brute
from test_texts import _brute_lines
from test_tokens import WORD, _library

import __spark_entry__ as entry_point
import corpus_pipeline
from parityscope.llm import quality_rules, toxicity
from parityscope.llm.shared import written
from parityscope.llm.text_bytes import Texts
from parityscope.llm.tokens import ChunkEncoder

NAMES = [
    "op1_ann", "op2_chat_format", "op3_line_dedup", "op4_toxicity", "op5_token_files", "op6_quality_rules",
    "op7_piece_codec", "op8_quality_model", "op9_packing", "op10_ngram_join",
    "op11_exact_search", "op12_whitening", "op13_lexical_search", "pipeline",
]
WITH_SQL = ["op2_chat_format", "op3_line_dedup", "op11_exact_search", "op13_lexical_search"]


def test_registered():
    assert set(NAMES) <= set(entry_point.queries())
    assert set(WITH_SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_as_sql(spark, sf_medium, name):
    ours = entry_point.queries()[name](spark, sf_medium)
    with duckdb.connect() as duck:
        for table in ("documents", "conversations", "embeddings", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_medium}/{table}.parquet'")
        theirs = duck.sql(entry_point.oracle_sql()[name])
        expected = sorted(map(str, theirs.project(", ".join(ours.columns)).fetchall()))
    assert sorted(str(tuple(r)) for r in ours.collect()) == expected


def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "line dedup", "n-gram Jaccard join", "packing"]
    clashing = docs.withColumns({"toxicity_score": F.lit("a"), "n_words": F.lit("b"), "group": F.lit("c"), "a.b": F.lit("d")})
    table, before = clashing, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf_small).cache()
        rows = table.collect()
        ids = [r.doc_id for r in rows]
        assert table.columns == clashing.columns and len(ids) == len(set(ids)) and set(ids) <= before, name
        assert all((r["n_words"], r["group"], r["a.b"]) == ("b", "c", "d") for r in rows)
        assert name != "line dedup" or set(ids) == before
        before = set(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, table, sf_small).collect()
    assert {p.doc_id for p in pieces} == before and math.isclose(sum(p.length for p in pieces), sum({p.doc_id: p.doc_tokens for p in pieces}.values()))


def test_pipeline_is_its_stages_by_brute_force(spark, sf_small):
    """Each stage on its predecessor's rows, against the plain versions of the other tests."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)

    def after(name, table):
        return written(stages[name](spark, table, sf_small), "stage")

    def score(text):
        features = toxicity._pairs()(Texts.of(pa.array([text], pa.string())))[0][0].as_py()
        return 1 / (1 + math.exp(-sum(model.weights[f] for f in set(features)) - model.intercept))

    harmless = after("toxicity", docs)
    assert {r.doc_id for r in harmless.collect()} == {r.doc_id for r in docs.collect() if score(r.text) < 0.5}
    usual = after("quality rules", harmless)
    counts = quality_rules.with_counts(harmless, ["doc_id", "lang", "source"]).cache()
    ids = [r.doc_id for r in counts.collect()]
    assert {r.doc_id for r in usual.collect()} == {i for i, kept in zip(ids, _numpy_verdicts(counts), strict=True) if kept}
    lines = after("line dedup", usual)
    rows = [(r.doc_id, r.text) for r in usual.collect()]
    left = {doc: text for (doc, _), (text, _) in _brute_lines(rows).items()}
    assert {r.doc_id: (r.text, r.n_chars) for r in lines.collect()} == {d: (t, len(t)) for d, t in left.items()}
    first = after("n-gram Jaccard join", lines)
    order = sorted(left)
    groups = [order[g] for _, g in _brute([left[d] for d in order])]
    assert {r.doc_id for r in first.collect()} == {d for d, g in zip(order, groups, strict=True) if d == g}
    found = stages["packing"](spark, first, sf_small).collect()
    kept = sorted(r.doc_id for r in first.collect())
    tokens = _library(ChunkEncoder(WORD), [left[d] for d in kept])
    by_doc = {d: [p for p in found if p.doc_id == d] for d in kept}
    for doc, ids in zip(kept, tokens, strict=True):
        whole = np.array([*ids, 2], "<u4")
        pieces = sorted(by_doc[doc], key=lambda p: p.start)
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        assert [p.ids_crc32 for p in pieces] == [zlib.crc32(whole[p.start : p.start + p.length].tobytes()) for p in pieces]
    assert len(found) == sum(map(len, by_doc.values()))


def test_pipeline_on_odd_documents(spark, sf_small):
    """Null, empty and very long texts, rows without an id, repeated rows."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    odd = [(90_000, None), (90_001, ""), (90_002, " \n\t "), (None, "a row without an id that has some ten words in it"), (90_003, "a word " * 300_000)]
    extra = spark.createDataFrame([(i, t, None, None, None) for i, t in odd], docs.schema)
    table = docs.unionAll(extra).unionAll(docs.filter("doc_id < 5")).unionAll(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, sf_small).cache()
        assert table.columns == docs.columns, name
        assert table.count() > 0
    ids = [r.doc_id for r in table.collect()]
    assert len(ids) - ids.count(None) == len({i for i in ids if i is not None})
    pieces = corpus_pipeline.STAGES[-1][1](spark, table, sf_small).collect()
    assert {p.doc_id for p in pieces} == set(ids)


def test_pipeline_on_no_documents(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, sf_small)
    assert table.count() == 0
