import numpy as np
import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from texts, with an extra column and nulls beside them."""

    def make(texts, **columns):
        rows = [(i, t, *(columns[c][i] for c in columns)) for i, t in enumerate(texts)]
        schema = "doc_id long, text string" + "".join(f", {c} {_kind(columns[c])}" for c in columns)
        return spark.createDataFrame(rows, schema)

    return make


def _kind(values):
    known = [v for v in values if v is not None]
    return "string" if not known or isinstance(known[0], str) else "long"


@pytest.fixture(scope="session")
def draw():
    return np.random.default_rng(3)
