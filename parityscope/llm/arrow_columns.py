"""Columns computed from a batch's texts and put beside all columns of the table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.llm.text_bytes import Texts, slices

def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, for use in expressions."""
    return "`" + name.replace("`", "``") + "`"


def aside(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """Columns that an operator does not use, renamed so that they clash with nothing, and
    a function that gives a table its first columns back, and further ones behind them."""
    others = {c: f"aside_{i}" for i, c in enumerate(docs.columns) if c not in used}
    moved = docs.select(*[F.col(quoted(c)).alias(others.get(c, c)) for c in docs.columns])

    def restore(result: DataFrame, *added: str) -> DataFrame:
        return result.select(*[F.col(quoted(others.get(c, c))).alias(c) for c in docs.columns], *[a for a in added if a not in docs.columns])

    return moved, restore


TextFunction = Callable[[Texts], list[pa.Array]]


def with_text_columns(
    docs: DataFrame, fields: dict[str, str], make: Callable[[], TextFunction], keep: list[str] | None = None
) -> DataFrame:
    """Add ``fields`` (name to type) that a function of the texts gives.

    ``make`` runs once in each task. ``keep`` names the columns carried along, all by
    default. A column of the table with the name of a field is replaced by it.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in fields]
    # Numbered on the way, as names may hold dots, which Python functions can't take.
    sent = kept if "text" in kept else [*kept, "text"]
    source = docs.select(*[F.col(quoted(c)).alias(f"kept_{i}") for i, c in enumerate(sent)])
    schema = T.StructType(list(source.schema.fields[: len(kept)]))
    text = f"kept_{sent.index('text')}"
    for i, kind in enumerate(fields.values()):
        schema = schema.add(f"added_{i}", T.StructType.fromDDL(f"x {kind}")[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for piece in slices(batch, text):
                columns = piece.columns[: len(kept)] + function(Texts.of(piece.column(text)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema).toDF(*kept, *fields)
