"""CSV in (with repeated header names) and predictions out."""

from __future__ import annotations

import csv
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parityscope.functions.scores import probability_text
from parityscope.roles import require_columns

#: Different headers that the files of one folder may have.
MOST_LAYOUTS = 1_000


def _header_names(spark: SparkSession, path: str) -> list[str]:
    """Header fields as written. Spark's own parser reads one row, so quoting is honoured."""
    first = spark.read.csv(path, header=False).limit(1).first()
    if first is None:
        raise ValueError(f"no header row in {path}")
    return [name or "" for name in first]


def _first_copies(names: Sequence[str], case_sensitive: bool) -> list[int]:
    """Positions of the first copy of each header name."""
    seen: dict[str, int] = {}
    for position, name in enumerate(names):
        seen.setdefault(name if case_sensitive else name.lower(), position)
    return sorted(seen.values())


def _file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and its first line that is not empty, ``header``, in one job for all files."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    first = F.min_by("value", "at").alias("header")
    return lines.filter("start = 0 and trim(value) <> ''").groupBy("file").agg(first)


def _fields(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")]))


def _check_each_header(spark: SparkSession, path: str, written: list[str]) -> None:
    """Raise unless all files have the same header."""
    headers = _file_headers(spark, path)
    for row in headers.groupBy("header").agg(F.min("file").alias("file")).limit(MOST_LAYOUTS).collect():
        if _fields(row.header) != written:
            raise ValueError(f"the header of {row.file} differs from {written}")


def _read_layouts(
    spark: SparkSession, path: str, schema: T.StructType, optional: Collection[str], aliases: Mapping[str, str]
) -> DataFrame:
    """Rows of files whose headers differ: one job finds the headers, one scan picks each
    file's fields by the positions of its own header."""
    headers = _file_headers(spark, path)
    written = [r.header for r in headers.select("header").distinct().limit(MOST_LAYOUTS + 1).collect()]
    if not written:
        raise ValueError(f"no header row in {path}")
    if len(written) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} different headers in {path}")
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    layouts = []
    for header in written:
        names = [name.strip() or f"_c{i}" for i, name in enumerate(_fields(header))]
        layouts.append((len(names), _positions(names, schema, case_sensitive, optional, aliases)))
    on_disk = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(max(n for n, _ in layouts))])
    reader = spark.read.option("header", True).option("nullValue", "").option("enforceSchema", True).schema(on_disk)
    raw = reader.csv(path).select("*", F.col("_metadata.file_path").alias("__file"))
    if len(layouts) > 1:
        number = F.create_map(*[F.lit(v) for i, h in enumerate(written) for v in (h, i)])
        of_file = headers.select(F.col("file").alias("__file"), F.element_at(number, F.col("header")).alias("__layout"))
        raw = raw.join(of_file, "__file")
    else:
        raw = raw.withColumn("__layout", F.lit(0))
    chosen = []
    for field in schema.fields:
        value = F.lit(None).cast("string")
        for i, (_, positions) in enumerate(layouts):
            if field.name in positions:
                value = F.when(F.col("__layout") == i, F.col(f"_{positions[field.name]}")).otherwise(value)
        if any(field.name in positions for _, positions in layouts):
            chosen.append(value.try_cast(field.dataType).alias(field.name))
    return raw.select(*chosen)


def _positions(
    names: Sequence[str], schema: T.StructType, case_sensitive: bool, optional: Collection[str], aliases: Mapping[str, str]
) -> dict[str, int]:
    """Position of each field of the schema that a header has."""
    keep = _first_copies(names, case_sensitive)
    position_of = {names[i] if case_sensitive else names[i].lower(): i for i in keep}
    wanted = {}
    for field in schema.fields:
        position = position_of.get(field.name if case_sensitive else field.name.lower())
        if position is None and field.name in aliases:
            fragment = aliases[field.name].lower()
            position = next((i for i in keep if fragment in names[i].lower()), None)
        wanted[field.name] = position
    absent = [name for name, position in wanted.items() if position is None and name not in optional]
    if absent:
        raise ValueError(f"schema names {absent} are not in the header {list(names)}")
    return {name: position for name, position in wanted.items() if position is not None}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sampling_ratio: float | None = None,
    optional: Collection[str] = (),
    aliases: Mapping[str, str] | None = None,
    layouts: str = "same",
) -> DataFrame:
    """CSV with a header; empty fields, and fields of another type than declared, are null.

    Where a header name is repeated, the first copy is kept under its own name and
    the others are dropped. Header names are trimmed. All files of a folder must have
    the same header: columns are taken by position, so another order would swap them.
    Spark checks that while it reads; headers with repeated or padded names, which it
    can't check, are compared beforehand.

    With ``schema`` (fields matched to the header by name) the file is read once and
    only wanted columns are returned. A field the header lacks raises, unless it is one
    of ``optional``, or ``aliases`` gives a fragment of a header name for it; then the
    first such column is taken. Without a schema the types are inferred, which costs
    one more pass; ``sampling_ratio`` shortens that pass.

    ``layouts="by name"``, which needs a schema, reads files whose headers differ in order,
    repeats or further columns: each file's fields are found by its own header. Fields
    are then converted as by ``try_cast``; a file without an ``optional`` field has null.
    """
    if layouts not in ("same", "by name"):
        raise ValueError("layouts must be 'same' or 'by name'")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if layouts == "by name":
        if schema is None:
            raise ValueError("layouts='by name' needs a schema")
        return _read_layouts(spark, path, schema, optional, aliases or {})
    written = _header_names(spark, path)
    names = [name.strip() or f"_c{position}" for position, name in enumerate(written)]
    case_sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    keep = _first_copies(names, case_sensitive)
    tidy = len(keep) == len(names) and names == written
    if not tidy:
        _check_each_header(spark, path, written)
    on_file = names if tidy else [f"_{i}" for i in range(len(names))]
    reader = spark.read.option("header", True).option("nullValue", "").option("nanValue", "")
    reader = reader.option("enforceSchema", not tidy)

    if schema is None:
        if sampling_ratio is not None:
            reader = reader.option("samplingRatio", sampling_ratio)
        raw = reader.option("inferSchema", True).csv(path).toDF(*[f"_{i}" for i in range(len(names))])
        return raw.select([F.col(f"_{i}").alias(names[i]) for i in keep])

    wanted = _positions(names, schema, case_sensitive, optional, aliases or {})
    types = {position: schema[name].dataType for name, position in wanted.items()}
    on_disk = T.StructType([T.StructField(on_file[i], types.get(i, T.StringType())) for i in range(len(names))])
    raw = reader.schema(on_disk).csv(path)
    return raw.select([raw[f"`{on_file[i]}`"].alias(name) for name, i in wanted.items()])


def write_predictions_csv(
    predictions: DataFrame,
    path: str,
    columns: Sequence[str],
    probability: str = "probability",
    text_column: str = "probability_str",
) -> None:
    """Write ``columns`` and the class probabilities as text to a CSV directory, replacing it."""
    require_columns(predictions, [*columns, probability])
    (
        predictions.select(*columns, probability_text(predictions, probability).alias(text_column))
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
