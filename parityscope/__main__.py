"""Run a recidivism audit: ``spark-submit -m parityscope`` or ``python -m parityscope``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from parityscope.operators.model import FOREST_SETTINGS, TRAINING_PARTITIONS
from parityscope.plans import recidivism


#: Tables of at most so many rows are also printed, whole.
SHOWN = 40


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="parityscope", description=__doc__)
    parser.add_argument("--input", required=True, help="CSV file or folder with a header")
    parser.add_argument("--output", required=True, help="folder for tables, model and predictions")
    parser.add_argument("--train-fraction", type=float, default=0.8)
    parser.add_argument("--estimator", choices=["rf", "logreg"], default="rf")
    parser.add_argument("--attributes", nargs="+", default=list(recidivism.ATTRIBUTES))
    parser.add_argument("--trees", type=int, default=FOREST_SETTINGS["numTrees"])
    parser.add_argument("--depth", type=int, default=FOREST_SETTINGS["maxDepth"])
    parser.add_argument("--training-partitions", type=int, default=TRAINING_PARTITIONS)
    parser.add_argument("--pre-aggregate", action="store_true", help="for few attributes of few values")
    parser.add_argument("--include-lowest", action="store_true", help="a score of 0 is in the first bin")
    parser.add_argument("--null-group", choices=["exclude", "include"], default="exclude")
    parser.add_argument("--infer-schema", action="store_true", help="types from the data, in one more pass")
    parser.add_argument("--histogram-bins", type=int, default=30)
    parser.add_argument("--sample-rows", type=int, default=100)
    parser.add_argument("--shares-of", nargs="+", help="values whose shares are wanted, all by default")
    parser.add_argument("--pair", nargs=2, help="groups to compare, the two largest by default")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("parityscope").getOrCreate()
    settings = {"training_partitions": options.training_partitions}
    if options.estimator == "rf":
        settings |= {"numTrees": options.trees, "maxDepth": options.depth}
    audit = recidivism.run(
        spark,
        options.input,
        options.output,
        **({"schema": None} if options.infer_schema else {}),
        histogram_bins=options.histogram_bins,
        sample_rows=options.sample_rows,
        named_values=options.shares_of and tuple(options.shares_of),
        pair=options.pair and tuple(options.pair),
        attributes=tuple(options.attributes),
        train_fraction=options.train_fraction,
        estimator=options.estimator,
        pre_aggregate=options.pre_aggregate,
        include_lowest=options.include_lowest,
        null_group=options.null_group,
        **settings,
    )
    for name, table in audit.write_tables(options.output).items():
        rows = table.count()
        print(f"{name}: {rows} rows in {options.output}/{name}")
        if rows <= SHOWN:
            table.orderBy(*table.columns).show(SHOWN, truncate=False)


if __name__ == "__main__":
    main()
