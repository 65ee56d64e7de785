"""``python -m themewell STEP --root FOLDER --run NAME``: run one step of a pipeline."""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from themewell.plans import pipeline
from themewell.session import get_spark
from themewell.sources.stages import StageStore, with_source_ids, write_csv

STEPS = ("load", "embed", "discover", "validate", "tune", "place", "label", "report")


def main() -> None:
    parser = argparse.ArgumentParser(prog="themewell", description=__doc__)
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--root", required=True, help="folder of the stage tables")
    parser.add_argument("--run", default="main", help="name of the run")
    parser.add_argument("--input", help="Parquet table of utterances (load)")
    parser.add_argument("--id-col", help="key column of the input; without it rows are numbered as read")
    parser.add_argument("--text-col", default="instruction")
    parser.add_argument("--category-col", default="category")
    parser.add_argument("--intent-col", default="intent")
    parser.add_argument("--sample-size", type=int)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--k", type=int)
    parser.add_argument("--neighbors", type=int, help="lay the map out by so many neighbours (place)")
    parser.add_argument("--out", help="folder for CSV files (tune, report)")
    args = parser.parse_args()
    spark = get_spark()
    store = StageStore(spark, args.root, args.run)

    def read_raw():
        raw = spark.read.parquet(args.input)
        raw = raw.withColumn("id", F.col(args.id_col)) if args.id_col else with_source_ids(raw)
        columns = {"text": args.text_col, "category": args.category_col, "intent": args.intent_col}
        return raw.select("id", *[F.col(c).alias(name) for name, c in columns.items()])

    if args.step == "load":
        pipeline.load(store, read_raw, args.sample_size, args.seed, args.force)
    elif args.step == "embed":
        pipeline.embed(store, force=args.force)
    elif args.step == "discover":
        pipeline.discover(store, args.k)
    elif args.step == "validate":
        pipeline.validate(store).show(truncate=False)
        pipeline.write_summary(store, f"{args.out or store.root}/summary_{store.run_id}")
    elif args.step == "tune":
        pipeline.tune(store, f"{args.out or store.root}/sweep_{store.run_id}").show(truncate=False)
    elif args.step == "place":
        pipeline.place(store, args.neighbors)
    elif args.step == "label":
        pipeline.label(store)
    else:
        for name, table in pipeline.make_report(store).items():
            if args.out:
                write_csv(table, f"{args.out}/{name}")
            else:
                table.show()


if __name__ == "__main__":
    main()
