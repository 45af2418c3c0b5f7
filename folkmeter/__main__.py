"""Commands over folders: ``python -m folkmeter build|train|ingest|payloads|eda|evaluate|status``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from folkmeter.functions.keys import load_timestamp
from folkmeter.plans import jobs
from folkmeter.session import get_session
from folkmeter.sources import store


def _raw(spark, root: str) -> dict:
    names = ("users", "posts", "comments", "communities")
    return {n: store.read_current(spark, root, n) for n in names}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="folkmeter")
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="stored tables -> silver -> gold")
    train = commands.add_parser("train", help="gold user features -> model and predictions")
    ingest = commands.add_parser("ingest", help="landed pages -> stored tables")
    payloads = commands.add_parser("payloads", help="landed API payloads -> stored tables")
    eda = commands.add_parser("eda", help="exploratory report over the silver layer")
    evaluate = commands.add_parser("evaluate", help="report over scored rows")
    status = commands.add_parser("status", help="row counts of tables and layers")
    for command in (build, ingest, payloads, status):
        command.add_argument("--store", required=True)
    for command in (build, eda, status):
        command.add_argument("--silver", required=True)
    for command in (build, train, status):
        command.add_argument("--gold", required=True)
    for command in (train, eda, evaluate):
        command.add_argument("--out", required=True)
    train.add_argument("--max-models", type=int, default=10)
    train.add_argument("--max-runtime", type=float, help="seconds; the rest is listed as skipped")
    train.add_argument("--scope", choices=("all", "cleaned"), default="all")
    evaluate.add_argument("--predictions", required=True)
    evaluate.add_argument("--method", choices=("nearest", "linear", "disc", "approx"), default="nearest")
    ingest.add_argument("--pages", required=True, help="Parquet table with url and html")
    payloads.add_argument("--communities", required=True, help="Parquet table with name and body")
    payloads.add_argument("--posts", required=True, help="Parquet table with id_post and body")
    payloads.add_argument("--profiles", required=True, help="Parquet table with name and body")
    for command in (ingest, payloads):
        command.add_argument("--batch", type=int, required=True, help="number of this load: 1, 2, ...")
        command.add_argument("--writer", default=store.WRITER, help="name of whoever numbers the loads")
        command.add_argument("--max-posts", type=int, help="per page; default: all")
        command.add_argument("--max-comments", type=int, help="per page; default: all")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = _parser().parse_args(argv)
    spark = get_session()
    if options.command == "build":
        print(json.dumps(jobs.build(spark, _raw(spark, options.store), options.silver, options.gold)))
    elif options.command == "train":
        result = jobs.train(
            spark,
            options.gold,
            options.out,
            scope=options.scope,
            max_models=options.max_models,
            max_runtime_secs=options.max_runtime,
        )
        print(json.dumps(result))
    elif options.command in ("ingest", "payloads"):
        limits = {"max_posts": options.max_posts, "max_comments": options.max_comments}
        place = (spark, options.store, options.batch)
        if options.command == "ingest":
            pages = spark.read.parquet(options.pages).select("url", "html")
            now = F.current_timestamp()
            counts = jobs.ingest_pages(*place, pages, now, load_timestamp(), options.writer, **limits)
        else:
            landed = {n: spark.read.parquet(getattr(options, n)) for n in ("communities", "posts", "profiles")}
            counts = jobs.ingest(*place, load_timestamp(), options.writer, **landed, **limits)
        print(json.dumps(counts))
    elif options.command == "eda":
        print(json.dumps(jobs.eda(spark, options.silver, options.out)))
    elif options.command == "evaluate":
        print(json.dumps(jobs.evaluate(spark, options.predictions, options.out, options.method)))
    else:
        report = jobs.status(spark, options.store, options.silver, options.gold)
        for name, frame in report.items():
            print(name)
            frame.show(truncate=False)


if __name__ == "__main__":
    main()
